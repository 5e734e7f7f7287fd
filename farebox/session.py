"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "farebox", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; ``conf`` wins over them.

    Timestamps are read in UTC so that hours and days do not depend on the
    machine. AQE coalesces small shuffle partitions and splits skewed ones.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a temporary folder of its own: on a
    cluster a folder of one machine would lose data with that machine.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder")
    root = tempfile.mkdtemp(prefix="farebox-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`work_root`; nothing is created there yet."""
    return f"{work_root(spark)}/farebox/{label}-{uuid.uuid4().hex}"


def local_table(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A short literal table as a local relation.

    Spark knows its exact size, so it broadcasts it in a join if, and only if,
    it is below the session's threshold.
    """
    return spark.createDataFrame(pa.table(columns))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage where a value must not be computed twice. The files
    outlive any executor, and unlike a row checkpoint they keep column pruning
    and file statistics.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
