"""DataFrame helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from farebox.session import work_dir

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# source bytes that a function of columns gets at once
SLICE_BYTES = 4 << 20


def release() -> None:
    """Give back what this process no longer uses; its allocators would keep it for a next task, next to the executor's heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only where the C library has it
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, source: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``size`` bytes of one column each, a row at least."""
    rows = max(1, batch.num_rows * size // max(1, batch.column(source).nbytes))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def mapped(df: DataFrame, run: Callable, schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` whose workers find this package where the driver found it, and keep no memory between tasks."""

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = df.sparkSession.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df.mapInArrow(released, schema)


def with_columns(df: DataFrame, source: str, added: dict[str, str], start: Callable) -> DataFrame:
    """``df`` with columns computed in Arrow batches from one of its columns.

    ``start()`` is called once per partition and returns the function that maps
    a batch's column to the new columns; it gets a large batch in slices. Columns of
    the same names are replaced; all others are passed through as they are.
    """
    kept = [f for f in df.schema.fields if f.name not in added]
    schema = T.StructType([*kept, *T.StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in added.items())).fields])
    names = [f.name for f in kept]
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in (part for whole in batches for part in slices(whole, whole.schema.get_field_index(source))):
            column = batch.column(batch.schema.get_field_index(source))
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names] + compute(column)
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, arrow, strict=True)], names=arrow.names)

    return mapped(df, run, schema)


@contextmanager
def no_shuffle_files_left(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside are removed when each is done."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, executors may be lost.

    The shuffle files of the write are of no more use and go when it is done.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    with no_shuffle_files_left(spark):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


PART_BYTES = 16 << 20


def parts_for(df: DataFrame, text: str, part_bytes: int = PART_BYTES) -> int:
    """Into how many parts to deal the texts: the session's number, or more where they have more bytes than that."""
    total = df.agg(F.sum(F.octet_length(F.col(text)).cast("bigint"))).first()[0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // part_bytes))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
