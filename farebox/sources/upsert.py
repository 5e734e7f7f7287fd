"""New and changed rows laid over a table."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from farebox.session import materialize


def refuse_bad_keys(key: str, sides: dict[str, DataFrame]) -> None:
    """Raise for a NULL or doubled key of a side: which row should win would not be defined. One shuffle for all sides."""
    keys = reduce(DataFrame.unionAll, [df.select(F.col(key).alias("key"), F.lit(name).alias("side")) for name, df in sides.items()])
    bad = keys.groupBy("key", "side").agg(F.count("*").alias("n")).filter((F.col("n") > 1) | F.col("key").isNull())
    first = bad.select("side").first()
    if first is not None:
        raise ValueError(f"{first['side']} has a NULL {key} or more than one row for some {key}")


def upsert(target: DataFrame, batch: DataFrame | list[DataFrame], key: str, check: bool = True, late: bool = False) -> DataFrame:
    """``target`` with the rows of ``batch`` instead of those that have their keys.

    Several batches are laid over it in turn, all in one shuffle by key. A
    column only one side has is NULL in the other's rows. NULL and doubled
    keys on any side are refused: at once, or with ``late`` by the job that
    computes the result, without a pass for it. ``check=False`` leaves that to the caller.
    """
    layers = [batch] if isinstance(batch, DataFrame) else list(batch)
    if check and not late:
        names = ["batch"] if len(layers) == 1 else [f"batch {i + 1}" for i in range(len(layers))]
        refuse_bad_keys(key, {**dict(zip(names, layers)), "target": target})
    return merged(target, layers, [key], refuse=check)


def in_partitions(df: DataFrame, by: tuple[str, ...], values: list[tuple]) -> DataFrame:
    """The rows of the named partitions, by a filter that reads no other folder."""
    def one(value: tuple) -> F.Column:
        return reduce(lambda a, b: a & b, [F.col(c) == v if v is not None else F.col(c).isNull() for c, v in zip(by, value, strict=True)])

    return df.filter(reduce(lambda a, b: a | b, map(one, values), F.lit(False)))


def merged(target: DataFrame, batch: DataFrame | list[DataFrame], key: list[str], refuse: bool = True) -> DataFrame:
    """All sides by name, of rows with the same key those of the last batch that has it.

    One shuffle by key. A NULL key, or one that a side has twice, ends the job
    that computes the result: no pass of its own looks for them. Without
    ``refuse`` they are kept, and a NULL key equals no other.
    """
    layers = [target, *([batch] if isinstance(batch, DataFrame) else batch)]
    marked = [df.withColumn("_layer", F.lit(i)) for i, df in enumerate(layers)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    own = Window.partitionBy(*key)
    null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    counted = both.withColumn("_last", F.max("_layer").over(own))
    kept = F.col("_layer") == F.col("_last")
    if refuse:
        # more rows than sides that have the key
        counted = counted.withColumns({"_sides": F.bit_or(F.expr("shiftleft(1L, _layer)")).over(own), "_all": F.count("*").over(own)})
        refused = F.raise_error(F.lit(f"a NULL {', '.join(key)}, or one that a side has more than once"))
        kept = F.when(null | (F.col("_all") > F.bit_count("_sides")), refused.cast("boolean")).otherwise(kept)
    else:
        kept = null | kept
    return counted.filter(kept).drop("_layer", "_last", "_sides", "_all")


def upsert_partitions(
    spark: SparkSession, path: str, batch: DataFrame, key: list[str], by: tuple[str, ...], moves: bool = False
) -> list[tuple]:
    """Lay ``batch`` over the Parquet table at ``path``, rewriting only the partitions it touches.

    Partitions are those of the batch's rows: a key belongs to one partition,
    as a trip does to its month. With ``moves`` keys may have changed theirs;
    then the table's key column is read too and their old partitions are
    touched as well. The new partitions are complete in the work folder before
    any old one is replaced. A table that is not there yet is begun. Returns
    the touched partitions, which are as few as the calendar has months.
    """
    batch = materialize(batch, "upsert-batch")
    touched = {tuple(r) for r in batch.select(*by).distinct().collect()}
    try:
        target = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        target = batch.limit(0)
    if moves:
        touched |= {tuple(r) for r in target.select(*key, *by).join(batch.select(*key), key, "left_semi").select(*by).distinct().collect()}
    values = sorted(touched, key=repr)
    new = materialize(merged(in_partitions(target, by, values), batch, key), "upsert-partitions")
    rows = new.hint("rebalance", *by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    if moves:
        # dynamic overwriting leaves a partition that has lost all of its rows: take those rows out by name
        left = {tuple(r) for r in new.select(*by).distinct().collect()}
        _remove_partitions(spark, path, by, [v for v in values if v not in left])
    return values


def _remove_partitions(spark: SparkSession, path: str, by: tuple[str, ...], values: list[tuple]) -> None:
    jvm = spark._jvm
    for value in values:
        folder = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(by, value, strict=True))
        place = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{folder}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
