"""File layout: compaction, clustering by several keys, partitions, buckets, CSV export."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

Z_BITS = 8
CELLS_PER_FILE = 64
PART_BYTES = 256 << 20
ROWS_PER_BUCKET = 5_000_000
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARALLELISM_FIRST = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


def compact(df: DataFrame, path: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Write ``df`` in parts of about ``part_bytes`` before encoding, and read it back.

    Small parts are merged and large ones split at run time, whatever the size of the data.
    """
    spark = df.sparkSession
    wanted = {ADVISORY: str(part_bytes), PARALLELISM_FIRST: "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        df.hint("rebalance").write.mode("overwrite").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.parquet(path)


def write_balanced(df: DataFrame, path: str) -> DataFrame:
    """Write with file sizes chosen at run time: AQE merges small parts and splits large ones."""
    df.hint("rebalance").write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _as_number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType | T.TimestampType):
        return F.unix_timestamp(name).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    raise TypeError(f"{name}: cluster by numbers, dates or times, not {kind.simpleString()}")


def _interleave(ranks: list[Column], bits: int = Z_BITS) -> Column:
    """Bits of the ranks in turn, highest first: close z-values are close in every rank."""
    width = len(ranks)
    placed = [
        F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1)), bit * width + width - 1 - i)
        for bit in range(bits)
        for i, rank in enumerate(ranks)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), placed)


def _gray(i: int) -> int:
    return i ^ (i >> 1)


def _low_ones(i: int) -> int:
    return (~i & (i + 1)).bit_length() - 1


def _hilbert_table(n: int) -> list[int]:
    """The curve's steps in ``n`` dimensions: at ``state * 2**n + cell``, the next state times ``2**n`` plus the cell's place.

    Each sub-cube of ``2**n`` cells is passed in Gray-code order. A state is the corner where the curve
    enters the sub-cube and the axis along which it leaves; the first state is 0.
    """
    cells = 1 << n

    def rotated(x: int, by: int) -> int:
        return (x << by | x >> (n - by)) & (cells - 1)

    place = {_gray(i): i for i in range(cells)}
    states, table = {(0, 0): 0}, []
    todo = [(0, 0)]
    for corner, axis in todo:  # grows as states are met
        for cell in range(cells):
            at = place[rotated(cell ^ corner, n - 1 - axis)]
            enter = _gray(2 * ((at - 1) // 2)) if at else 0
            leave = _low_ones(at if at % 2 else at - 1) % n if at else 0
            after = (corner ^ rotated(enter, (axis + 1) % n), (axis + leave + 1) % n)
            if after not in states:
                states[after] = len(states)
                todo.append(after)
            table.append(states[after] * cells + at)
    return table


def _hilbert(ranks: list[Column], bits: int) -> Column:
    """Place of the cell along a Hilbert curve: one step between neighbours, unlike the jumps of a z-curve.

    One look into a constant table per bit, from the highest down, in generated code.
    """
    n = len(ranks)
    ranks = [r.cast("int") for r in ranks]
    table = F.split(F.lit(",".join(map(str, _hilbert_table(n)))), ",").cast("array<int>")
    low = (1 << n) - 1
    state, along = F.lit(0), []
    for bit in reversed(range(bits)):
        cell = reduce(
            lambda a, b: a.bitwiseOR(b),
            (F.shiftleft(F.shiftright(r, bit).bitwiseAND(F.lit(1)), i) for i, r in enumerate(ranks)),
        )
        step = F.get(table, state.bitwiseOR(cell))
        along.append(F.shiftleft(step.bitwiseAND(F.lit(low)).cast("bigint"), bit * n))
        state = step.bitwiseAND(F.lit(~low))
    return reduce(lambda a, b: a.bitwiseOR(b), along)


def _along(df: DataFrame, keys: tuple[str, ...], unique: str, files: int | None, bits: int, curve: Callable) -> DataFrame:
    """Rows range-partitioned and sorted by their place on a curve over the keys' ranks of ``bits`` bits."""
    if not 2 <= len(keys) <= 7:
        raise ValueError("cluster by two to seven keys")
    numbers = [f"_n{i}" for i in range(len(keys))]
    ranks = [f"_r{i}" for i in range(len(keys))]
    numbered = df.withColumns({n: _as_number(df, k) for n, k in zip(numbers, keys)})
    ranker = QuantileDiscretizer(
        inputCols=numbers,
        outputCols=ranks,
        numBuckets=2**bits,
        relativeError=0.001,
        handleInvalid="keep",
    ).fit(numbered.select(*numbers))
    top = F.lit(2**bits - 1)
    z = curve([F.least(F.col(r).cast("bigint"), top) for r in ranks], bits)
    placed = ranker.transform(numbered).withColumn("_z", z)
    sliced = (
        placed.repartitionByRange(files, "_z", unique)
        if files
        else placed.repartitionByRange("_z", unique)
    )
    return sliced.sortWithinPartitions("_z", unique).drop(*numbers, *ranks, "_z")


def z_order(df: DataFrame, *keys: str, unique: str, files: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted along a z-curve over ``keys``.

    Each key becomes an 8-bit rank by approximate quantiles, so skewed keys
    still use the whole range. ``unique`` ends the order: a z-value that holds
    a third of the rows is then cut into as many ranges as it needs.
    """
    return _along(df, keys, unique, files, Z_BITS, _interleave)


def hilbert_bits(files: int, keys: int) -> int:
    """Bits per key that give ``CELLS_PER_FILE`` cells or more to each file; 8 at most, as quantiles tell no more apart."""
    cells = max(2, files * CELLS_PER_FILE)
    return min(Z_BITS, -(-(cells - 1).bit_length() // keys))


def hilbert_order(df: DataFrame, *keys: str, unique: str, files: int) -> DataFrame:
    """As :func:`z_order`, along a Hilbert curve, with the bits that so many files need."""
    return _along(df, keys, unique, files, hilbert_bits(files, len(keys)), _hilbert)


def file_boxes(table: DataFrame, *keys: str) -> DataFrame:
    """Rows and, per key, the least and the largest value of every file."""
    ends = [f(k).alias(f"{name}_{k}") for k in keys for name, f in (("min", F.min), ("max", F.max))]
    return table.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("rows"), *ends)


def touched(boxes: DataFrame, box: dict[str, tuple]) -> DataFrame:
    """The files that a reader of ``box`` (key: least and largest value) cannot skip."""
    meets = ((F.col(f"max_{k}") >= F.lit(lo)) & (F.col(f"min_{k}") <= F.lit(hi)) for k, (lo, hi) in box.items())
    return boxes.filter(reduce(lambda a, b: a & b, meets))


def write_partitioned(df: DataFrame, path: str, *by: str) -> DataFrame:
    """One folder per value of ``by``; a large value gets several files."""
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)
    return df.sparkSession.read.parquet(path)


def buckets_for(df: DataFrame, rows: int = ROWS_PER_BUCKET) -> int:
    """How many buckets hold about ``rows`` rows each, by a count."""
    return max(1, -(-df.count() // rows))


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, *by: str) -> DataFrame:
    """A catalog table whose rows are hashed into ``buckets`` by ``by``.

    Give a second column next to a coarse one such as the hour of the day:
    the hour alone has 24 values and could put a third of the rows into one bucket.
    Rows are hashed before the write, so each bucket is one file.
    """
    (
        df.repartition(buckets, *by).write.mode("overwrite")
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, *by)
        .sortBy(*by)
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)


def export_csv(report: DataFrame, path: str) -> None:
    """One CSV file with a header. For reports: their rows are bounded by the calendar."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
