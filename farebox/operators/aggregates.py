"""Aggregates shared by the marts and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from farebox.functions import hundredths, mean, units


def trip_sums() -> list[Column]:
    """Mergeable sums over trips: exact whole numbers, named with a leading ``s_``."""
    return [
        F.count("*").alias("total_trips"),
        F.sum(hundredths("total_amount")).alias("s_amount"),
        F.sum("passenger_count").cast("bigint").alias("s_passengers"),
        F.sum(hundredths("trip_duration_minutes")).alias("s_minutes"),
        F.sum(hundredths("trip_distance")).alias("s_distance"),
    ]


def merged_sums() -> list[Column]:
    """:func:`trip_sums` once more, over groups that already carry them."""
    names = ("total_trips", "s_amount", "s_passengers", "s_minutes", "s_distance")
    return [F.sum(n).alias(n) for n in names]


def revenue() -> Column:
    return units("s_amount")


def avg_amount(digits: int = 2) -> Column:
    return mean("s_amount", "total_trips", digits, scale=2)


def avg_passengers(digits: int = 2) -> Column:
    return mean("s_passengers", "total_trips", digits)


def avg_minutes(digits: int = 2) -> Column:
    return mean("s_minutes", "total_trips", digits, scale=2)


def avg_distance(digits: int = 2) -> Column:
    return mean("s_distance", "total_trips", digits, scale=2)


def discrete_median(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Per group the smallest value that at least half of the rows do not exceed.

    The exact counterpart of an approximate median. Rows collapse to one per
    distinct value before anything is ordered, so a group of any size costs no
    more than its number of distinct values (cents up to a ceiling, a head count).
    """
    histogram = (
        df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    )
    group = Window.partitionBy(*keys)
    upto = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        histogram.select(
            *keys,
            value,
            F.sum("n").over(upto).alias("upto"),
            F.sum("n").over(group).alias("whole"),
        )
        .filter(F.col("upto") * 2 >= F.col("whole"))
        .groupBy(*keys)
        .agg(F.min(value).alias(name))
    )


def hours_and_days(trips: DataFrame) -> DataFrame:
    """Trips and revenue per hour and day."""
    return trips.groupBy("pickup_hour", "pickup_date").agg(
        F.count("*").alias("total_trips"), units(F.sum(hundredths("total_amount"))).alias("total_revenue")
    )


def rows_per_layout_key(df: DataFrame, *keys: str, rsd: float = 0.05) -> DataFrame:
    """How rows, vendors (approximately) and revenue spread over a layout key."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("record_count"),
        F.approx_count_distinct("vendor_id", rsd).alias("unique_vendors"),
        (units(F.sum(hundredths("total_amount"))) / 1024 / 1024).alias("revenue_mebi"),
    )


def vendors_bound(df: DataFrame, *keys: str, rsd: float = 0.05) -> DataFrame:
    """Vendors per layout key, and whether the approximate number is within three deviations."""
    per_vendor = df.groupBy(*keys, "vendor_id").agg(F.lit(1).alias("one"))
    exact = per_vendor.groupBy(*keys).agg(F.count("vendor_id").alias("vendors"))
    near = rows_per_layout_key(df, *keys, rsd=rsd).select(*keys, "unique_vendors")
    off = F.abs(F.col("unique_vendors") - F.col("vendors"))
    return exact.join(near, list(keys)).select(*keys, "vendors", (off <= F.ceil(3 * rsd * F.col("vendors"))).alias("within_bound"))


def rows_per_partition(df: DataFrame) -> DataFrame:
    """Rows in each partition as it is read now: shows a skewed layout at once."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count("*").alias("record_count")
    )


def layout_skew(df: DataFrame, candidates: list[str], bucket_rows: int) -> DataFrame:
    """How evenly each candidate column would lay the rows out, and into how many buckets.

    Rows collapse to one per column and value before anything is compared.
    ``largest_share`` is the most common value's; a column is skewed if that
    value alone fills more than two buckets. No more buckets are suggested
    than the column has values. NULL is a value.
    """
    named = F.stack(F.lit(len(candidates)), *(x for c in candidates for x in (F.lit(c), F.col(c).cast("string"))))
    counts = df.select(named.alias("layout_key", "value")).groupBy("layout_key", "value").agg(F.count("*").alias("n"))
    per_key = counts.groupBy("layout_key").agg(
        F.sum("n").alias("record_count"), F.count("*").alias("distinct_values"), F.max("n").alias("largest"),
        F.min_by(F.col("value"), F.struct(-F.col("n"), F.col("value"))).alias("most_common"),
    )
    wanted = F.ceil(F.col("record_count") / bucket_rows)
    return per_key.select(
        "layout_key", "record_count", "distinct_values", "most_common", F.col("largest").alias("most_common_rows"),
        (F.col("largest") / F.col("record_count")).alias("largest_share"),
        F.least(wanted, F.col("distinct_values")).cast("bigint").alias("suggested_buckets"),
        (F.col("largest") > 2 * bucket_rows).alias("skewed"),
    )
