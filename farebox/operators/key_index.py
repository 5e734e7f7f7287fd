"""Uniqueness and reference checks that read the new rows only.

The keys of what is already stored are kept as bitmaps, one row for 32,768
neighbouring numbers: 4 KB for up to 32,768 keys, merged by OR. A new month is
checked against these rows, so no old month is read again. Made for dense
whole numbers; keys that lie far apart cost up to a row each. NULL keys are not
judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from farebox.operators.quality import check_row


def key_index(df: DataFrame, key: str, *by: str) -> DataFrame:
    """Bitmaps of the keys and the rows that hold them, per value of ``by``.

    Copies of a key set one bit before the shuffle, so a key may fill a third of the rows.
    """
    number = F.col(key).cast("bigint")
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(*by, F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"), F.count("*").alias("rows"))
    )


def merged(index: DataFrame) -> DataFrame:
    """One row per bucket, whatever the index was kept by."""
    return index.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.sum("rows").alias("rows"))


def compared(new: DataFrame, stored: DataFrame) -> DataFrame:
    """One row: rows and different keys of ``new``, and how many of these ``stored`` has.

    Both are indexes. Shared keys are what two counts have over the count of the union.
    """
    sides = merged(new).withColumn("is_new", F.lit(True)).unionByName(merged(stored).withColumn("is_new", F.lit(False)))
    bits = F.bitmap_count("bitmap")
    per_bucket = sides.groupBy("bucket").agg(
        _sum(F.when(F.col("is_new"), F.col("rows"))).alias("rows"),
        _sum(F.when(F.col("is_new"), bits)).alias("keys"),
        _sum(bits).alias("both"),
        F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("either"),
    )
    return per_bucket.agg(
        _sum(F.col("rows")).alias("rows"), _sum(F.col("keys")).alias("keys"),
        _sum(F.col("both") - F.col("either")).alias("known"),
    )


def _sum(c: Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def unique_checks(new: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows that repeat a key of the new rows, and keys that are already stored."""
    return compared(new, stored).select(F.inline(F.array(
        check_row(F.lit(f"repeated:{key}"), F.col("rows") - F.col("keys"), F.col("rows")),
        check_row(F.lit(f"known:{key}"), F.col("known"), F.col("rows")),
    )))


def reference_check(new: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Different keys of the new rows that ``parent`` lacks."""
    return compared(new, parent).select(
        F.inline(F.array(check_row(F.lit(f"reference:{key}"), F.col("keys") - F.col("known"), F.col("rows"))))
    )
