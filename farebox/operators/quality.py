"""Data-quality operators: ratios per file, layer statistics, checks, freshness."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from farebox import schema as S
from farebox.functions import rounded
from farebox.operators import silver as silver_ops
from farebox.operators.bronze import is_valid

# Fixed value: least share of valid rows that an ingestion should reach.
EXPECTED_VALID_PERCENT = 95.0


# ------------------------------------------------------------------- ingestion
def file_quality(feed: DataFrame) -> DataFrame:
    """Rows, valid rows and their ratio per source file, in one pass."""
    valid = F.count_if(is_valid())
    return feed.groupBy("taxi_type", "source_year", "source_month", "source_file").agg(
        F.count("*").alias("total_records"),
        valid.alias("valid_records"),
        ratio(valid, F.count("*")).alias("quality_score"),
    )


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, and 0 when there is nothing."""
    share = F.try_divide(part.cast("double"), whole.cast("double"))
    return F.coalesce(rounded(share, 6), F.lit(0.0))


def ingestion_summary(per_file: DataFrame) -> DataFrame:
    """Files, rows and valid share per fleet and, as ``ALL``, over everything."""
    total, valid = F.sum("total_records"), F.sum("valid_records")
    return (
        per_file.rollup("taxi_type")
        .agg(
            F.count("*").alias("files"),
            total.alias("total_records"),
            valid.alias("valid_records"),
            rounded(F.try_divide(valid.cast("double") * 100, total.cast("double")), 2).alias(
                "quality_percent"
            ),
        )
        .withColumn("taxi_type", F.coalesce("taxi_type", F.lit("ALL")))
        .orderBy("taxi_type")
    )


def below_threshold(per_file: DataFrame, percent: float = EXPECTED_VALID_PERCENT) -> DataFrame:
    """The files whose share of valid rows misses ``percent``."""
    return per_file.filter(F.col("quality_score") * 100 < percent)


# ------------------------------------------------------------ layer statistics
def bronze_stats(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.count("*").alias("total_records"),
        F.countDistinct("source_month").alias("months"),
        F.min("ingestion_timestamp").alias("first_ingestion"),
        F.max("ingestion_timestamp").alias("last_ingestion"),
    ).select(F.lit("Bronze").alias("layer"), "*")


def silver_stats(trips: DataFrame, layer: str = "Silver") -> DataFrame:
    return trips.agg(
        F.count("*").alias("total_records"),
        F.countDistinct("quality_flag").alias("quality_flags"),
        F.sum(F.when(F.col("quality_flag") == silver_ops.VALID, 1).otherwise(0)).alias(
            "valid_records"
        ),
    ).select(F.lit(layer).alias("layer"), "*")


def gold_stats(monthly: DataFrame) -> DataFrame:
    return monthly.agg(
        F.count("*").alias("total_months"),
        F.sum("total_trips").alias("total_trips_aggregated"),
        rounded(F.avg("avg_amount_per_trip"), 2).alias("overall_avg_amount"),
    ).select(F.lit("Gold-Monthly").alias("layer"), "*")


def fleet_counts(silver: DataFrame) -> DataFrame:
    """Trips per fleet and, as ``ALL``, in the whole layer."""
    return (
        silver.rollup("taxi_type")
        .agg(F.count("*").alias("trips"))
        .withColumn("taxi_type", F.coalesce("taxi_type", F.lit("ALL")))
    )


# ---------------------------------------------------------------------- checks
def row_checks(
    df: DataFrame,
    not_null: Iterable[str] = (),
    accepted: dict[str, Iterable] | None = None,
    rules: dict[str, Column] | None = None,
) -> DataFrame:
    """Checks that look at one row at a time, all in one pass: failures per check.

    A NULL passes ``accepted`` (that is ``not_null``'s business); a rule that
    is NULL fails.
    """
    failing: dict[str, Column] = {f"not_null:{c}": F.col(c).isNull() for c in not_null}
    for c, values in (accepted or {}).items():
        failing[f"accepted_values:{c}"] = ~F.col(c).isin(list(values))
    for name, rule in (rules or {}).items():
        failing[f"rule:{name}"] = ~F.coalesce(rule, F.lit(False))
    if not failing:
        raise ValueError("no checks given")
    totals = df.agg(
        F.count("*").alias("n"),
        *[F.count_if(bad).alias(f"f{i}") for i, bad in enumerate(failing.values())],
    )
    rows = [check_row(F.lit(name), F.col(f"f{i}"), F.col("n")) for i, name in enumerate(failing)]
    return totals.select(F.inline(F.array(*rows)))


def check_row(name: Column, failures: Column, rows: Column) -> Column:
    return F.struct(
        name.alias("check_name"),
        failures.alias("failures"),
        rows.alias("rows_checked"),
        (failures == 0).alias("passed"),
    )


def unique_check(df: DataFrame, *key: str) -> DataFrame:
    """Number of key values that more than one row has. Copies collapse before the shuffle."""
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("copies"))
        .agg(F.count_if(F.col("copies") > 1).alias("f"), F.coalesce(F.sum("copies"), F.lit(0)).alias("n"))
        .select(F.inline(F.array(check_row(F.lit(f"unique:{','.join(key)}"), F.col("f"), F.col("n")))))
    )


def reference_check(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose ``column`` has no counterpart in ``parent``.

    Rows collapse to one per value before the join, so a value that fills a
    third of the table arrives as one row with a count. NULLs are not judged.
    """
    values = df.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("rows"))
    known = parent.select(F.col(parent_column).alias("v")).distinct().withColumn("known", F.lit(1))
    orphan = F.col("known").isNull() & F.col("v").isNotNull()
    name = F.lit(f"reference:{column}")
    return (
        values.join(known, "v", "left")
        .agg(
            F.coalesce(F.sum(F.when(orphan, F.col("rows")).otherwise(0)), F.lit(0)).alias("f"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("n"),
        )
        .select(F.inline(F.array(check_row(name, F.col("f"), F.col("n")))))
    )


def period_rules(t: S.Thresholds = S.Thresholds()) -> dict[str, Column]:
    """Does the pickup lie in the file's month, and in the reporting season?"""
    day = F.to_date("pickup_datetime")
    return {
        "period_match": (F.year(day) == F.col("source_year"))
        & (F.month(day) == F.col("source_month")),
        "in_season": day.between(F.lit(t.first_day), F.lit(t.last_day)),
    }


def trip_checks(bronze: DataFrame, parent: DataFrame, column: str, parent_column: str,
                t: S.Thresholds = S.Thresholds()) -> DataFrame:
    """The standing checks of the raw layer: one row per check."""
    by_row = row_checks(
        bronze,
        not_null=("VendorID", "pickup_datetime", "dropoff_datetime", "total_amount", "passenger_count"),
        accepted={"taxi_type": list(S.FLEETS)},
        rules={
            "amount_in_range": (F.col("total_amount") > t.min_amount)
            & (F.col("total_amount") <= t.max_amount),
            "passengers_in_range": (F.col("passenger_count") > t.min_passengers)
            & (F.col("passenger_count") <= t.max_passengers),
            "duration_in_range": (F.col("trip_duration_minutes") > t.min_minutes)
            & (F.col("trip_duration_minutes") <= t.max_minutes),
            **period_rules(t),
        },
    )
    return by_row.unionByName(unique_check(bronze, "trip_id")).unionByName(
        reference_check(bronze, column, parent, parent_column)
    )


def freshness(df: DataFrame, column: str, as_of: Column, warn_hours: int, error_hours: int) -> DataFrame:
    """Age of the newest row per fleet at ``as_of``: ``pass``, ``warn`` or ``error``."""
    newest = df.groupBy("taxi_type").agg(F.max(column).alias("latest"))
    hours = F.floor((F.unix_timestamp(as_of) - F.unix_timestamp("latest")) / 3600)
    status = (
        F.when(F.col("age_hours") > error_hours, "error")
        .when(F.col("age_hours") > warn_hours, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("age_hours", hours).withColumn("status", status)
