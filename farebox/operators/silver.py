"""Clean layer: quality flags, valid rows, quarantine, staging view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from farebox import schema as S
from farebox.functions import fare_tier, service_area, time_period

# Flag names; the first broken rule names the row.
MISSING, VALID = "missing_value", "valid"
FLAGS = (
    MISSING,
    "invalid_amount",
    "invalid_passengers",
    "invalid_duration",
    "excessive_duration",
    "excessive_passengers",
    "excessive_amount",
    VALID,
)

PASSED_THROUGH = (
    "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance", "total_amount",
    "fare_amount", "tip_amount", "tolls_amount", "source_year", "source_month",
    "trip_duration_minutes", "pickup_hour", "pickup_dayofweek", "pickup_date",
)

_AMOUNT, _PEOPLE, _MINUTES = "total_amount", "passenger_count", "trip_duration_minutes"


def in_range(t: S.Thresholds = S.Thresholds()) -> Column:
    """The range rules as plain comparisons, which a Parquet scan can use to skip."""
    bounds = (
        (_AMOUNT, t.min_amount, t.max_amount),
        (_PEOPLE, t.min_passengers, t.max_passengers),
        (_MINUTES, t.min_minutes, t.max_minutes),
    )
    kept = F.lit(True)
    for name, low, high in bounds:
        kept = kept & (F.col(name) > low) & (F.col(name) <= high)
    return kept


def quality_flag(t: S.Thresholds = S.Thresholds()) -> Column:
    """First broken rule of a row, or ``valid``; ``valid`` exactly when :func:`in_range`."""
    gone = F.col(_AMOUNT).isNull() | F.col(_PEOPLE).isNull() | F.col(_MINUTES).isNull()
    broken = {
        MISSING: gone,
        "invalid_amount": F.col(_AMOUNT) <= t.min_amount,
        "invalid_passengers": F.col(_PEOPLE) <= t.min_passengers,
        "invalid_duration": F.col(_MINUTES) <= t.min_minutes,
        "excessive_duration": F.col(_MINUTES) > t.max_minutes,
        "excessive_passengers": F.col(_PEOPLE) > t.max_passengers,
        "excessive_amount": F.col(_AMOUNT) > t.max_amount,
    }
    # coalesce keeps the order of the rules: the first that gives a name wins
    return F.coalesce(*[F.when(rule, flag) for flag, rule in broken.items()], F.lit(VALID))


def flagged(bronze: DataFrame, t: S.Thresholds = S.Thresholds()) -> DataFrame:
    """Every raw-layer row in the clean layer's columns, with its flag."""
    return bronze.select(
        "trip_id",
        "taxi_type",
        F.col("VendorID").alias("vendor_id"),
        *PASSED_THROUGH,
        quality_flag(t).alias("quality_flag"),
        time_period("pickup_hour").alias("time_period"),
        service_area("taxi_type").alias("service_area"),
        F.current_timestamp().alias("silver_processed_at"),
    )


def silver(bronze: DataFrame, t: S.Thresholds = S.Thresholds()) -> DataFrame:
    """The valid trips."""
    return flagged(bronze.filter(in_range(t)), t)


def quarantine(bronze: DataFrame, t: S.Thresholds = S.Thresholds()) -> DataFrame:
    """The rows that :func:`silver` leaves out, with the reason."""
    return flagged(bronze, t).filter(F.col("quality_flag") != VALID)


def flag_counts(bronze: DataFrame, t: S.Thresholds = S.Thresholds()) -> DataFrame:
    return bronze.groupBy(quality_flag(t).alias("quality_flag")).agg(F.count("*").alias("trips"))


def staging(silver_trips: DataFrame) -> DataFrame:
    """The valid trips with fare tiers."""
    return (
        silver_trips.filter(F.col("quality_flag") == VALID)
        .select(
            "taxi_type",
            "pickup_datetime",
            "total_amount",
            "passenger_count",
            "time_period",
            fare_tier("total_amount").alias("fare_tier"),
            F.current_timestamp().alias("dbt_processed_at"),
        )
    )


def yellow_clean(silver_trips: DataFrame) -> DataFrame:
    """One fleet's clean trips, with its own time name and the file month as ``pickup_month``."""
    return silver_trips.filter(F.col("taxi_type") == "yellow").withColumns(
        {"pickup_month": F.col("source_month"), "tpep_pickup_datetime": F.col("pickup_datetime")}
    )
