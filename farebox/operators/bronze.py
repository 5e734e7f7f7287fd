"""Raw layer: one schema for all fleets, provenance, validity, derived columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from farebox import schema as S
from farebox.functions import minutes_between, trip_id
from farebox.sources.conform import union_by_name


def standardise(df: DataFrame, fleet_code: str) -> DataFrame:
    """Rename a fleet's own time columns to the canonical ones."""
    prefix = S.fleet(fleet_code).time_prefix
    return df.withColumnsRenamed(
        {f"{prefix}_{end}_datetime": f"{end}_datetime" for end in ("pickup", "dropoff")}
    )


def quality_rules(t: S.Thresholds = S.Thresholds()) -> dict[str, Column]:
    """The row rules by name; a rule over a NULL counts as broken."""
    known = {
        "vendor_known": F.col("VendorID").isNotNull(),
        "times_known": F.col("pickup_datetime").isNotNull() & F.col("dropoff_datetime").isNotNull(),
        "times_ordered": F.col("pickup_datetime") <= F.col("dropoff_datetime"),
        "amount_in_range": (F.col("total_amount") > t.min_amount)
        & (F.col("total_amount") <= t.max_amount),
        "passengers_in_range": (F.col("passenger_count") > t.min_passengers)
        & (F.col("passenger_count") <= t.max_passengers),
    }
    return {name: F.coalesce(rule, F.lit(False)) for name, rule in known.items()}


# What a raw row must have.
NEEDED = ("VendorID", "pickup_datetime", "dropoff_datetime", "total_amount")


def with_provenance(df: DataFrame, fleet_code: str | None = None) -> DataFrame:
    """Add where and when a row came from, and the share of rules it keeps."""
    rules = list(quality_rules().values())
    kept = reduce(lambda a, b: a + b, [r.cast("int") for r in rules])
    extra = {
        "ingestion_timestamp": F.current_timestamp(),
        "data_quality_score": kept / float(len(rules)),
        "lakehouse_layer": F.lit("bronze"),
    }
    if fleet_code is not None:
        extra["taxi_type"] = F.lit(S.fleet(fleet_code).code)
    return df.withColumns(extra)


def is_valid() -> Column:
    """Whether a raw row enters the raw layer; NULL where a needed time is missing."""
    present = reduce(lambda a, c: a & F.col(c).isNotNull(), NEEDED, F.lit(True))
    return present & (F.col("pickup_datetime") <= F.col("dropoff_datetime"))


def refusal() -> Column:
    """Why a raw row does not enter the raw layer; NULL if it does."""
    missing = [F.when(F.col(c).isNull(), f"missing_{c}") for c in NEEDED]
    return F.coalesce(*missing, F.when(F.col("pickup_datetime") > F.col("dropoff_datetime"), "dropoff_before_pickup"))


def refused(feed: DataFrame, fleet_code: str | None = None) -> DataFrame:
    """The rows that :func:`bronze` leaves out, as they came, with the reason."""
    if fleet_code is not None:
        feed = standardise(feed, fleet_code)
    return feed.withColumn("refusal", refusal()).filter("refusal IS NOT NULL")


def with_derived(df: DataFrame) -> DataFrame:
    """Duration, hour, weekday (Sunday is 1), day, and the trip id."""
    pickup = F.col("pickup_datetime")
    return df.withColumns(
        {
            "trip_duration_minutes": minutes_between(pickup, "dropoff_datetime"),
            "pickup_hour": F.hour(pickup),
            "pickup_dayofweek": F.dayofweek(pickup),
            "pickup_date": F.to_date(pickup),
            "trip_id": trip_id("VendorID", pickup, "record_key"),
        }
    )


def bronze(feed: DataFrame, fleet_code: str | None = None) -> DataFrame:
    """The raw layer of one feed. ``feed`` has a ``record_key`` unique per row.

    Give ``fleet_code`` for a feed of one fleet in that fleet's own shape; a
    feed that already carries ``taxi_type`` and canonical names needs none.
    A feed without one of the mandatory columns is refused.
    """
    if fleet_code is not None:
        feed = standardise(feed, fleet_code)
    absent = [c for c in S.MANDATORY if c not in feed.columns]
    if absent:
        raise ValueError(f"mandatory columns missing: {', '.join(absent)}")
    return with_derived(with_provenance(feed, fleet_code).filter(is_valid()))


def unify(feeds: dict[str, DataFrame]) -> DataFrame:
    """The raw layer over all fleets: by-name union, one branch per fleet."""
    return union_by_name(*[bronze(feed, code) for code, feed in feeds.items()])
