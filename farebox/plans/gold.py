"""Business marts over the clean trips.

Labels that follow from a grouping key (service area, period, month name) are
attached after the aggregate: once per group, not once per trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from farebox import functions as fn
from farebox.operators import aggregates as agg


def monthly(silver: DataFrame) -> DataFrame:
    """Per fleet and file month.

    Counts distinct vendors and days in two steps: trips first collapse to one
    row per fleet, month, vendor and day on the map side, and only those rows
    meet the distinct counts.
    """
    by_day = silver.groupBy(
        "taxi_type", "source_year", "source_month", "vendor_id", "pickup_date"
    ).agg(
        *agg.trip_sums(),
        F.min("total_amount").alias("min_amount"),
        F.max("total_amount").alias("max_amount"),
    )
    return _monthly(by_day)


def _monthly(parts: DataFrame) -> DataFrame:
    """The monthly mart from any groups that carry :func:`agg.trip_sums`, vendors and days apart."""
    by_month = parts.groupBy(
        "taxi_type", F.col("source_year").alias("year"), F.col("source_month").alias("month")
    ).agg(
        *agg.merged_sums(),
        F.countDistinct("vendor_id").alias("unique_vendors"),
        F.countDistinct("pickup_date").alias("active_days"),
        F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"),
    )
    return by_month.select(
        "taxi_type",
        "year",
        "month",
        fn.month_name("month").alias("month_name"),
        fn.service_area("taxi_type").alias("service_area"),
        "total_trips",
        "unique_vendors",
        "active_days",
        agg.revenue().alias("total_revenue"),
        agg.avg_amount().alias("avg_amount_per_trip"),
        "min_amount",
        "max_amount",
        agg.avg_passengers().alias("avg_passengers_per_trip"),
        agg.avg_minutes().alias("avg_trip_duration_minutes"),
        agg.avg_distance().alias("avg_trip_distance"),
        F.col("s_passengers").alias("total_passengers"),
        agg.units("s_distance").alias("total_distance"),
        F.current_timestamp().alias("gold_processed_at"),
    )


def hourly(silver: DataFrame, month: int = 5) -> DataFrame:
    """Per fleet and hour of the day within one file month (May unless told otherwise)."""
    by_hour = (
        silver.filter(F.col("source_month") == month)
        .groupBy("taxi_type", "pickup_hour")
        .agg(
            *agg.trip_sums(),
            F.min("passenger_count").alias("min_passengers"),
            F.max("passenger_count").alias("max_passengers"),
        )
    )
    return _hourly(by_hour)


def _hourly(by_hour: DataFrame) -> DataFrame:
    return by_hour.select(
        "taxi_type",
        "pickup_hour",
        fn.hour_range("pickup_hour").alias("hour_range"),
        "total_trips",
        agg.avg_passengers(3).alias("avg_passengers_per_trip"),
        F.col("s_passengers").cast("double").alias("total_passengers"),
        "min_passengers",
        "max_passengers",
        agg.avg_amount().alias("avg_amount_per_trip"),
        agg.revenue().alias("total_revenue"),
        agg.avg_distance().alias("avg_trip_distance"),
        fn.time_period("pickup_hour").alias("time_period"),
        fn.service_area("taxi_type").alias("service_area"),
        F.current_timestamp().alias("gold_processed_at"),
    )


def comparison(silver: DataFrame) -> DataFrame:
    """One row per fleet."""
    in_period = lambda name: F.count_if(fn.time_period("pickup_hour") == name)
    by_fleet = silver.groupBy("taxi_type").agg(
        *agg.trip_sums(),
        F.sum(fn.hundredths("tip_amount")).alias("s_tip"),
        *_tip_shares(),
        in_period("morning_rush").alias("morning_rush_trips"),
        in_period("evening_rush").alias("evening_rush_trips"),
    )
    return _comparison(by_fleet)


def _tip_shares() -> list[Column]:
    """Sum and number of the trips' tip shares; a sum of decimals does not depend on the order of rows."""
    share = F.try_divide("tip_amount", "total_amount")
    return [F.sum(share.cast("decimal(20,12)")).alias("s_tip_share"), F.count(share).alias("n_tip_share")]


def _comparison(by_fleet: DataFrame) -> DataFrame:
    tip_share = F.try_divide(F.col("s_tip_share").cast("double"), F.col("n_tip_share"))
    return by_fleet.select(
        "taxi_type",
        fn.service_area("taxi_type").alias("service_area"),
        "total_trips",
        agg.avg_amount().alias("avg_fare"),
        agg.avg_passengers().alias("avg_passengers"),
        agg.avg_distance().alias("avg_distance"),
        agg.avg_minutes().alias("avg_duration"),
        agg.revenue().alias("total_revenue"),
        fn.mean("s_tip", "total_trips", 2, scale=2).alias("avg_tip"),
        fn.rounded(tip_share * 100, 2).alias("avg_tip_percentage"),
        "morning_rush_trips",
        "evening_rush_trips",
        F.current_timestamp().alias("gold_processed_at"),
    )


def cube(silver: DataFrame) -> DataFrame:
    """Per fleet, file month, vendor, day and hour: what every mart is made of.

    All columns are sums, counts or extremes, so months are added to it one by
    one, and a month loaded again replaces its own rows only.
    """
    return silver.groupBy("taxi_type", "source_year", "source_month", "vendor_id", "pickup_date", "pickup_hour").agg(
        *agg.trip_sums(),
        F.min("total_amount").alias("min_amount"), F.max("total_amount").alias("max_amount"),
        F.min("passenger_count").alias("min_passengers"), F.max("passenger_count").alias("max_passengers"),
        F.sum(fn.hundredths("tip_amount")).alias("s_tip"),
        *_tip_shares(),
    )


def monthly_of(cells: DataFrame) -> DataFrame:
    """:func:`monthly` from the :func:`cube`."""
    return _monthly(cells)


def hourly_of(cells: DataFrame, month: int = 5) -> DataFrame:
    """:func:`hourly` from the :func:`cube`."""
    return _hourly(
        cells.filter(F.col("source_month") == month).groupBy("taxi_type", "pickup_hour").agg(
            *agg.merged_sums(), F.min("min_passengers").alias("min_passengers"), F.max("max_passengers").alias("max_passengers")
        )
    )


def comparison_of(cells: DataFrame) -> DataFrame:
    """:func:`comparison` from the :func:`cube`."""
    def in_period(name: str) -> Column:
        return F.sum(F.when(fn.time_period("pickup_hour") == name, F.col("total_trips")).otherwise(0))

    return _comparison(
        cells.groupBy("taxi_type").agg(
            *agg.merged_sums(), *(F.sum(c).alias(c) for c in ("s_tip", "s_tip_share", "n_tip_share")),
            in_period("morning_rush").alias("morning_rush_trips"), in_period("evening_rush").alias("evening_rush_trips"),
        )
    )
