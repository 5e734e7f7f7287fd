"""Reports: the recurring questions, over the clean trips or over a mart.

Windows without a partition run only over aggregates whose size is fixed by the
calendar or the number of fleets (months, hours, fleets), never over trips.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from farebox import functions as fn
from farebox.operators import aggregates as agg
from farebox.session import local_table

# Report texts.
Q1_TITLE = "PERGUNTA 1: Média de valor total por mês"
Q2_TITLE = "PERGUNTA 2: Média de passageiros por hora em maio"
STRATEGIES = (
    (
        "Yellow Taxi",
        "Manhattan/Airport",
        "Higher fares, premium service",
        "Business travelers, tourists",
        "Maintain premium positioning",
    ),
    (
        "Green Taxi",
        "Outer Boroughs",
        "Volume-based, local service",
        "Local residents, daily commuters",
        "Focus on frequency and reliability",
    ),
)
VALIDATION_LABELS = (
    "Total de registros analisados",
    "Registros de maio analisados",
    "Período de dados",
    "Média geral de passageiros",
    "Média geral de valor",
)
BUSINESS_HOURS = (7, 19)


# ------------------------------------------------------------------ question 1
def q1_report(monthly: DataFrame) -> DataFrame:
    return monthly.orderBy("year", "month", "taxi_type").select(
        "taxi_type",
        "year",
        "month_name",
        "avg_amount_per_trip",
        "total_trips",
        F.format_number("total_revenue", 2).alias("total_revenue_formatted"),
    )


def q1_distribution(monthly: DataFrame) -> DataFrame:
    """Trips, revenue, mean amount and passengers per fleet and month."""
    return monthly.orderBy("year", "month", "taxi_type").select(
        "taxi_type",
        "year",
        "month_name",
        "total_trips",
        F.format_number("total_revenue", 2).alias("revenue"),
        "avg_amount_per_trip",
        "avg_passengers_per_trip",
    )


def q1_titled(monthly: DataFrame) -> DataFrame:
    return monthly.orderBy("year", "month", "taxi_type").select(
        F.lit(Q1_TITLE).alias("pergunta"),
        "taxi_type",
        "year",
        "month_name",
        F.col("avg_amount_per_trip").alias("resposta"),
        "total_trips",
        F.concat(F.lit("$"), F.format_number("total_revenue", 0)).alias("receita_total"),
    )


def q1_from_silver(silver: DataFrame) -> DataFrame:
    """Straight from the trips: per fleet and month of the year."""
    return (
        silver.groupBy("taxi_type", "source_month")
        .agg(F.count("*").alias("total_trips"), F.sum(fn.hundredths("total_amount")).alias("s_amount"))
        .select(
            "taxi_type",
            "source_month",
            fn.month_name("source_month").alias("month_name"),
            "total_trips",
            agg.avg_amount().alias("avg_amount_per_trip"),
            agg.revenue().alias("total_revenue"),
        )
        .orderBy("source_month", "taxi_type")
    )


def _change(df: DataFrame, value: str, order: list[str], names: tuple[str, str, str]) -> DataFrame:
    """Previous value, change and change in percent along an already aggregated series."""
    before, delta, pct = names
    prev = F.lag(value).over(Window.orderBy(*order))
    return df.withColumn(before, prev).withColumns(
        {
            delta: fn.rounded(F.col(value) - F.col(before), 2),
            pct: fn.percent(F.col(value) - F.col(before), before),
        }
    )


def q1_month_over_month(yellow: DataFrame) -> DataFrame:
    """Change of the mean amount from one month of the year to the next, one fleet."""
    by_month = (
        yellow.groupBy("pickup_month")
        .agg(F.count("*").alias("total_trips"), F.sum(fn.hundredths("total_amount")).alias("s_amount"))
        .select(
            "pickup_month",
            fn.month_name("pickup_month").alias("month_name"),
            agg.avg_amount().alias("avg_amount"),
        )
    )
    return (
        _change(
            by_month, "avg_amount", ["pickup_month"],
            ("prev", "month_over_month_change", "pct_change"),
        )
        .drop("prev")
        .orderBy("pickup_month")
    )


def _q1_stats(silver: DataFrame, median: Column | None) -> DataFrame:
    amount = fn.hundredths("total_amount")
    extra = [] if median is None else [median.alias("median_amount")]
    return (
        silver.filter(F.col("total_amount") > 0)
        .groupBy("source_year", "source_month")
        .agg(
            F.count("*").alias("total_trips"),
            F.sum(amount).alias("s_amount"),
            (F.stddev(amount) / 100).alias("dev"),
            F.countDistinct("pickup_date").alias("active_days"),
            *extra,
        )
    )


_Q1_COLUMNS = (
    "source_year", "source_month", "month_name", "total_trips", "total_revenue",
    "avg_amount_per_trip", "stddev_amount", "median_amount", "active_days", "avg_daily_revenue",
)


def _q1_finish(stats: DataFrame) -> DataFrame:
    return (
        stats.withColumns(
            {
                "month_name": fn.month_name("source_month"),
                "total_revenue": agg.revenue(),
                "avg_amount_per_trip": agg.avg_amount(4),
                "stddev_amount": fn.rounded("dev", 4),
                "avg_daily_revenue": fn.mean("s_amount", "active_days", 2, scale=2),
            }
        )
        .select(*_Q1_COLUMNS)
        .orderBy("source_year", "source_month")
    )


def q1_extended(silver: DataFrame) -> DataFrame:
    """Monthly mean, spread, exact median and revenue per active day."""
    keys = ["source_year", "source_month"]
    median = agg.discrete_median(
        silver.filter(F.col("total_amount") > 0), keys, "total_amount", "median_amount"
    )
    return _q1_finish(_q1_stats(silver, None).join(median, keys))


def q1_extended_approx(silver: DataFrame, accuracy: int = 10000) -> DataFrame:
    """The same in one pass, with an approximate median."""
    return _q1_finish(_q1_stats(silver, F.percentile_approx("total_amount", 0.5, accuracy)))


def q1_median_bound(silver: DataFrame, share: float = 0.01) -> DataFrame:
    """The exact medians, and whether the approximate ones are within ``share`` of them."""
    keys = ["source_year", "source_month"]
    near = q1_extended_approx(silver).select(*keys, F.col("median_amount").alias("near"))
    off = F.abs(F.col("near") - F.col("median_amount"))
    return q1_extended(silver).join(near, keys).select(
        *keys, "median_amount", (off <= share * F.col("median_amount")).alias("within_bound")
    )


def q1_monthly_change(silver: DataFrame) -> DataFrame:
    """Month-over-month change along the calendar, all fleets together."""
    by_month = (
        silver.filter(F.col("total_amount") > 0)
        .groupBy("source_year", "source_month")
        .agg(F.count("*").alias("total_trips"), F.sum(fn.hundredths("total_amount")).alias("s_amount"))
        .withColumns(
            {
                "month_name": fn.month_name("source_month"),
                "avg_amount_per_trip": agg.avg_amount(4),
            }
        )
    )
    changed = _change(
        by_month, "avg_amount_per_trip", ["source_year", "source_month"],
        ("prev_month_avg", "month_over_month_change", "month_over_month_pct"),
    )
    return changed.orderBy("source_year", "source_month").select(
        "source_year", "source_month", "month_name", "avg_amount_per_trip", "prev_month_avg",
        "month_over_month_change", "month_over_month_pct",
    )


# ------------------------------------------------------------------ question 2
def q2_report(hourly: DataFrame) -> DataFrame:
    return hourly.orderBy("taxi_type", "pickup_hour").select(
        "taxi_type", "hour_range", "avg_passengers_per_trip", "total_trips", "time_period"
    )


def q2_business_hours(hourly: DataFrame, hours: tuple[int, int] = BUSINESS_HOURS) -> DataFrame:
    return (
        hourly.filter(F.col("pickup_hour").between(*hours))
        .orderBy("taxi_type", "pickup_hour")
        .select(
            F.lit(Q2_TITLE).alias("pergunta"),
            "taxi_type",
            "hour_range",
            F.col("avg_passengers_per_trip").alias("resposta"),
            "total_trips",
            "time_period",
        )
    )


def _passengers_by(trips: DataFrame, *keys: str) -> DataFrame:
    return trips.groupBy(*keys).agg(
        F.count("*").alias("total_trips"),
        F.sum("passenger_count").cast("bigint").alias("s_passengers"),
    )


def q2_from_silver(silver: DataFrame, month: int = 5) -> DataFrame:
    return (
        _passengers_by(silver.filter(F.col("source_month") == month), "taxi_type", "pickup_hour")
        .select(
            "taxi_type",
            "pickup_hour",
            fn.hour_range("pickup_hour").alias("hour_range"),
            "total_trips",
            agg.avg_passengers(3).alias("avg_passengers_per_trip"),
            F.col("s_passengers").cast("double").alias("total_passengers"),
            fn.time_period("pickup_hour").alias("time_period"),
        )
        .orderBy("taxi_type", "pickup_hour")
    )


def q2_text_bar(yellow: DataFrame, month: int = 5) -> DataFrame:
    """A bar of stars per hour, ten per passenger."""
    stars = fn.mean(F.col("s_passengers") * 10, "total_trips", 0).cast("int")
    return (
        _passengers_by(yellow.filter(F.col("pickup_month") == month), "pickup_hour")
        .select(
            "pickup_hour",
            agg.avg_passengers(3).alias("avg_passengers"),
            F.col("total_trips").alias("trip_count"),
            F.repeat(F.lit("*"), stars).alias("visual_bar"),
        )
        .orderBy("pickup_hour")
    )


def month_by_hour(yellow: DataFrame) -> DataFrame:
    return (
        _passengers_by(yellow, "pickup_month", "pickup_hour")
        .select(
            "pickup_month",
            fn.month_name("pickup_month").alias("month_name"),
            "pickup_hour",
            agg.avg_passengers().alias("avg_passengers"),
        )
        .orderBy("pickup_month", "pickup_hour")
    )


def peak_passengers(yellow: DataFrame, month: int = 5) -> DataFrame:
    """Hours of a month by mean passengers, fullest first."""
    return (
        _passengers_by(yellow.filter(F.col("pickup_month") == month), "pickup_hour")
        .select(
            "pickup_hour",
            agg.avg_passengers().alias("avg_passengers"),
            F.col("total_trips").alias("trip_count"),
            fn.period_pt("pickup_hour").alias("period_of_day"),
        )
        .orderBy(F.desc("avg_passengers"), "pickup_hour")
    )


_Q2_COLUMNS = (
    "pickup_hour", "hour_range", "total_trips", "avg_passengers_per_trip", "total_passengers",
    "stddev_passengers", "median_passengers", "min_passengers", "max_passengers",
    "avg_amount_per_trip", "period_classification",
)


def _q2_stats(may: DataFrame, median: Column | None) -> DataFrame:
    extra = [] if median is None else [median.alias("median_passengers")]
    return _as_q2(
        may.groupBy("pickup_hour").agg(
            F.count("*").alias("total_trips"),
            F.sum("passenger_count").cast("bigint").alias("s_passengers"),
            F.sum(fn.hundredths("total_amount")).alias("s_amount"),
            fn.stddev("passenger_count").alias("stddev_passengers"),
            F.min("passenger_count").alias("min_passengers"),
            F.max("passenger_count").alias("max_passengers"),
            *extra,
        )
    )


def _as_q2(stats: DataFrame) -> DataFrame:
    return stats.withColumns(
        {
            "hour_range": fn.hour_range("pickup_hour"),
            "avg_passengers_per_trip": agg.avg_passengers(6),
            "total_passengers": F.col("s_passengers").cast("double"),
            "avg_amount_per_trip": agg.avg_amount(4),
            "period_classification": fn.period_pt("pickup_hour"),
        }
    )


def q2_extended(silver: DataFrame, month: int = 5) -> DataFrame:
    """Passengers per hour with spread, exact median, minimum and maximum."""
    may = silver.filter(F.col("source_month") == month)
    median = agg.discrete_median(may, ["pickup_hour"], "passenger_count", "median_passengers")
    stats = _q2_stats(may, None).join(median, "pickup_hour")
    return stats.select(*_Q2_COLUMNS).orderBy("pickup_hour")


def q2_extended_approx(silver: DataFrame, month: int = 5, accuracy: int = 10000) -> DataFrame:
    may = silver.filter(F.col("source_month") == month)
    stats = _q2_stats(may, F.percentile_approx("passenger_count", 0.5, accuracy))
    return stats.select(*_Q2_COLUMNS).orderBy("pickup_hour")


def q2_ranked(silver: DataFrame, month: int = 5) -> DataFrame:
    """Hours of a month with their rank by mean passengers and by trips."""
    hours = _passengers_by(silver.filter(F.col("source_month") == month), "pickup_hour")
    return hours.select(
        "pickup_hour",
        fn.hour_range("pickup_hour").alias("hour_range"),
        agg.avg_passengers(6).alias("avg_passengers_per_trip"),
        "total_trips",
        fn.period_pt("pickup_hour").alias("period_classification"),
        F.dense_rank()
        .over(Window.orderBy(F.desc(agg.avg_passengers(6))))
        .alias("rank_by_avg_passengers"),
        F.dense_rank().over(Window.orderBy(F.desc("total_trips"))).alias("rank_by_trip_volume"),
    )


def q2_top_hours(silver: DataFrame, month: int = 5, k: int = 5) -> DataFrame:
    """The ``k`` best ranks by mean passengers; ties share a rank and all stay."""
    return (
        q2_ranked(silver, month)
        .filter(F.col("rank_by_avg_passengers") <= k)
        .select("hour_range", "avg_passengers_per_trip", "total_trips", "period_classification")
        .orderBy(F.desc("avg_passengers_per_trip"), "hour_range")
    )


# ------------------------------------------------------- fleet against fleet
def comparison_report(comparison: DataFrame) -> DataFrame:
    return comparison.orderBy("taxi_type").select(
        "taxi_type",
        "service_area",
        "total_trips",
        F.format_number("total_revenue", 2).alias("total_revenue_formatted"),
        "avg_fare",
        "avg_passengers",
        "avg_distance",
        "avg_tip_percentage",
    )


def market_share(monthly: DataFrame) -> DataFrame:
    """Shares, revenue per trip and per mile.

    ``avg_*`` and ``revenue_per_mile`` average the monthly averages as they
    are; the ``*_weighted`` columns are means over all trips, from the sums that
    the mart carries.
    """
    averages = {
        "avg_fare": "avg_amount_per_trip",
        "avg_passengers": "avg_passengers_per_trip",
        "avg_distance": "avg_trip_distance",
    }
    totals = monthly.groupBy("taxi_type").agg(
        F.sum("total_trips").alias("total_trips"),
        F.sum(fn.hundredths("total_revenue")).alias("s_amount"),
        F.count("*").alias("months"),
        *[F.sum(fn.hundredths(c)).alias(f"s_{n}") for n, c in averages.items()],
        F.sum(fn.hundredths("total_revenue")).alias("w_avg_fare"),
        (F.sum("total_passengers") * 100).alias("w_avg_passengers"),
        F.sum(fn.hundredths("total_distance")).alias("w_avg_distance"),
    )
    everything = Window.partitionBy()
    plain_distance = F.col("s_avg_distance") / F.col("months") / 100.0
    weighted_distance = F.col("w_avg_distance") / F.col("total_trips") / 100.0
    per_mile = lambda d: fn.rounded(
        F.try_divide(F.try_divide(agg.revenue(), d), F.col("total_trips").cast("double")), 2
    )
    return totals.select(
        "taxi_type",
        "total_trips",
        agg.revenue().alias("total_revenue"),
        fn.percent("total_trips", F.sum("total_trips").over(everything)).alias("trip_market_share"),
        fn.percent("s_amount", F.sum("s_amount").over(everything)).alias("revenue_market_share"),
        *[fn.mean(f"s_{n}", "months", 4, scale=2).alias(n) for n in averages],
        agg.avg_amount().alias("revenue_per_trip"),
        per_mile(plain_distance).alias("revenue_per_mile"),
        *[fn.mean(f"w_{n}", "total_trips", 4, scale=2).alias(f"{n}_weighted") for n in averages],
        per_mile(weighted_distance).alias("revenue_per_mile_weighted"),
    ).orderBy("taxi_type")


def hourly_pivot(hourly: DataFrame) -> DataFrame:
    """The fleets side by side, one row per hour."""
    sides = (
        hourly.groupBy("pickup_hour", "hour_range")
        .pivot("taxi_type", ["yellow", "green"])
        .agg(
            F.sum("total_trips").alias("trips"),
            F.avg("avg_passengers_per_trip").alias("avg_passengers"),
            F.avg("avg_amount_per_trip").alias("avg_fare"),
        )
    )
    return (
        sides.fillna(0, ["yellow_trips", "green_trips"])
        .orderBy("pickup_hour")
        .select(
            "hour_range",
            "yellow_trips",
            "green_trips",
            *[
                fn.rounded(f"{fleet}_{m}", digits).alias(f"{fleet}_{m}")
                for m, digits in (("avg_passengers", 3), ("avg_fare", 2))
                for fleet in ("yellow", "green")
            ],
        )
    )


def period_share(hourly: DataFrame) -> DataFrame:
    """Trips per period of the day and their share of the fleet's trips."""
    periods = hourly.groupBy("time_period", "taxi_type").agg(
        F.sum("total_trips").alias("total_trips"),
        fn.rounded(F.avg("avg_passengers_per_trip"), 4).alias("avg_passengers"),
        fn.rounded(F.avg("avg_amount_per_trip"), 4).alias("avg_fare"),
    )
    of_fleet = F.sum("total_trips").over(Window.partitionBy("taxi_type"))
    return periods.withColumn("pct_of_taxi_trips", fn.percent("total_trips", of_fleet)).orderBy(
        "taxi_type", fn.period_order("time_period")
    )


def monthly_trends(monthly: DataFrame) -> DataFrame:
    """Change of fare and trips against the fleet's previous month; its first month has none."""
    series = Window.partitionBy("taxi_type").orderBy("year", "month")
    fare, trips = F.col("avg_amount_per_trip"), F.col("total_trips")
    return (
        monthly.withColumns(
            {"prev_fare": F.lag(fare).over(series), "prev_trips": F.lag(trips).over(series)}
        )
        .filter(F.col("prev_fare").isNotNull())
        .orderBy("taxi_type", "year", "month")
        .select(
            "taxi_type",
            "year",
            "month",
            "month_name",
            "total_trips",
            "avg_amount_per_trip",
            fn.rounded(fare - F.col("prev_fare"), 2).alias("fare_change"),
            fn.percent(fare - F.col("prev_fare"), "prev_fare").alias("fare_change_pct"),
            (trips - F.col("prev_trips")).alias("trip_change"),
            fn.percent(trips - F.col("prev_trips"), "prev_trips").alias("trip_change_pct"),
        )
    )


def service_quality(comparison: DataFrame) -> DataFrame:
    rush = F.col("morning_rush_trips") + F.col("evening_rush_trips")
    return comparison.orderBy("taxi_type").select(
        "taxi_type",
        "service_area",
        "avg_passengers",
        "avg_distance",
        fn.rounded(F.col("avg_duration") / 60, 6).alias("avg_duration_hours"),
        "avg_tip_percentage",
        fn.tip_category("avg_tip_percentage").alias("tip_category"),
        rush.alias("rush_hour_trips"),
        fn.percent(rush, "total_trips").alias("rush_hour_percentage"),
    )


def strategy_table(spark: SparkSession) -> DataFrame:
    """The positioning of each fleet, with the display name reduced to its code."""
    names = ("display_name", "primary_market", "positioning", "target_customer", "recommendation")
    code = F.lower(F.substring_index("display_name", " ", 1))
    texts = local_table(spark, {n: list(column) for n, column in zip(names, zip(*STRATEGIES))})
    return texts.withColumn("taxi_type", code)


def strategy_segments(comparison: DataFrame) -> DataFrame:
    """Positioning next to the measured value segment of each fleet.

    The literal side has one row per fleet and a size Spark knows, so it is
    broadcast without a hint.
    """
    measured = comparison.select(
        "taxi_type",
        fn.business_model("taxi_type").alias("business_model"),
        "total_trips",
        "avg_fare",
        "avg_tip_percentage",
        fn.value_segment("avg_fare").alias("value_segment"),
    )
    return measured.join(strategy_table(comparison.sparkSession), "taxi_type").select(
        "taxi_type", "primary_market", "positioning", "target_customer", "business_model",
        "value_segment", "recommendation",
    )


# ----------------------------------------------------------------- validation
def validation_summary(yellow: DataFrame, month: int = 5) -> DataFrame:
    """Five metric/value rows from one pass over one fleet's trips."""
    totals = yellow.agg(
        F.count("*").alias("total_trips"),
        F.count_if(F.col("pickup_month") == month).alias("in_month"),
        F.min(F.to_date("tpep_pickup_datetime")).alias("first_day"),
        F.max(F.to_date("tpep_pickup_datetime")).alias("last_day"),
        F.sum("passenger_count").cast("bigint").alias("s_passengers"),
        F.sum(fn.hundredths("total_amount")).alias("s_amount"),
    )
    values = (
        F.col("total_trips").cast("string"),
        F.col("in_month").cast("string"),
        F.concat(F.col("first_day").cast("string"), F.lit(" a "), F.col("last_day").cast("string")),
        agg.avg_passengers().cast("string"),
        F.concat(F.lit("$"), agg.avg_amount().cast("string")),
    )
    rows = [
        F.struct(F.lit(label).alias("metric"), value.alias("value"))
        for label, value in zip(VALIDATION_LABELS, values)
    ]
    return totals.select(F.inline(F.array(*rows)))
