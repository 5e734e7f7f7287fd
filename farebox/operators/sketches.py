"""Mergeable sketches per month, so that any span of months is answered without its trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from farebox.functions import hundredths, units

LG_K, KLL_K = 12, 400
MONTHS = "source_year * 12 + source_month - 1"


def monthly_sketches(silver: DataFrame, lg_k: int = LG_K, k: int = KLL_K) -> DataFrame:
    """Per fleet and month: trips, and sketches of the vendors, the days and the amounts (in hundredths)."""
    return silver.groupBy("taxi_type", "source_year", "source_month").agg(
        F.count("*").alias("total_trips"),
        F.hll_sketch_agg("vendor_id", lg_k).alias("vendors"),
        F.hll_sketch_agg(F.unix_date("pickup_date"), lg_k).alias("days"),
        F.kll_sketch_agg_bigint(hundredths("total_amount"), k).alias("amounts"),
    )


def _amount(share: float) -> Column:
    return units(F.kll_sketch_get_quantile_bigint("amounts", F.lit(share)))


def over_months(sketches: DataFrame, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """Per fleet, from the (year, month) ``first`` to ``last``: trips, about how many vendors and days, and amounts at three ranks.

    Distinct counts have a relative deviation of about 1.04 / sqrt(2 ** lg_k),
    ranks one of about 1 / k, however many months are merged.
    """
    low, high = (y * 12 + m - 1 for y, m in (first, last))
    merged = sketches.filter(F.expr(MONTHS).between(low, high)).groupBy("taxi_type").agg(
        F.sum("total_trips").alias("total_trips"), F.hll_union_agg("vendors").alias("vendors"),
        F.hll_union_agg("days").alias("days"), F.kll_merge_agg_bigint("amounts").alias("amounts"),
    )
    return merged.select(
        "taxi_type", "total_trips", F.hll_sketch_estimate("vendors").alias("vendors"), F.hll_sketch_estimate("days").alias("days"),
        _amount(0.5).alias("median_amount"), _amount(0.9).alias("amount_at_90"),
    )


def span_bounds(silver: DataFrame, sketches: DataFrame, spans: dict[str, tuple[tuple[int, int], tuple[int, int]]]) -> DataFrame:
    """Exact vendors and days per span and fleet, and whether the sketches' answers are as near as they should be.

    Counts may be three deviations off, the median's true rank three hundredths.
    """
    out = None
    for name, (first, last) in spans.items():
        low, high = (y * 12 + m - 1 for y, m in (first, last))
        near = over_months(sketches, first, last).select(
            "taxi_type", F.col("vendors").alias("n_vendors"), F.col("days").alias("n_days"), "median_amount"
        )
        trips = silver.filter(F.expr(MONTHS).between(low, high)).select("taxi_type", "vendor_id", "pickup_date", "total_amount")
        exact = trips.join(near, "taxi_type").groupBy("taxi_type", "n_vendors", "n_days").agg(
            F.count("*").alias("total_trips"), F.countDistinct("vendor_id").alias("vendors"), F.countDistinct("pickup_date").alias("days"),
            F.count_if(F.col("total_amount") < F.col("median_amount")).alias("below"),
            F.count_if(F.col("total_amount") <= F.col("median_amount")).alias("upto"),
        )

        def about(estimate: str, value: str) -> Column:
            return F.abs(F.col(estimate) - F.col(value)) <= F.ceil(3 * 1.04 / 2 ** (LG_K / 2) * F.col(value))

        rows = exact.select(
            F.lit(name).alias("span"), "taxi_type", "total_trips", "vendors", "days",
            (about("n_vendors", "vendors") & about("n_days", "days")).alias("counts_within_bound"),
            ((F.col("below") <= 0.53 * F.col("total_trips")) & (F.col("upto") >= 0.47 * F.col("total_trips"))).alias("median_within_bound"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out
