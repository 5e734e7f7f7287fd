"""Every operator and report as a named query over one data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from farebox import schema as S
from farebox.operators import aggregates, bronze as b, clusters, key_index, ml, quality, selection, silver as s, sketches, windows
from farebox.plans import gold, reports
from farebox.session import materialize, work_dir
from farebox.sources import files, layout, lineitem
from farebox.sources.conform import conformance
from farebox.sources.lake import Lake, register_views
from farebox.sources.upsert import upsert, upsert_partitions
from farebox.streaming import marts as arrivals

Query = Callable[[SparkSession, str], DataFrame]

AUDIT_COLUMNS = (
    "ingestion_timestamp", "silver_processed_at", "gold_processed_at", "dbt_processed_at",
    "first_ingestion", "last_ingestion",
)
# times of the batches, fixed so that states can be compared
SPLITTING_PERCENT = 99.5  # some files are below it, some above
MONTH = ("source_year", "source_month")
SKEW_ROWS = 10_000
# a season within this data's years; the rules' own lies after them
SEASON = replace(S.Thresholds(), first_day=date(1994, 1, 1), last_day=date(1997, 5, 31))
NEW_MONTH = (1995, 5)
BOX = {"pickup_date": (date(1995, 3, 1), date(1995, 8, 31)), "trip_distance": (5.0, 9.0)}
BOX_FILES = 16
# centres of a fit on a small month, rounded, as a caller keeps them
EARLIER_FIT = clusters.Centres(
    points=((490.0, 3.25, 304.0, 4.4), (503.0, 5.05, 985.0, 14.1), (507.5, 1.88, 1009.0, 14.5)),
    weights=(0.0035, 0.58, 0.0025, 0.174),
)
COMMITTED = tuple(datetime(2024, 1, day) for day in (1, 2, 3))


def plain(df: DataFrame) -> DataFrame:
    """Without the run's own clock; dates and times as text, decimals as double."""
    columns = []
    for field in df.schema.fields:
        if field.name in AUDIT_COLUMNS:
            continue
        c = F.col(field.name)
        if isinstance(field.dataType, T.DateType | T.TimestampType | T.TimestampNTZType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        columns.append(c.alias(field.name))
    return df.select(*columns)


# ---------------------------------------------------------------------- layers

def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw layer, from the source rows."""
    return b.bronze(lineitem.trip_feed(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean trips, straight from the source rows; nothing is written."""
    return s.silver(bronze(spark, sf_dir))


def yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.yellow_clean(silver(spark, sf_dir))


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.monthly(silver(spark, sf_dir))


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.hourly(silver(spark, sf_dir))


def comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.comparison(silver(spark, sf_dir))


def over(start: Query, *steps: Callable[[DataFrame], DataFrame]) -> Query:
    """A query that takes its start through some steps."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = start(spark, sf_dir)
        for step in steps:
            df = step(df)
        return plain(df)

    return run


# --------------------------------------------------------------------- sources
def bronze_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(b.unify(lineitem.fleet_feeds(spark, sf_dir)))


def conformance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The green fleet's files against the schema declared for them."""
    return conformance(lineitem.fleet_feeds(spark, sf_dir)["green"], S.raw_schema("green"))


def conformance_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yellow fleet's files against the schema declared for them."""
    return conformance(lineitem.fleet_feeds(spark, sf_dir)["yellow"], S.raw_schema("yellow"))


def land_files(spark: SparkSession, sf_dir: str, root: str | None = None, drift: bool = False) -> list[files.SourceFile]:
    """Write the feeds as monthly files of each fleet's shape; their manifest.

    With ``drift`` the green fleet's files have other types than declared.
    """
    root = root or work_dir(spark, "landing")
    found = []
    for code, feed in lineitem.fleet_feeds(spark, sf_dir).items():
        prefix = S.fleet(code).time_prefix
        times = [f"{prefix}_pickup_datetime", f"{prefix}_dropoff_datetime"]
        landed = feed.withColumns({t: F.col(t).cast("timestamp") for t in times})
        key = F.regexp_replace("source_file", r"\.parquet$", "")
        landed = landed.withColumn("file_key", key).drop("source_file", "record_key")
        if drift and code == "green":
            landed = landed.withColumns({"VendorID": F.col("VendorID").cast("int"), "passenger_count": F.col("passenger_count").cast("bigint")})
        landed.drop("source_year", "source_month").hint("rebalance", "file_key").write.partitionBy(
            "file_key"
        ).parquet(f"{root}/{code}")
        # one row per month of the calendar
        for row in landed.select("file_key", "source_year", "source_month").distinct().collect():
            path = f"{root}/{code}/file_key={row['file_key']}"
            found.append(files.SourceFile(code, row["source_year"], row["source_month"], path))
    return found


def manifest_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly files in, raw layer out, through a manifest."""
    feeds = files.read_manifest(spark, land_files(spark, sf_dir))
    return plain(
        b.unify(feeds).select(
            "taxi_type", "source_file", "source_year", "source_month", "VendorID",
            "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
            "total_amount", "trip_duration_minutes", "pickup_hour",
        )
    )


def lake_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers written, the monthly mart read back."""
    fresh = Lake(spark, work_dir(spark, "lake"))
    return plain(fresh.build(bronze(spark, sf_dir))[S.GOLD_MONTHLY])


# --------------------------------------------------------------------- quality
def dq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    return quality.trip_checks(bronze(spark, sf_dir), orders, "order_key", "o_orderkey", SEASON)


def new_month_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """May 1995 against the key indexes of all months before it and of the orders.

    A line's number is its order's with three more bits for its place in the order.
    """
    place = F.split_part("record_key", F.lit("|"), F.lit(2)).cast("bigint")
    feed = lineitem.trip_feed(spark, sf_dir).withColumn("line_key", F.col("order_key") * 8 + place)
    month = F.struct(*MONTH)
    new = F.struct(*(F.lit(v).alias(c) for c, v in zip(MONTH, NEW_MONTH, strict=True)))
    old, arrived = feed.filter(month < new), feed.filter(month == new)
    found = []
    for key in ("line_key", "order_key"):
        stored = materialize(key_index.key_index(old, key, *MONTH), f"index-{key}")
        found.append(key_index.unique_checks(key_index.key_index(arrived, key), stored, key))
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    parent = key_index.key_index(orders, "o_orderkey")
    found.append(key_index.reference_check(key_index.key_index(arrived, "order_key"), parent, "order_key"))
    return reduce(DataFrame.unionByName, found)


def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = F.lit(datetime(2002, 1, 1)).cast("timestamp_ntz")
    return plain(quality.freshness(bronze(spark, sf_dir), "pickup_datetime", as_of, 24, 24 * 7))


def file_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.file_quality(lineitem.trip_feed(spark, sf_dir))


# --------------------------------------------------------------------- upserts
def _content(df: DataFrame) -> DataFrame:
    return df.drop("silver_processed_at")


def batches(spark: SparkSession, sf_dir: str) -> list[tuple[str, datetime, DataFrame]]:
    """Valid trips; then one fleet's amounts raised by 1; then the quarantined rows added."""
    valid = _content(silver(spark, sf_dir))
    raised = valid.filter(F.col("taxi_type") == "yellow").withColumn(
        "total_amount", (aggregates.hundredths("total_amount") + 100) / 100.0
    )
    rest = _content(s.quarantine(bronze(spark, sf_dir)))
    return [*zip(("WRITE", "MERGE", "MERGE"), COMMITTED, (valid, raised, rest), strict=True)]


def content_at(spark: SparkSession, sf_dir: str, moment: datetime | None = None) -> DataFrame:
    """The batches up to ``moment`` put one over the other."""
    frames = [df for _, at, df in batches(spark, sf_dir) if moment is None or at <= moment]
    return plain(upsert(frames[0], frames[1:], "trip_id", late=True))


def upsert_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_at(spark, sf_dir)


def upsert_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by month, over which May of every year is laid: raised amounts, and rows that were in quarantine."""
    path = work_dir(spark, "by-month")
    layout.write_partitioned(_content(silver(spark, sf_dir)), path, *MONTH)
    _, (_, _, raised), (_, _, rest) = batches(spark, sf_dir)
    may = raised.unionByName(rest).filter(F.col("source_month") == 5)
    upsert_partitions(spark, path, may, ["trip_id"], MONTH)
    return plain(spark.read.parquet(path))


def arrivals_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly files taken up as they arrive, into hours of trips and revenue."""
    root = work_dir(spark, "arrivals")
    land_files(spark, sf_dir, f"{root}/landing", drift=True)
    return plain(arrivals.follow(spark, f"{root}/landing", root))


# ----------------------------------------------------------------------- cube
def trip_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.cube(silver(spark, sf_dir))


SPANS = {"month": ((1995, 5), (1995, 5)), "year": ((1995, 1), (1995, 12)), "all": ((1, 1), (9999, 12))}


def sketch_spans_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers for a month, a year and all months from monthly sketches, against the trips."""
    trips = silver(spark, sf_dir)
    return sketches.span_bounds(trips, materialize(sketches.monthly_sketches(trips), "sketches"), SPANS)


def selected_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact median amount of every fleet and month, by digits."""
    found = selection.selected(silver(spark, sf_dir), ["taxi_type", *MONTH], aggregates.hundredths("total_amount"), "cents")
    return found.select("taxi_type", *MONTH, aggregates.units("cents").alias("median_amount"))


def layout_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.layout_skew(silver(spark, sf_dir), ["pickup_hour", "pickup_date", "vendor_id"], SKEW_ROWS)


# -------------------------------------------------------------------- clusters
def cluster_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What centres are fitted on; sums of squares as text, for they are wider than any number type of others."""
    cells = clusters.coreset(silver(spark, sf_dir))
    return cells.withColumns({c: F.col(c).cast("string") for c in cells.columns if c.startswith("q")})


def earlier_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.outliers(clusters.assign(silver(spark, sf_dir), EARLIER_FIT))


def fitted_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = silver(spark, sf_dir)
    return clusters.outliers(clusters.assign(trips, clusters.fit(trips)))


def coreset_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the fitted clusters, wherever their centres lie."""
    return clusters.profile(fitted_clusters(spark, sf_dir)).agg(
        F.count("*").alias("clusters"), F.sum("trips").alias("trips"),
        F.bool_and(F.col("outliers") * 100 <= F.col("trips")).alias("outliers_within_bound"),
    )


# ---------------------------------------------------------------------- layout
def compact_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _content(silver(spark, sf_dir))
    return plain(layout.compact(trips, work_dir(spark, "compact")))


def balanced_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _content(silver(spark, sf_dir))
    return plain(layout.write_balanced(trips, work_dir(spark, "balanced")))


def zorder_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "zorder")
    layout.z_order(
        _content(silver(spark, sf_dir)), "pickup_date", "vendor_id", unique="trip_id"
    ).write.parquet(path)
    return plain(spark.read.parquet(path))


def layout_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a box under two curves: all of them lie in the files a reader opens, which are not all files."""
    trips = _content(silver(spark, sf_dir))
    inside = reduce(lambda x, y: x & y, (F.col(k).between(F.lit(lo), F.lit(hi)) for k, (lo, hi) in BOX.items()))
    found = []
    for name, order in (("hilbert", layout.hilbert_order), ("z", layout.z_order)):
        path = work_dir(spark, f"curve-{name}")
        order(trips, *BOX, unique="trip_id", files=BOX_FILES).write.parquet(path)
        laid = spark.read.parquet(path)
        boxes = layout.file_boxes(laid, *BOX)
        opened = layout.touched(boxes, BOX).select("file_path", F.lit(1).alias("opened"))
        held = laid.filter(inside).groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("n"))
        found.append(
            boxes.join(opened, "file_path", "left").join(held, "file_path", "left").agg(
                F.lit(name).alias("curve"), F.sum("rows").alias("record_count"), F.sum("n").alias("box_rows"),
                F.sum(F.when(F.col("opened") == 1, F.col("n"))).alias("opened_rows"),
                (F.sum("opened") < F.count("*")).alias("skips_files"),
            )
        )
    return found[0].unionByName(found[1])


def view_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly mart as SQL users ask for it, by its public name."""
    register_views(bronze(spark, sf_dir))
    return plain(spark.sql(f"SELECT * FROM {S.GOLD_MONTHLY}"))


def view_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of the staging view by fleet, time of day and fare tier, asked in SQL."""
    register_views(bronze(spark, sf_dir))
    return spark.sql(f"SELECT taxi_type, time_period, fare_tier, COUNT(*) AS trips FROM {S.STAGING_VIEW} GROUP BY ALL")


def partitioned_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips laid out by year and month; the report reads the May folders only."""
    trips = layout.write_partitioned(
        _content(silver(spark, sf_dir)), work_dir(spark, "months"), "source_year", "source_month"
    )
    return plain(gold.hourly(trips))


def bucketed_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips and revenue per hour and day, read from buckets of just these keys."""
    trips = _content(silver(spark, sf_dir))
    name = f"trips_by_hour_{uuid.uuid4().hex}"
    buckets = layout.buckets_for(trips)
    table = layout.write_bucketed(trips, name, work_dir(spark, "buckets"), buckets, "pickup_hour", "pickup_date")
    try:
        return plain(materialize(aggregates.hours_and_days(table), "by-hour"))
    finally:
        spark.sql(f"DROP TABLE {name}")


def layout_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.rows_per_layout_key(silver(spark, sf_dir), "source_year", "source_month")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.q1_extended(silver(spark, sf_dir))
    path = work_dir(spark, "csv")
    layout.export_csv(report, path)
    return layout.read_csv(spark, path, report.schema)


# ---------------------------------------------------------------------- catalog
def queries() -> dict[str, Query]:
    return {
        # raw and clean layers
        "bronze_valid_trips": over(bronze),
        "bronze_unified": bronze_unified,
        "refused_rows": lambda sp, d: plain(
            b.refused(lineitem.trip_feed(sp, d)).select("record_key", "taxi_type", "source_file", "refusal")
        ),
        "bronze_trip_id": over(bronze, lambda d: d.select("trip_id", "VendorID", "pickup_datetime")),
        "conformance_report": conformance_report,
        "conformance_yellow": conformance_yellow,
        "manifest_ingest": manifest_ingest,
        "silver_trips": over(silver),
        "silver_quality_flags": over(bronze, s.flag_counts),
        "quarantine_trips": over(bronze, s.quarantine),
        "stg_fare_tier": over(silver, s.staging),
        # marts
        "gold_monthly": over(monthly),
        "gold_hourly_may": over(hourly),
        "gold_comparison": over(comparison),
        "lake_build": lake_build,
        "cube_monthly": over(trip_cube, gold.monthly_of),
        "cube_hourly_may": over(trip_cube, gold.hourly_of),
        "cube_comparison": over(trip_cube, gold.comparison_of),
        "sketch_spans_bound": sketch_spans_bound,
        "selected_medians": selected_medians,
        "stats_bronze": over(bronze, quality.bronze_stats),
        "stats_silver": over(silver, quality.silver_stats),
        "stats_flagged": over(bronze, s.flagged, lambda d: quality.silver_stats(d, "Flagged")),
        "stats_gold": over(monthly, quality.gold_stats),
        # question 1
        "q1_report_gold": over(monthly, reports.q1_report),
        "q1_distribution": over(monthly, reports.q1_distribution),
        "q1_formatted_revenue": over(monthly, reports.q1_titled),
        "q1_from_silver": over(silver, reports.q1_from_silver),
        "q1_mom_change": over(yellow, reports.q1_month_over_month),
        "q1_monthly_change": over(silver, reports.q1_monthly_change),
        "q1_extended": over(silver, reports.q1_extended),
        "q1_median_bound": over(silver, reports.q1_median_bound),
        "q1_extended_approx": over(silver, reports.q1_extended_approx),
        # question 2
        "q2_report_gold": over(hourly, reports.q2_report),
        "q2_business_hours": over(hourly, reports.q2_business_hours),
        "q2_from_silver": over(silver, reports.q2_from_silver),
        "q2_extended": over(silver, reports.q2_extended),
        "q2_extended_approx": over(silver, reports.q2_extended_approx),
        "q2_ranked_hours": over(silver, reports.q2_ranked),
        "q2_rank_hours_top5": over(silver, reports.q2_top_hours),
        "q2_text_bar": over(yellow, reports.q2_text_bar),
        "month_by_hour": over(yellow, reports.month_by_hour),
        "may_peak_passengers": over(yellow, reports.peak_passengers),
        # fleets compared
        "comparison_formatted": over(comparison, reports.comparison_report),
        "market_share": over(monthly, reports.market_share),
        "hourly_pivot": over(hourly, reports.hourly_pivot),
        "period_share": over(hourly, reports.period_share),
        "monthly_trends": over(monthly, reports.monthly_trends),
        "service_quality": over(comparison, reports.service_quality),
        "strategy_segments": over(comparison, reports.strategy_segments),
        # windows over trips
        "running_hour_count": over(
            silver,
            windows.running_hour_count,
            lambda d: d.select("trip_id", "pickup_date", "pickup_hour", "trips_in_hour"),
        ),
        "running_daily_total": over(
            silver,
            windows.running_daily_total,
            lambda d: d.select("trip_id", "pickup_date", "running_daily_total"),
        ),
        "prev_trip_amount": over(
            silver,
            lambda d: d.select("trip_id", "vendor_id", "pickup_datetime", "total_amount"),
            windows.previous_trip_amount,
        ),
        "peak_hour_per_day": over(silver, windows.peak_hour_per_day),
        "peak_hour_first_rows": over(silver, windows.first_peak_hours),
        # quality
        "validation_summary": over(yellow, reports.validation_summary),
        "file_quality": file_quality,
        "ingestion_summary": lambda sp, d: quality.ingestion_summary(file_quality(sp, d)),
        "files_below_threshold": lambda sp, d: quality.below_threshold(file_quality(sp, d), SPLITTING_PERCENT),
        "fleet_counts": over(silver, quality.fleet_counts),
        "dq_checks": dq_checks,
        "freshness": source_freshness,
        # statistics and clusters
        "corr_matrix_long": over(silver, ml.correlations),
        "kmeans_profile": over(silver, ml.kmeans, ml.cluster_profile),
        "kmeans_checks": over(silver, ml.kmeans, ml.cluster_checks),
        "kmeans_outliers": over(silver, ml.kmeans, ml.flag_outliers),
        "cluster_cells": cluster_cells,
        "centre_profile": over(earlier_clusters, clusters.profile),
        "centre_outliers": over(earlier_clusters, lambda d: d.select("trip_id", "cluster", "is_outlier")),
        "coreset_profile": over(fitted_clusters, clusters.profile),
        "coreset_checks": coreset_checks,
        # versions and file layout
        "upsert_trips": upsert_trips,
        "upsert_months": upsert_months,
        "arrivals_hourly": arrivals_hourly,
        "compact_layout": compact_layout,
        "balanced_layout": balanced_layout,
        "zorder_layout": zorder_layout,
        "partitioned_layout": partitioned_layout,
        "bucketed_layout": bucketed_layout,
        "layout_distribution": layout_distribution,
        "layout_vendors_bound": lambda sp, d: aggregates.vendors_bound(silver(sp, d), "source_year", "source_month"),
        "layout_skew": layout_skew,
        "layout_boxes": layout_boxes,
        "new_month_keys": new_month_keys,
        "view_monthly": view_monthly,
        "view_staging": view_staging,
        "layout_rows": lambda sp, d: layout_distribution(sp, d).drop("unique_vendors"),
        "csv_roundtrip": csv_roundtrip,
    }
