"""What the plans look like: pruning, pushdown, no Python, no global work over trips."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from farebox.operators import silver
from farebox.plans import catalog
from farebox.sources import lineitem

LIBRARY = Path(__file__).resolve().parent.parent / "farebox"
MARTS = ("gold_monthly", "gold_hourly_may", "gold_comparison", "q1_extended", "q2_ranked_hours",
         "market_share", "running_hour_count", "running_daily_total", "peak_hour_per_day",
         "corr_matrix_long", "validation_summary", "hourly_pivot")


def plan(df, mode="simple"):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


@pytest.mark.parametrize("name", MARTS)
def test_no_python_and_no_cartesian_product(spark, small, name):
    text = plan(catalog.queries()[name](spark, small))
    assert "Python" not in text and "Arrow" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_literal_side_is_broadcast_by_its_known_size(spark, small):
    text = plan(catalog.queries()["strategy_segments"](spark, small))
    assert "BroadcastHashJoin" in text and "LocalTableScan" in text


def test_may_report_prunes_folders_and_columns(spark, small, tmp_path):
    from farebox.plans import reports
    from farebox.sources import layout

    trips = layout.write_partitioned(catalog.silver(spark, small), str(tmp_path / "p"), "source_year", "source_month")
    text = plan(reports.q2_from_silver(trips))
    assert re.search(r"PartitionFilters: \[isnotnull\(source_month\S+, \(source_month\S+ = 5\)", text)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"taxi_type", "passenger_count", "pickup_hour"}


def test_reports_scan_only_their_columns(spark, small):
    text = plan(catalog.queries()["fleet_counts"](spark, small), "formatted")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert len(schema.split(",")) <= 9


def test_range_rules_reach_the_scan(spark, small, tmp_path):
    from farebox.operators import silver as s

    path = str(tmp_path / "raw")
    catalog.bronze(spark, small).write.parquet(path)
    text = plan(s.silver(spark.read.parquet(path)).select("total_amount"), "formatted")
    for bound in ("GreaterThan(total_amount,0.0)", "LessThanOrEqual(total_amount,1000.0)",
                  "LessThanOrEqual(passenger_count,6.0)", "LessThanOrEqual(trip_duration_minutes,1440.0)"):
        assert bound in text


@pytest.mark.parametrize("name", ("q1_monthly_change", "q2_ranked_hours", "market_share"))
def test_single_partition_only_above_an_aggregate(spark, small, name):
    lines = plan(catalog.queries()[name](spark, small)).splitlines()
    singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert singles and all(any("HashAggregate" in x for x in lines[i:]) for i in singles)


def test_trip_windows_have_no_window_over_a_whole_vendor(spark, small):
    """The only window by vendor alone runs over one row per minute; nothing is written in between."""
    text = plan(catalog.queries()["prev_trip_amount"](spark, small))
    alone = re.findall(r"Window \[lag\([^\n]*\], \[vendor_id#\w+\], \[", text)
    assert len(alone) <= 1 and "slices" not in text and "RoundRobin" not in text


@pytest.mark.parametrize("name", ("running_daily_total", "running_hour_count"))
def test_running_totals_share_one_aggregate(spark, small, name):
    df = catalog.queries()[name](spark, small)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_library_does_not_pull_rows_to_the_driver():
    # months of the calendar; in marts.py also the paths of one batch of files
    allowed = {"lake.py": 1, "catalog.py": 1, "upsert.py": 3, "marts.py": 2}
    for path in LIBRARY.rglob("*.py"):
        if "llm" in path.parts:  # bounded samples and filters, see there
            continue
        text = path.read_text()
        assert "toPandas" not in text and "localCheckpoint" not in text and "crossJoin" not in text
        assert text.count(".collect()") <= allowed.get(path.name, 0), path


@pytest.mark.parametrize("name", ("gold_monthly", "running_daily_total", "q1_extended"))
def test_result_does_not_depend_on_partitions(spark, small, name):
    query = catalog.queries()[name]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(sorted(map(str, query(spark, small).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_sums_agree_across_layers(spark, small):
    run = lambda n: catalog.queries()[n](spark, small)
    trips = run("silver_trips").count()
    assert run("gold_monthly").groupBy().sum("total_trips").first()[0] == trips
    shares = run("market_share").groupBy().sum("trip_market_share", "revenue_market_share").first()
    assert all(abs(x - 100) < 0.011 for x in shares)
    days = run("peak_hour_per_day").select("pickup_date").distinct().count()
    assert days == run("silver_trips").select("pickup_date").distinct().count()


@pytest.mark.parametrize(
    "name, keys",
    [
        ("q2_report_gold", ["taxi_type", "hour_range"]),
        ("q2_extended", ["pickup_hour"]),
        ("q1_extended", ["source_year", "source_month"]),
        ("q1_monthly_change", ["source_year", "source_month"]),
        ("market_share", ["taxi_type"]),
        ("hourly_pivot", ["hour_range"]),
        ("monthly_trends", ["taxi_type", "year"]),
        ("peak_hour_per_day", ["pickup_date", "pickup_hour"]),
        ("ingestion_summary", ["taxi_type"]),
    ],
)
def test_ordered_reports_come_in_order(spark, small, name, keys):
    rows = catalog.queries()[name](spark, small).collect()
    seen = [tuple(r[k] for k in keys) for r in rows]
    assert len(rows) > 1 and seen == sorted(seen)


def test_trips_of_large_tables_are_derived_in_functions_the_jvm_compiles(spark, small, monkeypatch):
    """A table too large for the extra shuffle is read and derived in one stage; methods over 8000 bytes are interpreted."""
    monkeypatch.setattr(lineitem, "SPREAD_BYTES", (1 << 60, 1 << 60))
    raw = catalog.bronze(spark, small)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (catalog.plain(silver.silver(raw)), silver.quarantine(raw)):
            code = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
            sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]
            assert sizes and all(0 < n <= 8000 for n in sizes), sizes
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
