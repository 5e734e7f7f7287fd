"""Hand-made edge rows: flags, labels, conformance, provenance."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farebox import functions as fn, schema as S
from farebox.operators import bronze as b, quality, silver as s
from farebox.plans import gold, reports
from farebox.sources.conform import conform, conformance, union_by_name

COLUMNS = (
    "record_key string, VendorID bigint, pickup_datetime timestamp, dropoff_datetime timestamp, "
    "passenger_count double, trip_distance double, total_amount double, fare_amount double, "
    "tip_amount double, tolls_amount double, source_year int, source_month int, source_file string, "
    "taxi_type string"
)
START = datetime(2023, 5, 10, 8, 30)


def trip(key, *, vendor=1, start=START, minutes=10.0, people=1.0, total=20.0, fleet="yellow",
         month=5, tip=2.0):
    end = None if start is None or minutes is None else start + timedelta(minutes=minutes)
    return (key, vendor, start, end, people, 1.5, total, 15.0, tip, 0.0, 2023, month, "f", fleet)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def flags(spark, **rows):
    raw = b.bronze(frame(spark, *[trip(k, **v) for k, v in rows.items()]))
    keyed = raw.select("record_key", s.quality_flag().alias("flag"))
    return {r["record_key"]: r["flag"] for r in keyed.collect()}


def test_rows_without_needed_values_do_not_enter(spark):
    got = flags(
        spark,
        fine={},
        vendor={"vendor": None},
        pickup={"start": None},
        dropoff={"minutes": None},
        total={"total": None},
        backwards={"minutes": -1},
        people={"people": None},
        instant={"minutes": 0},
    )
    assert got == {"fine": "valid", "people": "missing_value", "instant": "invalid_duration"}


def test_flag_edges(spark):
    got = flags(
        spark,
        d1440={"minutes": 1440}, d1440_01={"minutes": 1440.02},
        t0={"total": 0.0}, t001={"total": 0.01}, t1000={"total": 1000.0}, t1000_01={"total": 1000.01},
        p0={"people": 0.0}, p1={"people": 1.0}, p6={"people": 6.0}, p7={"people": 7.0},
        two={"total": -1.0, "people": 0.0},
    )
    assert got == {
        "d1440": "valid", "d1440_01": "excessive_duration",
        "t0": "invalid_amount", "t001": "valid", "t1000": "valid", "t1000_01": "excessive_amount",
        "p0": "invalid_passengers", "p1": "valid", "p6": "valid", "p7": "excessive_passengers",
        "two": "invalid_amount",
    }


def test_valid_and_quarantine_make_the_raw_layer(spark, small):
    from farebox.plans.catalog import bronze

    raw = bronze(spark, small)
    assert s.silver(raw).count() + s.quarantine(raw).count() == raw.count()
    wrong = raw.filter(s.in_range() != (s.quality_flag() == s.VALID))
    assert wrong.isEmpty()


def labelled(spark, column, values, kind="int"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_periods(spark):
    hours = [0, 5, 6, 9, 10, 16, 17, 20, 21, 23, None]
    late, day = "late_night", ["morning_rush", "midday", "evening_rush", "night"]
    assert labelled(spark, fn.time_period, hours) == [late, late, *[d for d in day for _ in "ab"], late]
    assert labelled(spark, fn.period_pt, [6, 12, 18, 22, 3]) == [
        "Manhã (Rush)", "Meio do Dia", "Tarde (Rush)", "Noite", "Madrugada",
    ]


def test_other_labels(spark):
    assert labelled(spark, fn.hour_range, [0, 7, 23]) == [
        "00:00 - 01:00", "07:00 - 08:00", "23:00 - 24:00",
    ]
    assert labelled(spark, fn.month_name, [1, 3, 5, 6, 0, None]) == [
        "Janeiro", "Março", "Maio", None, None, None,
    ]
    assert labelled(spark, fn.fare_tier, [20.0, 20.01, 50.0, 50.01, None], "double") == [
        "Economy", "Standard", "Standard", "Premium", "Economy",
    ]
    assert labelled(spark, fn.tip_category, [10.0, 10.1, 15.0, 15.1], "double") == [
        "Baixo", "Médio", "Médio", "Alto",
    ]
    assert labelled(spark, fn.value_segment, [10.0, 12.0, 16.0], "double") == [
        "Low Value", "Medium Value", "High Value",
    ]
    assert labelled(spark, fn.service_area, ["yellow", "green", "fhv"], "string") == [
        "Manhattan/Airport", "Outer Boroughs", "Unknown",
    ]
    order = ["late_night", "midday", "morning_rush", "night", "evening_rush", "noon"]
    assert labelled(spark, fn.period_order, order, "string") == [5, 2, 1, 4, 3, None]


def test_rounding_is_half_up_and_exact(spark):
    assert labelled(spark, lambda x: fn.rounded(x, 2), [1.005, 2.675, -1.005], "double") == [
        1.01, 2.68, -1.01,
    ]
    assert labelled(spark, lambda x: fn.mean(x, F.lit(2), 2, scale=2), [24691], "bigint") == [123.46]
    assert labelled(spark, lambda x: fn.percent(x, F.lit(0)), [5], "int") == [None]


def test_unknown_fleet_is_refused(spark):
    with pytest.raises(ValueError, match="unknown fleet"):
        b.standardise(frame(spark, trip("a")), "fhv")


def test_mandatory_columns(spark):
    with pytest.raises(ValueError, match="passenger_count"):
        b.bronze(frame(spark, trip("a")).drop("passenger_count"))


def test_union_fills_columns_of_one_fleet_only(spark):
    yellow = frame(spark, trip("a")).drop("taxi_type").withColumnsRenamed(
        {"pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime"}
    )
    green = frame(spark, trip("b")).drop("taxi_type").withColumnsRenamed(
        {"pickup_datetime": "lpep_pickup_datetime", "dropoff_datetime": "lpep_dropoff_datetime"}
    ).withColumn("trip_type", F.lit(1))
    both = b.unify({"yellow": yellow, "green": green})
    got = {r["taxi_type"]: (r["trip_type"], r["pickup_datetime"]) for r in both.collect()}
    assert got == {"yellow": (None, START), "green": (1, START)}
    with pytest.raises(ValueError):
        union_by_name()


def test_conform_and_report(spark):
    schema = S.raw_schema("green")
    df = spark.createDataFrame(
        [("7", 1.0, "x"), ("bad", None, "y")], "VendorID string, passenger_count double, note string"
    )
    rows = conform(df, schema).collect()
    assert [r["VendorID"] for r in rows] == [7, None]
    assert conform(df, schema).columns == [*schema.names, "note"]
    report = {r["column_name"]: r for r in conformance(df, schema).collect()}
    assert report["VendorID"]["status"] == "type_drift" and report["VendorID"]["fitting_values"] == 1
    assert report["note"]["status"] == "extra" and report["extra"]["status"] == "missing"
    assert report["passenger_count"]["status"] == "ok"
    with pytest.raises(ValueError, match="total_amount"):
        conform(df, schema, required=("total_amount",))


def test_file_month_and_pickup_month_may_differ(spark):
    raw = b.bronze(frame(spark, trip("a"), trip("b", start=datetime(2023, 4, 30, 23, 59))))
    checks = quality.row_checks(raw, rules=quality.period_rules())
    got = {r["check_name"]: r["failures"] for r in checks.collect()}
    assert got == {"rule:period_match": 1, "rule:in_season": 0}


def test_quality_of_nothing_is_zero(spark):
    empty = frame(spark)
    assert quality.file_quality(empty).count() == 0
    assert empty.agg(quality.ratio(F.count_if(b.is_valid()), F.count("*"))).first()[0] == 0.0


def test_single_rows_and_first_months(spark):
    raw = b.bronze(
        frame(
            spark,
            trip("a", month=1, start=datetime(2023, 1, 5, 8)),
            trip("b", month=2, start=datetime(2023, 2, 5, 8), total=30.0),
        )
    )
    trips = s.silver(raw)
    spread = reports.q1_extended(trips).select("stddev_amount").collect()
    assert [r[0] for r in spread] == [None, None]
    trends = reports.monthly_trends(gold.monthly(trips)).collect()
    assert [(r["month"], r["fare_change"], r["fare_change_pct"]) for r in trends] == [(2, 10.0, 50.0)]
    series = reports.q1_monthly_change(trips).collect()
    assert [r["month_over_month_change"] for r in series] == [None, 10.0]


def test_checks(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, None), (None, "z")], "id int, kind string"
    )
    got = {
        r["check_name"]: (r["failures"], r["passed"])
        for r in quality.row_checks(df, ["id", "kind"], {"kind": ["a", "b"]}, {"low": F.col("id") < 2})
        .unionByName(quality.unique_check(df, "id"))
        .unionByName(quality.reference_check(df, "id", spark.range(1, 2), "id"))
        .collect()
    }
    assert got == {
        "not_null:id": (1, False), "not_null:kind": (1, False), "accepted_values:kind": (1, False),
        "rule:low": (2, False), "unique:id": (1, False), "reference:id": (1, False),
    }
