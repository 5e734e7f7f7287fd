"""Sliced windows against plain ones and against brute force, with crowded keys."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window, functions as F

from farebox.operators import aggregates, windows


@pytest.fixture(scope="module")
def crowded(spark):
    """One vendor, day and minute hold most rows; many share one instant."""
    rng = random.Random(7)
    day = datetime(2023, 5, 1)
    rows = []
    for i in range(3000):
        crowd = rng.random() < 0.6
        start = day + timedelta(
            days=0 if crowd else rng.randrange(4), hours=8 if crowd else rng.randrange(24),
            minutes=0 if crowd else rng.randrange(60), seconds=rng.choice([0, 0, 0, 1, 59]),
        )
        vendor = 1 if rng.random() < 0.8 else rng.randrange(2, 6)
        rows.append((f"t{i:05d}", vendor, start, start.date(), start.hour, rng.randrange(1, 9999) / 100))
    df = spark.createDataFrame(
        rows,
        "trip_id string, vendor_id bigint, pickup_datetime timestamp, pickup_date date, "
        "pickup_hour int, total_amount double",
    )
    return df.repartition(6)


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_running_hour_count(crowded):
    peers = Window.partitionBy("pickup_date", "pickup_hour").orderBy("pickup_datetime")
    plain = crowded.select("trip_id", F.count("*").over(peers).alias("n"))
    same(windows.running_hour_count(crowded).select("trip_id", "trips_in_hour"), plain)


def test_running_daily_total(crowded):
    peers = Window.partitionBy("pickup_date").orderBy("pickup_datetime")
    cents = F.sum(F.round(F.col("total_amount") * 100).cast("bigint")).over(peers)
    plain = crowded.select("trip_id", (cents / 100.0).alias("n"))
    same(windows.running_daily_total(crowded).select("trip_id", "running_daily_total"), plain)


def test_previous_trip_amount(crowded):
    order = Window.partitionBy("vendor_id").orderBy("pickup_datetime", "trip_id")
    plain = crowded.select("trip_id", F.lag("total_amount").over(order).alias("p"))
    same(windows.previous_trip_amount(crowded).select("trip_id", "prev_trip_amount"), plain)


def test_previous_value_with_null_keys(crowded):
    some = crowded.withColumn("vendor_id", F.when(F.col("vendor_id") == 1, F.col("vendor_id")))
    order = Window.partitionBy("vendor_id").orderBy("pickup_datetime", "trip_id")
    plain = some.select("trip_id", F.lag("total_amount").over(order).alias("p"))
    same(windows.previous_trip_amount(some).select("trip_id", "prev_trip_amount"), plain)


def test_peak_hours_keep_ties(spark):
    rows = [(datetime(2023, 5, 1).date(), h) for h in (7, 7, 9, 9, 10)]
    df = spark.createDataFrame(rows, "pickup_date date, pickup_hour int")
    got = [(r["pickup_hour"], r["trips_in_hour"]) for r in windows.peak_hour_per_day(df).collect()]
    assert got == [(7, 2), (9, 2)]


def test_discrete_median(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("b", 9.0), ("c", None), *[("d", 5.0)] * 7]
    df = spark.createDataFrame(rows, "k string, v double")
    got = dict(aggregates.discrete_median(df, ["k"], "v", "m").collect())
    assert got == {"a": 2.0, "b": 9.0, "d": 5.0}
