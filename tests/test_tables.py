"""Versions, upsert, layouts, file ingestion and the layer tables."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.operators import aggregates, bronze as b, ml, silver as s
from farebox.plans import catalog
from farebox.session import CHECKPOINT_CONF, work_dir, work_root
from farebox.sources import files, layout
from farebox.sources.lake import Lake, register_views, use_database
from farebox.sources.upsert import upsert


def content(df):
    return {r["id"]: r["v"] for r in df.collect()}


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, "id string, v int")


def test_upsert_replaces_and_adds(spark):
    target, batch = rows_of(spark, ("a", 1), ("b", 2)), rows_of(spark, ("b", 20), ("c", 30))
    once = upsert(target, batch, "id")
    assert content(once) == {"a": 1, "b": 20, "c": 30}
    assert content(upsert(once, batch, "id")) == content(once)
    wider = spark.createDataFrame([("c", 3, "n")], "id string, v int, note string")
    assert {r["id"]: r["note"] for r in upsert(target, wider, "id").collect()} == {"a": None, "b": None, "c": "n"}
    assert content(upsert(target, rows_of(spark), "id")) == {"a": 1, "b": 2}


@pytest.mark.parametrize("bad", [[("b", 1), ("b", 2)], [(None, 1)]])
def test_upsert_refuses_doubled_and_null_keys(spark, bad):
    good = rows_of(spark, ("a", 1))
    with pytest.raises(ValueError, match="batch has"):
        upsert(good, rows_of(spark, *bad), "id")
    with pytest.raises(ValueError, match="target has"):
        upsert(rows_of(spark, *bad), good, "id")


def test_upsert_of_several_batches_in_one_shuffle(spark):
    target = rows_of(spark, ("a", 1), ("b", 2), ("c", 3)).repartition(3)
    layers = [rows_of(spark, ("b", 20), ("d", 4)).repartition(3), rows_of(spark, ("b", 200), ("e", 5)).repartition(3)]
    done = upsert(target, layers, "id", late=True)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("hashpartitioning(id") == 1
    assert sorted(map(tuple, done.collect())) == [("a", 1), ("b", 200), ("c", 3), ("d", 4), ("e", 5)]
    assert content(done) == content(upsert(upsert(target, layers[0], "id"), layers[1], "id"))
    with pytest.raises(ValueError, match="batch 2 has"):
        upsert(target, [layers[0], rows_of(spark, ("z", 1), ("z", 2))], "id")


@pytest.mark.parametrize("bad", [[("b", 1), ("b", 2)], [(None, 1)]])
def test_upsert_refuses_late_or_leaves_it_to_the_caller(spark, bad):
    good = rows_of(spark, ("b", 1))
    for target, batch in ((good, rows_of(spark, *bad)), (rows_of(spark, *bad), good)):
        with pytest.raises(Exception, match="a NULL id, or one"):
            upsert(target, batch, "id", late=True).collect()
    kept = upsert(good, rows_of(spark, *bad), "id", check=False).collect()
    assert sorted(map(str, kept)) == sorted(map(str, rows_of(spark, *bad, *([] if bad[0][0] else [("b", 1)])).collect()))


def test_z_order_lets_a_box_skip_files(spark):
    rng = spark.range(40000).select(
        F.col("id").cast("string").alias("u"),
        (F.hash("id") % 1000).alias("x"),
        (F.hash(F.col("id") + 7) % 1000).alias("y"),
    )
    path = work_dir(spark, "z")
    layout.z_order(rng, "x", "y", unique="u", files=16).write.parquet(path)
    back = spark.read.parquet(path)
    assert back.count() == 40000
    ends = back.groupBy(F.input_file_name().alias("f")).agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")
    )
    hit = ends.filter("x0 <= 500 and x1 >= 500 and y0 <= 500 and y1 >= 500").count()
    assert ends.count() == 16 and hit <= 6


def test_z_order_cuts_a_crowded_value(spark):
    crowd = spark.range(20000).select(F.col("id").cast("string").alias("u"), F.lit(1).alias("x"), F.lit(2).alias("y"))
    path = work_dir(spark, "z")
    layout.z_order(crowd, "x", "y", unique="u", files=8).write.parquet(path)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 20000 / 8


def test_compaction_and_partitions(spark, small):
    trips = catalog.silver(spark, small)
    path = work_dir(spark, "c")
    back = layout.compact(trips.repartition(8), path)
    assert back.select(F.input_file_name()).distinct().count() == 1 and back.count() == trips.count()
    wide = spark.range(400_000).select(F.md5(F.col("id").cast("string")).alias("x"))
    split = layout.compact(wide, work_dir(spark, "c"), part_bytes=2 << 20)
    assert 3 <= split.select(F.input_file_name()).distinct().count() <= 20
    months = layout.write_partitioned(trips, work_dir(spark, "p"), "source_year", "source_month")
    may = months.filter(F.col("source_month") == 5)
    assert "PartitionFilters: [isnotnull(source_month" in may._jdf.queryExecution().toString()


def test_files_through_a_manifest(spark):
    root = work_dir(spark, "landing")
    times = ["2023-01-31 23:50:00", "2023-02-01 00:10:00"]
    for fleet, prefix in (("yellow", "tpep"), ("green", "lpep")):
        for month in (1, 2):
            spark.createDataFrame([(1, *times, 5.0)] * 2, "VendorID long, a string, b string, total_amount double").select(
                "VendorID",
                F.col("a").cast("timestamp").alias(f"{prefix}_pickup_datetime"),
                F.col("b").cast("timestamp").alias(f"{prefix}_dropoff_datetime"),
                "total_amount",
                F.lit(1.0).alias("passenger_count"),
            ).coalesce(1).write.parquet(f"{root}/{files.file_key(fleet, 2023, month)}.parquet")
    entries = files.manifest(root, ["yellow", "green"], [(2023, 1), (2023, 2)])
    raw = b.unify(files.read_manifest(spark, entries))
    got = sorted(raw.groupBy("taxi_type", "source_file", "source_year", "source_month").count().collect())
    assert [tuple(r) for r in got] == [
        (f, f"{f}_tripdata_2023-0{m}.parquet", 2023, m, 2) for f in ("green", "yellow") for m in (1, 2)
    ]
    # exact copies of a row keep ids of their own, the same on every read
    ids = {r[0] for r in raw.select("trip_id").collect()}
    assert len(ids) == 8
    assert ids == {r[0] for r in b.unify(files.read_manifest(spark, entries)).select("trip_id").collect()}
    with pytest.raises(ValueError):
        files.read_manifest(spark, [files.SourceFile("fhv", 2023, 1, root)])


def test_arriving_files_enter_once(spark):
    from farebox.streaming.ingest import ingest_arrivals

    landing, target, state = (work_dir(spark, x) for x in ("landing", "raw", "state"))

    def land(month, rows):
        start = f"2023-{month:02d}-03 10:00:00"
        spark.createDataFrame([(1, start, start, 5.0)] * rows, "VendorID long, a string, b string, total_amount double").select(
            "VendorID",
            F.col("a").cast("timestamp").alias("lpep_pickup_datetime"),
            F.col("b").cast("timestamp").alias("lpep_dropoff_datetime"),
            "total_amount",
        ).coalesce(1).write.parquet(f"{landing}/{files.file_key('green', 2023, month)}.parquet")

    def months():
        rows = spark.read.parquet(target).groupBy("taxi_type", "source_month").count().collect()
        return {r["source_month"]: r["count"] for r in rows}

    land(1, 3)
    ingest_arrivals(spark, "green", landing, target, state)
    assert months() == {1: 3}
    land(2, 4)
    ingest_arrivals(spark, "green", landing, target, state)
    ingest_arrivals(spark, "green", landing, target, state)
    assert months() == {1: 3, 2: 4}
    assert spark.read.parquet(target).select("trip_id").distinct().count() == 7


def test_rows_per_partition(spark):
    from farebox.operators.aggregates import rows_per_partition

    sizes = {r[0]: r[1] for r in rows_per_partition(spark.range(0, 100, 1, 4)).collect()}
    assert sizes == {0: 25, 1: 25, 2: 25, 3: 25}


def test_lake_loads_a_month_without_touching_others(spark, small):
    raw = catalog.bronze(spark, small)
    lake = Lake(spark, work_dir(spark, "lake"))
    lake.load(raw)

    def times():
        root = lake.root.removeprefix("file:")
        return {
            f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns
            for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")
        }

    before, rows = times(), lake.read(S.SILVER_TRIPS).count()
    may = raw.filter("source_year = 1997 and source_month = 5")
    lake.load(may, may.select("source_year", "source_month"))
    after = times()
    gone = {f for f in before if after.get(f) != before[f]}
    assert gone and all("source_year=1997/source_month=5/" in f for f in gone)
    assert lake.read(S.SILVER_TRIPS).count() == rows


def test_reports_write_nothing(spark, small):
    root = work_root(spark).removeprefix("file:")
    before = {d for d, _, _ in os.walk(root)}
    for _ in range(2):
        assert catalog.queries()["gold_monthly"](spark, small).count() == 166
    assert {d for d, _, _ in os.walk(root)} == before


def monthly_file(spark, root, month, columns):
    frame = spark.range(2).select(
        F.lit("2023-01-31 23:50:00").cast("timestamp").alias("tpep_pickup_datetime"),
        F.lit("2023-02-01 00:10:00").cast("timestamp").alias("tpep_dropoff_datetime"),
        *(F.expr(sql).alias(name) for name, sql in columns.items()),
    )
    frame.coalesce(1).write.parquet(f"{root}/{files.file_key('yellow', 2023, month)}.parquet")


def test_files_that_differ_from_each_other(spark):
    root = work_dir(spark, "landing")
    monthly_file(spark, root, 1, {"VendorID": "1L", "total_amount": "5D", "passenger_count": "2D"})
    monthly_file(spark, root, 2, {"VendorID": "CAST(1 AS INT)", "total_amount": "6D", "passenger_count": "3L", "note": "'n'"})
    entries = files.manifest(root, ["yellow"], [(2023, 1), (2023, 2)])
    raw = b.unify(files.read_manifest(spark, entries))
    got = sorted(tuple(r) for r in raw.select("source_month", "VendorID", "passenger_count", "note").distinct().collect())
    assert got == [(1, 1, 2.0, None), (2, 1, 3.0, "n")]
    assert raw.count() == 4 and dict(raw.dtypes)["passenger_count"] == "double"
    monthly_file(spark, root, 3, {"VendorID": "1L", "passenger_count": "2D"})
    with pytest.raises(ValueError, match="2023-03.*total_amount"):
        files.read_manifest(spark, files.manifest(root, ["yellow"], [(2023, 1), (2023, 3)]))


def test_refused_rows_have_a_reason(spark, small):
    feed = catalog.lineitem.trip_feed(spark, small)
    assert b.refused(feed).count() + b.bronze(feed).count() == feed.count()
    broken = feed.limit(1).withColumn("total_amount", F.lit(None).cast("double"))
    assert b.refused(broken).first()["refusal"] == "missing_total_amount"


def test_buckets_spare_the_exchange(spark, small):
    trips = catalog.silver(spark, small)
    table = layout.write_bucketed(trips, "bucket_test", work_dir(spark, "b"), layout.buckets_for(trips, 1000), "pickup_hour", "pickup_date")
    try:
        plan = aggregates.hours_and_days(table)._jdf.queryExecution().toString()
        assert "Exchange" not in plan.split("== Physical Plan ==")[1]
        assert table.select(F.input_file_name()).distinct().count() <= 5
    finally:
        spark.sql("DROP TABLE bucket_test")


def test_sql_views(spark, small):
    register_views(catalog.bronze(spark, small))
    names = (S.BRONZE_TRIPS, S.SILVER_TRIPS, S.YELLOW_CLEAN, S.STAGING_VIEW, S.GOLD_MONTHLY,
             S.GOLD_HOURLY, S.GOLD_COMPARISON, S.QUARANTINE_TRIPS)
    counts = {n: spark.sql(f"SELECT COUNT(*) FROM {n}").first()[0] for n in names}
    assert counts[S.SILVER_TRIPS] == 4354 and counts[S.STAGING_VIEW] == 4354
    assert counts[S.BRONZE_TRIPS] == counts[S.SILVER_TRIPS] + counts[S.QUARANTINE_TRIPS]
    per_hour = spark.sql(
        f"SELECT pickup_hour, avg(passenger_count) AS people FROM {S.YELLOW_CLEAN} "
        "WHERE pickup_month = 5 GROUP BY pickup_hour"
    )
    assert per_hour.count() <= 24


def test_namespace(spark):
    use_database(spark, "trips_test")
    assert spark.catalog.currentDatabase() == "trips_test"
    spark.catalog.setCurrentDatabase("default")


def test_work_root_follows_the_session(spark):
    assert work_root(spark) == spark.conf.get(CHECKPOINT_CONF)


def test_clusters(spark, small):
    clustered = ml.kmeans(catalog.silver(spark, small))
    assert {r["cluster"] for r in clustered.select("cluster").distinct().collect()} == {0, 1, 2}
    flagged = ml.flag_outliers(clustered).groupBy("is_outlier").count().collect()
    share = {r["is_outlier"]: r["count"] for r in flagged}
    assert 0 < share[True] < 0.02 * sum(share.values())
    assert clustered.filter("centre_distance < 0 or centre_distance is null").isEmpty()


def test_clean_rows_are_written_from_the_raw_folders_without_a_shuffle(spark, small, monkeypatch):
    raw = catalog.bronze(spark, small)
    hinted, real = [], type(raw).hint
    monkeypatch.setattr(type(raw), "hint", lambda self, name, *by: hinted.append((name, *by)) or real(self, name, *by))
    lake = Lake(spark, work_dir(spark, "lake"))
    counted = lake.load(raw)
    # the raw layer and the cube are dealt by month, what is read from months is not
    assert hinted == [("rebalance", "source_year", "source_month")] * 2
    assert counted["clean"] + counted["quarantined"] == counted["rows"] == raw.count()
    months = lake.read(S.SILVER_TRIPS).groupBy("source_year", "source_month").agg(F.countDistinct(F.col("_metadata.file_path")).alias("n"))
    assert months.agg(F.max("n")).first()[0] <= 2
