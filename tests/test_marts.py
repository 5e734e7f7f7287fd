"""Marts that grow month by month: streams, upserts by partition, the cube, sketches, exact selection."""

from __future__ import annotations

import os
import random
import shutil
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from compare import rows_of
from farebox import schema as S
from farebox.operators import aggregates, selection, sketches
from farebox.plans import catalog, gold
from farebox.session import work_dir
from farebox.sources import files
from farebox.sources.lake import Lake
from farebox.sources.upsert import in_partitions, merged, upsert_partitions
from farebox.streaming import marts


# ---------------------------------------------------------------------- streams
def trips(spark, prefix, rows, vendor="bigint", passengers="double", without=()):
    """A file's rows: (start, minutes, amount)."""
    data = [(1, start, start + timedelta(minutes=m), 1, 1.5, amount) for start, m, amount in rows]
    df = spark.createDataFrame(data, "VendorID long, a timestamp, b timestamp, passenger_count long, trip_distance double, total_amount double")
    df = df.withColumnsRenamed({"a": f"{prefix}_pickup_datetime", "b": f"{prefix}_dropoff_datetime"})
    df = df.withColumns({"VendorID": F.col("VendorID").cast(vendor), "passenger_count": F.col("passenger_count").cast(passengers), "fare_amount": F.lit(1.0)})
    return df.withColumns({"tip_amount": F.lit(0.0), "tolls_amount": F.lit(0.0)}).drop(*without)


def land(df, path):
    df.coalesce(1).write.mode("overwrite").parquet(path)


def hour_rows(df):
    return sorted((r.taxi_type, r.hour_start, r.total_trips, r.total_revenue) for r in df.collect())


def expected(*landed):
    """Hours of the valid trips of each (fleet, rows)."""
    out = {}
    for fleet, rows in landed:
        for start, minutes, amount in rows:
            if minutes > 0 and 0 < amount <= 1000:
                key = fleet, start.replace(minute=0, second=0)
                n, cents = out.get(key, (0, 0))
                out[key] = n + 1, cents + round(amount * 100)
    return sorted((*k, n, cents / 100) for k, (n, cents) in out.items())


def month(year, number, n=40, seed=1):
    draw = random.Random(seed * 100 + number)
    first = datetime(year, number, 1)
    return [(first + timedelta(minutes=draw.randrange(27 * 1440)), draw.choice([5, 30, 0]), draw.choice([10.25, 7.5, 1000.0, 1000.01, -3.0])) for _ in range(n)]


def test_drifting_repeated_and_late_files(spark, tmp_path):
    landing, root = f"{tmp_path}/landing", f"{tmp_path}/root"
    may, june, green, late = month(2023, 5), month(2023, 6), month(2023, 6, seed=2), month(2023, 1)
    land(trips(spark, "tpep", may), f"{landing}/yellow_tripdata_2023-05")
    land(trips(spark, "lpep", green, vendor="int", passengers="string"), f"{landing}/green_tripdata_2023-06")
    first = marts.follow(spark, landing, root)
    assert hour_rows(first) == expected(("yellow", may), ("green", green))

    # the same types no more, a file of long ago, and one delivered again elsewhere
    land(trips(spark, "tpep", june, vendor="int"), f"{landing}/yellow_tripdata_2023-06")
    shutil.copytree(f"{landing}/yellow_tripdata_2023-05", f"{landing}/again/yellow_tripdata_2023-05")
    marts.follow(spark, landing, root)
    land(trips(spark, "tpep", late), f"{landing}/yellow_tripdata_2023-01")
    whole = marts.follow(spark, landing, root)
    assert hour_rows(whole) == expected(("yellow", may), ("green", green), ("yellow", june), ("yellow", late))
    before = {p: os.path.getmtime(p) for p in parquet_files(f"{root}/mart")}
    marts.follow(spark, landing, root)  # nothing new: nothing is touched
    assert before == {p: os.path.getmtime(p) for p in parquet_files(f"{root}/mart")}


def test_a_file_that_comes_again_adds_only_rows_it_did_not_have(spark, tmp_path):
    """Within a batch and in a later one; the stream of hours keeps state by hour and none by row."""
    landing, root = f"{tmp_path}/landing", f"{tmp_path}/root"
    may, june = month(2023, 5), month(2023, 6)

    def put(folder, rows, number):
        land(trips(spark, "tpep", rows), path := f"{landing}/{folder}/yellow_tripdata_2023-{number:02d}")
        os.rename(parquet_files(path)[0], f"{path}/part-0.parquet")

    put("a", may, 5)
    put("b", may, 5)
    put("a", june[:25], 6)
    assert hour_rows(marts.follow(spark, landing, root)) == expected(("yellow", may), ("yellow", june[:25]))
    put("c", june, 6)
    put("c", may, 5)
    batches = marts.take_up(spark, landing, f"{root}/rows", f"{root}/state")
    marts.sum_up(spark, f"{root}/rows", f"{root}/mart", f"{root}/state")
    assert marts.mend(spark, f"{root}/rows", f"{root}/mart", batches) == 0
    assert hour_rows(marts.follow(spark, landing, root)) == expected(("yellow", may), ("yellow", june))
    assert [d for d in os.listdir(f"{root}/state/hours/state") if d.isdigit()] == ["0"]


def test_rows_later_than_the_watermark_are_mended(spark, tmp_path):
    """Files one by one, so that the last is months behind the watermark of the rest."""
    landing, root = f"{tmp_path}/landing", f"{tmp_path}/root"
    parts = {number: month(2023, number) for number in (6, 5, 1)}
    for i, (number, rows) in enumerate(parts.items()):
        land(trips(spark, "tpep", rows), path := f"{landing}/yellow_tripdata_2023-{number:02d}")
        for p in parquet_files(path):
            os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    batches = marts.take_up(spark, landing, f"{root}/rows", f"{root}/state", files_per_batch=1)
    assert len(batches) == 3
    for b in batches:
        for p in parquet_files(f"{root}/rows/batch={b}"):
            os.utime(p, (1_700_000_000 + b, 1_700_000_000 + b))
    marts.sum_up(spark, f"{root}/rows", f"{root}/mart", f"{root}/state", delay="1 day", files_per_batch=1)
    assert marts.mend(spark, f"{root}/rows", f"{root}/mart", batches) > 0
    assert marts.mend(spark, f"{root}/rows", f"{root}/mart", batches) == 0
    out = spark.read.parquet(f"{root}/mart").selectExpr("taxi_type", "hour_start", "total_trips", "s_amount / 100 AS total_revenue")
    assert hour_rows(out) == expected(*(("yellow", r) for r in parts.values()))


@pytest.mark.parametrize("name, without, match", [
    ("yellow_tripdata_2023-05", ("total_amount",), "mandatory columns missing: total_amount"), ("purple_tripdata_2023-05", (), "unknown fleet"), ("notes", (), "not named like"),
])
def test_files_that_cannot_be_taken_up_are_named(spark, tmp_path, name, without, match):
    land(trips(spark, "tpep", month(2023, 5), without=without), f"{tmp_path}/landing/{name}")
    with pytest.raises(Exception, match=match):
        marts.follow(spark, f"{tmp_path}/landing", f"{tmp_path}/root")


def test_record_keys_do_not_depend_on_the_folder(spark, tmp_path):
    land(trips(spark, "tpep", month(2023, 5)), f"{tmp_path}/a/yellow_tripdata_2023-05")
    shutil.copytree(f"{tmp_path}/a", f"{tmp_path}/b")
    keys = []
    for root in "ab":
        found = [files.source_file(p) for p in parquet_files(f"{tmp_path}/{root}")]
        keys.append({r.record_key for r in files.read_manifest(spark, found)["yellow"].collect()})
    assert keys[0] == keys[1] and len(keys[0]) == 40


# ---------------------------------------------------------------------- upserts
def parquet_files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


BY = ("y", "m")


def table(spark, *rows):
    return spark.createDataFrame(rows, "id string, v int, y int, m int")


def contents(spark, path):
    return sorted(tuple(r) for r in spark.read.parquet(path).select("id", "v", "y", "m").collect())


def test_only_touched_months_are_rewritten(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert upsert_partitions(spark, path, table(spark, *((f"{m}-{i}", i, 2023, m) for m in (1, 2, 3) for i in range(5))), ["id"], BY) == [(2023, 1), (2023, 2), (2023, 3)]
    before = {p: os.path.getmtime(p) for p in parquet_files(path)}
    assert upsert_partitions(spark, path, table(spark, ("2-1", 100, 2023, 2), ("2-9", 9, 2023, 2), ("4-1", 1, 2023, 4)), ["id"], BY) == [(2023, 2), (2023, 4)]
    want = [(f"{m}-{i}", i, 2023, m) for m in (1, 2, 3) for i in range(5) if (m, i) != (2, 1)] + [("2-1", 100, 2023, 2), ("2-9", 9, 2023, 2), ("4-1", 1, 2023, 4)]
    assert contents(spark, path) == sorted(want)
    kept = [p for p in before if "m=2/" not in p]
    assert kept and all(os.path.getmtime(p) == before[p] for p in kept)
    plan = in_partitions(spark.read.parquet(path), BY, [(2023, 2)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan
    again = contents(spark, path)
    upsert_partitions(spark, path, table(spark, ("2-1", 100, 2023, 2)), ["id"], BY)
    assert contents(spark, path) == again
    assert upsert_partitions(spark, path, table(spark), ["id"], BY) == [] and contents(spark, path) == again


def test_keys_that_moved_leave_their_old_month(spark, tmp_path):
    path = f"{tmp_path}/t"
    upsert_partitions(spark, path, table(spark, ("a", 1, 2023, 1), ("b", 2, 2023, 2), ("c", 3, 2023, 2)), ["id"], BY)
    touched = upsert_partitions(spark, path, table(spark, ("a", 10, 2023, 2), ("d", 4, 2023, 3)), ["id"], BY, moves=True)
    assert touched == [(2023, 1), (2023, 2), (2023, 3)]
    assert contents(spark, path) == [("a", 10, 2023, 2), ("b", 2, 2023, 2), ("c", 3, 2023, 2), ("d", 4, 2023, 3)]


@pytest.mark.parametrize("bad", [[("a", 1, 2023, 1), ("a", 2, 2023, 1)], [(None, 1, 2023, 1)]])
def test_bad_keys_end_the_job_and_leave_the_table(spark, tmp_path, bad):
    path = f"{tmp_path}/t"
    upsert_partitions(spark, path, table(spark, ("a", 1, 2023, 1)), ["id"], BY)
    with pytest.raises(Exception, match="a NULL id, or one that a side has more than once"):
        upsert_partitions(spark, path, table(spark, *bad), ["id"], BY)
    assert contents(spark, path) == [("a", 1, 2023, 1)]


def test_merging_is_one_shuffle(spark):
    plan = merged(table(spark, ("a", 1, 1, 1)).repartition(3), table(spark, ("a", 2, 1, 1)).repartition(3), ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("ENSURE_REQUIREMENTS") == 1


# ------------------------------------------------------------------------- cube
def test_marts_of_the_cube_are_those_of_the_trips(spark, small):
    lake = Lake(spark, work_dir(spark, "lake"))
    made = lake.build(catalog.bronze(spark, small))
    clean = catalog.silver(spark, small)
    for name, direct in ((S.GOLD_MONTHLY, gold.monthly), (S.GOLD_HOURLY, gold.hourly), (S.GOLD_COMPARISON, gold.comparison)):
        a, b = (catalog.plain(df).select(sorted(catalog.plain(df).columns)) for df in (made[name], direct(clean)))
        assert rows_of(a.columns, map(tuple, a.collect())) == rows_of(b.columns, map(tuple, b.collect()))
    for make in (gold.monthly_of, gold.hourly_of, gold.comparison_of):
        plan = make(lake.read(S.TRIP_CUBE))._jdf.queryExecution().executedPlan().toString()
        assert "silver" not in plan.split("FileScan")[1].split("ReadSchema")[0]


def test_a_month_loaded_again_replaces_its_cells(spark, small):
    lake = Lake(spark, work_dir(spark, "lake"))
    raw = catalog.bronze(spark, small)
    lake.load(raw)
    before = lake.read(S.TRIP_CUBE).groupBy().sum("total_trips", "s_amount").first()
    may = raw.filter("source_month = 5")
    lake.load(may, may.select("source_year", "source_month"))
    assert lake.read(S.TRIP_CUBE).groupBy().sum("total_trips", "s_amount").first() == before


# --------------------------------------------------------------------- sketches
def test_sketches_of_months_merge_to_that_of_a_span(spark, medium):
    clean = catalog.silver(spark, medium)
    months = sketches.monthly_sketches(clean)
    year = {r.taxi_type: r for r in sketches.over_months(months, (1995, 1), (1995, 12)).collect()}
    exact = {r.taxi_type: r for r in clean.filter("source_year = 1995").groupBy("taxi_type").agg(
        F.count("*").alias("n"), F.countDistinct("pickup_date").alias("days"), F.sort_array(F.collect_list("total_amount")).alias("amounts")
    ).collect()}
    for fleet, r in year.items():
        want = exact[fleet]
        assert r.total_trips == want.n and r.vendors == 2 and abs(r.days - want.days) <= 0.05 * want.days
        for share, value in ((0.5, r.median_amount), (0.9, r.amount_at_90)):
            rank = sum(a <= value for a in want.amounts) / want.n
            assert abs(rank - share) < 0.02


# -------------------------------------------------------------------- selection
@pytest.mark.parametrize("bits", [2, 12])
def test_selection_against_sorting(spark, bits):
    draw = random.Random(4)
    groups = {k: [draw.randrange(-(10**6), 10**9) for _ in range(n)] for k, n in (("a", 1), ("b", 2), (None, 501), ("c", 1000))}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(5)
    got = {r.k: r.x for r in selection.selected(df, ["k"], F.col("v"), "x", bits=bits).collect()}
    assert got == {k: statistics.median_low(vs) for k, vs in groups.items()}
    high = {r.k: r.x for r in selection.selected(df, ["k"], F.col("v"), "x", share=(9, 10), bits=bits).collect()}
    assert high == {k: sorted(vs)[-(-len(vs) * 9 // 10) - 1] for k, vs in groups.items()}


def test_selection_over_distinct_values_and_nothing(spark):
    df = spark.range(100_001).select((F.col("id") * 7919 % 100_003).alias("v"))
    values = sorted(i * 7919 % 100_003 for i in range(100_001))
    assert [r.x for r in selection.selected(df, [], F.col("v"), "x").collect()] == [values[50_000]]
    assert selection.selected(df.limit(0), [], F.col("v"), "x").count() == 0
    same = spark.createDataFrame([("a", 5)] * 9, "k string, v int")
    assert [tuple(r) for r in selection.selected(same, ["k"], F.col("v"), "x").collect()] == [("a", 5)]


# ------------------------------------------------------------------------- skew
def test_layout_skew_names_the_crowded_value(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, "hot").otherwise(F.col("id").cast("string")).alias("a"), (F.col("id") % 10).alias("b"), F.lit(None).cast("int").alias("c"))
    got = {r.layout_key: tuple(r)[1:] for r in aggregates.layout_skew(df, ["a", "b", "c"], 100).collect()}
    assert got == {
        "a": (1000, 601, "hot", 400, 0.4, 10, True), "b": (1000, 10, "0", 100, 0.1, 10, False), "c": (1000, 1, None, 1000, 1.0, 1, True),
    }


def test_counts_taken_while_writing(spark, small):
    lake = Lake(spark, work_dir(spark, "lake"))
    raw = catalog.bronze(spark, small)
    counted = lake.load(raw)
    names = {"rows": S.BRONZE_TRIPS, "clean": S.SILVER_TRIPS, "quarantined": S.QUARANTINE_TRIPS}
    assert {k: counted[k] for k in names} == {k: lake.read(n).count() for k, n in names.items()}
    assert counted["valid"] == counted["clean"] == counted["rows"] - counted["quarantined"]
    assert 0 < counted["clean"] < counted["rows"]
    none = raw.limit(0)
    nothing = lake.load(none, none.select("source_year", "source_month"))
    assert nothing == dict.fromkeys(("rows", "valid", "clean", "quarantined"), 0)
    assert lake.read(S.SILVER_TRIPS).count() == counted["clean"]
