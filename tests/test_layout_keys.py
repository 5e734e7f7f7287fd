"""Key indexes against counting, and the Hilbert curve against its definition."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from farebox.operators import key_index
from farebox.session import work_dir
from farebox.sources import layout
from farebox.sources.lake import use_database


def keyed(spark, rows):
    return spark.createDataFrame(rows, "m int, k long, m2 string")


def checks(df):
    return {r["check_name"]: (r["failures"], r["rows_checked"], r["passed"]) for r in df.collect()}


def test_key_index_against_counting(spark):
    drawn = random.Random(3)
    pool = [*range(-40_000, 40_000, 37), 32767, 32768, 32769, 0, 1, -1, 10**12]
    rows = [(drawn.randrange(1, 4), drawn.choice([*drawn.sample(pool, 5), 7, None]), "x") for _ in range(3000)]
    table = keyed(spark, rows)
    index = key_index.key_index(table, "k", "m")
    for month in (1, 2, 3):
        fresh = [k for m, k, _ in rows if m == month and k is not None]
        old = {k for m, k, _ in rows if m < month and k is not None}
        got = checks(key_index.unique_checks(index.filter(F.col("m") == month), index.filter(F.col("m") < month), "k"))
        known = len(set(fresh) & old)
        assert got == {
            "repeated:k": (len(fresh) - len(set(fresh)), len(fresh), len(fresh) == len(set(fresh))),
            "known:k": (known, len(fresh), known == 0),
        }
        parent = spark.range(-5000, 20_000)
        lacking = len({k for k in fresh if not -5000 <= k < 20_000})
        got = checks(key_index.reference_check(index.filter(F.col("m") == month), key_index.key_index(parent, "id"), "k"))
        assert got == {"reference:k": (lacking, len(fresh), lacking == 0)}


def test_key_index_of_nothing(spark):
    none = key_index.key_index(keyed(spark, []), "k")
    some = key_index.key_index(keyed(spark, [(1, 5, "a"), (1, None, "b")]), "k")
    assert checks(key_index.unique_checks(none, some, "k")) == {"repeated:k": (0, 0, True), "known:k": (0, 0, True)}
    assert checks(key_index.reference_check(some, none, "k")) == {"reference:k": (1, 1, False)}


def test_a_new_month_reads_no_old_one(spark):
    path, kept = work_dir(spark, "months"), work_dir(spark, "index")
    spark.range(9000).select((F.col("id") % 3 + 1).alias("m"), F.col("id").alias("k")).write.partitionBy("m").parquet(path)
    key_index.key_index(spark.read.parquet(path).filter("m < 3"), "k", "m").write.parquet(kept)
    fresh = key_index.key_index(spark.read.parquet(path).filter("m = 3"), "k")
    found = key_index.unique_checks(fresh, spark.read.parquet(kept), "k")
    assert checks(found) == {"repeated:k": (0, 3000, True), "known:k": (0, 3000, True)}
    read = [f for f in found.inputFiles() if path in f]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert read and "PartitionFilters: [isnotnull(m" in plan and "(m#" in plan


@pytest.mark.parametrize("keys, bits", [(2, 1), (2, 5), (3, 3), (4, 2)])
def test_hilbert_steps_to_a_neighbour(spark, keys, bits):
    cells = spark.range(1 << bits).withColumnRenamed("id", "r0")
    for i in range(1, keys):
        cells = cells.crossJoin(spark.range(1 << bits).withColumnRenamed("id", f"r{i}"))
    names = [f"r{i}" for i in range(keys)]
    rows = cells.select(layout._hilbert([F.col(n) for n in names], bits).alias("h"), *names).orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(1 << bits * keys))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[n] - b[n]) for n in names) == 1


def test_hilbert_is_worked_out_in_generated_code(spark):
    cells = spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).alias("y"))
    placed = cells.select("x", "y", layout._hilbert([F.col("x"), F.col("y")], 3).alias("h"))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "aggregate(" not in plan
    # the 2 x 2 curve within each quarter, by hand: up, across, down
    first = sorted((r["h"], r["x"], r["y"]) for r in placed.collect())[:4]
    assert [r[1:] for r in first] in ([(0, 0), (1, 0), (1, 1), (0, 1)], [(0, 0), (0, 1), (1, 1), (1, 0)])


def test_bits_follow_the_files():
    assert [layout.hilbert_bits(f, 2) for f in (1, 16, 256, 10**6)] == [3, 5, 7, 8]
    assert layout.hilbert_bits(16, 7) == 2


def test_hilbert_opens_fewer_files_than_z(spark):
    rng = spark.range(40000).select(
        F.col("id").cast("string").alias("u"), (F.hash("id") % 1000).alias("x"), (F.hash(F.col("id") + 7) % 1000).alias("y"),
    )
    opened = {}
    for name, order in (("h", layout.hilbert_order), ("z", layout.z_order)):
        path = work_dir(spark, name)
        order(rng, "x", "y", unique="u", files=24).write.parquet(path)
        boxes = layout.file_boxes(spark.read.parquet(path), "x", "y").cache()
        assert boxes.agg(F.sum("rows"), F.count("*")).first() == (40000, 24)
        grid = [(x, y) for x in range(-900, 900, 200) for y in range(-900, 900, 200)]
        opened[name] = sum(layout.touched(boxes, {"x": (x, x + 150), "y": (y, y + 150)}).count() for x, y in grid)
        boxes.unpersist()
    assert opened["h"] < opened["z"]


def test_hilbert_with_nulls_ties_and_nothing(spark):
    rows = [(None, 1.0, "a"), (2, None, "b"), (2, 3.0, "c"), (2, 3.0, "c")]
    df = spark.createDataFrame(rows, "x int, y double, u string")
    assert sorted(map(tuple, layout.hilbert_order(df, "x", "y", unique="u", files=2).collect()), key=str) == sorted(rows, key=str)
    with pytest.raises(ValueError, match="two to seven"):
        layout.hilbert_order(df, "x", unique="u", files=2)
    with pytest.raises(TypeError, match="u: cluster by"):
        layout.hilbert_order(df, "x", "u", unique="u", files=2)


def test_a_namespace_is_made_and_used(spark):
    before = spark.catalog.currentDatabase()
    try:
        use_database(spark, "trips_ns")
        assert spark.catalog.currentDatabase() == "trips_ns"
        use_database(spark, "trips_ns")
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE trips_ns")
