"""Clusters: the same wherever the rows lie, and right on rows worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from farebox.operators import clusters, ml
from farebox.plans import catalog

COLUMNS = "total_amount double, passenger_count double, trip_duration_minutes double, trip_distance double"


def test_same_centres_however_trips_are_dealt(spark, small):
    trips = catalog.silver(spark, small)
    found = clusters.fit(trips.coalesce(1))
    assert found == clusters.fit(trips.repartition(7, "trip_id")) == clusters.fit(trips.orderBy(F.desc("trip_id")))
    assert list(found.points) == sorted(found.points) and len(found.points) == clusters.CLUSTERS


def test_cells(spark):
    values = [*range(1, 300), 2**40, 2**62 - 1]
    frame = spark.createDataFrame([(v,) for v in values], "v bigint")
    found = {r["v"]: r["c"] for r in frame.select("v", clusters.cell(F.col("v")).alias("c")).collect()}
    for v in values:
        assert found[v] == v.bit_length() * 4 + ((v >> max(v.bit_length() - 3, 0)) & 3)
    assert [found[v] for v in values] == sorted(found.values())


def test_sums_of_cells_and_rows_left_out(spark):
    rows = [(10.0, 1.0, 5.0, 2.5)] * 3 + [(10.01, 1.0, 5.0, 2.5), (None, 1.0, 5.0, 2.5), (10.0, 0.0, 5.0, 2.5), (-1.0, 1.0, 5.0, 2.5)]
    cells = clusters.coreset(spark.createDataFrame(rows, COLUMNS)).collect()
    assert sum(r["n"] for r in cells) == 4
    assert sum(r["s0"] for r in cells) == 4001
    assert sum(int(r["q0"]) for r in cells) == 3 * 1000**2 + 1001**2


def test_nothing_varies_and_nothing_at_all(spark):
    one = spark.createDataFrame([(10.0, 1.0, 5.0, 2.5)] * 4, COLUMNS)
    found = clusters.fit(one, k=2)
    assert len(found.points) == 1
    assert found.weights == (1.0, 1.0, 1.0, 1.0)
    assert found.points[0] == pytest.approx((10.0, 1.0, 5.0, 2.5))
    empty = one.limit(0)
    assert clusters.coreset(empty).isEmpty()
    with pytest.raises(ValueError):
        clusters.fit(empty)
    centres = clusters.Centres(((1.0, 1.0, 1.0, 1.0),), (1.0, 1.0, 1.0, 1.0))
    assert clusters.outliers(clusters.assign(empty, centres)).isEmpty()


def test_outliers_and_ties_by_hand(spark):
    rows = [(float(i), 1.0, 1.0, 1.0) for i in range(1, 201)] + [(1000.0, 1.0, 1.0, 1.0)]
    centres = clusters.Centres(((1.0, 1.0, 1.0, 1.0), (401.0, 1.0, 1.0, 1.0), (401.0, 1.0, 1.0, 1.0)), (1.0, 1.0, 1.0, 1.0))
    flagged = clusters.outliers(clusters.assign(spark.createDataFrame(rows, COLUMNS), centres), (1, 2))
    found = {r["total_amount"]: (r["cluster"], r["is_outlier"]) for r in flagged.collect()}
    # of 200 distances 0 to 199 the 100th is 99; the only member of the second cluster is its own limit
    assert all(found[float(i)] == (0, i > 100) for i in range(1, 201))
    assert found[1000.0] == (1, False)
    profile = {r["cluster"]: (r["trips"], r["outliers"], r["avg_amount"]) for r in clusters.profile(flagged).collect()}
    assert profile == {0: (200, 100, 100.5), 1: (1, 0, 1000.0)}


def test_few_cells(spark):
    rows = [(float(2**i), 1.0, 5.0, 2.5) for i in range(4)]
    for k in (2, 3, 4, 5):
        found = clusters.fit(spark.createDataFrame(rows, COLUMNS), k=k)
        assert 2 <= len(found.points) <= min(k, len(rows))
    assert [p[0] for p in found.points] == pytest.approx([1.0, 2.0, 4.0, 8.0])


def test_distances_are_not_worked_out_again_by_filters(spark):
    rows = [(float(i), 1.0, 5.0, 2.5) for i in range(1, 50)]
    centres = clusters.Centres(((1.0, 1.0, 5.0, 2.5), (40.0, 1.0, 5.0, 2.5)), (1.0, 1.0, 1.0, 1.0))
    flagged = clusters.outliers(clusters.assign(spark.createDataFrame(rows, COLUMNS), centres))
    plan = flagged._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "SQRT" in line]
    assert flagged.count() == 49


@pytest.mark.parametrize("per_task, parts", [(50, 40), (1_000_000, 3)])
def test_vectors_are_dealt_by_their_number(spark, per_task, parts):
    rows = spark.range(0, 2000, 1, 3).toDF("v")
    dealt = ml._dealt(rows, per_task)
    sizes = dealt.groupBy(F.spark_partition_id()).count().collect()
    assert dealt.rdd.getNumPartitions() == parts
    assert sum(r["count"] for r in sizes) == 2000
    assert dealt.agg(F.sum("v")).first()[0] == 1999 * 1000
