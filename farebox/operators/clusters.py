"""Clusters that do not depend on how trips are dealt over tasks, and their use on any table.

Trips collapse to the cells of a fixed grid, with exact counts and sums. The
cells are what the centres are fitted on, each with its count as weight, in one
order. Centres are plain numbers that can be kept and applied later.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction
from functools import reduce
from math import sqrt

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from farebox.functions import hundredths, mean
from farebox.operators.ml import CLUSTER_FEATURES, CLUSTERS, SEED, positive
from farebox.operators.selection import selected

AXES = [f"c{i}" for i in range(len(CLUSTER_FEATURES))]
MILLIONTHS = 1_000_000
MAX_ITERATIONS = 50


@dataclass(frozen=True)
class Centres:
    """One point per cluster in the units of the features, and the weight of each feature in a distance."""

    points: tuple[tuple[float, ...], ...]
    weights: tuple[float, ...]


def cell(value: Column) -> Column:
    """Cell of a positive whole number: four to each power of two, so one is at most a quarter wide."""
    length = F.length(F.bin(value))
    high = F.call_function("shiftright", value, F.greatest(length - 3, F.lit(0)))
    return length * 4 + high.bitwiseAND(F.lit(3)).cast("int")


def coreset(trips: DataFrame) -> DataFrame:
    """(c0..c3, n, s0..s3, q0..q3): trips, sums and sums of squares, in hundredths, per cell of the grid.

    Rows without four positive features are left out, values of less than a
    hundredth too. Cells are at most 4 per power of two and feature, whatever
    the number of trips; sums are exact. An empty table has no cells.
    """
    values = [f"_v{i}" for i in range(len(AXES))]
    rows = positive(trips, *CLUSTER_FEATURES).select(
        *[hundredths(c).alias(v) for c, v in zip(CLUSTER_FEATURES, values, strict=True)]
    )
    square = [F.sum(F.col(v).cast("decimal(19,0)") * F.col(v).cast("decimal(19,0)")).alias(f"q{i}") for i, v in enumerate(values)]
    return (
        positive(rows, *values)
        .groupBy(*[cell(F.col(v)).alias(c) for c, v in zip(AXES, values, strict=True)])
        .agg(F.count("*").alias("n"), *[F.sum(v).alias(f"s{i}") for i, v in enumerate(values)], *square)
    )


def feature_weights(cells: DataFrame) -> tuple[float, ...]:
    """One over the sample deviation of each feature, from exact moments; 1 where nothing varies."""
    names = [f"{kind}{i}" for i in range(len(AXES)) for kind in "sq"]
    row = cells.agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names]).first()
    if not row["n"]:
        raise ValueError("no trip has all the features above 0")
    found = []
    for i in range(len(AXES)):
        total, squares, n = int(row[f"s{i}"]), int(row[f"q{i}"]), row["n"]
        spread = Fraction(squares * n - total * total, n * max(n - 1, 1) * 10_000)
        found.append(1 / sqrt(spread) if spread else 1.0)
    return tuple(found)


def fit(trips: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> Centres:
    """``k`` centres, at least 2, by their first feature; with ``k`` cells or fewer, the means of the cells.

    The cells go to one task, in order: their number is bounded by the range
    of the values, not by the trips, so the fit sees the same rows in the same
    order on any cluster.
    """
    cells = coreset(trips).persist()
    try:
        weights = feature_weights(cells)
        at = [F.col(f"s{i}") / (F.col("n") * 100.0) * w for i, w in enumerate(weights)]
        points = cells.repartition(1).sortWithinPartitions(*AXES).select(
            array_to_vector(F.array(*at)).alias("features"), F.col("n").cast("double").alias("weight")
        )
        found = [r["features"].toArray() for r in points.head(k + 1)]
        if len(found) > k:
            # the start is k different cells: the parallel start may find fewer among few cells, which Spark does not bear
            model = KMeans(k=k, seed=seed, maxIter=MAX_ITERATIONS, initMode="random", weightCol="weight")
            found = model.fit(points).clusterCenters()
    finally:
        cells.unpersist()
    centres = {tuple(float(x) / w for x, w in zip(c, weights, strict=True)) for c in found}
    return Centres(tuple(sorted(centres)), weights)


def assign(trips: DataFrame, centres: Centres) -> DataFrame:
    """Trips with four positive features, their ``cluster`` (the first of equals) and ``centre_distance``."""

    def distance(point: tuple[float, ...]) -> Column:
        steps = [
            (F.col(c).cast("double") - F.lit(x)) * F.lit(w)
            for c, x, w in zip(CLUSTER_FEATURES, point, centres.weights, strict=True)
        ]
        return F.sqrt(reduce(lambda a, b: a + b, [s * s for s in steps]))

    return (
        positive(trips, *CLUSTER_FEATURES)
        .withColumn("_all", F.array(*[distance(p) for p in centres.points]))
        .withColumn("centre_distance", F.array_min("_all"))
        # never NULL, and said so: a join would else look for NULLs by working all distances out again in the scan
        .withColumn("cluster", F.coalesce((F.array_position("_all", F.col("centre_distance")) - 1).cast("int"), F.lit(0)))
        .drop("_all")
    )


def outliers(clustered: DataFrame, share: tuple[int, int] = (99, 100)) -> DataFrame:
    """With ``is_outlier``: further from the centre than ``share`` of the cluster, by exact selection.

    Distances count in whole millionths. The limits are one row per cluster.
    """
    away = F.floor(F.col("centre_distance") * MILLIONTHS)
    limits = selected(clustered, ["cluster"], away, "_limit", share)
    return clustered.join(F.broadcast(limits), "cluster").withColumn("is_outlier", away > F.col("_limit")).drop("_limit")


def profile(flagged: DataFrame) -> DataFrame:
    """Trips, outliers and mean features of each cluster, from exact sums."""
    names = ("avg_amount", "avg_passengers", "avg_duration", "avg_distance")
    sums = [F.sum(hundredths(c)).alias(a) for c, a in zip(CLUSTER_FEATURES, names, strict=True)]
    found = flagged.groupBy("cluster").agg(F.count("*").alias("trips"), F.count_if("is_outlier").alias("outliers"), *sums)
    return found.select("cluster", "trips", "outliers", *[mean(a, "trips", 4, 2).alias(a) for a in names])
