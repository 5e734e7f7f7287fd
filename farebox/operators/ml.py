"""Clusters, outliers and correlations of trips."""

from __future__ import annotations

from itertools import product

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, functions as F

from farebox.functions import rounded

# The variables of each analysis, the number of clusters, the seed.
CLUSTER_FEATURES = ("total_amount", "passenger_count", "trip_duration_minutes", "trip_distance")
CORRELATED = ("total_amount", "passenger_count", "trip_duration_minutes", "pickup_hour")
CLUSTERS, SEED = 3, 42
ROWS_PER_TASK = 250_000


def positive(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which all of ``columns`` exceed 0; a NULL does not."""
    for name in columns:
        df = df.filter(F.col(name) > 0)
    return df


def kmeans(trips: DataFrame, k: int = CLUSTERS, seed: int = SEED, scale: bool = True) -> DataFrame:
    """Trips with their ``cluster`` and the distance to its centre.

    Features are scaled to unit deviation unless ``scale`` is off, so that the
    largest unit does not decide alone. The fit keeps only the feature vectors
    between its passes, in memory or on executor disk, dealt so that a task
    holds about ``ROWS_PER_TASK`` of them, whatever the size of the table.
    """
    inputs = positive(trips, *CLUSTER_FEATURES)
    column = "features"
    stages = [
        VectorAssembler(inputCols=list(CLUSTER_FEATURES), outputCol=column, handleInvalid="skip")
    ]
    if scale:
        stages.append(StandardScaler(inputCol=column, outputCol="scaled", withStd=True))
        column = "scaled"
    stages.append(KMeans(k=k, seed=seed, featuresCol=column, predictionCol="cluster"))
    model = Pipeline(stages=stages).fit(_dealt(inputs.select(*CLUSTER_FEATURES)))
    return (
        model.transform(inputs)
        .withColumn("_at", vector_to_array(column))
        .withColumn("_all", _distances(model.stages[-1].clusterCenters()))
        .withColumn("centre_distance", F.get("_all", F.col("cluster")))
        .withColumn("nearest_distance", F.array_min("_all"))
        .drop("features", "scaled", "_at", "_all")
    )


def _dealt(rows: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``rows`` over as many partitions as their number asks for; as they are if there are tasks enough for few of them."""
    parts = -(-rows.count() // per_task)
    return rows.repartition(parts) if parts > rows.sparkSession.sparkContext.defaultParallelism else rows


def _distances(centres) -> Column:
    """Distances of ``_at`` to every centre; the centres are k short literals."""

    def to(centre) -> Column:
        squares = F.zip_with("_at", F.array(*[F.lit(float(x)) for x in centre]), lambda a, b: (a - b) * (a - b))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))

    return F.array(*[to(c) for c in centres])


def cluster_checks(clustered: DataFrame, quantile: float = 0.99) -> DataFrame:
    """What must hold of any clustering: clusters, trips, trips not at their nearest centre, outlier shares."""
    flagged = flag_outliers(clustered, quantile)
    away = (F.col("centre_distance") > F.col("nearest_distance") * (1 + 1e-9) + 1e-9).cast("bigint")
    per = flagged.groupBy("cluster").agg(
        F.count("*").alias("n"), F.count_if("is_outlier").alias("out"), F.sum(away).alias("away")
    )
    return per.agg(
        F.count("*").alias("clusters"), F.sum("n").alias("trips"), F.sum("away").alias("misplaced"),
        F.bool_and(F.col("out") <= (1 - quantile) * F.col("n") * 1.1 + 1).alias("outliers_within_bound"),
    )


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Size and mean features of each cluster."""
    return (
        clustered.groupBy("cluster")
        .agg(
            F.count("*").alias("count"),
            F.avg("total_amount").alias("avg_amount"),
            F.avg("passenger_count").alias("avg_passengers"),
            F.avg("trip_duration_minutes").alias("avg_duration"),
            F.avg("trip_distance").alias("avg_distance"),
        )
        .orderBy("cluster")
    )


def flag_outliers(clustered: DataFrame, quantile: float = 0.99) -> DataFrame:
    """Mark trips further from their centre than ``quantile`` of their cluster.

    One row per cluster on the small side: k rows, whatever the data.
    """
    limits = clustered.groupBy("cluster").agg(
        F.percentile_approx("centre_distance", quantile).alias("limit")
    )
    return (
        clustered.join(F.broadcast(limits), "cluster")
        .withColumn("is_outlier", F.col("centre_distance") > F.col("limit"))
        .drop("limit")
    )


def _correlated_rows(trips: DataFrame) -> DataFrame:
    return positive(trips, "total_amount", "passenger_count", "trip_duration_minutes").select(
        *CORRELATED
    )


def correlations(trips: DataFrame, digits: int = 6) -> DataFrame:
    """Pearson correlation of every pair of variables, long form, from one aggregate."""
    rows = _correlated_rows(trips)
    pairs = list(product(CORRELATED, CORRELATED))
    values = rows.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs if a < b])

    def cell(a: str, b: str) -> Column:
        low, high = sorted((a, b))
        value = F.lit(1.0) if a == b else rounded(f"{low}__{high}", digits)
        return F.struct(
            F.lit(a).alias("variable_a"), F.lit(b).alias("variable_b"), value.alias("correlation")
        )

    return values.select(F.inline(F.array(*[cell(a, b) for a, b in pairs])))


def correlation_matrix(trips: DataFrame, digits: int = 6) -> DataFrame:
    """The same from the ML library's matrix: one 4 x 4 matrix reaches the driver."""
    assembler = VectorAssembler(
        inputCols=list(CORRELATED), outputCol="features", handleInvalid="skip"
    )
    vectors = assembler.transform(_correlated_rows(trips)).select("features")
    matrix = Correlation.corr(vectors, "features").head()[0].toArray()
    cells = [
        (a, b, float(matrix[i][j]))
        for i, a in enumerate(CORRELATED)
        for j, b in enumerate(CORRELATED)
    ]
    schema = "variable_a string, variable_b string, correlation double"
    return trips.sparkSession.createDataFrame(cells, schema).withColumn(
        "correlation", rounded("correlation", digits)
    )
