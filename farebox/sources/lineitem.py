"""Trips derived from a TPC-H-like ``lineitem`` table.

Integer arithmetic only, so that every engine derives the same trips. Each
order line becomes one trip whose key is the digest of six of its columns.
Times are UTC; the session's time zone should be too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from farebox.functions import hundredths, units

# The rule by which an order line becomes a trip.
MINUTES_PER_DAY = 1440
DURATION_SPAN, DURATION_SHIFT = 1600, 10
YELLOW_STATUS = "O"  # every other status, and none, is the other fleet's
TIP_WEIGHT = {"yellow": 4, "green": 3}


# A table of such a size is often one row group, which one task would read and derive alone; larger ones have many.
SPREAD_BYTES = (4 << 20, 256 << 20)
# More partitions than a table is read in: coalescing to so many changes none of them.
AS_READ = 1 << 20


def _read(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")
    size = int(str(lines._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if SPREAD_BYTES[0] <= size < SPREAD_BYTES[1]:
        return lines.repartition(spark.sparkContext.defaultParallelism, "l_orderkey")
    # Ends the scan's generated function before the trips are derived. In one function with them
    # it would pass the 8000 bytes up to which the JVM compiles, and every row be interpreted.
    return lines.coalesce(AS_READ)


def is_yellow() -> Column:
    """Which fleet an order line's trip belongs to."""
    return F.coalesce(F.col("l_linestatus") == YELLOW_STATUS, F.lit(False))


def _shape(lines: DataFrame) -> DataFrame:
    yellow = is_yellow()
    started = (F.col("l_orderkey") * 37 + F.col("l_partkey") * 11) % MINUTES_PER_DAY
    lasted = (F.col("l_partkey") * 7 + F.col("l_linenumber")) % DURATION_SPAN - DURATION_SHIFT
    # whole seconds: a filter on the times repeats this in the scan, so it has to be cheap
    day = F.unix_timestamp("l_shipdate")
    price = hundredths("l_extendedprice")
    total = F.col("l_extendedprice").cast("bigint") - 2000
    weight = F.when(yellow, TIP_WEIGHT["yellow"]).otherwise(TIP_WEIGHT["green"])
    tip = F.floor(F.greatest(total, F.lit(0)) * hundredths("l_tax") * weight / 100)
    tolls = F.col("l_linenumber") % 3 * 100
    return lines.select(
        F.when(yellow, "yellow").otherwise("green").alias("taxi_type"),
        (F.col("l_suppkey") % 2 + 1).alias("VendorID"),
        F.timestamp_seconds(day + started * 60).alias("pickup_datetime"),
        F.timestamp_seconds(day + (started + lasted) * 60).alias("dropoff_datetime"),
        (F.col("l_quantity").cast("int") % 8).cast("double").alias("passenger_count"),
        (F.col("l_partkey") % 300 / 10.0).alias("trip_distance"),
        units(total - tip - tolls).alias("fare_amount"),
        units(tip).alias("tip_amount"),
        units(tolls).alias("tolls_amount"),
        units(total).alias("total_amount"),
        F.year("l_shipdate").alias("source_year"),
        F.month("l_shipdate").alias("source_month"),
        F.concat_ws(
            "|",
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "l_suppkey",
            price,
            F.to_date("l_shipdate").cast("string"),
        ).alias("record_key"),
        F.col("l_orderkey").alias("order_key"),
    )


def _source_file() -> Column:
    period = F.concat_ws("-", "source_year", F.lpad(F.col("source_month").cast("string"), 2, "0"))
    return F.concat("taxi_type", F.lit("_tripdata_"), period, F.lit(".parquet"))


def trip_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both fleets from one scan, with canonical time columns."""
    return _shape(_read(spark, sf_dir)).withColumn("source_file", _source_file())


def fleet_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One frame per fleet in the shape of that fleet's own files.

    The status filter reaches the scan. The second fleet's files have other
    time-column names and one column more.
    """
    lines = _read(spark, sf_dir)
    feeds = {}
    for code, prefix, own in (("yellow", "tpep", is_yellow()), ("green", "lpep", ~is_yellow())):
        feed = _shape(lines.filter(own))
        feeds[code] = feed.withColumn("source_file", _source_file()).withColumnsRenamed(
            {
                "pickup_datetime": f"{prefix}_pickup_datetime",
                "dropoff_datetime": f"{prefix}_dropoff_datetime",
            }
        ).drop("taxi_type")
    feeds["green"] = feeds["green"].withColumn(
        "trip_type", (F.col("order_key") % 2 + 1).cast("int")
    )
    return feeds
