"""Hourly trips and revenue that follow the monthly files as they arrive.

Two streams, each with its own state, both ending when there is nothing new:
the first takes up files of any types, conforms them and drops repeated rows, the
second sums hours within a watermark. A row later than the watermark
is in the conformed rows but not in the sums; the hours of the months that a run
has brought are compared with them at its end, and mended. Only a file that comes
again under its name can repeat rows: the names taken are kept, one for each file,
and no key of a row is held as state.
"""

from __future__ import annotations

from collections import Counter

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from farebox import schema as S
from farebox.functions import hundredths, units
from farebox.functions.keys import FILE_PATH
from farebox.operators import bronze as b, silver as s
from farebox.session import materialize
from farebox.sources import files
from farebox.sources.conform import union_by_name
from farebox.sources.upsert import in_partitions, upsert_partitions

FILES_PER_BATCH = 1000
DELAY = "35 days"
MART_KEY, MART_MONTH = ["taxi_type", "hour_start"], ("hour_year", "hour_month")
PATHS = "path string, modificationTime timestamp, length bigint, content binary"
ROWS = (
    "record_key string, taxi_type string, pickup_datetime timestamp, total_amount double, passenger_count double, "
    "trip_duration_minutes double, hour_year int, hour_month int, batch bigint"
)


def _month_of(time: str) -> dict[str, F.Column]:
    return {"hour_year": F.year(time), "hour_month": F.month(time)}


def _names_taken(spark: SparkSession, state: str, number: int) -> DataFrame:
    """Names of the files that the batches before ``number`` took up."""
    try:
        names = spark.read.schema("name string, batch bigint").parquet(f"{state}/names")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        names = spark.createDataFrame([], "name string, batch bigint")
    return names.filter(F.col("batch") < number).select("name", F.lit(True).alias("again")).distinct()


def _unrepeated(raw: DataFrame, rows: str, number: int, t: S.Thresholds) -> DataFrame:
    """Rows of files that came before or twice: of those in range each key once, and none that an earlier batch has."""
    spark = raw.sparkSession
    counted = F.coalesce(s.in_range(t), F.lit(False))
    new = raw.filter(counted).dropDuplicates(["record_key"])
    if number > 0:
        earlier = spark.read.schema(ROWS).parquet(rows).filter(F.col("batch") < number).filter(s.in_range(t))
        new = new.join(earlier.select("record_key"), "record_key", "left_anti")
    return new.unionByName(raw.filter(~counted))


def take_up(
    spark: SparkSession, landing: str, rows: str, state: str, files_per_batch: int = FILES_PER_BATCH, t: S.Thresholds = S.Thresholds()
) -> list[int]:
    """Conform the files that are new below ``landing`` into ``rows``; the batches that this took.

    Only paths are streamed; a batch of files is read like a manifest, each in
    the types of its own footer, and a file without a mandatory column, of an
    unknown fleet or name is refused by its path. A batch that is tried again replaces its
    own folder. Rows have their file's name in their keys, so only those of files that
    come again under a name are compared by key.
    """
    taken: list[int] = []

    def conform(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        named = batch.select("path", F.regexp_extract("path", FILE_PATH, 1).alias("name"))
        # at most files_per_batch paths
        found = [(files.source_file(r["path"]), r["name"], r["again"]) for r in named.join(_names_taken(session, state, number), "name", "left").collect()]
        if not found:
            return
        times = Counter(name for _, name, _ in found)
        once = [f for f, name, again in found if not again and times[name] == 1]
        more = [f for f, name, again in found if again or times[name] > 1]
        parts = [b.unify(files.read_manifest(session, once))] if once else []
        if more:
            parts.append(_unrepeated(b.unify(files.read_manifest(session, more)), rows, number, t))
        raw = union_by_name(*parts).withColumns(_month_of("pickup_datetime"))
        raw.write.mode("overwrite").partitionBy(*MART_MONTH).parquet(f"{rows}/batch={number}")
        names = session.createDataFrame([(name,) for name in times], "name string")
        names.coalesce(1).write.mode("overwrite").parquet(f"{state}/names/batch={number}")
        taken.append(number)

    paths = (
        spark.readStream.format("binaryFile").schema(PATHS).option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).load(landing).select("path")
    )
    paths.writeStream.foreachBatch(conform).option("checkpointLocation", f"{state}/files").trigger(availableNow=True).start().awaitTermination()
    return taken


def hours(clean: DataFrame) -> DataFrame:
    """Trips and revenue, in whole hundredths, per fleet and hour; the same over a stream and over a table."""
    return clean.groupBy("taxi_type", F.window("pickup_datetime", "1 hour").alias("hour")).agg(
        F.count("*").alias("total_trips"), F.sum(hundredths("total_amount")).alias("s_amount")
    ).select("taxi_type", F.col("hour.start").alias("hour_start"), "total_trips", "s_amount").withColumns(_month_of("hour_start"))


def sum_up(spark: SparkSession, rows: str, mart: str, state: str, delay: str = DELAY, t: S.Thresholds = S.Thresholds(), files_per_batch: int = FILES_PER_BATCH) -> None:
    """Bring the mart's hours up to the conformed rows that are new; hours still open are updated in place."""
    clean = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", files_per_batch).parquet(rows).filter(s.in_range(t))

    def lay_over(batch: DataFrame, number: int) -> None:
        upsert_partitions(batch.sparkSession, mart, batch, MART_KEY, MART_MONTH)

    hours(clean.withWatermark("pickup_datetime", delay)).writeStream.outputMode("update").foreachBatch(lay_over).option("checkpointLocation", f"{state}/hours").trigger(
        availableNow=True
    ).start().awaitTermination()


def mend(spark: SparkSession, rows: str, mart: str, batches: list[int], t: S.Thresholds = S.Thresholds()) -> int:
    """Recompute the months that ``batches`` brought rows for, and lay over the hours that differ; how many did."""
    if not batches:
        return 0
    table = spark.read.schema(ROWS).parquet(rows)
    months = [tuple(r) for r in table.filter(F.col("batch").isin(batches)).select(*MART_MONTH).distinct().collect()]
    whole = in_partitions(table, MART_MONTH, months).filter(s.in_range(t))
    columns = [*MART_KEY, "total_trips", "s_amount", *MART_MONTH]
    known = in_partitions(spark.read.parquet(mart), MART_MONTH, months).select(columns)
    off = materialize(hours(whole).select(columns).join(known, columns, "left_anti"), "late-hours")
    late = off.count()
    if late:
        upsert_partitions(spark, mart, off, MART_KEY, MART_MONTH)
    return late


def follow(
    spark: SparkSession, landing: str, root: str, delay: str = DELAY, t: S.Thresholds = S.Thresholds(), files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """All that has arrived below ``landing`` since the last call taken into the mart below ``root``, and the mart.

    A file that is delivered again under the same name, wherever, adds nothing.
    """
    rows, mart, state = (f"{root.rstrip('/')}/{x}" for x in ("rows", "mart", "state"))
    batches = take_up(spark, landing, rows, state, files_per_batch, t)
    if batches:
        sum_up(spark, rows, mart, state, delay, t, files_per_batch)
        mend(spark, rows, mart, batches, t)
    return spark.read.parquet(mart).select(*MART_KEY, "total_trips", units("s_amount").alias("total_revenue"))
