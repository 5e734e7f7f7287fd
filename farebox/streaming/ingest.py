"""Monthly files that keep arriving: each one enters the raw layer exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from farebox import schema as S
from farebox.functions import file_record_key
from farebox.operators.bronze import bronze
from farebox.sources.files import FILE_KEY


def arriving(spark: SparkSession, fleet_code: str, landing: str) -> DataFrame:
    """The raw layer over the fleet's files below ``landing``, as a stream.

    Fleet, year and month are read off the file name, as the manifest gives
    them for a batch.
    """
    key = F.regexp_extract("_metadata.file_path", FILE_KEY, 1)
    period = F.substring_index("file_key", "_", -1)
    feed = (
        spark.readStream.schema(S.raw_schema(fleet_code))
        .parquet(f"{landing}/{fleet_code}_tripdata_*")
        .select("*", key.alias("file_key"), file_record_key().alias("record_key"))
        .withColumns(
            {
                "source_year": F.substring_index(period, "-", 1).cast("int"),
                "source_month": F.substring_index(period, "-", -1).cast("int"),
                "source_file": F.concat("file_key", F.lit(".parquet")),
            }
        )
        .drop("file_key")
    )
    return bronze(feed, fleet_code)


def ingest_arrivals(
    spark: SparkSession, fleet_code: str, landing: str, target: str, state: str
) -> None:
    """Append what has arrived since the last call to ``target``, then stop.

    ``state`` is a shared folder that remembers the files already taken; with
    it a call after a failure neither repeats nor skips a file.
    """
    query = (
        arriving(spark, fleet_code, landing)
        .writeStream.format("parquet")
        .partitionBy("source_year", "source_month")
        .option("path", target)
        .option("checkpointLocation", f"{state}/{fleet_code}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
