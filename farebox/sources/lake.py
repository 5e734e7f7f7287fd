"""Layer tables as Parquet folders, and the views that SQL users query."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from farebox import schema as S
from farebox.operators import bronze as bronze_ops, silver as silver_ops
from farebox.plans import gold

# digests as text halve under it, and not at all under the default
COMPRESSION = "zstd"


@dataclass(frozen=True)
class Lake:
    """Tables below ``root``, one folder per layer and table."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{S.REGISTRY[name].layer}/{name}"

    def read(self, name: str, merge_schema: bool = False) -> DataFrame:
        """A table; ``merge_schema`` also finds columns that only later files have."""
        return self.spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(
            self.path(name)
        )

    def write(
        self, name: str, df: DataFrame, counts: dict[str, Column] | None = None, into: dict | None = None, lies_by_partition: bool = False
    ) -> DataFrame:
        """Overwrite a table; of a partitioned one only the partitions present in ``df``.

        So loading a month again replaces that month. Partitioned tables are
        rebalanced on their partition columns first: few files per month, and
        AQE splits a month that is far larger than the rest. Rows of a table that
        ``lies_by_partition``, in folders of the same columns, are written from
        the tasks that read them, without a shuffle. ``counts`` are taken
        of the rows as they are written, in the tasks that write them, and put
        ``into`` a dict; nothing is scanned again.
        """
        by = S.REGISTRY[name].partition_by
        if by and not lies_by_partition:
            df = df.hint("rebalance", *by)
        seen = Observation()
        if counts:
            df = df.observe(seen, *[c.alias(k) for k, c in counts.items()])
        if by:
            (
                df.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*by)
                .option("compression", COMPRESSION)
                .parquet(self.path(name))
            )
        else:
            df.write.mode("overwrite").parquet(self.path(name))
        if counts and into is not None:
            into |= {k: seen.get.get(k, 0) for k in counts}
        return self.read(name)

    def load(self, bronze: DataFrame, months: DataFrame | None = None, t: S.Thresholds = S.Thresholds()) -> dict[str, int]:
        """Write the raw layer, the clean one, the quarantine, and the cube that all marts are made of.

        Returns what was counted while writing: ``rows`` of the raw layer, those
        ``valid`` among them by their flag, and the rows ``clean`` and ``quarantined``.

        ``months`` names the (source_year, source_month) being loaded; then the
        later layers take only those from the raw table, and no file of another
        month is read or replaced. Without it all of the raw table is taken.
        """
        counted: dict[str, int] = {}
        every = F.count("*")
        valid = F.count_if(silver_ops.quality_flag(t) == silver_ops.VALID)
        raw = self.write(S.BRONZE_TRIPS, bronze, {"rows": every, "valid": valid}, counted)
        if months is not None:
            # one row per month of the calendar: folders to read
            wanted = [(r[0], r[1]) for r in months.select("source_year", "source_month").distinct().collect()]
            pick = F.lit(False)
            for year, month in wanted:
                pick = pick | ((F.col("source_year") == year) & (F.col("source_month") == month))
            raw = raw.filter(pick)
        self.write(S.SILVER_TRIPS, silver_ops.silver(raw, t), {"clean": every}, counted, lies_by_partition=True)
        self.write(S.QUARANTINE_TRIPS, silver_ops.quarantine(raw, t), {"quarantined": every}, counted, lies_by_partition=True)
        trips = self.read(S.SILVER_TRIPS)
        self.write(S.TRIP_CUBE, gold.cube(trips if months is None else trips.filter(pick)))
        return counted

    def build(self, bronze: DataFrame, t: S.Thresholds = S.Thresholds()) -> dict[str, DataFrame]:
        """Raw layer to marts. Every layer is read back from its table by the next."""
        self.load(bronze, t=t)
        layers = (S.BRONZE_TRIPS, S.SILVER_TRIPS, S.QUARANTINE_TRIPS, S.TRIP_CUBE)
        return {name: self.read(name) for name in layers} | self.marts()

    def marts(self) -> dict[str, DataFrame]:
        """The marts written from the cube; no trip is read."""
        cells = self.read(S.TRIP_CUBE)
        made = {S.GOLD_MONTHLY: gold.monthly_of, S.GOLD_HOURLY: gold.hourly_of, S.GOLD_COMPARISON: gold.comparison_of}
        return {name: self.write(name, make(cells)) for name, make in made.items()}


def register_views(bronze: DataFrame, t: S.Thresholds = S.Thresholds()) -> None:
    """Every table and view name for SQL, over ``bronze``, without writing anything."""
    trips = silver_ops.silver(bronze, t)
    views = {
        S.BRONZE_TRIPS: bronze,
        S.SILVER_TRIPS: trips,
        S.QUARANTINE_TRIPS: silver_ops.quarantine(bronze, t),
        S.YELLOW_CLEAN: silver_ops.yellow_clean(trips),
        S.STAGING_VIEW: silver_ops.staging(trips),
        S.GOLD_MONTHLY: gold.monthly(trips),
        S.GOLD_HOURLY: gold.hourly(trips),
        S.GOLD_COMPARISON: gold.comparison(trips),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def use_database(spark: SparkSession, name: str) -> None:
    """Create the namespace when absent and make it current."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")
    spark.catalog.setCurrentDatabase(name)
