"""Monthly trip files: a manifest says which file belongs to which fleet and month."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from farebox import schema as S
from farebox.functions import file_record_key
from farebox.session import local_table
from farebox.sources.conform import conform, union_by_name

# Fixed value: the naming pattern of a monthly file (or folder of part files).
FILE_KEY = r"([a-z]+_tripdata_\d{4}-\d{2})[^/]*"


@dataclass(frozen=True)
class SourceFile:
    """A monthly file, or a folder of part files, named ``<fleet>_tripdata_<yyyy-MM>``."""

    fleet: str
    year: int
    month: int
    path: str

    @property
    def key(self) -> str:
        return file_key(self.fleet, self.year, self.month)


def file_key(fleet: str, year: int, month: int) -> str:
    return f"{fleet}_tripdata_{year:04d}-{month:02d}"


def source_file(path: str) -> SourceFile:
    """The monthly file that a path names; a part of a folder belongs to that folder's month."""
    found = re.search(r"([a-z]+)_tripdata_(\d{4})-(\d{2})", path)
    if not found:
        raise ValueError(f"{path}: not named like a monthly file")
    return SourceFile(S.fleet(found[1]).code, int(found[2]), int(found[3]), path)


def manifest(root: str, fleets: Iterable[str], periods: Iterable[tuple[int, int]]) -> list[SourceFile]:
    """The files of every fleet for every (year, month) below ``root``."""
    periods = list(periods)
    return [
        SourceFile(fleet, year, month, f"{root}/{file_key(fleet, year, month)}.parquet")
        for fleet in fleets
        for year, month in periods
    ]


def own_schemas(spark: SparkSession, files: list[SourceFile]) -> dict[str, list[SourceFile]]:
    """The files by the schema in their footers (as JSON); a manifest has one file per fleet and month."""
    with ThreadPoolExecutor(8) as pool:
        schemas = list(pool.map(lambda f: spark.read.parquet(f.path).schema.json(), files))
    groups: dict[str, list[SourceFile]] = {}
    for schema, f in zip(schemas, files, strict=True):
        groups.setdefault(schema, []).append(f)
    return groups


def scan_as_declared(
    spark: SparkSession, schema: T.StructType, files: list[SourceFile], required: tuple[str, ...]
) -> DataFrame:
    """All ``files`` in the declared columns and types, further columns after them.

    Files of one footer schema are one scan, read as they are and then
    conformed, so a column may change its type from month to month. A file
    without a ``required`` column is refused by name.
    """
    parts = []
    for own, entries in own_schemas(spark, files).items():
        found = {c.lower() for c in T.StructType.fromJson(json.loads(own)).names}
        absent = [c for c in required if c.lower() not in found]
        if absent:
            raise ValueError(f"{entries[0].path}: mandatory columns missing: {', '.join(absent)}")
        scan = spark.read.schema(T.StructType.fromJson(json.loads(own))).parquet(*[f.path for f in entries])
        scan = scan.select(
            "*", F.regexp_extract("_metadata.file_path", FILE_KEY, 1).alias("file_key"), file_record_key().alias("record_key")
        )
        parts.append(conform(scan, schema))
    return union_by_name(*parts)


def required_columns(code: str) -> tuple[str, ...]:
    """The mandatory columns under the fleet's own names."""
    prefix = S.fleet(code).time_prefix
    return tuple(f"{prefix}_{c}" if c.endswith("_datetime") else c for c in S.MANDATORY)


def read_manifest(spark: SparkSession, files: Iterable[SourceFile]) -> dict[str, DataFrame]:
    """One lazy frame per fleet over all of its files, in the declared schema.

    There is one scan per footer schema, not per file. Year and month come from
    the manifest through a join on the file key found in the path. The manifest
    is a local relation of known size, so Spark itself decides whether to
    broadcast it.
    """
    by_fleet: dict[str, list[SourceFile]] = {}
    for f in files:
        S.fleet(f.fleet)
        by_fleet.setdefault(f.fleet, []).append(f)
    feeds = {}
    for code, entries in by_fleet.items():
        keys = {f.key: f for f in entries}  # a month may have several files or parts
        months = local_table(
            spark,
            {
                "file_key": [*keys],
                "source_year": [f.year for f in keys.values()],
                "source_month": [f.month for f in keys.values()],
            },
        ).withColumns({c: F.col(c).cast("int") for c in ("source_year", "source_month")})
        feeds[code] = (
            scan_as_declared(spark, S.raw_schema(code), entries, required_columns(code))
            .join(months, "file_key")
            .withColumn("source_file", F.concat("file_key", F.lit(".parquet")))
            .drop("file_key")
        )
    return feeds
