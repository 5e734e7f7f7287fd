"""Row identity that is the same on every run."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# Fixed value: a monthly file's path from its key on, parts of a folder included.
FILE_PATH = r"([a-z]+_tripdata_\d{4}-\d{2}.*)$"


def file_record_key() -> Column:
    """Place of a row in its source file: the file's key, part if it has any, and row number.

    Landing files never change, so this is unique and repeatable, needs no
    shuffle, and tells exact copies of a row apart. The folders above the file
    do not count: a lake that is moved, or a file that is delivered again
    elsewhere, keeps its rows' keys.
    """
    inside = F.regexp_extract("_metadata.file_path", FILE_PATH, 1)
    return F.concat_ws(":", inside, F.col("_metadata.row_index"))


def trip_id(vendor: Column | str, pickup: Column | str, record_key: Column | str) -> Column:
    """Readable id: vendor, pickup time, and a digest of the record key."""
    return F.concat_ws("_", vendor, F.date_format(pickup, "yyyyMMddHHmmss"), F.md5(record_key))
