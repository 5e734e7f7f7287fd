"""Data model: source schema, fleets, thresholds, table names."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import types as T

# The published column names and types of the monthly trip files.
TRIP_COLUMNS = {
    "VendorID": "bigint",
    "tpep_pickup_datetime": "timestamp",
    "tpep_dropoff_datetime": "timestamp",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "double",
    "store_and_fwd_flag": "string",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}
_TYPES = {t.simpleString(): t for t in (T.LongType(), T.TimestampType(), T.DoubleType(), T.StringType())}

MANDATORY = ("VendorID", "passenger_count", "total_amount", "pickup_datetime", "dropoff_datetime")


@dataclass(frozen=True)
class Fleet:
    """What differs from one source fleet to the next."""

    code: str
    time_prefix: str
    service_area: str
    business_model: str


# Fleet codes, their time-column prefixes and business labels.
FLEETS = {
    "yellow": Fleet("yellow", "tpep", "Manhattan/Airport", "Premium Service"),
    "green": Fleet("green", "lpep", "Outer Boroughs", "Volume Service"),
}
UNKNOWN_AREA = "Unknown"
DEFAULT_MODEL = "Volume Service"


def fleet(code: str) -> Fleet:
    if code not in FLEETS:
        raise ValueError(f"unknown fleet {code!r}; known: {', '.join(FLEETS)}")
    return FLEETS[code]


def raw_schema(code: str) -> T.StructType:
    """The file schema of a fleet: the common one with that fleet's time names."""
    prefix = fleet(code).time_prefix + "_"
    named = {name.replace("tpep_", prefix): kind for name, kind in TRIP_COLUMNS.items()}
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in named.items()])


@dataclass(frozen=True)
class Thresholds:
    """Bounds of a valid trip. Lower bounds are exclusive, upper ones inclusive."""

    # The business rules' bounds.
    min_amount: float = 0.0
    max_amount: float = 1000.0
    min_passengers: float = 0.0
    max_passengers: float = 6.0
    min_minutes: float = 0.0
    max_minutes: float = 1440.0
    first_day: date = date(2023, 1, 1)
    last_day: date = date(2023, 5, 31)


# Public table names of each layer.
BRONZE_TRIPS = "bronze_taxi_unified"
SILVER_TRIPS = "silver_taxi_clean"
QUARANTINE_TRIPS = "test_failures_taxi"
TRIP_CUBE = "gold_trip_cube"
GOLD_MONTHLY = "gold_monthly_averages"
GOLD_HOURLY = "gold_may_hourly_patterns"
GOLD_COMPARISON = "gold_taxi_comparison"
YELLOW_CLEAN = "yellow_taxi_clean"
STAGING_VIEW = "stg_yellow_taxi_trips"


@dataclass(frozen=True)
class TableSpec:
    """One entry of the layer registry."""

    name: str
    layer: str
    key: tuple[str, ...]
    partition_by: tuple[str, ...] = ()


REGISTRY = {
    t.name: t
    for t in (
        TableSpec(BRONZE_TRIPS, "bronze", ("trip_id",), ("source_year", "source_month")),
        TableSpec(SILVER_TRIPS, "silver", ("trip_id",), ("source_year", "source_month")),
        TableSpec(QUARANTINE_TRIPS, "quarantine", ("trip_id",), ("source_year", "source_month")),
        TableSpec(
            TRIP_CUBE, "gold", ("taxi_type", "source_year", "source_month", "vendor_id", "pickup_date", "pickup_hour"),
            ("source_year", "source_month"),
        ),
        TableSpec(GOLD_MONTHLY, "gold", ("taxi_type", "year", "month")),
        TableSpec(GOLD_HOURLY, "gold", ("taxi_type", "pickup_hour")),
        TableSpec(GOLD_COMPARISON, "gold", ("taxi_type",)),
    )
}
