"""Business labels: every CASE-like mapping is a table plus one of two builders."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from farebox import schema as S

# ---------------------------------------------------------------- fixed values
# Hours of the day, both ends inclusive; any other hour is LATE / LATE_PT.
PERIODS = (
    (6, 9, "morning_rush"),
    (10, 16, "midday"),
    (17, 20, "evening_rush"),
    (21, 23, "night"),
)
LATE = "late_night"
PERIODS_PT = (
    (6, 9, "Manhã (Rush)"),
    (10, 16, "Meio do Dia"),
    (17, 20, "Tarde (Rush)"),
    (21, 23, "Noite"),
)
LATE_PT = "Madrugada"
PERIOD_ORDER = ("morning_rush", "midday", "evening_rush", "night", "late_night")
MONTHS_PT = ("Janeiro", "Fevereiro", "Março", "Abril", "Maio")
# Strict lower limits, highest first; anything else takes the last label.
FARE_TIERS = ((50, "Premium"), (20, "Standard"))
FARE_TIER_ELSE = "Economy"
TIP_LEVELS = ((15, "Alto"), (10, "Médio"))
TIP_LEVEL_ELSE = "Baixo"
VALUE_SEGMENTS = ((15, "High Value"), (10, "Medium Value"))
VALUE_SEGMENT_ELSE = "Low Value"
# -----------------------------------------------------------------------------


def _chain(pairs: Sequence[tuple[Column, str]], otherwise: str | None) -> Column:
    (first, label), *rest = pairs
    chain = reduce(lambda c, p: c.when(p[0], p[1]), rest, F.when(first, label))
    return chain if otherwise is None else chain.otherwise(otherwise)


def between_bands(c: Column | str, bands: Sequence[tuple], otherwise: str) -> Column:
    """Label of the closed band holding ``c``; NULL falls to ``otherwise``."""
    c = F.col(c) if isinstance(c, str) else c
    return _chain([(c.between(lo, hi), label) for lo, hi, label in bands], otherwise)


def above(c: Column | str, limits: Sequence[tuple], otherwise: str) -> Column:
    """Label of the first limit that ``c`` exceeds; NULL falls to ``otherwise``."""
    c = F.col(c) if isinstance(c, str) else c
    return _chain([(c > limit, label) for limit, label in limits], otherwise)


def time_period(hour: Column | str) -> Column:
    return between_bands(hour, PERIODS, LATE)


def period_pt(hour: Column | str) -> Column:
    return between_bands(hour, PERIODS_PT, LATE_PT)


def period_order(period: Column | str) -> Column:
    """1-based place of a period in the day, for sorting; NULL if not a period."""
    period = F.col(period) if isinstance(period, str) else period
    place = F.array_position(F.array(*map(F.lit, PERIOD_ORDER)), period)
    return F.nullif(place, F.lit(0))


def month_name(month: Column | str) -> Column:
    """Portuguese month name; months outside the reporting season have none."""
    month = F.col(month) if isinstance(month, str) else month
    return F.when(month >= 1, F.get(F.array(*map(F.lit, MONTHS_PT)), month.cast("int") - 1))


def _by_fleet(c: Column | str, attribute: str, otherwise: str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return _chain([(c == f.code, getattr(f, attribute)) for f in S.FLEETS.values()], otherwise)


def service_area(taxi_type: Column | str) -> Column:
    return _by_fleet(taxi_type, "service_area", S.UNKNOWN_AREA)


def business_model(taxi_type: Column | str) -> Column:
    return _by_fleet(taxi_type, "business_model", S.DEFAULT_MODEL)


def fare_tier(amount: Column | str) -> Column:
    return above(amount, FARE_TIERS, FARE_TIER_ELSE)


def tip_category(tip_percent: Column | str) -> Column:
    return above(tip_percent, TIP_LEVELS, TIP_LEVEL_ELSE)


def value_segment(avg_fare: Column | str) -> Column:
    return above(avg_fare, VALUE_SEGMENTS, VALUE_SEGMENT_ELSE)


def hour_range(hour: Column | str) -> Column:
    """``07:00 - 08:00``; the last hour of the day ends at ``24:00``."""
    hour = F.col(hour) if isinstance(hour, str) else hour
    return F.format_string("%02d:00 - %02d:00", hour, hour + 1)
