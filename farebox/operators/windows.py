"""Windows over trips that survive a partition key holding a third of all rows.

A plain window sends each partition key to one task. Here the rows of a key are
cut into slices along the order; a window runs inside each slice, a second one
over the slice totals, and the two are put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from farebox.functions import hundredths, units


def running_totals(
    df: DataFrame, keys: list[str], order: str, totals: dict[str, Column], slice_unit: str = "minute"
) -> DataFrame:
    """Running sums per ``keys`` along the timestamp ``order``; equal times share a value.

    That is the RANGE frame from the start to the current row. Rows of one time
    first collapse to one (so a crowded instant costs one row), then each
    calendar slice gets its own window and starts at the sum of the slices
    before it. Joining back is an equi-join with one row per key and time on
    the small side, where AQE can split a crowded key. A row without key or
    time stays, with no total.
    """
    names = list(totals)
    part = "_slice"
    # without this filter the two uses below would be filtered apart and aggregate twice
    instants = (
        df.dropna(subset=[*keys, order])
        .groupBy(*keys, order)
        .agg(*[F.sum(c).alias(n) for n, c in totals.items()])
        .withColumn(part, F.date_trunc(slice_unit, order))
        .filter(F.col(part).isNotNull())
    )
    inside = Window.partitionBy(*keys, part).orderBy(order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy(part)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        instants.groupBy(*keys, part)
        .agg(*[F.sum(n).alias(n) for n in names])
        .select(
            *keys,
            part,
            *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_from_{n}") for n in names],
        )
    )
    running = (
        instants.select(*keys, part, order, *[F.sum(n).over(inside).alias(n) for n in names])
        .join(starts, [*keys, part])
        .select(*keys, order, *[(F.col(n) + F.col(f"_from_{n}")).alias(n) for n in names])
    )
    return df.join(running, [*keys, order], "left")


def previous_value(
    df: DataFrame, key: str, order: list[str], value: str, name: str, slices: list[list[str]]
) -> DataFrame:
    """``lag(value)`` per ``key`` along ``order``, which must be unique within ``key``.

    Each entry of ``slices`` names columns of ``df`` that cut the one before more
    finely, along the order: they must never fall while the order rises. A window runs within each
    of the finest slices; only its first row lacks a predecessor, which is the
    last value of the slice before. Those last values, one row per slice, are
    lagged in the same way over the coarser slices, and over the key at the end.
    Rows are shuffled once; a NULL key is a key of its own.
    """
    if not slices:
        along = Window.partitionBy(key).orderBy(*order)
        return df.withColumn(name, F.lag(value).over(along))
    *coarser, parts = slices
    last, carry, first = f"_last{len(slices)}", f"_carry{len(slices)}", f"_first{len(slices)}"
    ends = df.groupBy(key, *parts).agg(F.max_by(value, F.struct(*order)).alias(last))
    carried = previous_value(ends, key, parts, last, carry, coarser).select(
        F.col(key).alias("_key"), *(F.col(p).alias(f"_{p}") for p in parts), carry
    )
    along = Window.partitionBy(key, *parts).orderBy(*order)
    inside = df.withColumns({name: F.lag(value).over(along), first: F.lag(F.lit(False), 1, True).over(along)})
    same = F.col(key).eqNullSafe(F.col("_key"))
    for p in parts:
        same = same & F.col(p).eqNullSafe(F.col(f"_{p}"))
    joined = inside.join(carried, same, "left")
    return joined.withColumn(name, F.when(F.col(first), F.col(carry)).otherwise(F.col(name))).select(*df.columns, name)


def running_hour_count(trips: DataFrame) -> DataFrame:
    """Trips so far in the same hour of the same day, equal times together."""
    return running_totals(
        trips, ["pickup_date", "pickup_hour"], "pickup_datetime", {"trips_in_hour": F.lit(1)}
    )


def running_daily_total(trips: DataFrame) -> DataFrame:
    """Revenue so far on the same day, equal times together."""
    amount = {"s_running": hundredths("total_amount")}
    return (
        running_totals(trips, ["pickup_date"], "pickup_datetime", amount)
        .withColumn("running_daily_total", units("s_running"))
        .drop("s_running")
    )


def previous_trip_amount(trips: DataFrame) -> DataFrame:
    """Amount of the vendor's trip before this one; the vendor's first has none."""
    # within one time the ids differ in the digest behind their last underscore
    fine = {
        "_minute": F.date_trunc("minute", "pickup_datetime"), "_time": F.col("pickup_datetime"),
        "_digit": F.substring(F.substring_index("trip_id", "_", -1), 1, 1),
    }
    return previous_value(
        trips.withColumns(fine), "vendor_id", ["pickup_datetime", "trip_id"], "total_amount", "prev_trip_amount",
        [["_minute"], list(fine)],
    ).drop(*fine)


def peak_hour_per_day(trips: DataFrame) -> DataFrame:
    """The busiest hour of each day; hours that tie are all kept."""
    hours = trips.groupBy("pickup_date", "pickup_hour").agg(F.count("*").alias("trips_in_hour"))
    busiest = Window.partitionBy("pickup_date").orderBy(F.desc("trips_in_hour"))
    return (
        hours.withColumn("hour_rank_by_volume", F.dense_rank().over(busiest))
        .filter(F.col("hour_rank_by_volume") == 1)
        .select("pickup_date", "pickup_hour", "trips_in_hour")
        .orderBy("pickup_date", "pickup_hour")
    )


def first_peak_hours(trips: DataFrame, rows: int = 10) -> DataFrame:
    """The head of :func:`peak_hour_per_day`, earliest days first."""
    return peak_hour_per_day(trips).limit(rows)
