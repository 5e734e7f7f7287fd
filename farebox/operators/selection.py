"""Exact quantiles in bounded memory, for all groups at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from farebox.session import materialize

DIGIT_BITS = 12


def selected(df: DataFrame, keys: list[str], value: Column, name: str, share: tuple[int, int] = (1, 2), bits: int = DIGIT_BITS) -> DataFrame:
    """(keys, ``name``): per group the smallest whole number that ``share`` of its values do not exceed.

    Selection by digits, the highest first: every round counts one digit of
    the values that still agree with what is known, and settles it for every
    group. A group never has more than ``2 ** bits`` counts, whatever its number
    of distinct values; a round is one scan of the keys and values, which are
    written once, and one small aggregate. NULL values do not count, a group
    without others is left out, and NULL keys are a group of their own.
    """
    # written once: the rounds read numbers, and their filters are not worked out from the value's inputs
    rows = materialize(df.select(*keys, value.cast("bigint").alias("_v")), "selection-values").filter("_v IS NOT NULL")
    low, high = rows.agg(F.min("_v"), F.max("_v")).first()
    if low is None:
        return rows.select(*keys, F.col("_v").alias(name)).limit(0)
    rows = rows.select(*keys, (F.col("_v") - F.lit(low)).alias("_v"))
    part, whole = share
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_digit").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = None
    rounds = max(1, -(-(int(high) - int(low)).bit_length() // bits))
    for shift in range((rounds - 1) * bits, -1, -bits):
        left = rows
        if state is not None:
            known = state.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
            same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
            same.append(F.shiftright("_v", shift + bits) == F.col("_prefix"))
            left = rows.join(known.select(*(f"_k{i}" for i in range(len(keys))), "_prefix"), reduce(lambda a, b: a & b, same), "left_semi")
        digit = F.shiftright("_v", shift).bitwiseAND(F.lit((1 << bits) - 1))
        counts = left.groupBy(*keys, digit.alias("_digit")).agg(F.count("*").alias("_n"))
        summed = counts.select(*keys, "_digit", "_n", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(group).alias("_all"))
        if state is None:
            rank = F.expr(f"(_all * {part} + {whole - 1}) DIV {whole}")
            joined = summed.select("*", F.lit(0).cast("bigint").alias("_prefix"), F.greatest(rank, F.lit(1)).alias("_rank"))
        else:
            joined = summed.join(known, reduce(lambda a, b: a & b, same[:-1], F.lit(True))).drop(*(f"_k{i}" for i in range(len(keys))))
        found = joined.filter((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank")))
        # one row per group and round
        state = materialize(
            found.select(
                *keys, (F.shiftleft("_prefix", bits) + F.col("_digit")).alias("_prefix"),
                (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank"),
            ), "selection",
        )
    return state.select(*keys, (F.col("_prefix") + F.lit(low)).alias(name))
