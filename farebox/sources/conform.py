"""Bring differently shaped files to a declared schema, and report the differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T


def conform(df: DataFrame, schema: T.StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the columns of ``schema`` first, in its types; others follow.

    A missing column becomes NULL, a value that does not fit its type too
    (``try_cast``). A missing ``required`` column raises.
    """
    present = {c.lower(): c for c in df.columns}
    absent = [c for c in required if c.lower() not in present]
    if absent:
        raise ValueError(f"mandatory columns missing: {', '.join(absent)}")
    declared = []
    for field in schema.fields:
        found = present.pop(field.name.lower(), None)
        source = F.lit(None).cast(field.dataType) if found is None else F.col(found)
        if found is not None and df.schema[found].dataType != field.dataType:
            source = source.try_cast(field.dataType)
        declared.append(source.alias(field.name))
    return df.select(*declared, *present.values())


def conformance(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per column: how it compares to ``schema`` and how many values fit.

    Counts come from one aggregate over the data with no shuffle beyond it.
    """
    present = {c.lower(): c for c in df.columns}
    declared = {f.name.lower(): f for f in schema.fields}
    counts, rows = [F.count("*").alias("n_rows")], []
    for key in [*declared, *(c for c in present if c not in declared)]:
        field, found = declared.get(key), present.get(key)
        name = field.name if field else found
        expected = field.dataType.simpleString() if field else None
        actual = df.schema[found].dataType.simpleString() if found else None
        if found is None:
            status, fits = "missing", F.lit(None).cast("bigint")
        else:
            value = F.col(found)
            status = "extra" if field is None else "ok" if actual == expected else "type_drift"
            fits = F.count(value.try_cast(field.dataType) if status == "type_drift" else value)
        slot = f"fits_{len(rows)}"
        counts.append(fits.alias(slot))
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(status).alias("status"),
                F.lit(expected).cast("string").alias("expected_type"),
                F.lit(actual).cast("string").alias("found_type"),
                F.col("n_rows").alias("total_rows"),
                F.col(slot).alias("fitting_values"),
            )
        )
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def union_by_name(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column only some frames have is NULL in the rest."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
