"""The corpus operators as stages of the pipeline: ``(spark, docs, sf_dir) -> DataFrame``.

Every stage but the last returns the columns of its input and takes effect on
all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from farebox.llm import bpe, contamination, jaccard, lines, quality
from farebox.llm.catalog import tokenizer_path
from farebox.llm.frames import table


def _with_row(docs: DataFrame) -> DataFrame:
    """Key, text and the whole row, so that no column of it meets one that an operator adds."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the trees reject go.

    Null and empty texts have no words and go; repeated rows are judged alike,
    whatever their key; an empty table stays empty.
    """
    trees = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, trees)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, but for the first; so do documents of which no word is left.

    Null texts and documents that lose no line stay as they are, empty ones
    included; rows that repeat a key and text lose the same lines. ``n_chars``,
    if there is one, follows the text; columns of any other name are kept.
    """
    changed = lines.drop_recurring_lines(_with_row(docs))
    left = changed.filter("n_dropped = 0 OR kept_text RLIKE '[^ \\\\t\\\\n\\\\r\\\\f\\\\x0B]'")
    new = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_dropped") == 0, F.col("row.n_chars")).otherwise(
            F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)
        )
    return left.select(*(new[c].alias(c) if c in new else F.col("row").getField(c).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id.

    A null id stands before all others; of repeated rows one stays, but rows
    without words are copies of nothing and all stay.
    """
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go, word for word; items that are only near are no reason.

    Null and empty texts stay; repeated rows are judged alike.
    """
    found = contamination.contamination(_with_row(docs), table(spark, sf_dir, "benchmark"))
    return found.filter("NOT contaminated").select("row.*")


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its token ids, which decode to the text again.

    Null and empty texts have no ids. ``ids``, ``n_tokens`` and ``round_trip``
    take the place of columns of these names; repeated rows stay.
    """
    added = ("ids", "n_tokens", "round_trip", "decoded")
    return bpe.round_trip(docs.drop(*added), tokenizer_path()).select(
        *(c for c in docs.columns if c not in added),
        "ids",
        F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )
