"""License texts found by diagonal voting, with DataFrame functions only.

Every rolling pair of words is joined by its hash to the places where it stands
in a template. A hit votes for the diagonal (place in the text minus place in
the template); votes on neighbouring diagonals are merged, so that inserted or
missing words do not part a text, and the merged span is checked for length and
share of the template. The templates are a fixed list, a few hundred pairs, and
a local relation that Spark broadcasts by its own size check.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from farebox.llm.words import words

# fixed values: phrases whose words must stand consecutively, and their labels
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# fixed values: statements and openings of public licenses, found also with small changes
TEMPLATES = {
    "apache-2.0-notice": "licensed under the apache license version 2 0",
    "bsd-text": "redistribution and use in source and binary forms with or without modification are permitted",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-sa-notice": "licensed under cc by sa 4 0",
    "gpl-3-notice": "this work is licensed under the gnu general public license version 3",
    "mit-notice": "released under the mit license",
    "mit-text": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license",
}
SHARE, GAP = 0.7, 3


def template_pairs(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """A row for each pair of neighbouring words of each template."""
    rows = [
        (label, i, a, b, len(split) - 1)
        for label, text in templates.items()
        for split in [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)]
        for i, (a, b) in enumerate(zip(split, split[1:], strict=False))
    ]
    names = ("template", "t_pos", "t_a", "t_b", "t_pairs")
    table = pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)})
    return spark.createDataFrame(table).withColumn("gram", F.xxhash64("t_a", "t_b"))


def _keyed(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    return df.select(
        F.struct(*keys).alias("k"), F.xxhash64(F.col(text), F.length(text)).alias("h"), F.col(text).alias("t")
    )


def hits(df: DataFrame, templates: dict[str, str], text: str, keys: list[str]) -> DataFrame:
    """(k, h, template, t_pairs, t_pos, pos): places of the templates' pairs in the documents."""
    docs = _keyed(df, text, keys).select("k", "h", words(F.col("t")).alias("w"))
    pairs = docs.select(
        "k", "h", F.posexplode(F.arrays_zip(F.col("w").alias("a"), F.expr("slice(w, 2, size(w))").alias("b")))
    ).select("k", "h", "pos", F.col("col.a").alias("a"), F.col("col.b").alias("b"))
    known = template_pairs(df.sparkSession, templates)
    found = pairs.withColumn("gram", F.xxhash64("a", "b")).join(known, "gram").filter("a = t_a AND b = t_b")
    return found.select("k", "h", "template", "t_pairs", "t_pos", "pos")


def by_template(found: DataFrame) -> DataFrame:
    """(k, h, template, t_pairs, at): a document's hits in one template, no more than it has words.

    Only those of which enough different pairs are there at all: chance hits of
    common pairs end here.
    """
    return found.groupBy("k", "h", "template", "t_pairs").agg(
        F.collect_set(F.struct((F.col("pos") - F.col("t_pos")).alias("diagonal"), "t_pos", "pos")).alias("at")
    )


def spans(found: DataFrame, share: float = SHARE, gap: int = GAP) -> DataFrame:
    """Bands of neighbouring diagonals, merged and verified: (k, h, template, start_word, end_word, score).

    A band has up to ``gap`` diagonals beyond its first, so no chain of chance
    hits makes it longer than the template and ``gap``. Its score is the number
    of the template's pairs that it hits, over the template's pairs or those of
    the span from its first hit to its last, whichever are more; bands that
    reach ``share`` are places of the template.
    """
    enough = found.filter(F.size(F.array_distinct(F.col("at.t_pos"))) >= share * F.col("t_pairs"))
    each = enough.select("k", "h", "template", "t_pairs", F.explode("at").alias("hit"))
    # every band that a diagonal belongs to: first diagonal and width
    bands = F.array(*(F.struct((F.col("hit.diagonal") - j).alias("first"), F.lit(g).alias("width")) for g in range(gap + 1) for j in range(g + 1)))
    merged = each.withColumn("band", F.explode(bands)).groupBy("k", "h", "template", "t_pairs", "band").agg(
        F.countDistinct("hit.t_pos").alias("pairs"), F.min("hit.pos").alias("start_word"), (F.max("hit.pos") + 2).alias("end_word")
    )
    score = F.col("pairs") / F.greatest(F.col("t_pairs"), F.col("end_word") - F.col("start_word") - 1)
    return merged.withColumn("score", score).filter(F.col("score") >= share)


def phrase_places(found: DataFrame) -> DataFrame:
    """Places at which every pair of a template stands on one diagonal."""
    on_diagonal = found.groupBy("k", "h", "template", "t_pairs", (F.col("pos") - F.col("t_pos")).alias("start_word")).agg(
        F.countDistinct("t_pos").alias("pairs")
    )
    return on_diagonal.filter("pairs = t_pairs").select("k", "h", "template", "start_word", F.lit(1.0).alias("score"))


def license_scan(
    df: DataFrame, keys: list[str], text: str = "text",
    phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None,
) -> DataFrame:
    """Licenses of each row: the key columns, then counts, places and labels.

    ``phrases`` (phrase to label) need all their words in a row; ``templates``
    (label to text) may differ a little. A null text counts as empty and has
    neither. Equal rows get equal results, each its own row.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    found = hits(df, {f"phrase:{p}": p for p in phrases} | templates, text, keys)
    exact = F.col("template").startswith("phrase:")
    label = F.element_at(
        F.create_map(*(F.lit(x) for p, name in phrases.items() for x in (f"phrase:{p}", name))), F.col("template")
    )
    base = phrase_places(found.filter(exact)).select(
        "k", "h", label.alias("label"), "start_word", F.lit(True).alias("base"), "score"
    )
    own = spans(by_template(found.filter(~exact))).select(
        "k", "h", F.col("template").alias("label"), "start_word", F.lit(False).alias("base"), "score"
    )
    start = F.when(F.col("base"), F.col("start_word").cast("bigint"))
    per_doc = base.unionByName(own).groupBy("k", "h").agg(
        F.count_if("base").alias("n_base"),
        F.min(start).alias("first_word"),
        F.max(start).alias("last_word"),
        F.collect_set(F.when(F.col("base"), F.col("label"))).alias("base_set"),
        F.collect_set("label").alias("all_set"),
        F.max("score").alias("score"),
    )
    # all places of a hit are in per_doc, which is one short row per document with any
    all_docs = _keyed(df, text, keys).select(
        F.col("k").alias("dk"), F.col("h").alias("dh"), F.size(words(F.col("t"))).cast("bigint").alias("n_words")
    )
    joined = all_docs.join(per_doc, F.col("dk").eqNullSafe(F.col("k")) & (F.col("dh") == F.col("h")), "left")

    def listed(c: str) -> F.Column:
        return F.coalesce(F.array_join(F.sort_array(c), ","), F.lit(""))

    return joined.select(
        "dk.*", "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), "first_word", "last_word",
        listed("base_set").alias("base_labels"), listed("all_set").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
