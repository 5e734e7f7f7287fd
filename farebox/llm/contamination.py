"""Benchmark passages found through a positional inverted index, with DataFrame functions only.

The index stores a posting (term, document, place) for every document word that
any benchmark item uses. Lists are then read from the rarest term up: each
window of an item names its few rarest places, and a document is looked at on a
diagonal (place in the document minus place in the item) only where all of
them stand on it. What is left is compared with the document's own words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from farebox.llm.frames import stored
from farebox.llm.words import words

WINDOW, RARE = 10, 3
SHARE, SLOP, LEAST = 0.5, 20, 3


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of equal key and text are one document: (d, h, t)."""
    return df.select(
        F.col(key).alias("d"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"), F.col(text).alias("t")
    )


def same_document(d: str, h: str, d2: str, h2: str) -> Column:
    return (F.col(h) == F.col(h2)) & F.col(d).eqNullSafe(F.col(d2))


def item_words(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, ik, iw): id as text, a key of id and words, and the words; items without words are left out.

    A null id is written as the empty string.
    """
    iw = words(F.col(text))
    item = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return items.select(item.alias("item"), iw.alias("iw")).filter(F.size("iw") > 0).distinct().withColumn(
        "ik", F.xxhash64("item", "iw")
    )


def postings(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The index: one row per place of a benchmark term in a document."""
    terms = items.select(F.explode("iw").alias("term")).distinct()
    every = docs.select("d", "h", F.posexplode(words(F.col("t"))).alias("pos", "term"))
    return every.join(terms, "term")


def windows(items: DataFrame, index: DataFrame, window: int = WINDOW, rare: int = RARE) -> DataFrame:
    """(ik, item, iw, length, starts, least_need, wanted): for each window its first word and the places of its rarest terms.

    ``wanted`` is the number of such places of the item. An item of fewer than ``window`` words is one window. Terms that no
    document has are the rarest of all.
    """
    counts = index.groupBy("term").agg(F.count("*").alias("n"))
    places = items.select("ik", F.posexplode("iw").alias("ipos", "term"))
    rated = places.join(counts, "term", "left").groupBy("ik").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "ipos"))).alias("by_count")
    )
    length = F.least(F.lit(window), F.size("iw"))
    found = items.join(rated, "ik").select("ik", "item", "iw", "by_count", length.alias("length"))
    need = (
        f"transform(slice(filter(by_count, x -> x.ipos >= s AND x.ipos < s + length), 1, {rare}), x -> x.ipos)"
    )
    starts = f"transform(sequence(0, size(iw) - length), s -> struct(s AS start, {need} AS need))"
    spans = found.select("ik", "item", "iw", "length", F.expr(starts).alias("starts"))
    return spans.withColumn("least_need", F.expr("array_min(transform(starts, x -> size(x.need)))")).withColumn(
        "wanted", F.size(F.array_distinct(F.flatten("starts.need")))
    )


def rare_hits(index: DataFrame, spans: DataFrame) -> DataFrame:
    """(d, h, ik, at): the postings of an item's rarest terms in a document, each a diagonal and a place in the item.

    They are no more than the document has words times the item's places of one
    term. Documents in which fewer of the places are met than any window needs are left out.
    """
    anchors = spans.select("ik", "iw", F.explode(F.array_distinct(F.flatten("starts.need"))).alias("ipos")).select(
        "ik", "ipos", F.expr("iw[ipos]").alias("term")
    )
    each = index.join(anchors, "term").select("d", "h", "ik", F.struct((F.col("pos") - F.col("ipos")).alias("shift"), "ipos").alias("hit"))
    met = each.groupBy("d", "h", "ik").agg(F.collect_set("hit").alias("at"))
    return met.join(spans.select("ik", "least_need"), "ik").filter(
        F.size(F.array_distinct(F.col("at.ipos"))) >= F.col("least_need")
    ).select("d", "h", "ik", "at")


def likely_diagonals(hits: DataFrame, spans: DataFrame) -> DataFrame:
    """(d, h, ik, item, iw, length, shift): diagonals on which all rarest terms of some window stand."""
    each = hits.select("d", "h", "ik", F.explode("at").alias("hit"))
    diagonals = each.groupBy("d", "h", "ik", F.col("hit.shift").alias("shift")).agg(F.collect_set("hit.ipos").alias("seen"))
    all_there = "exists(starts, x -> size(array_except(x.need, seen)) = 0)"
    return diagonals.join(spans, "ik").filter("size(seen) >= least_need").filter(all_there).select(
        "d", "h", "ik", "item", "iw", "length", "shift"
    )


def phrase_matches(docs: DataFrame, hits: DataFrame, spans: DataFrame, rare: int = RARE) -> DataFrame:
    """(d, h, item, start, length): exact places of windows in documents, from 0.

    An item that is all rarest terms is matched by its postings alone. The
    diagonals of all others are gathered, no more than the document has words
    for each item, and its words are cut once for all of them.
    """
    likely = likely_diagonals(hits, spans)
    short = likely.filter(F.size("iw") <= rare).select("d", "h", "item", F.col("shift").alias("start"), "length")
    gathered = likely.filter(F.size("iw") > rare).groupBy(F.col("d").alias("cd"), F.col("h").alias("ch")).agg(
        F.collect_list(F.struct("item", "iw", "length", "shift")).alias("diagonals")
    )
    texts = docs.dropDuplicates(["d", "h"]).join(gathered, same_document("d", "h", "cd", "ch")).select(
        "d", "h", words(F.col("t")).alias("w"), "diagonals"
    )
    # unequal places in the item, with its two ends; a gap of a window's length between two has windows
    unequal = (
        "filter(sequence(0, size(x.iw) - 1), j -> NOT (x.shift + j >= 0 AND x.shift + j < size(w) AND get(w, x.shift + j) <=> x.iw[j]))"
    )
    gaps = "transform(sequence(1, size(cut) - 1), i -> struct(x.item AS item, x.length AS length, x.shift + cut[i - 1] + 1 AS a, x.shift + cut[i] AS b))"
    runs = (
        f"flatten(transform(diagonals, x -> filter(flatten(transform(array(concat(array(-1), {unequal}, array(size(x.iw)))), cut -> {gaps})), "
        "r -> r.b - r.a >= r.length)))"
    )
    long = texts.select("d", "h", F.explode(F.expr(runs)).alias("run")).select(
        "d", "h", "run.item", F.explode(F.expr("sequence(run.a, run.b - run.length)")).alias("start"), "run.length"
    )
    return short.unionByName(long).distinct()


def proximity_matches(hits: DataFrame, spans: DataFrame, share: float = SHARE, slop: int = SLOP, least: int = LEAST) -> DataFrame:
    """(d, h, item): items of whose rarest places at least ``share``, and ``least``, stand near each other.

    Near means on diagonals that fall into one band of ``2 * slop``, in either
    of two bandings half a band apart, so that any two diagonals at most
    ``slop`` apart share a band.
    """
    wanted = spans.filter(F.col("wanted") >= least).select("ik", "item", "wanted")
    enough = hits.join(wanted, "ik").filter(
        (F.size(F.array_distinct(F.col("at.ipos"))) >= least) & (F.size(F.array_distinct(F.col("at.ipos"))) >= share * F.col("wanted"))
    )
    each = enough.select("d", "h", "ik", "item", "wanted", F.explode("at").alias("hit"))
    bands = F.array(*(F.struct(F.lit(b).alias("o"), F.floor((F.col("hit.shift") + b * slop) / (2 * slop)).alias("n")) for b in (0, 1)))
    close = each.withColumn("band", F.explode(bands)).groupBy("d", "h", "ik", "item", "wanted", "band").agg(
        F.countDistinct("hit.ipos").alias("seen")
    )
    return close.filter((F.col("seen") >= least) & (F.col("seen") >= share * F.col("wanted"))).select("d", "h", "item").distinct()


def summary(matches: DataFrame) -> DataFrame:
    """Per document: words in any match, and the items matched, sorted as strings."""
    ends = matches.groupBy("d", "h", "start").agg(F.max("length").alias("length"))
    in_order = "PARTITION BY d, h ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    gained = ends.withColumn(
        "gain", F.expr(f"greatest(0, start + length - greatest(start, coalesce(max(start + length) OVER ({in_order}), start)))")
    )
    hit = gained.groupBy("d", "h").agg(F.sum("gain").cast("bigint").alias("n_hit"))
    names = matches.groupBy("d", "h").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return hit.join(
        names.withColumnsRenamed({"d": "nd", "h": "nh"}), same_document("d", "h", "nd", "nh")
    ).select("d", "h", "n_hit", "items")


def contamination(
    documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """``documents`` with ``n_words``, ``n_hit``, ``items``, ``near_items`` and ``contaminated``.

    ``items`` are those with a window of ``window`` consecutive words (or all
    words of a shorter item) in the document, ``n_hit`` the document words
    inside such windows, ``near_items`` the items whose rarest words stand close
    together. Null and empty texts have no words and no matches; documents of
    equal key and text are judged alike, each its own row; an item without
    words matches nothing. Columns of the new names are replaced.
    """
    docs = keyed(documents, key, text)
    items = stored(item_words(benchmark, item_key, item_text), "items")
    index = stored(postings(docs, items), "postings")
    spans = stored(windows(items, index, window), "item-windows")
    hits = stored(rare_hits(index, spans), "rare-postings")
    exact = summary(stored(phrase_matches(docs, hits, spans), "phrase-matches"))
    close = proximity_matches(hits, spans).groupBy(F.col("d").alias("xd"), F.col("h").alias("xh")).agg(
        F.array_sort(F.collect_set("item")).alias("near_items")
    )
    found = exact.join(close, same_document("d", "h", "xd", "xh"), "full").select(
        F.coalesce("d", "xd").alias("fd"), F.coalesce("h", "xh").alias("fh"), "n_hit", "items", "near_items"
    )
    new = ("n_words", "n_hit", "items", "near_items", "contaminated")
    own = documents.select(
        F.struct(*documents.columns).alias("row"), F.col(key).alias("d"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"), F.size(words(F.col(text))).cast("bigint").alias("n_words"),
    )
    none = F.array().cast("array<string>")
    return own.join(found, same_document("d", "h", "fd", "fh"), "left").select(
        *(F.col("row").getField(c).alias(c) for c in documents.columns if c not in new),
        "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", none).alias("items"), F.coalesce("near_items", none).alias("near_items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
