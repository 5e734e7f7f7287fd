"""Near duplicates on five-word shingles by the chosen-path join.

A set's tokens are its min-hashes, so two sets share each of them with a
probability of their Jaccard similarity. Every run splits the sets along a tree:
a node samples about 1 / similarity of the tokens by a hash of its own path,
and a set goes to the child of each sampled token. Nodes are split until they
are small, and then compared exactly by brute force; runs are repeated until a
pair at the threshold is met with the target probability.

Sets that are equal are one row from the start, with their number. A bucket
that stays large at the last level is compared block against block, so no task
holds more than two blocks, and a block gives back a count and a component per
set rather than its pairs. A pair that meets in several buckets counts in the
one with the smallest key only, which each side knows from its own list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from farebox.llm.batches import Words, chunks, mixed, utf8, window_hash
from farebox.llm.frames import mapped, parts_for, stored
from farebox.llm.substrings import NONE, keyed

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.9999
TOKENS = 32
LIMIT, BLOCK, LAST_LEVEL = 2000, 512, 6
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = mixed(np.arange(1, TOKENS + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


def shingles(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, text by text, and where each text's begin (and the end).

    A text of fewer than ``k`` words has one shingle of all of them.
    """
    w = Words(texts)
    at, h = w.windows(k)
    doc = w.doc[at]
    for i in np.flatnonzero((np.diff(w.first) > 0) & (np.diff(w.first) < k)):
        own = w.hash[w.first[i] : w.first[i + 1]]
        doc, h = np.append(doc, i), np.append(h, window_hash(own, len(own)))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, bool)
    doc, h = doc[new], h[new]
    return h, np.searchsorted(doc, np.arange(len(texts) + 1))


def min_hashes(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """``TOKENS`` min-hashes of each set that has a shingle."""
    heads = begin[:-1][np.diff(begin) > 0]
    return np.stack([np.minimum.reduceat(h * f, heads) for f in _FACTORS], 1) if len(heads) else np.zeros((0, TOKENS), np.uint64)


def children(keys: np.ndarray, tokens: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The child nodes of each row's node: (row, key).

    A token is sampled with probability 1 / (similarity * TOKENS) by the node's
    key, the same for all sets at that node; at least one is.
    """
    draw = mixed(keys[:, None] + (np.arange(1, TOKENS + 1, dtype=np.uint64) * _STEP)[None, :])
    chosen = draw < np.uint64(min(2**64 - 1, int(2**64 / (similarity * TOKENS))))
    chosen[np.arange(len(keys)), draw.argmin(1)] = True
    row, token = np.nonzero(chosen)
    return row, mixed(draw[row, token] ^ tokens[row, token])


def found_in_a_run(similarity: float, levels: int) -> float:
    """Probability that a pair of this similarity shares a node after ``levels`` splits."""
    p = 1 / (similarity * TOKENS)
    weights = [math.comb(TOKENS, n) * p**n * (1 - p) ** (TOKENS - n) for n in range(TOKENS + 1)]
    weights[1] += weights[0]
    lost = 0.0
    for _ in range(levels):
        stays = similarity * (1 - lost)
        lost = sum(w * (1 - stays) ** n for n, w in enumerate(weights) if n)
    return 1 - lost


def runs_for(recall: float, similarity: float, levels: int = 2) -> int:
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - found_in_a_run(similarity, levels))))


def missed(similarity: float, levels: int, runs: int) -> float:
    """Probability that no run finds a pair of this similarity, as all runs share the min-hashes.

    Given the number of them that agree, runs are independent: their nodes have
    keys of their own.
    """
    p = 1 / (similarity * TOKENS)
    none = (1 - p) ** TOKENS
    total = 0.0
    for agree in range(TOKENS + 1):
        lost = 0.0
        for _ in range(levels):
            lost = (1 - p * (1 - lost)) ** agree - none + none * (1 - agree / TOKENS * (1 - lost))
        total += math.comb(TOKENS, agree) * similarity**agree * (1 - similarity) ** (TOKENS - agree) * lost**runs
    return total


def runs_to(recall: float, similarity: float, levels: int) -> int:
    """Runs that meet a pair with probability ``recall`` even where nodes are split ``levels`` times."""
    runs = runs_for(recall, similarity, levels)
    while missed(similarity, levels, runs) > 1 - recall:
        runs += 1
    return runs


SKETCH_SCHEMA = "d bigint, h bigint, size int, set_a bigint, set_b bigint, tokens binary, keys array<bigint>"


def sketches(docs: DataFrame, similarity: float, recall: float, k: int, last_level: int = LAST_LEVEL) -> DataFrame:
    """Per document: the digest of its shingle set, its tokens, and its nodes after two splits of each run."""
    runs = runs_to(recall, similarity, last_level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = mixed(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        for batch in batches:
            d, h = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = utf8(batch.column(2))
            for lo, hi in chunks(texts):
                s, begin = shingles(texts[lo:hi], k)
                size = np.diff(begin)
                has = np.flatnonzero(size)
                tokens = min_hashes(s, begin)
                heads = begin[:-1][has]
                set_a = np.add.reduceat(s, heads) if len(has) else s
                set_b = np.add.reduceat(mixed(s), heads) if len(has) else s
                rows, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
                for root in roots:
                    row, key = children(np.full(len(has), root), tokens, similarity)
                    again, key = children(key, tokens[row], similarity)
                    rows.append(row[again])
                    keys.append(key)
                row, key = np.concatenate(rows), np.concatenate(keys)
                order = np.lexsort((key, row))
                row, key = row[order], key[order]
                offsets = np.searchsorted(row, np.arange(len(has) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(d[lo:hi][has]), pa.array(h[lo:hi][has]), pa.array(size[has].astype(np.int32)),
                        pa.array(set_a.view(np.int64)), pa.array(set_b.view(np.int64)),
                        pa.array([t.tobytes() for t in tokens], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(key.view(np.int64))),
                    ],
                    names=["d", "h", "size", "set_a", "set_b", "tokens", "keys"],
                )

    return mapped(docs, run, SKETCH_SCHEMA)


def _deeper(rows: DataFrame, similarity: float) -> DataFrame:
    """The children of oversized nodes: (id, key, tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            tokens = np.stack([np.frombuffer(t, np.uint64) for t in batch.column(2).to_pylist()])
            row, key = children(keys, tokens, similarity)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(key.view(np.int64)), batch.column(2).take(at)], names=["id", "key", "tokens"])

    return mapped(rows.select("id", "key", "tokens"), run, rows.select("id", "key", "tokens").schema)


def buckets(classes: DataFrame, similarity: float, limit: int = LIMIT, last_level: int = LAST_LEVEL) -> DataFrame:
    """(id, key, n): the buckets of at least two sets; of buckets with equal members one is left.

    Most buckets hold two sets, and their smallest and largest id are all there is to know: only
    larger ones meet their rows again.
    """
    rows = classes.select("id", F.explode(F.array_distinct("keys")).alias("key"))
    out, level = None, 2
    while True:
        sizes = stored(
            rows.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).filter("n > 1"), "node-sizes"
        )
        two = sizes.filter("n = 2").groupBy("a", "b").agg(F.min("key").alias("key"))
        pairs = stored(two.select(F.explode(F.array("a", "b")).alias("id"), "key", F.lit(2).cast("bigint").alias("n")), "buckets")
        out = pairs if out is None else out.unionByName(pairs)
        final = F.lit(True) if level == last_level else F.col("n") <= limit
        more = sizes.filter("n > 2").select("key", "n", final.alias("final"))
        # one meeting with all rows, for the buckets that are ready and for those to split
        met = stored(rows.join(more, "key").select("id", "key", "n", "final"), "members")
        members = met.filter("final").drop("final")
        ready = members.groupBy("key", "n").agg(
            F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")
        ).groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key")
        out = out.unionByName(stored(members.join(ready, "key", "left_semi").select("id", "key", "n"), "buckets"))
        split = met.filter("NOT final").select("id", "key")
        if level == last_level or split.isEmpty():
            return out
        rows = stored(_deeper(split.join(classes.select("id", "tokens"), "id"), similarity).drop("tokens").distinct(), "split-nodes")
        level += 1


LINK_SCHEMA = "d bigint, h bigint, links bigint, to_d bigint, to_h bigint"


def _bucket_rows(taken: DataFrame, block: int) -> DataFrame:
    """(key, i, j, block, d, h, w, keys, t): a row per set and pair of blocks; a bucket of one block has one pair.

    The text goes to its buckets rather than its shingles, which are longer and do not compress.
    """

    def places(x: Column) -> Column:
        blocks = F.ceil(x["n"] / block)
        mine = F.pmod(F.col("h"), blocks)
        return F.transform(
            F.sequence(F.lit(0).cast("bigint"), blocks - 1),
            lambda other: F.struct(
                x["key"].alias("key"), F.least(mine, other).alias("i"), F.greatest(mine, other).alias("j"), mine.alias("block")
            ),
        )

    keys = F.array_sort(F.col("lists.key")).alias("keys")
    rows = taken.select("d", "h", "w", keys, F.col("t").cast("binary").alias("t"), F.explode(F.flatten(F.transform("lists", places))).alias("x"))
    return rows.select("x.*", "d", "h", "w", "keys", "t")


def _common(parts: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Number of common values of each two sets, some thousand values at a time."""
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    _, code, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    shared = counts > 1
    column = np.cumsum(shared) - 1
    good = shared[code]
    owner, column = owner[good], column[code[good]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(parts), len(parts)), np.float32)
    for start in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, [start, start + width])
        has = np.zeros((len(parts), width), np.float32)
        has[owner[lo:hi], column[lo:hi] - start] = 1
        out += has @ has.T
    return out


def links_within(
    key: int, i: int, j: int, block: np.ndarray, weight: np.ndarray,
    keys: list[np.ndarray], sets: list[np.ndarray], similarity: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Weighted links of each set of a bucket, and the first set of its component.

    Of two blocks only pairs across count. Pairs that share a smaller bucket
    key count there.
    """
    size = np.array([len(s) for s in sets], np.float32)
    common = _common(sets)
    linked = common >= similarity * (size[:, None] + size[None, :] - common) - 1e-3
    np.fill_diagonal(linked, False)
    if i != j:
        linked &= block[:, None] != block[None, :]
    earlier = [x[x < key] for x in keys]
    counted = linked & (_common(earlier) == 0) if any(len(x) for x in earlier) else linked
    first = np.arange(len(sets))
    while True:
        best = np.where(linked, first[None, :], len(sets)).min(1)
        new = np.minimum(first, best)
        new = new[new]
        if (new == first).all():
            return counted @ weight, first
        first = new


def _links(rows: DataFrame, similarity: float, k: int, n: int) -> DataFrame:
    """Links within each pair of blocks, one at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def resolve() -> pa.RecordBatch:
            key, i, j = held[0][:3]
            block, d, h, w = (np.array([r[c] for r in held], np.int64) for c in (3, 4, 5, 6))
            keys, texts, sets = [np.array(r[7], np.int64) for r in held], [r[8] for r in held], []
            for lo, hi in chunks(texts):
                s, begin = shingles(texts[lo:hi], k)
                sets += np.split(s, begin[1:-1])
            links, first = links_within(key, i, j, block, w.astype(np.float64), keys, sets, similarity)
            out = np.flatnonzero((links > 0) | (first != np.arange(len(first))))
            columns = [d[out], h[out], links[out].astype(np.int64), d[first[out]], h[first[out]]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["d", "h", "links", "to_d", "to_h"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:3] != held[0][:3]:
                    yield resolve()
                    held = []
                held.append(row)
        if held:
            yield resolve()

    return mapped(rows.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j"), run, LINK_SCHEMA)


def components(edges: DataFrame) -> DataFrame:
    """(v, root): the smallest vertex of each vertex's component.

    Every vertex takes the smallest label around it, then its label's label,
    until none changes; labels are written once per round.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "v"), "labels")
    while True:
        around = both.join(labels.select(F.col("v").alias("b"), "root"), "b").groupBy(F.col("a").alias("v")).agg(F.min("root").alias("near"))
        lower = labels.join(around, "v").select("v", F.least("root", "near").alias("mid"), F.col("root").alias("old"))
        jump = labels.select(F.col("v").alias("mid"), F.col("root").alias("top"))
        new = stored(lower.join(jump, "mid").select("v", F.least("mid", "top").alias("root"), "old"), "labels")
        labels = new.select("v", "root")
        if new.filter("NOT root <=> old").isEmpty():
            return labels


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY,
    recall: float = RECALL, k: int = SHINGLE, limit: int = LIMIT, block: int = BLOCK, last_level: int = LAST_LEVEL,
) -> DataFrame:
    """(d, h, root, class_id, n_links, n_copies): a row per row of ``df``.

    ``n_links`` counts the other documents with a Jaccard similarity of
    ``similarity`` or more, copies included; ``class_id`` is the smallest key of
    all documents joined by links. ``root`` tells classes apart: the smallest
    (key, hash of the text), as keys may be null or repeated. Shingles are ``k`` words cut at ASCII white
    space. Null and empty texts have no shingle, hence no links, and are their
    own class; a null key stands before all others. The last level's buckets
    are compared whatever their size.
    """
    docs = keyed(df, key, text)
    rows = stored(sketches(docs, similarity, recall, k, last_level), "sketches")
    same = ("size", "set_a", "set_b")
    classes = stored(
        rows.groupBy(*same).agg(
            F.min(F.struct("d", "h")).alias("rep"), F.count("*").alias("w"),
            F.first("tokens").alias("tokens"), F.first("keys").alias("keys"),
        ).withColumn("id", F.monotonically_increasing_id()), "classes",  # written with the rows, so an id is the same in every read
    )
    lists = buckets(classes, similarity, limit, last_level).groupBy("id").agg(F.collect_list(F.struct("key", "n")).alias("lists"))
    weighted = lists.join(classes.select("id", "rep", "w"), "id").select(F.col("rep.d").alias("pd"), F.col("rep.h").alias("ph"), "w", "lists")
    # a document given twice is one set
    texts = docs.join(weighted, (F.col("d") == F.col("pd")) & (F.col("h") == F.col("ph"))).select("d", "h", "t", "w", "lists")
    links = stored(_links(_bucket_rows(texts, block), similarity, k, parts_for(docs, "t")), "links")
    counts = links.groupBy("d", "h").agg(F.sum("links").alias("links"))
    roots = components(
        links.select(F.struct("d", "h").alias("a"), F.struct(F.col("to_d").alias("d"), F.col("to_h").alias("h")).alias("b")).filter("a <> b")
    )
    judged = classes.select(*same, "rep", "w").join(
        counts.select(F.struct("d", "h").alias("rep"), "links"), "rep", "left"
    ).join(roots.withColumnRenamed("v", "rep"), "rep", "left").select(
        *(F.col(c).alias(f"c_{c}") for c in same), "w",
        F.coalesce("root", "rep").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("w") - 1).alias("n_links"),
    )
    matched = rows.select("d", "h", *same).join(judged, [F.col(c) == F.col(f"c_{c}") for c in same])
    return matched.select("d", "h", "root", F.col("root.d").alias("class_id"), F.col("n_links").cast("bigint"), F.col("w").cast("bigint").alias("n_copies"))


def classes_of(df: DataFrame, key: str = "doc_id", text: str = "text", **options: float) -> DataFrame:
    """(key, class_id, n_links, n_copies) for every row of ``df``; see :func:`near_duplicates`."""
    # every (d, h) once; a document given n times is judged once and joined n times
    found = near_duplicates(df, key, text, **options).groupBy(F.col("d").alias("pd"), F.col("h").alias("ph")).agg(
        F.min("class_id").alias("class_id"), F.max("n_links").alias("n_links"), F.max("n_copies").alias("n_copies")
    )
    docs = keyed(df, key, text).select("d", "h")
    joined = docs.join(found, (F.col("d") == F.col("pd")) & (F.col("h") == F.col("ph")), "left")

    def real(c: str) -> F.Column:
        return F.when(F.col(c) != NONE, F.col(c))

    return joined.select(
        real("d").alias(key), F.when(F.col("class_id").isNull(), real("d")).otherwise(real("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("n_copies", F.lit(1)).cast("bigint").alias("n_copies"),
    )


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", **options: float) -> DataFrame:
    """``df`` with one row of each class: that with the smallest key (of equal keys, the smallest text hash).

    Of rows that repeat a key and a text, with a word or more, the first by
    their columns as JSON stays. Rows without words are no copies of each other and all stay.
    """
    found = stored(near_duplicates(df, key, text, **options), "near-duplicates")
    first = found.groupBy("root").agg(F.min(F.struct("d", "h")).alias("first"))
    # a row for each document that goes or is there several times: no other needs a second look
    marked = stored(
        found.join(first, "root").groupBy(F.col("d").alias("pd"), F.col("h").alias("ph")).agg(
            F.bool_and(F.struct("d", "h") != F.col("first")).alias("gone"), F.count("*").alias("c")
        ).filter("gone OR c > 1"), "marked",
    )
    docs = df.select(
        F.struct(*df.columns).alias("row"), F.coalesce(F.col(key).cast("bigint"), F.lit(NONE)).alias("d"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"),
    )
    same = (F.col("d") == F.col("pd")) & (F.col("h") == F.col("ph"))
    plain = docs.join(marked, same, "left_anti")
    repeated = docs.join(marked.filter("NOT gone"), same, "left_semi")
    one = Window.partitionBy("d", "h").orderBy(F.to_json("row"))
    chosen = repeated.withColumn("n", F.row_number().over(one)).filter("n = 1").drop("n")
    return plain.unionByName(chosen).select("row.*")
