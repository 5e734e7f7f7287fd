"""Word-substring dedup by fixed-block anchors.

A repeat of 50 words holds, in the earlier document, a whole block of 25 words
that starts at a multiple of 25. So the blocks of all documents are indexed by
hash, with the smallest document of each, and every rolling 25-word window of
every document probes that index. Around the hits, on both sides, all 50-word
windows are taken up, and each is compared with the smallest document that has
it too; the windows found overlap into maximal repeats.

Index and probes meet in shards: rows of packed arrays, dealt by hash. A shard
keeps one entry per distinct hash and streams the probes past it, so neither a
long list of equal windows nor a long document is ever held whole. A probe
costs eight bytes and a fraction; the texts themselves are shuffled only to
take up the windows, and to remove them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from farebox.llm.batches import Words, chunks, covered, per_text, utf8
from farebox.llm.frames import mapped, parts_for, stored, with_columns

NONE = -(1 << 63)  # stands for a null document id: neither earlier nor later than any other
SHARD_SCHEMA = "shard int, kind int, keys binary, d binary, h binary, n binary, pos binary"
FOUND_SCHEMA = "key bigint, d bigint, h bigint, pos array<int>"
SHARD_ARROW = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), *((c, pa.binary()) for c in ("keys", "d", "h", "n", "pos"))])
FOUND_ARROW = pa.schema([("key", pa.int64()), ("d", pa.int64()), ("h", pa.int64()), ("pos", pa.list_(pa.int32()))])


def keyed(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key, hash of the text and the text itself: rows of equal key and text are one document."""
    return df.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(NONE)).alias("d"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"),
        F.col(text).alias("t"),
    )


def packed(kind: int, keys: np.ndarray, doc: np.ndarray, pos: np.ndarray, d: np.ndarray, h: np.ndarray, n: int) -> Iterator[tuple]:
    """Rows of one chunk, one per shard; ``doc`` points into ``d`` and ``h``."""
    shard = ((keys >> np.uint64(40)) % np.uint64(n)).astype(np.int32)
    order = np.argsort(shard, kind="stable")
    cut = np.searchsorted(shard[order], np.arange(n + 1))
    for s in range(n):
        at = order[cut[s] : cut[s + 1]]
        if not len(at):
            continue
        own = doc[at]
        head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        count = np.diff(np.concatenate([head, [len(own)]])).astype(np.uint32)
        yield (
            s, kind, keys[at].tobytes(), d[own[head]].tobytes(), h[own[head]].tobytes() if kind else None,
            count.tobytes(), pos[at].astype(np.uint32).tobytes() if kind else None,
        )


def batches_of(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(rows), 512):
        part = [*zip(*rows[start : start + 512], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(part, schema, strict=True)], schema=schema)


def items(df: DataFrame, emit: Callable, shards: int) -> DataFrame:
    """Packed rows for the shards; ``emit`` gives (kind, keys, doc, pos) arrays for a chunk of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, h = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts, extra = utf8(batch.column(2)), batch.columns[3:]
            for lo, hi in chunks(texts):
                w = Words(texts[lo:hi])
                own = [c.slice(lo, hi - lo) for c in extra]
                for kind, keys, doc, pos in emit(w, *own):
                    real = d[lo:hi][doc] != NONE
                    yield from batches_of(
                        [*packed(kind, keys[real], doc[real], pos[real], d[lo:hi], h[lo:hi], shards)], SHARD_ARROW
                    )

    return mapped(df, run, SHARD_SCHEMA)


def smallest(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, each with its smallest value."""
    order = np.lexsort((values, keys))
    k, v = keys[order], values[order]
    head = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
    return k[head], v[head]


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, each with the sum of its values."""
    order = np.argsort(keys)
    k, v = keys[order], values[order]
    head = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[head], np.add.reduceat(v, head) if len(head) else v


class _Index:
    """Distinct keys of a shard with one value each; what comes in is merged now and then."""

    def __init__(self, merge: Callable) -> None:
        self.merge = merge
        self.keys, self.docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        self.waiting = 0

    def add(self, keys: np.ndarray, docs: np.ndarray) -> None:
        self.keys.append(keys)
        self.docs.append(docs)
        self.waiting += len(keys)
        if self.waiting > max(1 << 18, len(self.keys[0])):
            self.close()

    def close(self) -> tuple[np.ndarray, np.ndarray]:
        k, d = self.merge(np.concatenate(self.keys), np.concatenate(self.docs))
        self.keys, self.docs, self.waiting = [k], [d], 0
        return k, d


def earlier(value: np.ndarray, d: np.ndarray) -> np.ndarray:
    return value < d


def probed(rows: DataFrame, shards: int, active: bool, merge: Callable = smallest, hits: Callable = earlier, hot: Callable | None = None) -> DataFrame:
    """Places whose key passes ``hits`` (index value, document); with ``active``, each such key too.

    By default: places whose key also stands in an earlier document. ``hot``
    tells which of the places are marked, by a key of 1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, known, docs, used = _Index(merge), None, None, None
        for batch in batches:
            out = []
            for kind, keys, d, h, n, pos in zip(*(batch.column(i).to_pylist() for i in range(1, 7)), strict=True):
                keys, d, n = np.frombuffer(keys, np.uint64), np.frombuffer(d, np.int64), np.frombuffer(n, np.uint32)
                if kind == 0:
                    index.add(keys, np.repeat(d, n))
                    continue
                if known is None:
                    known, docs = index.close()
                    used = np.zeros(len(known), bool)
                if not len(known):
                    continue
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                owner = np.repeat(np.arange(len(d)), n)
                hit = np.flatnonzero((known[at] == keys) & hits(docs[at], d[owner]))
                if not len(hit):
                    continue
                used[at[hit]] = True
                h, pos = np.frombuffer(h, np.int64), np.frombuffer(pos, np.uint32).astype(np.int32)
                marked = hot(docs[at[hit]], d[owner[hit]]) if hot else np.zeros(len(hit), bool)
                for mark, part in ((None, hit[~marked]), (1, hit[marked])):
                    own = owner[part]
                    cut = np.flatnonzero(np.diff(own)) + 1
                    heads = own[np.concatenate([[0], cut])] if len(own) else own
                    for o, p in zip(heads, np.split(pos[part], cut), strict=False):
                        out.append((mark, int(d[o]), int(h[o]), p))
            yield from batches_of(out, FOUND_ARROW)
        if active and used is not None:
            keys = known[used].view(np.int64)
            for start in range(0, len(keys), 10_000):
                part = keys[start : start + 10_000]
                nothing = pa.nulls(len(part), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), nothing, nothing, pa.nulls(len(part), pa.list_(pa.int32()))], schema=FOUND_ARROW
                )

    dealt = rows.repartitionById(shards, "shard").sortWithinPartitions("kind")
    return mapped(dealt, run, FOUND_SCHEMA)


def places(found: DataFrame) -> DataFrame:
    """All places of each document; no more than it has words."""
    return found.groupBy("d", "h").agg(F.flatten(F.collect_list("pos")).alias("pos"))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, and the row of each."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), sizes)


def _block_rows(docs: DataFrame, block: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, h = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = utf8(batch.column(2))
            for lo, hi in chunks(texts):
                w = Words(texts[lo:hi])
                at, keys = w.windows(block)
                pos = at - w.first[w.doc[at]]
                good = (pos % block == 0) & (d[lo:hi][w.doc[at]] != NONE)
                doc = w.doc[at[good]] + lo
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[good].view(np.int64)), pa.array(d[doc]), pa.array(h[doc]), pa.array(pos[good].astype(np.int32))],
                    names=["key", "d", "h", "pos"],
                )

    return mapped(docs, run, "key bigint, d bigint, h bigint, pos int")


def _index_rows(blocks: DataFrame, shards: int) -> DataFrame:
    """The block index as shard rows, one document per key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            d = batch.column(1).to_numpy(zero_copy_only=False)
            yield from batches_of([*packed(0, keys, np.arange(len(d)), d, d, d, shards)], SHARD_ARROW)

    return mapped(blocks.groupBy("key").agg(F.min("d").alias("d")), run, SHARD_SCHEMA)


def repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """(d, h, pos): first words of the windows that an earlier document has too."""
    block = window // 2
    docs = keyed(df, key, text)
    shards = parts_for(docs, "t")
    blocks = stored(_block_rows(docs, block), "blocks")

    def rolling(w: Words) -> Iterator[tuple]:
        at, keys = w.windows(block)
        doc = w.doc[at]
        yield 1, keys, doc, at - w.first[doc]

    probes = items(docs, rolling, shards).unionByName(_index_rows(blocks, shards))
    hits = stored(probed(probes, shards, active=True), "block-hits")
    # the earlier side: blocks that some later document has
    hit_blocks = blocks.join(hits.filter("key IS NOT NULL").select("key"), "key").select("d", "h", F.array("pos").alias("pos"))
    around = places(hits.filter("key IS NULL").select("d", "h", "pos").unionByName(hit_blocks))
    taken = docs.join(around.withColumnsRenamed({"d": "pd", "h": "ph"}), (F.col("d") == F.col("pd")) & (F.col("h") == F.col("ph"))).select("d", "h", "t", "pos")

    def near(w: Words, pos: pa.Array) -> Iterator[tuple]:
        at, keys = w.windows(window)
        place, row = flat(pos)
        # a window holds the block at x if it starts at x - (window - block) to x
        first = np.maximum(w.first[row] + place - (window - block), w.first[row])
        step = np.zeros(len(w.start) + 2, np.int32)
        np.add.at(step, first, 1)
        np.add.at(step, w.first[row] + place + 1, -1)
        keep = np.cumsum(step)[at] > 0
        at, keys = at[keep], keys[keep]
        doc = w.doc[at]
        yield 0, keys, doc, at
        yield 1, keys, doc, at - w.first[doc]

    return stored(probed(items(taken, near, shards), shards, active=False), "repeats").drop("key")


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """``df`` with ``kept_text``, ``n_words`` and ``n_removed``.

    Words are cut at ASCII white space. Every word covered by a window of
    ``window`` words that also starts in a document with a smaller key goes;
    the kept words are joined by one space. Windows are judged on the input.
    Null and empty texts have no words; rows with a null key are kept whole and
    remove nothing; rows that repeat a key and text are one document and lose
    the same words. Columns of the new names are replaced.
    """
    found = places(repeats(df, key, text, window)).withColumnsRenamed({"d": "pd", "h": "ph", "pos": "pp"})
    row = F.struct(*df.columns).alias("row")
    docs = df.select(row, F.coalesce(F.col(key).cast("bigint"), F.lit(NONE)).alias("d"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"))
    joined = docs.join(found, (F.col("d") == F.col("pd")) & (F.col("h") == F.col("ph")), "left")
    both = joined.select("row", F.struct(F.col("row").getField(text).alias("t"), F.col("pp").alias("p")).alias("tp"))

    def start():
        def run(column: pa.Array) -> list[pa.Array]:
            texts, pos = utf8(column.field(0)), column.field(1)
            out: list[tuple[str, int, int]] = []
            for lo, hi in chunks(texts):
                w = Words(texts[lo:hi], hashes=False)
                place, owner = flat(pos.slice(lo, hi - lo))
                gone = covered(w.first[owner] + place, window, len(w.start))
                removed, total = per_text(gone, w.first), np.diff(w.first)
                raw = w.buf.tobytes()
                for i in range(hi - lo):
                    if removed[i]:
                        a, b = w.first[i], w.first[i + 1]
                        keep = np.flatnonzero(~gone[a:b]) + a
                        words = [raw[s:e] for s, e in zip(w.start[keep].tolist(), w.end[keep].tolist(), strict=True)]
                    else:
                        words = texts[lo + i].split()
                    out.append((b" ".join(words).decode(), int(total[i]), int(removed[i])))
            kept, total, removed = zip(*out, strict=True) if out else ((), (), ())
            return [pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())]

        return run

    new = {"kept_text": "string", "n_words": "bigint", "n_removed": "bigint"}
    done = with_columns(both, "tp", new, start)
    return done.select(*(F.col("row").getField(c).alias(c) for c in df.columns if c not in new), *new)


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
