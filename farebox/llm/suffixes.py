"""Byte-substring dedup on suffixes sorted bucket by bucket.

Which 200-byte strings occur twice follows from sorted suffixes, compared up to
200 bytes. The cover is a sample of suffixes such that any two equal strings
hold sample suffixes at the same distance from their starts: of each 101
neighbouring 100-byte grams the one with the smallest hash. A difference cover
picks such places by arithmetic and needs a distance per pair of residues; one
picked by content gives equal strings the same distance at once, so the sample
can be dealt to buckets by gram. Grams that stand only once in the corpus
cannot be in a repeat, and their buckets are never built.

A bucket holds the sample suffixes of its grams with the bytes before them. It
is sorted once to the right and once, reversed, to the left; common prefixes of
neighbours give ranks at any depth. A string that starts ``o`` bytes before its
sample suffix is then told from all others by two ranks: that of the sample at
depth 200 - o and that of the ``o`` bytes before it. No string is compared byte
by byte beyond its sample, and memory holds one bucket at a time.

A gram that stands more often than ``HOT`` times is not gathered in a bucket:
its strings are counted by hash, pre-aggregated, and joined back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from farebox.llm.batches import byte_prefix, chunks, covered, range_hash, utf8
from farebox.llm.frames import mapped, parts_for, stored, with_columns
from farebox.llm.substrings import (
    FOUND_ARROW, FOUND_SCHEMA, NONE, SHARD_ARROW, SHARD_SCHEMA,
    batches_of, flat, keyed, packed, probed, summed,
)

HOT = 20_000
PIECE = 512 << 10
BATCH = 8192
_LOW = np.uint64(0xFFFFFFFF)
SUFFIX_SCHEMA = "key bigint, d bigint, h bigint, start int, lead int, n int, bytes binary"


class Cover:
    """The sample suffixes of some texts.

    ``at`` has their places in ``buf``, ``key`` the hash of their grams, ``low``
    and ``high`` the first and last start of the strings they serve, ``doc`` the
    index of their text.
    """

    def __init__(self, texts: list[bytes], length: int):
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.offset = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        self.prefix = byte_prefix(self.buf)
        gram, span = length // 2, length - length // 2 + 1
        n = len(self.buf) - gram + 1
        starts = np.zeros(0, np.int64)
        if n >= span:
            place = np.arange(n)
            low = range_hash(self.prefix, place, place + gram)
            low = (low & ~_LOW) | place.astype(np.uint64)
            width = 1
            while 2 * width <= span:
                low = np.minimum(low[: len(low) - width], low[width:])
                width *= 2
            low = np.minimum(low[: len(low) - (span - width)], low[span - width :]) if span > width else low
            room = np.zeros(len(self.buf) + 1, np.int8)
            for a, b in zip(self.offset[:-1], self.offset[1:] - 1, strict=True):
                if b - a >= length:
                    room[a] += 1
                    room[b - length + 1] -= 1
            starts = np.flatnonzero(np.cumsum(room[: len(low)]) > 0)
        owner = (low[starts] & _LOW).astype(np.int64) if len(starts) else starts
        head = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)])) if len(starts) else starts
        self.at = owner[head]
        self.low = starts[head]
        self.high = starts[np.concatenate([head[1:] - 1, [len(starts) - 1]])] if len(starts) else starts
        self.key = range_hash(self.prefix, self.at, self.at + gram)
        self.doc = np.searchsorted(self.offset, self.at, side="right") - 1
        self.pos = self.at - self.offset[self.doc]


def _sample_rows(docs: DataFrame, length: int, shards: int) -> DataFrame:
    """Shard rows: the count of each gram in a piece of text (0), and its places (1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, h = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = utf8(batch.column(2))
            for lo, hi in chunks(texts, PIECE):
                c = Cover(texts[lo:hi], length)
                keys, counts = np.unique(c.key, return_counts=True)
                none = np.zeros(len(keys), np.int64)
                out = [*packed(0, keys, np.arange(len(keys)), none, counts, none, shards)]
                out += packed(1, c.key, c.doc, c.pos, d[lo:hi], h[lo:hi], shards)
                yield from batches_of(out, SHARD_ARROW)

    return mapped(docs, run, SHARD_SCHEMA)


def _suffix_rows(taken: DataFrame, length: int) -> DataFrame:
    """The sample suffixes at ``pos`` with the bytes of the strings they serve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, h = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = utf8(batch.column(2))
            for lo, hi in chunks(texts, PIECE):
                c = Cover(texts[lo:hi], length)
                place, row = flat(batch.column(3).slice(lo, hi - lo))
                served = np.flatnonzero(np.isin(c.at, c.offset[row] + place))
                raw = c.buf.tobytes()
                ends = c.high[served] + length
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c.key[served].view(np.int64)), pa.array(d[lo:hi][c.doc[served]]),
                        pa.array(h[lo:hi][c.doc[served]]),
                        pa.array((c.low - c.offset[c.doc])[served].astype(np.int32)),
                        pa.array((c.at - c.low)[served].astype(np.int32)),
                        pa.array((c.high - c.low + 1)[served].astype(np.int32)),
                        pa.array([raw[a:b] for a, b in zip(c.low[served].tolist(), ends.tolist(), strict=True)], pa.binary()),
                    ],
                    names=["key", "d", "h", "start", "lead", "n", "bytes"],
                )

    return mapped(taken, run, SUFFIX_SCHEMA)


def _sorted_ranks(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank of each row of bytes, and the common prefix of each with the one before it in order."""
    width = rows.shape[1]
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{width}").ravel(), kind="stable")
    differs = rows[order[1:]] != rows[order[:-1]]
    common = np.where(differs.any(1), differs.argmax(1), width) if len(rows) > 1 else np.zeros(0, np.int64)
    rank = np.empty(len(rows), np.int64)
    rank[order] = np.arange(len(rows))
    return rank, np.concatenate([[-1], common])


def repeated_starts(lead: np.ndarray, n: np.ndarray, data: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a bucket's strings, those that occur again in it: (suffix, start in its bytes).

    ``lead`` is the number of bytes before the sample, ``n`` the number of
    strings, which start at the first ``n`` bytes.
    """
    gram = length // 2
    before = length - gram
    right = np.zeros((len(data), length), np.uint8)
    left = np.zeros((len(data), max(before, 1)), np.uint8)
    for i, (x, o) in enumerate(zip(data, lead.tolist(), strict=True)):
        own = np.frombuffer(x, np.uint8)
        right[i, : len(own) - o] = own[o : o + length]
        left[i, :o] = own[:o][::-1]
    rank_r, common_r = _sorted_ranks(right)
    rank_l, common_l = _sorted_ranks(left)
    items, starts = [], []
    for o in range(before + 1):
        at = np.flatnonzero((o <= lead) & (o > lead - n))
        if len(at) < 2:
            continue
        key = (np.cumsum(common_r < length - o)[rank_r[at]] << 32) | np.cumsum(common_l < o)[rank_l[at]]
        order = np.argsort(key)
        same = key[order[1:]] == key[order[:-1]]
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        items.append(at[again])
        starts.append(lead[at[again]] - o)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *items]), np.concatenate([none, *starts])


def _bucket_repeats(suffixes: DataFrame, length: int) -> DataFrame:
    """Repeated strings by document, one batch of whole buckets at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def resolve(t: pa.Table) -> Iterator[pa.RecordBatch]:
            d, h, start, lead, n = (t.column(c).to_numpy() for c in ("d", "h", "start", "lead", "n"))
            item, offset = repeated_starts(lead.astype(np.int64), n.astype(np.int64), t.column("bytes").to_pylist(), length)
            order = np.argsort(item, kind="stable")
            item, pos = item[order], start[item[order]] + offset[order]
            cut = np.flatnonzero(np.diff(item)) + 1
            heads = item[np.concatenate([[0], cut])] if len(item) else item
            rows = [(None, int(d[i]), int(h[i]), p) for i, p in zip(heads, np.split(pos.astype(np.int32), cut), strict=False)]
            yield from batches_of(rows, FOUND_ARROW)

        for batch in batches:
            for start in range(0, batch.num_rows, BATCH):
                held.append(batch.slice(start, BATCH))
                if sum(b.num_rows for b in held) < BATCH:
                    continue
                t = pa.Table.from_batches(held)
                keys = t.column("key").to_numpy()
                whole = int(np.searchsorted(keys, keys[-1]))  # the last bucket may go on
                held = t.slice(whole).combine_chunks().to_batches()
                if whole:
                    yield from resolve(t.slice(0, whole))
        if held:
            yield from resolve(pa.Table.from_batches(held))

    n = int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return mapped(suffixes.repartition(n, "key").sortWithinPartitions("key"), run, FOUND_SCHEMA)


def _hot_repeats(taken: DataFrame, length: int) -> DataFrame:
    """Repeated strings of the commonest grams: counted by hash, then joined to their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, h = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = utf8(batch.column(2))
            for lo, hi in chunks(texts, PIECE):
                c = Cover(texts[lo:hi], length)
                place, row = flat(batch.column(3).slice(lo, hi - lo))
                served = np.flatnonzero(np.isin(c.at, c.offset[row] + place))
                size = c.high[served] - c.low[served] + 1
                owner = np.repeat(served, size)
                s = c.low[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
                doc = c.doc[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(range_hash(c.prefix, s, s + length).view(np.int64)), pa.array(d[lo:hi][doc]),
                        pa.array(h[lo:hi][doc]), pa.array((s - c.offset[doc]).astype(np.int32)),
                    ],
                    names=["key", "d", "h", "start"],
                )

    rows = mapped(taken, run, "key bigint, d bigint, h bigint, start int")
    again = rows.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key")
    return rows.join(again, "key").select(F.lit(None).cast("bigint").alias("key"), "d", "h", F.array("start").alias("pos"))


def _twice(count: np.ndarray, d: np.ndarray) -> np.ndarray:
    return count > 1


def _often(limit: int):
    def hits(count: np.ndarray, d: np.ndarray) -> np.ndarray:
        return count > limit

    return hits


def repeated_strings(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200, hot: int = HOT) -> DataFrame:
    """(d, h, pos): starts of the strings of ``length`` bytes that start anywhere else, too."""
    docs = keyed(df, key, text)
    shards = parts_for(docs, "t")
    rows = _sample_rows(docs, length, shards)
    found = stored(probed(rows, shards, active=False, merge=summed, hits=_twice, hot=_often(hot)), "gram-places")
    cold, hottest = found.filter("key IS NULL"), found.filter("key IS NOT NULL")

    def with_places(f: DataFrame) -> DataFrame:
        around = f.groupBy(F.col("d").alias("pd"), F.col("h").alias("ph")).agg(F.flatten(F.collect_list("pos")).alias("pos"))
        return docs.join(around, (F.col("d") == F.col("pd")) & (F.col("h") == F.col("ph"))).select("d", "h", "t", "pos")

    out = _bucket_repeats(_suffix_rows(with_places(cold), length), length)
    if not hottest.isEmpty():
        out = out.unionByName(_hot_repeats(with_places(hottest), length))
    return stored(out, "repeated-strings").drop("key")


def remove_repeated(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200, hot: int = HOT) -> DataFrame:
    """``df`` with ``kept_bytes``, ``n_bytes``, ``n_removed`` and ``n_spans``.

    Every byte covered by a string of ``length`` bytes that also starts
    anywhere else, in the same text or another, goes; strings are judged on the
    input and never cross texts. Null and empty texts have no bytes. Rows that
    repeat a key and a text count as two texts, and both lose all of them if
    they are long enough. Columns of the new names are replaced.
    """
    found = repeated_strings(df, key, text, length, hot)
    around = found.groupBy(F.col("d").alias("pd"), F.col("h").alias("ph")).agg(F.flatten(F.collect_list("pos")).alias("pp"))
    docs = df.select(
        F.struct(*df.columns).alias("row"), F.coalesce(F.col(key).cast("bigint"), F.lit(NONE)).alias("d"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"),
    )
    joined = docs.join(around, (F.col("d") == F.col("pd")) & (F.col("h") == F.col("ph")), "left")
    both = joined.select("row", F.struct(F.col("row").getField(text).alias("t"), F.col("pp").alias("p")).alias("tp"))

    def start():
        def run(column: pa.Array) -> list[pa.Array]:
            texts = utf8(column.field(0))
            place, row = flat(column.field(1))
            cut = np.searchsorted(row, np.arange(len(texts) + 1))
            kept, removed, spans = [], [], []
            for i, x in enumerate(texts):
                at = place[cut[i] : cut[i + 1]]
                if not len(at):
                    kept.append(x)
                    removed.append(0)
                    spans.append(0)
                    continue
                gone = covered(at.astype(np.int64), length, len(x))
                kept.append(np.frombuffer(x, np.uint8)[~gone].tobytes())
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            sizes = [len(x) for x in texts]
            return [pa.array(kept, pa.binary()), *(pa.array(c, pa.int64()) for c in (sizes, removed, spans))]

        return run

    new = {"kept_bytes": "binary", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint"}
    done = with_columns(both, "tp", new, start)
    return done.select(*(F.col("row").getField(c).alias(c) for c in df.columns if c not in new), *new)
