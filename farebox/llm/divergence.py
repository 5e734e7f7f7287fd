"""How far the sources of a language differ in the terms they use.

Each language's kept terms, sorted, become minimal acyclic transducers of up to
``SHARD`` terms each; a term's ordinal is the shard's place and the sum of outputs
along its path. Texts are then streamed through the transducers to count the kept
terms of every source, and ordinals stand for terms until the last step, ties
included. Counts go over blocks of terms, so no task holds a whole vocabulary, and
a shard that many texts meet is dealt over several tasks.

All figures are whole numbers. A term's probability is
``p = 1 + floor(SCALE * (count + 2) / (N + 2 * V))`` and the difference of two
``floor((p - q)^2 / (p + q))``.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from farebox.llm.batches import chunks, utf8
from farebox.llm.frames import mapped, stored
from farebox.llm.transducer import Transducer

MIN_DOCS, TOP = 10, 10
SHARD, BLOCK = 1 << 14, 1 << 11
SALTS = 4
SPLIT_BYTES = 8 << 20  # a longer text is taken in parts
HELD_SOURCES = 64

# fixed values: ASCII letters and all bytes above ASCII make terms
_TERM_BYTE = np.zeros(256, bool)
_TERM_BYTE[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def terms_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct terms ascending, each term's place among them, each term's text) in order of the texts."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    held = _TERM_BYTE[buf]
    edge = np.diff(np.concatenate([[0], held.view(np.int8)]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    letters = _LOWER[buf[held]]
    offset = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    every = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offset), pa.py_buffer(letters)])
    found = every.dictionary_encode()
    order = pc.sort_indices(found.dictionary).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    return found.dictionary.take(pa.array(order)), place[found.indices.to_numpy()], np.searchsorted(ends, start, "right")


def parts(text: bytes, size: int = SPLIT_BYTES) -> Iterator[bytes]:
    """``text`` in parts of about ``size`` bytes that cut no term; a term longer than that stays whole."""
    at = 0
    while len(text) - at > size:
        end, step = at + size, 1 << 16
        while end < len(text):
            gap = np.flatnonzero(~_TERM_BYTE[np.frombuffer(text, np.uint8, min(step, len(text) - end), end)])
            if len(gap):
                end += int(gap[0])
                break
            end += step
        yield text[at : min(end, len(text))]
        at = min(end, len(text))
    if at < len(text) or not text:
        yield text[at:]


def _clean(df: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    names = {"lang": lang, "source": source, "text": text}
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for a, c in names.items()))


def document_counts(docs: DataFrame) -> DataFrame:
    """(lang, term, docs) with the term as bytes; a batch's counts are summed before they are shuffled."""
    schema = pa.schema([("lang", pa.string()), ("term", pa.binary()), ("docs", pa.int64())])

    def counted(langs: list, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        names = sorted(set(langs))
        terms, place, row = terms_of(texts)
        code = np.array([names.index(x) for x in langs], np.int64)
        each = np.unique(row * len(terms) + place) if len(terms) else np.zeros(0, np.int64)
        pair, n = np.unique(code[each // max(1, len(terms))] * len(terms) + each % max(1, len(terms)), return_counts=True)
        if len(pair):
            which = pa.array(pair // len(terms))
            cells = [pa.array(names).take(which), terms.take(pa.array(pair % len(terms))).cast(pa.binary()), pa.array(n.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(cells, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
            for a, b in chunks(texts):
                if b == a + 1 and len(texts[a]) > SPLIT_BYTES:
                    distinct = {x for part in parts(texts[a]) for x in terms_of([part])[0].to_pylist()}
                    yield from counted(langs[a:b], [b"\n".join(distinct)])
                else:
                    yield from counted(langs[a:b], texts[a:b])

    partial = mapped(docs.select("lang", "text"), run, "lang string, term binary, docs bigint")
    return partial.groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


def vocabulary(docs: DataFrame, min_docs: int = MIN_DOCS, shard: int = SHARD) -> DataFrame:
    """(lang, shard, n, first_term, fst): transducers of each language's terms, shards numbered in term order."""
    kept = stored(document_counts(docs).filter(F.col("docs") >= min_docs).select("lang", "term"), "kept-terms")
    spread = max(1, -(-kept.count() // (4 * shard)))
    schema = pa.schema([("lang", pa.string()), ("first_term", pa.binary()), ("n", pa.int64()), ("fst", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        of = None

        def built() -> pa.RecordBatch:
            row = {"lang": of, "first_term": held[0], "n": len(held), "fst": bytes(Transducer.build(held))}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for lang, term in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (lang != of or len(held) == shard):
                    yield built()
                    held = []
                of = lang
                held.append(term)
        if held:
            yield built()

    in_order = kept.repartitionByRange(spread, "lang", "term").sortWithinPartitions("lang", "term")
    built = stored(mapped(in_order, run, "lang string, first_term binary, n bigint, fst binary"), "transducers")
    # one row per shard, without its transducer
    number = F.row_number().over(Window.partitionBy("lang").orderBy("first_term")) - 1
    numbered = built.select("lang", "first_term", number.alias("shard"))
    return built.join(numbered, ["lang", "first_term"]).select("lang", "shard", "n", "first_term", "fst")


_TEXT_ROW = pa.schema([
    ("lang", pa.string()), ("shard", pa.int32()), ("salt", pa.int32()), ("kind", pa.int32()), ("fst", pa.binary()), ("terms", pa.list_(pa.binary())),
    ("sources", pa.list_(pa.string())), ("sizes", pa.list_(pa.int32())), ("places", pa.binary()), ("counts", pa.binary()),
])
_TEXT_DDL = (
    "lang string, shard int, salt int, kind int, fst binary, terms array<binary>, "
    "sources array<string>, sizes array<int>, places binary, counts binary"
)


def _dealt_texts(docs: DataFrame, cuts: dict[str, list[bytes]], salts: int) -> DataFrame:
    """The texts as their terms, cut by shard: a row per batch, language and shard, equal terms of a source put together."""

    def dealt(langs: list, sources: list, texts: list[bytes], salt: int) -> Iterator[dict]:
        terms, place, row = terms_of(texts)
        listed = terms.to_pylist()
        source_names = sorted(set(sources))
        code = np.array([source_names.index(s) for s in sources], np.int64)
        for lang in sorted(set(langs) & set(cuts)):
            mine = np.array([x == lang for x in langs])[row]
            # a term belongs to the last shard that does not begin behind it
            bounds = np.array([0, *(bisect_left(listed, c) for c in cuts[lang][1:]), len(listed)])
            pair, n = np.unique(code[row[mine]] * len(listed) + place[mine], return_counts=True)
            source, term = pair // max(1, len(listed)), pair % max(1, len(listed))
            shard = np.searchsorted(bounds, term, "right") - 1
            order = np.argsort(shard, kind="stable")
            edges = np.flatnonzero(np.diff(np.concatenate([[-1], shard[order], [-1]])))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                at = order[a:b]
                own, where = np.unique(term[at], return_inverse=True)
                names, sizes = np.unique(source[at], return_counts=True)
                yield {
                    "lang": lang, "shard": int(shard[at[0]]), "salt": salt, "kind": 1, "fst": None, "terms": [listed[i] for i in own],
                    "sources": [source_names[i] for i in names], "sizes": sizes.tolist(),
                    "places": where.astype(np.int32).tobytes(), "counts": n[at].astype(np.int64).tobytes(),
                }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = 0
        for batch in batches:
            langs, sources, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))
            for a, b in chunks(texts, SPLIT_BYTES):
                for part in parts(texts[a]) if b == a + 1 else [None]:
                    # any spread will do: equal rows meet again when counts are summed
                    salt += 1 + len(texts[a])
                    rows = [*dealt(langs[a:b], sources[a:b], texts[a:b] if part is None else [part], salt % salts)]
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema=_TEXT_ROW)

    return mapped(docs.select("lang", "source", "text"), run, _TEXT_DDL)


_COUNT_DDL = "lang string, shard int, block int, source string, places binary, counts binary, total bigint"
_COUNT_ROW = pa.schema([
    ("lang", pa.string()), ("shard", pa.int32()), ("block", pa.int32()), ("source", pa.string()), ("places", pa.binary()),
    ("counts", pa.binary()), ("total", pa.int64()),
])


def term_counts(docs: DataFrame, shards: DataFrame, salts: int = SALTS, block: int = BLOCK) -> DataFrame:
    """(lang, shard, block, source, places, counts, total): partial counts of kept terms.

    ``places`` are ordinals within the block. A shard and salt is one stream of
    rows through its transducer, which holds the counts of a few sources at a
    time; the same source may come several times.
    """
    # the first term of each shard: one per SHARD kept terms or language
    heads = shards.select("lang", "shard", "first_term").collect()
    cuts: dict[str, list[bytes]] = {}
    for lang, _, first in sorted((r[0], r[1], bytes(r[2])) for r in heads):
        cuts.setdefault(lang, []).append(first)
    texts = _dealt_texts(docs, cuts, salts)
    copies = shards.select(
        "lang", "shard", F.explode(F.expr(f"sequence(0, {salts - 1})")).alias("salt"), F.lit(0).alias("kind"), "fst",
        *(F.lit(None).cast(t).alias(c) for c, t in (("terms", "array<binary>"), ("sources", "array<string>"), ("sizes", "array<int>"), ("places", "binary"), ("counts", "binary"))),
    )
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = copies.union(texts).repartition(n, "lang", "shard", "salt").sortWithinPartitions("lang", "shard", "salt", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, fst, held = None, None, {}

        def flush() -> Iterator[pa.RecordBatch]:
            out = []
            for source, counts in held.items():
                for b, low in enumerate(range(0, len(counts), block)):
                    part = counts[low : low + block]
                    at = np.flatnonzero(part)
                    if len(at):
                        out.append({
                            "lang": of[0], "shard": of[1], "block": b, "source": source, "places": at.astype(np.int32).tobytes(),
                            "counts": part[at].tobytes(), "total": int(part[at].sum()),
                        })
            held.clear()
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_COUNT_ROW)

        for batch in batches:
            terms_column = batch.column(5)
            for i, row in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 3, 4, 6, 7, 8, 9)), strict=True)):
                lang, shard, salt, kind, data, sources, sizes, places, counts = row
                if (lang, shard, salt) != of:
                    yield from flush()
                    of = (lang, shard, salt)
                if kind == 0:
                    fst = Transducer.read(data)
                    size = fst.words
                    continue
                terms = terms_column[i].values
                blob = b"".join(terms.to_pylist())
                ends = np.cumsum(pc.binary_length(terms).to_numpy())
                starts = np.concatenate([[0], ends[:-1]])
                ordinal = fst.ordinals(np.frombuffer(blob, np.uint8), starts, ends)[np.frombuffer(places, np.int32)]
                number, at = np.frombuffer(counts, np.int64), 0
                for source, n_terms in zip(sources, sizes, strict=True):
                    own, value = ordinal[at : at + n_terms], number[at : at + n_terms]
                    at += n_terms
                    total = held.setdefault(source, np.zeros(size, np.int64))
                    known = own >= 0
                    total[own[known]] += value[known]  # a term comes once per source and row
                if len(held) > HELD_SOURCES:
                    yield from flush()
        yield from flush()

    return mapped(rows, run, _COUNT_DDL)


def scaled_share(count: np.ndarray, size: int) -> np.ndarray:
    """``1 + floor(10^9 * (count + 2) / size)``, three digits at a time: exact in 64 bits for sizes below 9 * 10^15."""
    whole, rest = np.divmod(count + 2, size)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, size)
        whole = whole * 1000 + digit
    return whole + 1


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


_PART_DDL = "lang string, part string, source string, other string, shard int, ordinal int, value bigint"
_PART_ROW = pa.schema([
    ("lang", pa.string()), ("part", pa.string()), ("source", pa.string()), ("other", pa.string()), ("shard", pa.int32()),
    ("ordinal", pa.int32()), ("value", pa.int64()),
])


def _block_parts(counts: DataFrame, members: DataFrame, top: int, block: int) -> DataFrame:
    """Per block of terms: the sum of differences of each pair of sources (smaller name first), and each source's first terms."""
    none = [F.lit(None).cast(t).alias(c) for c, t in (("places", "binary"), ("counts", "binary"))]
    fields = ["lang", "shard", "block", "kind", "source", "total", "lang_total", "v", "n"]
    rows = members.withColumn("kind", F.lit(0)).select(*fields, *none).union(
        counts.select("lang", "shard", "block", F.lit(1), "source", *(F.lit(None).cast("bigint") for _ in range(4)), "places", "counts")
    )
    n = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "lang", "shard", "block").sortWithinPartitions("lang", "shard", "block", "kind", "source")

    def judged(of: tuple, sources: list[str], totals: list[int], lang_total: int, v: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        lang, shard, b = of
        size = counts.shape[1]
        shares = np.array([scaled_share(c, t + 2 * v) if size else c for c, t in zip(counts, totals, strict=True)])
        names = pa.array(sources, pa.string())
        for i in range(len(sources) - 1):
            value = difference(shares[i + 1 :], shares[i]).sum(axis=1)
            cells = [[lang] * len(value), ["pair"] * len(value), [sources[i]] * len(value), names[i + 1 :], None, None, value]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(value), f.type) if c is None else pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(cells, _PART_ROW, strict=True)],
                schema=_PART_ROW,
            )
        if size:
            whole = scaled_share(counts.sum(axis=0), lang_total + 2 * v)
            for i, name in enumerate(sources):
                at = np.flatnonzero((counts[i] > 0) & (shares[i] > whole))
                value = difference(shares[i][at], whole[at])
                best = np.lexsort((at, -value))[:top]
                out = [{"lang": lang, "part": "term", "source": name, "other": None, "shard": shard, "ordinal": b * block + int(at[j]), "value": int(value[j])} for j in best]
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_PART_ROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, sources, totals, counts = None, {}, [], None

        def block_counts() -> np.ndarray:
            return np.zeros((len(sources), n_terms), np.int64) if counts is None else counts

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != of:
                    if of is not None:
                        yield from judged(of, [*sources], totals, lang_total, v, block_counts())
                    of, sources, totals, counts = row[:3], {}, [], None
                kind, source = row[3], row[4]
                if kind == 0:  # all members come before the counts
                    sources[source] = len(sources)
                    totals.append(row[5])
                    lang_total, v, n_terms = row[6:9]
                    continue
                counts = block_counts()
                counts[sources[source], np.frombuffer(row[9], np.int32)] += np.frombuffer(row[10], np.int64)
        if of is not None:
            yield from judged(of, [*sources], totals, lang_total, v, block_counts())

    return mapped(rows, run, _PART_DDL)


def _terms_at(wanted: DataFrame, shards: DataFrame) -> DataFrame:
    """``wanted`` with ``item``, read off the transducers by ordinal."""
    fields = [*wanted.columns]
    rows = shards.select("lang", "shard", F.lit(0).alias("kind"), "fst", *(F.lit(None).cast(wanted.schema[c].dataType).alias(f"w_{c}") for c in fields)).union(
        wanted.select("lang", "shard", F.lit(1), F.lit(None).cast("binary"), *fields)
    )
    n = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "lang", "shard").sortWithinPartitions("lang", "shard", "kind")
    ordinal = 4 + fields.index("ordinal")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = None
        for batch in batches:
            kinds, ordinals, data = batch.column(2).to_pylist(), batch.column(ordinal).to_pylist(), batch.column(3)
            keep, items = [], []
            for i, (kind, place) in enumerate(zip(kinds, ordinals, strict=True)):
                if kind == 0:
                    fst = Transducer.read(data[i].as_py())
                else:
                    keep.append(i)
                    items.append(fst.term(place).decode())
            if keep:
                kept = batch.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([*kept.columns[4:], pa.array(items, pa.string())], names=[*fields, "item"])

    return mapped(rows, run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in wanted.schema.fields) + ", item string")


def divergence(
    df: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", min_docs: int = MIN_DOCS,
    top: int = TOP, shard: int = SHARD, block: int = BLOCK, salts: int = SALTS,
) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) of ``df``.

    Part ``pair`` has the other sources of the language with the difference
    summed over all kept terms, and part ``term`` the ``top`` terms that the
    source has more often than the language. Kept are terms of at least
    ``min_docs`` rows of the language. Null values are empty; rows that repeat are documents of
    their own; a source without kept terms, and a language without any, still
    have their pairs (with value 0 in the latter). Ranks follow value, then the item's
    bytes. Pairs of sources are asked for, so their number is the square of a
    language's sources; a task holds one block of terms for all of them.
    """
    docs = _clean(df, lang, source, text)
    shards = stored(vocabulary(docs, min_docs, shard), "vocabulary")
    counts = stored(term_counts(docs, shards, salts, block), "term-counts")
    groups = docs.select("lang", "source").distinct()
    totals = groups.join(counts.groupBy("lang", "source").agg(F.sum("total").alias("total")), ["lang", "source"], "left").withColumn(
        "total", F.coalesce("total", F.lit(0)).cast("bigint")
    )
    sizes = shards.groupBy("lang").agg(F.sum("n").alias("v"))
    by_lang = totals.groupBy("lang").agg(F.sum("total").alias("lang_total")).join(sizes, "lang", "left")
    blocks = shards.select("lang", "shard", "n", F.posexplode(F.expr(f"sequence(0, n - 1, {block})")).alias("block", "low"))
    blocks = blocks.select("lang", "shard", "block", F.least(F.col("n") - F.col("low"), F.lit(block)).cast("bigint").alias("n"))
    # a language without kept terms is one empty block
    empty = by_lang.filter("v IS NULL").select("lang", F.lit(-1).alias("shard"), F.lit(0).alias("block"), F.lit(0).cast("bigint").alias("n"))
    members = totals.join(by_lang, "lang").join(blocks.union(empty), "lang").withColumn("v", F.coalesce("v", F.lit(0)).cast("bigint"))
    found = stored(_block_parts(counts, members, top, block), "block-parts")
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    both = pairs.union(pairs.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))

    def ranked(*order: Column | str) -> Column:
        return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), *order))

    terms = found.filter("part = 'term'").select("lang", "source", "shard", "ordinal", "value").withColumn("rank", ranked("shard", "ordinal"))
    named = _terms_at(terms.filter(F.col("rank") <= top), shards)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return both.withColumnRenamed("other", "item").withColumns({"part": F.lit("pair"), "rank": ranked("item")}).select(*columns).union(
        named.withColumn("part", F.lit("term")).select(*columns)
    )
