"""Fill-in-the-middle: each text cut into prefix, middle and suffix and put into a new order.

The places where a text may be cut are the byte offsets of its code points. They
are held as a set in containers of 65,536 offsets, each an array, a bitmap or a
list of runs, whichever is smallest, with cumulative cardinalities: the n-th cut
place is found by a search for its container and a select within it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from farebox.llm.batches import chunks, utf8
from farebox.llm.frames import mapped

SEED, FIM_PERCENT, SPM_PERCENT = 1, 90, 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SPAN = 1 << 16


class Places:
    """Sorted offsets in array containers: two bytes an offset."""

    def __init__(self, held: np.ndarray):
        self.values = np.flatnonzero(held).astype(np.uint16)

    def select(self, rank: np.ndarray) -> np.ndarray:
        return self.values[rank].astype(np.int64)


class Runs:
    """Offsets as runs: a start and the number of offsets before it."""

    def __init__(self, held: np.ndarray):
        edge = np.diff(np.concatenate([[0], held.view(np.int8), [0]]))
        self.start = np.flatnonzero(edge == 1)
        length = np.flatnonzero(edge == -1) - self.start
        self.before = np.cumsum(length) - length

    def select(self, rank: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, rank, "right") - 1
        return self.start[run] + rank - self.before[run]


class Bits:
    """Offsets as a bitmap of 64-bit words and the number of bits before each."""

    def __init__(self, held: np.ndarray):
        bits = np.packbits(held, bitorder="little")
        self.bytes = np.pad(bits, (0, -len(bits) % 8)).reshape(-1, 8)
        count = np.bitwise_count(self.bytes.view("<u8")[:, 0]).astype(np.int64)
        self.before = np.cumsum(count) - count

    def select(self, rank: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.before, rank, "right") - 1
        bits = np.unpackbits(self.bytes[word], axis=1, bitorder="little")
        return word * 64 + (np.cumsum(bits, axis=1) <= (rank - self.before[word])[:, None]).sum(axis=1)


def container(held: np.ndarray) -> Places | Runs | Bits:
    """The smallest container for the marked offsets of one span."""
    runs = int(np.count_nonzero(held[1:] & ~held[:-1])) + int(held[:1].sum())
    sizes = {Runs: 4 * runs, Places: 2 * int(np.count_nonzero(held)), Bits: SPAN // 8}
    return min(sizes, key=sizes.get)(held)


class Boundaries:
    """The set of offsets at which a code point begins; the end of the bytes belongs to it."""

    def __init__(self, data: np.ndarray):
        self.containers, counts = [], []
        for low in range(0, len(data) + 1, SPAN):
            part = data[low : low + SPAN]
            held = (part & 0xC0) != 0x80
            if low + SPAN > len(data):
                held = np.append(held, True)
            self.containers.append(container(held))
            counts.append(np.count_nonzero(held))
        self.before = np.cumsum([0, *counts])

    def select(self, rank: np.ndarray) -> np.ndarray:
        """The offsets of the given ranks, from 0."""
        rank = np.asarray(rank, np.int64)
        place = np.searchsorted(self.before, rank, "right") - 1
        out = np.empty(len(rank), np.int64)
        for c in np.unique(place):
            here = np.flatnonzero(place == c)
            out[here] = c * SPAN + self.containers[c].select(rank[here] - self.before[c])
        return out


def draws(key: object, seed: int) -> tuple[int, int, int, int]:
    """Four numbers that depend on the document's key alone; a null key counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def cut(keys: list, texts: list[bytes], seed: int, fim_percent: int, spm_percent: int, marks: tuple[bytes, bytes, bytes]) -> list[tuple]:
    """(n, form, prefix_chars, middle_chars, output) of each text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    places = Boundaries(data)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(sizes) - sizes
    n = np.array([np.count_nonzero((data[b : b + s] & 0xC0) != 0x80) for b, s in zip(begin, sizes, strict=True)], np.int64)
    first = np.cumsum(n) - n  # rank of each text's first offset
    drawn = [draws(k, seed) for k in keys]
    ends = np.array([sorted((h[0] % (c + 1), h[1] % (c + 1))) for h, c in zip(drawn, n.tolist(), strict=True)], np.int64).reshape(-1, 2)
    low, high = (places.select(first + ends[:, i]) - begin for i in (0, 1))
    p, s, m = marks
    out = []
    for i, (t, h) in enumerate(zip(texts, drawn, strict=True)):
        size = int(n[i])
        if not t or h[2] % 100 >= fim_percent or any(x in t for x in marks):
            out.append((size, "plain", None, None, t))
            continue
        head, middle, tail = t[: low[i]], t[low[i] : high[i]], t[high[i] :]
        chars = int(ends[i, 0]), int(ends[i, 1] - ends[i, 0])
        if h[3] % 100 < spm_percent:
            out.append((size, "spm", *chars, b"".join((s, tail, p, head, m, middle))))
        else:
            out.append((size, "psm", *chars, b"".join((p, head, s, tail, m, middle))))
    return out


ADDED = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def fill_in_middle(
    df: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
) -> DataFrame:
    """``df`` with ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Where a text is cut and which form it takes depend on its key and ``seed``
    alone. Empty and null texts, those that hold one of ``marks`` and those
    drawn out stay ``plain``: the output is the text (of a null one the empty
    string) and the two lengths are null. Rows with a null key are cut alike,
    and so are rows that repeat a key. Columns of the new names are replaced.
    """
    kept = [f for f in df.schema.fields if f.name not in ("n", "form", "prefix_chars", "middle_chars", "output")]
    schema = T.StructType([*kept, *T.StructType.fromDDL(ADDED).fields])
    arrow, names = to_arrow_schema(schema), [f.name for f in kept]
    marked = tuple(m.encode() for m in marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {name: batch.column(batch.schema.get_field_index(name)) for name in (*names, key, text)}
            texts, keys = utf8(column[text]), column[key].to_pylist()
            for a, b in chunks(texts):
                rows = cut(keys[a:b], texts[a:b], seed, fim_percent, spm_percent, marked)
                new = [pa.array(c, f.type) if f.type != pa.string() else pa.array(c, pa.binary()).cast(f.type) if f.name == "output" else pa.array(c, f.type)
                       for c, f in zip(zip(*rows, strict=True), list(arrow)[len(names) :], strict=True)]
                old = [column[name].slice(a, b - a) for name in names]
                cells = [c if c.type == f.type else c.cast(f.type) for c, f in zip([*old, *new], arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(cells, names=arrow.names)

    return mapped(df, run, schema)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text again, from the output and its form alone."""
    def halves(value: Column, mark: str) -> Column:
        return F.split(value, f"\\Q{mark}\\E", 2)

    p, s, m = marks
    psm = halves(F.substr(output, F.lit(len(p) + 1)), s)
    psm_rest = halves(psm[1], m)
    spm = halves(F.substr(output, F.lit(len(s) + 1)), p)
    spm_rest = halves(spm[1], m)
    return F.when(form == "psm", F.concat(psm[0], psm_rest[1], psm_rest[0])).when(
        form == "spm", F.concat(spm_rest[0], spm_rest[1], spm[0])
    ).otherwise(output)
