"""Document statistics and gradient-boosted trees over them.

The trees are fitted on a bounded sample of labelled documents, flattened into
node arrays and scored on whole Arrow batches at once. On the features named in
``WORSE_WHEN_HIGHER`` the score may only rise, whatever the sample says.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from farebox.llm.batches import Words, chunks, covered, per_text, utf8
from farebox.llm.frames import with_columns

WINDOW = 8
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "mean_word_chars", "symbols_per_word", "dup_line_share", "repeat_word_share",
    "upper_byte_share", "digit_byte_share", "punctuation_byte_share", "punctuated_word_share",
    "single_byte_word_share", "adjacent_equal_share",
)
WORSE_WHEN_HIGHER = (
    "symbols_per_word", "dup_line_share", "repeat_word_share", "upper_byte_share",
    "adjacent_equal_share", "single_byte_word_share",
)

# fixed values: the characters counted as symbols
SYMBOLS = b"#*$%&|<>"


def _marks(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


_SYMBOL = _marks(SYMBOLS)
_UPPER = _marks(bytes(range(ord("A"), ord("Z") + 1)))
_DIGIT = _marks(b"0123456789")
_PUNCTUATION = _marks(bytes(b for b in range(33, 127) if not chr(b).isalnum()))
_LATER_BYTE = _marks(bytes(range(0x80, 0xC0)))  # not the first byte of a code point


def statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``COUNTS`` (exact) and ``FEATURES`` of each text."""
    w = Words(texts)
    n_texts, n = len(texts), len(w.start)
    n_words = np.diff(w.first)
    bounds = w.offset

    def bytes_in(marks: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(marks[w.buf])])
        return total[bounds[1:]] - total[bounds[:-1]]

    later = np.concatenate([[0], np.cumsum(_LATER_BYTE[w.buf])])
    size = w.end - w.start
    word_chars = per_text(size - (later[w.end] - later[w.start]), w.first)

    # lines that have a word, told apart by their bytes
    line_end = np.flatnonzero(w.buf == 10)
    line_start = np.concatenate([[0], line_end[:-1] + 1])
    at = np.searchsorted(w.start, line_start)
    with_word = at < np.searchsorted(w.start, line_end)
    line_doc = np.searchsorted(bounds, line_start[with_word], side="right") - 1
    raw = w.buf.tobytes()
    bounds_of = zip(line_start[with_word].tolist(), line_end[with_word].tolist(), strict=True)
    code = pa.array([raw[a:b] for a, b in bounds_of], pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    first = np.unique(line_doc * (len(code) + 1) + code, return_index=True)[1]
    n_lines = np.bincount(line_doc, minlength=n_texts)
    n_dup_lines = n_lines - np.bincount(line_doc[first], minlength=n_texts)

    places, h = w.windows(WINDOW)
    again = repeated(w.doc[places], h)
    n_repeat = per_text(covered(places[again], WINDOW, n), w.first)

    equal = np.zeros(n, bool)
    equal[1:] = (w.hash[1:] == w.hash[:-1]) & (w.doc[1:] == w.doc[:-1])
    same = per_text(equal, w.first)
    nw = np.maximum(n_words, 1)
    nb = np.maximum(np.diff(bounds) - 1, 1)
    single = per_text(size == 1, w.first)
    punctuated = per_text(_PUNCTUATION[w.buf[w.end - 1]] if n else np.zeros(0), w.first)
    counts = np.stack([n_words, word_chars, bytes_in(_SYMBOL), n_dup_lines, n_repeat], 1).astype(np.int64)
    features = np.stack(
        [
            np.log1p(n_words), word_chars / nw, counts[:, 2] / nw, n_dup_lines / np.maximum(n_lines, 1),
            n_repeat / nw, bytes_in(_UPPER) / nb, bytes_in(_DIGIT) / nb,
            bytes_in(_PUNCTUATION) / nb, punctuated / nw, single / nw, same / nw,
        ],
        1,
    )
    return counts, features


def repeated(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the hashes stand more than once in their document."""
    if not len(h):
        return np.zeros(0, bool)
    order = np.lexsort((h, doc))
    d, x = doc[order], h[order]
    equal = (d[1:] == d[:-1]) & (x[1:] == x[:-1])
    out = np.zeros(len(h), bool)
    out[order[1:][equal]] = True
    out[order[:-1][equal]] = True
    return out


# ------------------------------------------------------------------------ trees
@dataclass(frozen=True)
class Trees:
    """All trees in five arrays of one length; ``root`` has the first node of each.

    A leaf points at itself, so every row may take ``depth`` steps.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    root: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of low quality of each row."""
        out = np.full(len(x), self.base)
        row = np.arange(len(x))
        for r in self.root:
            at = np.full(len(x), r)
            for _ in range(self.depth):
                at = np.where(x[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out += self.value[at]
        return out


def fit(
    x: np.ndarray, y: np.ndarray, rising: np.ndarray, trees: int = 60, depth: int = 4,
    rate: float = 0.2, bins: int = 256, least: float = 5.0, l2: float = 5.0,
) -> Trees:
    """Boosted trees for the log loss; ``rising`` marks features on which the score may not fall.

    Splits are chosen on histograms of quantile bins. A split on a rising
    feature needs a left value of at most the right one, and the values below
    it are held to either side of their middle. Without rows, or with labels of
    one kind, the score is a constant.
    """
    share = np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []

    def leaf(value: float) -> int:
        i = len(nodes["value"])
        for k, v in zip(nodes, (0, np.inf, i, i, value), strict=True):
            nodes[k].append(v)
        return i

    if len(y) and 0 < y.sum() < len(y):
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
        score = np.full(len(y), base)

        def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
            total_g, total_h = g[rows].sum(), h[rows].sum()
            own = float(np.clip(-total_g / (total_h + l2), low, high))
            best = (1e-6, -1, 0, 0.0, 0.0)
            for j in range(x.shape[1]) if level < depth else ():
                if not len(cuts[j]):
                    continue
                b = binned[rows, j]
                gl = np.cumsum(np.bincount(b, g[rows], len(cuts[j]) + 1))[:-1]
                hl = np.cumsum(np.bincount(b, h[rows], len(cuts[j]) + 1))[:-1]
                vl = np.clip(-gl / (hl + l2), low, high)
                vr = np.clip(-(total_g - gl) / (total_h - hl + l2), low, high)

                def loss(gs: np.ndarray, hs: np.ndarray, v: np.ndarray) -> np.ndarray:
                    return gs * v + 0.5 * (hs + l2) * v * v

                gain = loss(total_g, total_h, own) - loss(gl, hl, vl) - loss(total_g - gl, total_h - hl, vr)
                gain = np.where((hl * 4 >= least) & ((total_h - hl) * 4 >= least), gain, -np.inf)
                if rising[j]:
                    gain = np.where(vl <= vr, gain, -np.inf)
                k = int(np.argmax(gain))
                if gain[k] > best[0]:
                    best = (float(gain[k]), j, k, float(vl[k]), float(vr[k]))
            if best[1] < 0:
                return leaf(own * rate)
            _, j, k, vl, vr = best
            at = leaf(0.0)
            goes_left = binned[rows, j] <= k
            middle = (vl + vr) / 2
            low_r, high_l = (middle, middle) if rising[j] else (low, high)
            # halfway into the gap, as far from either side as it goes
            gap = (x[rows[goes_left], j].max() + x[rows[~goes_left], j].min()) / 2
            nodes["feature"][at], nodes["threshold"][at] = j, float(gap)
            nodes["left"][at] = grow(rows[goes_left], g, h, level + 1, low, high_l)
            nodes["right"][at] = grow(rows[~goes_left], g, h, level + 1, low_r, high)
            return at

        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            before = len(nodes["value"])
            roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
            part = Trees(**{k: np.array(v) for k, v in nodes.items()}, root=np.array([before]), depth=depth, base=0.0)
            score += part.score(x)
    else:
        leaf(0.0)
    return Trees(**{k: np.array(v) for k, v in nodes.items()}, root=np.array(roots, np.int64), depth=depth, base=base)


# -------------------------------------------------------------------- operators
def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``COUNTS`` and an array ``features``; null and empty texts count as nothing."""

    def start():
        def run(column: pa.Array) -> list[pa.Array]:
            counts, features = _batch(column)
            return [*(pa.array(counts[:, i]) for i in range(len(COUNTS))), pa.array(list(features), pa.list_(pa.float64()))]

        return run

    return with_columns(df, text, {c: "bigint" for c in COUNTS} | {"features": "array<double>"}, start)


def _batch(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = utf8(column)
    parts = [statistics(texts[lo:hi]) for lo, hi in chunks(texts)]
    if not parts:
        return np.zeros((0, len(COUNTS)), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def train(
    docs: DataFrame, labels: DataFrame, sample: int = 6000, key: str = "doc_id",
    label: str = "quality", text: str = "text", **options: float,
) -> Trees:
    """Trees fitted on at most ``sample`` labelled documents.

    The sample is the labelled rows with the smallest hashes of their keys, so
    it is the same on every run. Rows without key or label are not used; of a
    key with several labels the highest is, and of one with several texts that
    with the smallest hash.
    """
    drawn = (
        labels.select(F.col(key).alias("k"), F.col(label).alias("y")).dropna().groupBy("k").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("k", F.lit(7)), "k").limit(sample)
    )
    # at most ``sample`` rows of two numbers
    matched = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(drawn), "k")
    one = matched.groupBy("k", "y").agg(F.min(F.struct(F.xxhash64("t"), "t")).alias("first")).select("k", "y", F.col("first.t").alias("t"))
    # a row per key of the sample
    rows = with_statistics(one, "t").select("k", "y", "features").toPandas().sort_values("k")
    x = np.stack(rows["features"].to_list()) if len(rows) else np.zeros((0, len(FEATURES)))
    y = 1.0 - np.clip(rows["y"].to_numpy(float), 0, 1)
    rising = np.array([f in WORSE_WHEN_HIGHER for f in FEATURES])
    return fit(x, y, rising, **options)


def _verdict(counts: np.ndarray, features: np.ndarray, trees: Trees, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether a base rule is broken, the probability of low quality, and whether the row is kept."""
    low = 1 / (1 + np.exp(-trees.score(features)))
    failed = (counts[:, 0] < 20) | (100 * counts[:, 4] > 30 * counts[:, 0])
    return failed, low, ~failed & (low <= threshold)


def judge(df: DataFrame, trees: Trees, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``df`` with ``COUNTS``, ``base_failed``, ``low_quality`` (0 to 1) and ``kept``.

    A document is kept unless it breaks a base rule (under 20 words, or over
    30 % of its words in repeated 8-word windows) or the trees give it a
    probability of low quality above ``threshold``. Null and empty texts have no
    words and break the first rule. Repeated rows are judged alike.
    """

    def start():
        def run(column: pa.Array) -> list[pa.Array]:
            counts, features = _batch(column)
            verdict = _verdict(counts, features, trees, threshold)
            return [*(pa.array(counts[:, i]) for i in range(len(COUNTS))), *map(pa.array, verdict)]

        return run

    added = {c: "bigint" for c in COUNTS} | {"base_failed": "boolean", "low_quality": "double", "kept": "boolean"}
    return with_columns(df, text, added, start)


def keep_good(df: DataFrame, trees: Trees, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``df`` that :func:`judge` keeps, with their own columns only."""
    rows = df.select(F.struct(*df.columns).alias("row"))
    at = df.columns.index(text)

    def start():
        def run(column: pa.Array) -> list[pa.Array]:
            counts, features = _batch(column.field(at))
            return [pa.array(_verdict(counts, features, trees, threshold)[2])]

        return run

    return with_columns(rows, "row", {"kept": "boolean"}, start).filter("kept").select("row.*")
