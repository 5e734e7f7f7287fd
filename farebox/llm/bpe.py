"""Byte-level BPE by an index of pair occurrences, and its inverse.

Each batch of a partition collects the pieces it has not met yet and encodes
them together: an index maps the rank of every adjacent pair to all places
where it stands, the lowest active rank is applied to all of its places at
once, and the lists of the pairs that appear next to them are extended. A merge
only ever creates pairs of a higher rank, so each rank is visited once, in
ascending order. There is no shuffle and nothing is kept between partitions.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from farebox.llm.batches import chunks
from farebox.llm.frames import with_columns

# fixed values: the pattern that cuts a text into pieces
LETTER, NUMBER = r"\p{L}", r"\p{N}"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^\s{LN}]+|\s+(?!\S)|\s+"
# fixed values: white space other than the space and the line feed
_OTHER_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
CACHED_WORDS = 150_000

ENCODED_BYTES = 2 << 20  # text encoded at once


@lru_cache(maxsize=1)
def _newer_characters() -> str:
    """Letters and digits known to the pattern library but not to the Unicode version of the vocabulary."""
    blocks = (lo for lo in range(0, 0x110000, 0x800) if lo != 0xD800)  # not the surrogates
    found = (regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, range(lo, lo + 0x800)))) for lo in blocks)
    return "".join(c for block in found for c in block if unicodedata.category(c) == "Cn")


def _uneven(text: str) -> bool:
    """Whether a space of the text touches other white space or an end of the text."""
    return (
        text[0].isspace() or text[-1].isspace() or "  " in text or " \n" in text or "\n " in text
        or (" " in text and _OTHER_SPACE.search(text) is not None)
    )


def _pattern(without: str = "") -> regex.Pattern:
    if not without:
        return regex.compile(PATTERN.replace("{LN}", LETTER + NUMBER).replace("{L}", LETTER).replace("{N}", NUMBER))
    drop = f"[{regex.escape(without)}]"
    cut = {"L": rf"[{LETTER}--{drop}]", "N": rf"[{NUMBER}--{drop}]"}
    other = rf"[[^\s{LETTER}{NUMBER}]||{drop}]"
    full = PATTERN.replace(r"[^\s{LN}]", other).replace("{L}", cut["L"]).replace("{N}", cut["N"])
    return regex.compile(f"(?V1){full}")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE file; its size is that of the file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            self.tokens[i] = bytes(map(letters.get, token)) if token not in self.special else b""
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.of_byte = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        key = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.pair_keys, self.pair_ranks = key[order], order
        self.key_of_rank = key

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The merge rank of each pair; -1 for none."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)


def _distinct(a: np.ndarray) -> np.ndarray:
    a.sort()
    return a[np.concatenate([[True], a[1:] != a[:-1]])] if len(a) else a


def encode_pieces(pieces: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all pieces, one after the other, and where each piece's ids begin (and the end)."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    n = int(begin[-1])
    symbol = v.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
    piece = np.repeat(np.arange(len(pieces)), sizes)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)  # neighbours; the ends of a piece have none
    if n:
        last = begin[1:][sizes > 0] - 1
        after[last] = n
        before[begin[:-1][sizes > 0]] = -1
    alive = np.ones(n, bool)
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def add(at: np.ndarray, rank: np.ndarray) -> None:
        found = rank >= 0
        at, rank = at[found], rank[found]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cut = np.flatnonzero(np.diff(rank)) + 1
        for r, places in zip(rank[np.concatenate([[0], cut])].tolist(), np.split(at, cut), strict=True):
            if r in index:
                index[r].append(places)
            else:
                index[r] = [places]
                heapq.heappush(active, r)

    inner = np.flatnonzero(piece[:-1] == piece[1:]) if n else np.zeros(0, np.int64)
    add(inner, v.ranks(symbol[inner], symbol[inner + 1]))
    while active:
        r = heapq.heappop(active)
        lists = index.pop(r)
        at = lists[0] if len(lists) == 1 else _distinct(np.concatenate(lists))
        left, right = int(v.key_of_rank[r]) >> 32, int(v.key_of_rank[r]) & 0xFFFFFFFF
        at = at[alive[at] & (symbol[at] == left)]
        nxt = after[at]
        good = nxt < n
        at, nxt = at[good], nxt[good]
        good = symbol[nxt] == right
        at, nxt = at[good], nxt[good]
        if left == right and len(at) > 1:  # in a run of one symbol every other pair goes, from its left end
            chained = np.concatenate([[False], nxt[:-1] == at[1:]])
            place = np.arange(len(at))
            head = np.maximum.accumulate(np.where(chained, 0, place))
            good = (place - head) % 2 == 0
            at, nxt = at[good], nxt[good]
        if not len(at):
            continue
        symbol[at] = v.merged[r]
        alive[nxt] = False
        beyond = after[nxt]
        after[at] = beyond
        inside = beyond < n
        before[beyond[inside]] = at[inside]
        prior = before[at]
        prior = prior[prior >= 0]
        follow = at[inside]
        places = _distinct(np.concatenate([prior, follow]))
        add(places, v.ranks(symbol[places], symbol[after[places]]))
    kept = np.flatnonzero(alive)
    return symbol[kept], np.searchsorted(kept, begin)


class Encoder:
    """Encodes batches of texts; words met before in the same partition are looked up."""

    def __init__(self, v: Vocabulary):
        self.v = v
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.pattern = _pattern()
        newer = _newer_characters()
        self.newer = frozenset(newer)
        self.beyond = re.compile(f"[{min(newer, default=chr(0x10FFFF))}-{chr(0x10FFFF)}]")
        self.strict = _pattern(newer)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(v.special, key=len, reverse=True))) + ")") if v.special else None

    def _has_newer(self, text: str) -> bool:
        return not text.isascii() and self.beyond.search(text) is not None and not self.newer.isdisjoint(text)

    def _units(self, text: str) -> tuple[list[str], list[str]]:
        """The text as pieces, then words that each follow a single space.

        A space between two other characters always opens a piece, so a text
        with no other white space at a space is cut at its spaces.
        """
        if self._has_newer(text):
            return self.strict.findall(text), []
        if _uneven(text):
            return self.pattern.findall(text), []
        head, *words = text.split(" ")
        return self.pattern.findall(head), words

    def _parts(self, text: str) -> list[tuple[list[str], list[str]] | int]:
        if not text:
            return []
        if not any(s in text for s in self.v.special):
            return [self._units(text)]
        cut = [x for x in self.specials.split(text) if x]
        return [self.v.special[x] if x in self.v.special else self._units(x) for x in cut]

    def _pieces(self, word: str) -> list[str]:
        """The pieces of a word and the space before it; plain words need no pattern."""
        if word.isalpha():
            return [" " + word]
        if word[-1] in ".,;:!?" and word[:-1].isalpha():
            return [" " + word[:-1], word[-1]]
        return self.pattern.findall(" " + word)

    def learn(self, pieces: list[str], words: list[str]) -> None:
        """Encode pieces and words not met before, all in one index."""
        cut = [self._pieces(w) for w in words]
        new = dict.fromkeys(pieces)
        for c in cut:
            new.update(dict.fromkeys(c))
        todo = [p for p in new if p not in self.pieces]
        ids, begin = encode_pieces([p.encode() for p in todo], self.v)
        packed = ids.astype("<u4").tobytes()
        at = (4 * begin).tolist()
        self.pieces.update(zip(todo, map(packed.__getitem__, map(slice, at[:-1], at[1:])), strict=True))
        look = self.pieces.__getitem__
        self.words.update(zip(words, [look(c[0]) if len(c) == 1 else b"".join(map(look, c)) for c in cut], strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text, packed as little-endian 32-bit integers."""
        parts = [self._parts(t) for t in texts]
        if len(self.words) > CACHED_WORDS:  # only what is looked up goes; the ids stay the same
            self.pieces, self.words = {}, {}
        pieces: set[str] = set()
        words: set[str] = set()
        for units in (u for p in parts for u in p if not isinstance(u, int)):
            pieces.update(units[0])
            words.update(units[1])
        self.learn(list(pieces - self.pieces.keys()), list(words - self.words.keys()))
        piece, word = self.pieces.__getitem__, self.words.__getitem__
        return [
            b"".join(
                u.to_bytes(4, "little") if isinstance(u, int) else b"".join([*map(piece, u[0]), *map(word, u[1])])
                for u in p
            )
            for p in parts
        ]


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with the ids of its texts, packed as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids. White space, special tokens in the text
    and characters outside the vocabulary's Unicode version are treated as the
    file's own library treats them; all columns and repeated rows are kept. A
    column already called ``out`` is replaced.
    """
    v = Vocabulary(path)

    def start():
        encoder = Encoder(v)

        def run(column: pa.Array) -> list[pa.Array]:
            texts = [x or "" for x in column.to_pylist()]
            ids = [x for lo, hi in chunks(texts, ENCODED_BYTES) for x in encoder.encode(texts[lo:hi])]
            return [pa.array(ids, pa.binary())]

        return run

    return with_columns(df, text, {out: "binary"}, start)


def decode_ids(packed: list[bytes], v: Vocabulary) -> Iterator[str]:
    """The text of each id list; broken UTF-8 becomes the replacement character."""
    tokens = v.tokens
    for x in packed:
        yield b"".join([tokens[i] for i in np.frombuffer(x, "<u4").tolist()]).decode("utf-8", "replace")


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text of its packed ids, special tokens included; null ids give an empty text."""
    v = Vocabulary(path)

    def start():
        def run(column: pa.Array) -> list[pa.Array]:
            return [pa.array(list(decode_ids([x or b"" for x in column.to_pylist()], v)), pa.string())]

        return run

    return with_columns(df, ids, {out: "string"}, start)


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` encoded and decoded again by one worker per task; as :func:`encode` and then :func:`decode`."""
    v = Vocabulary(path)

    def start():
        encoder = Encoder(v)

        def run(column: pa.Array) -> list[pa.Array]:
            packed, decoded = [], []
            texts = [x or "" for x in column.to_pylist()]
            for lo, hi in chunks(texts, ENCODED_BYTES):
                part = encoder.encode(texts[lo:hi])
                packed += part
                decoded += decode_ids(part, v)
            return [pa.array(packed, pa.binary()), pa.array(decoded, pa.string())]

        return run

    return with_columns(df, text, {ids: "binary", out: "string"}, start)
