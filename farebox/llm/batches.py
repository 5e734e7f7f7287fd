"""Arrow batches cut into pieces of bounded text size, and NumPy word tables over them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 256 << 10
# fixed values: the six ASCII white-space bytes
WHITE = b" \t\n\x0b\x0c\r"


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(texts: list, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes or characters each; a longer text is a range of its own."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > size:
            yield start, i
            start, held = i, 0
        held += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


# a prime below 2**31, so that products of two residues fit in 64 bits
PRIME = np.uint64((1 << 31) - 1)
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # of each base, the longest asked for so far


def _prime_powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers modulo ``PRIME``, doubled from those at hand."""
    out = np.ones(1, np.uint32)
    while len(out) < n:
        more = out * np.uint64(pow(base, len(out), int(PRIME))) % PRIME
        out = np.concatenate([out, more.astype(np.uint32)])
    return out[:n]


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64, out=out)


def _table(base: int, n: int, fill: Callable, modulus: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _TABLES or len(_TABLES[base][0]) < n:
        size = max(1 << 10, n + n // 8)
        _TABLES[base] = fill(base, size), fill(pow(base, -1, modulus), size)
    up, down = _TABLES[base]
    return up[:n], down[:n]


def prime_powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """As many powers of a number and of its inverse modulo ``PRIME`` as asked for."""
    return _table(base, n, _prime_powers, int(PRIME))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """As many powers of an odd number and of its inverse modulo 2**64 as asked for."""
    return _table(base, n, _powers, 1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that any of their bits can deal them out."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE_BASE = 0x5851F42D4C957F2D
_WORD_BASE = 0x2545F4914F6CDD1D
# primitive roots modulo PRIME: no difference of two texts vanishes for the base alone
_BYTE_ROOT, _WORD_ROOT = 16807, 1583458089


def _prefix(values: np.ndarray, base: int, root: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of the values' polynomial, modulo 2**64 and modulo ``PRIME``."""
    n = len(values)
    whole, prime = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n + 1)[0][:n], out=whole[1:])
    np.cumsum(values % PRIME * prime_powers(root, n + 1)[0][:n] % PRIME, out=prime[1:])
    return whole, prime % PRIME


def _ranges(prefix: tuple[np.ndarray, np.ndarray], start: np.ndarray | slice, end: np.ndarray | slice, base: int, root: int) -> np.ndarray:
    """64 bits out of both residues of each range.

    Modulo 2**64 alone, strings are known that differ and have one residue
    whatever the base; a second, prime modulus tells them apart.
    """
    whole, prime = prefix
    a = (whole[end] - whole[start]) * powers(base, len(whole))[1][start]
    b = (prime[end] + PRIME - prime[start]) % PRIME * prime_powers(root, len(prime))[1][start] % PRIME
    return mixed(mixed(a) + b * np.uint64(0x9E3779B97F4A7C15))


def byte_prefix(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which the hash of any byte range follows."""
    return _prefix(_BYTE_VALUES[buf], _BYTE_BASE, _BYTE_ROOT)


def range_hash(prefix: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges; equal bytes give equal hashes wherever they stand."""
    return _ranges(prefix, start, end, _BYTE_BASE, _BYTE_ROOT)


def window_hash(values: np.ndarray, k: int) -> np.ndarray:
    """The hash of each run of ``k`` values, by first position."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    return _ranges(_prefix(values, _WORD_BASE, _WORD_ROOT), slice(0, n), slice(k, None), _WORD_BASE, _WORD_ROOT)


_IS_WORD = np.ones(256, bool)
_IS_WORD[list(WHITE)] = False


class Words:
    """The white-space separated words of some texts.

    ``buf`` holds the texts, each followed by a line feed; ``start`` and
    ``end`` are the words' places in it, ``doc`` the index of their text and
    ``hash`` a 64-bit hash of their bytes. ``first`` has the index of each
    text's first word, and the number of all words at its end.
    """

    def __init__(self, texts: list[bytes], hashes: bool = True):
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.offset = np.concatenate([[0], np.cumsum(sizes)])
        inside = np.zeros(len(self.buf) + 1, np.int8)
        inside[1:] = _IS_WORD[self.buf]
        edge = np.diff(inside)
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        self.first = np.searchsorted(self.start, self.offset)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        if hashes:
            self.prefix = byte_prefix(self.buf)
            self.hash = range_hash(self.prefix, self.start, self.end)

    def bytes_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return range_hash(self.prefix, start, end)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of ``k`` words that stays in its text."""
        h = window_hash(self.hash, k)
        at = np.flatnonzero(self.doc[: len(h)] == self.doc[k - 1 :]) if len(h) else np.zeros(0, np.int64)
        return at, h[at]


def per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[first[1:]] - total[first[:-1]]


def covered(starts: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a run of ``k`` that begins at one of ``starts``."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + k, n), -1)
    return np.cumsum(step[:n]) > 0
