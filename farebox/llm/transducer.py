"""A vocabulary as a minimal acyclic transducer: every term leads to its place in sorted order."""

from __future__ import annotations

import struct
from collections.abc import Iterable
from os.path import commonprefix

import numpy as np

_HEAD = struct.Struct("<qq")


class Transducer:
    """States with labelled edges; the outputs along a term's path add up to its ordinal.

    ``first`` has the first edge of each state and the number of edges at its
    end. States with the same continuations are one state, whatever leads to
    them, so an edge's output is the number of terms that branch off before it.
    """

    def __init__(self, final: np.ndarray, first: np.ndarray, label: np.ndarray, target: np.ndarray, output: np.ndarray):
        self.final, self.first, self.label, self.target, self.output = final, first, label, target, output
        self.root = len(final) - 1
        state = np.repeat(np.arange(len(final), dtype=np.int64), np.diff(first))
        self.keys = state * 256 + label
        self.words, state = 0, self.root  # along the last edges: what branches off before them, and the last term
        while first[state] < first[state + 1]:
            self.words += int(output[first[state + 1] - 1])
            state = int(target[first[state + 1] - 1])
        self.words += int(final[state])

    @classmethod
    def build(cls, terms: Iterable[bytes]) -> Transducer:
        """From distinct terms in ascending order; what no later term can change is made minimal at once."""
        register: dict[tuple, int] = {}
        words: list[int] = []
        path: list[list] = [[False, []]]  # of the last term: whether a term ends here, and the finished edges
        last = None

        def finish(depth: int) -> None:
            while len(path) > depth + 1:
                final, edges = path.pop()
                path[-1][1].append((last[len(path) - 1], state_of(final, tuple(edges))))

        def state_of(final: bool, edges: tuple) -> int:
            found = register.setdefault((final, edges), len(words))
            if found == len(words):
                words.append(final + sum(words[target] for _, target in edges))
            return found

        for term in terms:
            if last is not None and term <= last:
                raise ValueError("terms must be distinct and ascending")
            same = len(commonprefix([last or b"", term]))
            finish(same)
            path.extend([False, []] for _ in range(len(term) - same))
            path[-1][0] = True
            last = term
        finish(0)
        final, edges = path[0]
        state_of(final, tuple(edges))  # the root, unlike any other state, is the last
        states = [*register]
        sizes = np.array([len(e) for _, e in states], np.int64)
        flat = [x for _, e in states for x in e]
        output = []
        for final, edges in states:
            before = int(final)
            for _, target in edges:
                output.append(before)
                before += words[target]
        return cls(
            np.array([f for f, _ in states], bool), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32),
            np.array([x for x, _ in flat], np.uint8), np.array([t for _, t in flat], np.int32), np.array(output, np.int32),
        )

    def __bytes__(self) -> bytes:
        parts = (self.final, self.first, self.label, self.target, self.output)
        return _HEAD.pack(len(self.final), len(self.label)) + b"".join(p.tobytes() for p in parts)

    @classmethod
    def read(cls, data: bytes) -> Transducer:
        states, edges = _HEAD.unpack_from(data)
        at, parts = _HEAD.size, []
        for kind, n in ((bool, states), (np.int32, states + 1), (np.uint8, edges), (np.int32, edges), (np.int32, edges)):
            parts.append(np.frombuffer(data, kind, n, at))
            at += n * np.dtype(kind).itemsize
        return cls(*parts)

    def ordinals(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The ordinal of each byte range, -1 if it is no term; all ranges go along their edges together."""
        out = np.full(len(start), -1, np.int64)
        state = np.full(len(start), self.root, np.int64)
        total = np.zeros(len(start), np.int64)
        at = start.astype(np.int64)
        alive = np.arange(len(start))
        while len(alive):
            over = at[alive] == end[alive]
            ended = alive[over]
            out[ended] = np.where(self.final[state[ended]], total[ended], -1)
            alive = alive[~over]
            if not len(alive) or not len(self.keys):
                break
            key = state[alive] * 256 + buf[at[alive]]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[edge] == key
            alive, edge = alive[known], edge[known]
            total[alive] += self.output[edge]
            state[alive] = self.target[edge]
            at[alive] += 1
        return out

    def term(self, ordinal: int) -> bytes:
        """The term with this ordinal: at each state, the last edge whose output does not go beyond it."""
        out, state = bytearray(), self.root
        while True:
            if ordinal == 0 and self.final[state]:
                return bytes(out)
            low, high = int(self.first[state]), int(self.first[state + 1])
            edge = low + int(np.searchsorted(self.output[low:high], ordinal, "right")) - 1
            out.append(int(self.label[edge]))
            ordinal -= int(self.output[edge])
            state = int(self.target[edge])
