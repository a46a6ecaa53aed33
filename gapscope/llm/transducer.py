"""Minimal acyclic transducer over a sorted list of terms: term to ordinal and back.

Built in one pass over the sorted terms: when a term leaves the path of the one
before it, the states left behind are finished, and a finished state that equals a
known one (same end mark, same arcs) is replaced by it.  An arc's output is how many
terms come before those that go through it, so the outputs along a term's path add
up to its place in the order (its ordinal).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

_ONE = np.uint64(1)
_BIT = _ONE << np.arange(64, dtype=np.uint64)


@dataclass
class Transducer:
    """States are numbered children first, the root last; the arcs of state s are ``first[s]`` to ``first[s + 1]``."""

    final: np.ndarray
    first: np.ndarray
    label: np.ndarray
    target: np.ndarray

    def __post_init__(self):
        states = len(self.final)
        # which bytes leave a state: four words of bits, with the arcs before each word, so that an arc is found by counting bits
        cell = np.repeat(np.arange(states) * 4, np.diff(self.first)) + (self.label >> 6)
        self.bits = np.zeros(states * 4, np.uint64)
        np.bitwise_or.at(self.bits, cell, _BIT[self.label & 63])
        ones = np.bitwise_count(self.bits).astype(np.int32)
        self.arcs_before = np.cumsum(ones, dtype=np.int32) - ones
        terms, self.output = np.zeros(states, np.int64), np.zeros(len(self.target), np.int64)
        for s in range(states):  # children come first
            low, high = self.first[s], self.first[s + 1]
            below = terms[self.target[low:high]]
            self.output[low:high] = self.final[s] + np.cumsum(below) - below
            terms[s] = self.final[s] + below.sum()
        self.size = int(terms[-1])

    def to_bytes(self) -> bytes:
        head = np.array([len(self.final), len(self.target)], "<i4")
        return b"".join(x.tobytes() for x in (head, self.first, self.target, self.final, self.label))

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        states, arcs = np.frombuffer(data, "<i4", 2)
        first = np.frombuffer(data, "<i4", states + 1, 8)
        target = np.frombuffer(data, "<i4", arcs, 12 + 4 * states)
        rest = np.frombuffer(data, np.uint8, offset=12 + 4 * states + 4 * arcs)
        return cls(rest[:states], first, rest[states:], target)

    def ordinals(self, words: list[bytes]) -> np.ndarray:
        """The ordinal of each word, -1 for a word that is no term; all words move a byte at a time, until none is left."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(size) - size
        text = np.frombuffer(b"".join(words), np.uint8)
        out = np.full(len(words), -1, np.int64)
        going, at = np.arange(len(words)), 0
        state, sums = np.full(len(words), len(self.final) - 1), np.zeros(len(words), np.int64)
        while len(going):
            done = size[going] == at
            ended = done & (self.final[state] > 0)
            out[going[ended]] = sums[ended]
            going, state, sums = going[~done], state[~done], sums[~done]
            byte = text[start[going] + at]
            cell, bit = state * 4 + (byte >> 6), _BIT[byte & 63]
            leaving = self.bits[cell]
            there = (leaving & bit) != 0
            smaller = np.bitwise_count(leaving[there] & (bit[there] - _ONE))
            arc = self.arcs_before[cell[there]] + smaller
            going, state, sums = going[there], self.target[arc].astype(np.int64), sums[there] + self.output[arc]
            at += 1
        return out

    def terms(self) -> Iterator[bytes]:
        """All terms in order of their ordinals."""
        path = [(len(self.final) - 1, b"")]
        while path:
            state, spelled = path.pop()
            if self.final[state]:
                yield spelled
            arcs = range(self.first[state + 1] - 1, self.first[state] - 1, -1)
            path += [(int(self.target[a]), spelled + bytes([self.label[a]])) for a in arcs]


def build(terms: Iterable[bytes]) -> Transducer:
    """The transducer of distinct terms in ascending order of their bytes."""
    known: dict[tuple, int] = {}
    path: list[list] = [[False, [], []]]  # unfinished states: end mark, labels, targets of all but the last label

    def finish(length: int) -> None:
        while len(path) > length:
            final, labels, targets = path.pop()
            state = known.setdefault((final, bytes(labels), tuple(targets)), len(known))
            if path:
                path[-1][2].append(state)

    before = b""
    for n, term in enumerate(terms):
        if n and term <= before:
            raise ValueError(f"terms are not in ascending order: {before!r}, {term!r}")
        shared = next((i for i, (a, b) in enumerate(zip(before, term)) if a != b), min(len(before), len(term)))
        finish(shared + 1)
        for byte in term[shared:]:
            path[-1][1].append(byte)
            path.append([False, [], []])
        path[-1][0] = True
        before = term
    finish(0)
    return Transducer(np.array([k[0] for k in known], np.uint8), np.cumsum([0, *(len(k[1]) for k in known)]).astype("<i4"),
                      np.frombuffer(b"".join(k[1] for k in known), np.uint8),
                      np.array([t for k in known for t in k[2]], "<i4"))
