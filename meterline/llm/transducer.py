"""A minimal acyclic transducer: sorted terms to their ordinals, and texts streamed through it."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Arcs(NamedTuple):
    """Arcs by `key` (state * 256 + byte): the states they lead to and what they add to the ordinal."""

    root: int
    key: np.ndarray
    to: np.ndarray
    add: np.ndarray
    final: np.ndarray

    def dump(self) -> bytes:
        head = np.array([self.root, len(self.key), len(self.final)], np.int64)
        return b"".join(part.tobytes() for part in (head, *self[1:]))

    @staticmethod
    def load(data: bytes) -> Arcs:
        root, arcs, states = np.frombuffer(data, np.int64, 3).tolist()
        key, to, add = np.frombuffer(data, np.int64, 3 * arcs, 24).reshape(3, arcs)
        return Arcs(root, key, to, add, np.frombuffer(data, bool, states, 24 + 24 * arcs))


def build(terms: Iterable[bytes]) -> Arcs:
    """The least transducer that gives each of `terms`, ascending and distinct, its place among them.

    Only the states along the last term can still change. What lies beyond its common prefix
    with the next one is closed: a state with the same arcs and finality as an earlier one is
    replaced by that. An arc adds the number of terms that come before those it leads to.
    """
    closed: dict[tuple, int] = {}
    states: list[tuple] = []
    counts: list[int] = []

    def close(final: bool, arcs: list[tuple[int, int]]) -> int:
        shape = (final, tuple(arcs))
        state = closed.setdefault(shape, len(states))
        if state == len(states):
            states.append(shape)
            counts.append(int(final) + sum(counts[to] for _, to in arcs))
        return state

    last = b""
    # For each byte of the last term the state it leaves, and then the state it ends in.
    finals, arcs = [False], [[]]

    def cut(size: int) -> None:
        while len(arcs) > size + 1:
            state = close(finals.pop(), arcs.pop())
            arcs[-1].append((last[len(arcs) - 1], state))

    for term in terms:
        shared = 0
        least = min(len(last), len(term))
        while shared < least and last[shared] == term[shared]:
            shared += 1
        cut(shared)
        for _ in term[shared:]:
            finals.append(False)
            arcs.append([])
        finals[-1] = True
        last = term
    cut(0)
    root = close(finals[0], arcs[0])

    keys, tos, adds = [], [], []
    for state, (final, leaving) in enumerate(states):
        before = int(final)
        for byte, to in leaving:
            keys.append(state << 8 | byte)
            tos.append(to)
            adds.append(before)
            before += counts[to]
    numbers = [np.array(column, np.int64) for column in (keys, tos, adds)]
    return Arcs(root, *numbers, np.array([final for final, _ in states], bool))


class Transducer:
    """`Arcs` made ready for whole texts: their keys lie in a hash table, at most half full."""

    def __init__(self, arcs: Arcs):
        self.arcs = arcs
        bits = max(4, int(2 * len(arcs.key)).bit_length())
        self._shift = np.uint64(64 - bits)
        self._mask = (1 << bits) - 1
        self._key = np.full(1 << bits, -1, np.int64)
        self._arc = np.zeros(1 << bits, np.int64)
        left = np.arange(len(arcs.key))
        slot = self._slot(arcs.key)
        while len(left):
            free = np.flatnonzero(self._key[slot] < 0)
            self._arc[slot[free]] = left[free]
            self._key[slot[free]] = arcs.key[self._arc[slot[free]]]
            placed = self._key[slot] == arcs.key[left]
            left, slot = left[~placed], (slot[~placed] + 1) & self._mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * _SPREAD) >> self._shift).astype(np.int64)

    def _follow(self, key: np.ndarray) -> np.ndarray:
        """The arc of each key, or -1."""
        slot = self._slot(key)
        held = self._key[slot]
        found = np.where(held == key, self._arc[slot], -1)
        left = np.flatnonzero((held != key) & (held >= 0))
        slot, key = slot[left], key[left]
        while len(left):
            slot = (slot + 1) & self._mask
            held = self._key[slot]
            hit = held == key
            found[left[hit]] = self._arc[slot[hit]]
            on = ~hit & (held >= 0)
            left, slot, key = left[on], slot[on], key[on]
        return found

    def ordinals(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The ordinal of each of the terms data[start:end], none of them empty, or -1.

        All terms go one byte on at a time; those that no arc takes on are let go, so a term
        longer than any known one costs no more steps than that.
        """
        result = np.full(len(starts), -1, np.int64)
        term, at, state = np.arange(len(starts)), starts, np.full(len(starts), self.arcs.root)
        total = np.zeros(len(starts), np.int64)
        while len(term):
            arc = self._follow(state << 8 | data[at])
            on = np.flatnonzero(arc >= 0)
            term, at, total, arc = term[on], at[on] + 1, total[on], arc[on]
            state, total = self.arcs.to[arc], total + self.arcs.add[arc]
            ended = at == ends[term]
            known = ended & self.arcs.final[state]
            result[term[known]] = total[known]
            on = np.flatnonzero(~ended)
            term, at, state, total = term[on], at[on], state[on], total[on]
        return result
