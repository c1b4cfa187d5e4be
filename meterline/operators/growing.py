"""Regression trees grown on rows in memory: every split between two values of a feature is tried.

Rows come in chunks, a chunk's column as its distinct values and each row's place among them. A tree
is stored level by level, the left child of a node next before the right one, as the features its
nodes ask for (LEAF for none) and their values: thresholds, of leaves the prediction.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np

LEAF = -1
# Rows of a chunk, each of which draws its rows' weights by itself.
CHUNK = 1 << 16


class Rows(NamedTuple):
    """Of each feature the distinct values in order and each row's place among them, the labels, the
    chunks' names and where they begin."""

    values: list[np.ndarray]
    codes: list[np.ndarray]
    label: np.ndarray
    chunks: list[tuple[int, int]]
    begins: np.ndarray


class Tree(NamedTuple):
    feature: np.ndarray
    value: np.ndarray
    count: np.ndarray
    impurity: np.ndarray


def _narrow(codes: np.ndarray, most: int) -> np.ndarray:
    if most > 1 << 31:
        return codes
    return codes.astype(np.min_scalar_type(max(most - 1, 0)) if most <= 1 << 16 else np.int32)


def pack(columns: Sequence[np.ndarray]) -> bytes:
    """A chunk's columns, the label last."""
    packed = []
    for column in columns:
        values, codes = np.unique(column, return_inverse=True)
        packed.append((values, _narrow(codes, len(values))))
    return pickle.dumps(packed, protocol=5)


def unpack(chunks: dict[tuple[int, int], bytes], fill: Sequence[float]) -> Rows:
    """All chunks' rows, in the order of the chunks' names, gaps filled with each feature's `fill`."""
    names = sorted(chunks)
    parts = [pickle.loads(chunks[name]) for name in names]
    values, codes = [], []
    for column, gap in zip(zip(*parts, strict=True), [*fill, np.nan], strict=True):
        column = [(np.where(np.isnan(own), gap, own), at) for own, at in column]
        known = np.unique(np.concatenate([own for own, _ in column]))
        placed = [_narrow(np.searchsorted(known, own), len(known))[at] for own, at in column]
        values.append(known)
        codes.append(np.concatenate(placed))
    begins = np.cumsum([0, *(len(part[0][1]) for part in parts)])
    return Rows(values[:-1], codes[:-1], values[-1][codes[-1]], names, begins)


def weights(rows: Rows, seed: int, tree: int) -> np.ndarray:
    """How often each row is drawn for a tree: as in draws with replacement, Poisson with a mean of 1.
    A chunk's depend on its name, not on the other chunks."""
    sizes = np.diff(rows.begins)
    return np.concatenate([drawn(seed, tree, name, size) for name, size in zip(rows.chunks, sizes, strict=True)])


def drawn(seed: int, tree: int, name: tuple[int, int], size: int) -> np.ndarray:
    """The weights of one chunk's rows."""
    return np.random.default_rng([seed, tree, *name]).poisson(1.0, size).astype(np.uint8)


def _runs(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes)[:-1]))


def _by_table(code, count, place, weight, pull, sums):
    """The best split of each node by a table of all values for each: gain, last value on the left, next value."""
    nodes, (whole, pulled) = len(sums[0]), sums
    key = place * np.int64(count) + code
    size = nodes * count
    left = np.cumsum(np.bincount(key, weight, size).reshape(nodes, count), axis=1)
    pull = np.cumsum(np.bincount(key, pull, size).reshape(nodes, count), axis=1)
    right = whole[:, None] - left
    # A value that no row of the node has leaves the sums as they are: the first of equal ones is taken.
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = pull * pull / left + (pulled[:, None] - pull) ** 2 / right
    gain[(left == 0) | (right == 0)] = -np.inf
    at = gain.argmax(axis=1)
    each = np.arange(nodes)
    following = (left > left[each, at][:, None]).argmax(axis=1)
    return gain[each, at], at, following


def _by_order(code, place, begins, weight, pull, sums):
    """As above, from rows in the order of their nodes and values."""
    nodes, (whole, pulled) = len(sums[0]), sums
    ends = code[1:] != code[:-1]
    ends[begins[1:] - 1] = False
    at = np.flatnonzero(ends)
    best, last, following = np.full(nodes, -np.inf), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    if not len(at):
        return best, last, following
    node = place[at]
    weight, pull = np.cumsum(weight), np.cumsum(pull)
    left, pulled_left = weight[at], pull[at]
    first = begins[1:] - 1
    left -= np.concatenate(([0], weight[first]))[node]
    pulled_left -= np.concatenate(([0], pull[first]))[node]
    gain = pulled_left * pulled_left / left
    pulled_left -= pulled[node]
    left -= whole[node]
    gain -= pulled_left * pulled_left / left
    new = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    best[node[new]] = np.maximum.reduceat(gain, new)
    hit = np.flatnonzero(gain == best[node])[::-1]
    found = np.full(nodes, -1, np.int64)
    found[node[hit]] = at[hit]
    has = found >= 0
    last[has], following[has] = code[found[has]], code[found[has] + 1]
    return best, last, following


def grow(rows: Rows, weight: np.ndarray, depth: int, room: int = 1 << 25) -> Tree:
    """A tree on the rows that have a weight. A split is the one of least squared error over all places
    between two values of a feature, the first of equal ones; a node with one label, at the last level
    or that no split makes better is a leaf. `room` is how many numbers a table may have: more
    values and nodes are searched in sorted order, with the same result.

    Labels count as whole multiples of a small part of their node's spread, so few that their sums are
    exact: the order in which they are added makes no difference.
    """
    some = np.flatnonzero(weight)
    if not len(some):
        some = np.arange(min(1, len(weight)))
        weight = np.ones(len(weight), np.uint8)
    codes = [code[some] for code in rows.codes]
    label, weight = rows.label[some], weight[some].astype(np.float64)
    exact = 2.0**52 / weight.sum()
    order, orders = np.arange(len(some), dtype=np.int32), {}
    sizes = np.array([len(some)])
    side, pull = np.empty(len(some), np.int8), np.empty(len(some))
    levels: list[Tree] = []
    for level in range(depth + 1):
        begins, nodes = _runs(sizes), len(sizes)
        own, w = label[order], weight[order]
        count = np.add.reduceat(w, begins)
        mean = np.add.reduceat(w * own, begins) / count
        low, high = np.minimum.reduceat(own, begins), np.maximum.reduceat(own, begins)
        # The average of one label is that label, and no average leaves its labels.
        mean = np.clip(mean, low, high)
        place = np.repeat(np.arange(nodes, dtype=np.int32), sizes)
        with np.errstate(invalid="ignore"):
            away = own - mean[place]
            impurity = np.add.reduceat(w * away * away, begins) / count
            wide = np.maximum(high - mean, mean - low)
        feature, value = np.full(nodes, LEAF, np.int8), mean
        levels.append(Tree(feature, value, count, impurity))
        open_ = (low < high) & np.isfinite(wide)
        if level == depth or not open_.any():
            break
        best, cut = np.zeros(nodes), np.zeros(nodes, np.int64)
        with np.errstate(divide="ignore", invalid="ignore"):
            unit = np.where(open_, exact / wide, 0)
        moved = np.rint(away * unit[place]) * w
        pull[order] = moved
        del own, away
        sums = count, np.add.reduceat(moved, begins)
        before = sums[1] ** 2 / count
        for number, (code, known) in enumerate(zip(codes, rows.values, strict=True)):
            if len(known) < 2:
                continue
            if number not in orders and nodes * len(known) <= min(room, max(2 * len(order), 1 << 12)):
                found = _by_table(code[order], len(known), place, w, moved, sums)
            else:
                if number not in orders:
                    key = place * np.int64(len(known)) + code[order]
                    # The sort of short numbers is the faster one.
                    orders[number] = order[np.argsort(_narrow(key, nodes * len(known)), kind="stable")]
                    del key
                sorted_ = orders[number]
                found = _by_order(code[sorted_], place, begins, weight[sorted_], pull[sorted_], sums)
            gain = found[0] - before
            # Rounding alone makes a gain of a quarter for each row at most.
            better = open_ & (gain > count) & (gain > best)
            if better.any():
                best[better], cut[better], feature[better] = gain[better], found[1][better], number
                left, right = known[found[1][better]], known[found[2][better]]
                with np.errstate(over="ignore", invalid="ignore"):
                    middle = left + (right - left) / 2
                value[better] = np.where((middle >= left) & (middle < right), middle, left)
        split = feature != LEAF
        if not split.any():
            break
        asked = feature[place]
        goes = np.full(len(order), 2, np.int8)
        for number in np.unique(feature[split]):
            at = np.flatnonzero(asked == number)
            goes[at] = codes[number][order[at]] <= cut[place[at]]
        side[order] = goes
        lefts = np.bincount(place[goes == 1], minlength=nodes)[split]
        sizes = np.concatenate((lefts, sizes[split] - lefts))
        order = np.concatenate((order[goes == 1], order[goes == 0]))
        for number, sorted_ in orders.items():
            goes = side[sorted_]
            orders[number] = np.concatenate((sorted_[goes == 1], sorted_[goes == 0]))
    return _joined(levels)


def _joined(levels: list[Tree]) -> Tree:
    """One tree of levels whose left children all come before the right ones."""
    placed, at = [], np.zeros(1, np.int64)
    for number, level in enumerate(levels):
        own = np.argsort(at)
        placed.append(Tree(*(part[own] for part in level)))
        if number + 1 < len(levels):
            split = np.flatnonzero(level.feature != LEAF)
            rank = np.argsort(np.argsort(at[split]))
            at = np.concatenate((2 * rank, 2 * rank + 1))
    joined = [np.concatenate(parts) for parts in zip(*placed, strict=True)]
    return Tree(joined[0].astype(np.int8), joined[1], joined[2].astype(np.int64), joined[3])


_KINDS = Tree(np.int8, np.float64, np.int64, np.float64)


def written(tree: Tree) -> list[bytes]:
    return [part.astype(kind).tobytes() for part, kind in zip(tree, _KINDS, strict=True)]


def read(parts: Sequence[bytes]) -> Tree:
    return Tree(*(np.frombuffer(part, kind) for part, kind in zip(parts, _KINDS, strict=True)))


def children(feature: np.ndarray) -> np.ndarray:
    """The left child of each node; of a leaf the leaf itself."""
    inner = feature != LEAF
    return np.where(inner, 2 * np.cumsum(inner) - 1, np.arange(len(feature))).astype(np.int32)


def predict(trees: Sequence[tuple[np.ndarray, np.ndarray, np.ndarray]], columns: Sequence[np.ndarray]) -> np.ndarray:
    """The sum of the trees' predictions; a tree is its nodes' features, values and left children."""
    rows = len(columns[0])
    # A leaf asks for the last of these, which sends every row back to it.
    given = np.stack([*columns, np.full(rows, -np.inf)])
    flat, row, total = given.ravel(), np.arange(rows), np.zeros(rows)
    starts = np.append(np.arange(len(columns)), len(columns)) * rows
    for feature, value, left in trees:
        base = starts[feature]
        node = np.zeros(rows, np.int32)
        while True:
            following = left[node] + (flat[base[node] + row] > value[node])
            if (following == node).all():
                break
            node = following
        total += value[node]
    return total
