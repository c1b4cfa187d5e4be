"""The first splits of trees that learn from more rows than a task holds.

The rows stay in their chunks, and all trees gain a level at a time. A feature's values are counted in
bins. The sums at a bin's two ends bound what any place in it can gain, so only the bins that could
hold a better place than the best end are looked into, value by value: the split is the best of all.
Nodes of few enough rows are then sent to a task each, which grows the rest.
"""

from __future__ import annotations

import pickle
from collections import deque
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.operators import growing
from meterline.operators.growing import LEAF, Tree
from meterline.session import scratch_path


REST = 1 << 20


class Scale(NamedTuple):
    """Labels as whole numbers from 0 up, whose sums are exact."""

    low: float
    unit: float

    def whole(self, label: np.ndarray) -> np.ndarray:
        return np.rint((label - self.low) * self.unit) if self.unit else np.zeros(len(label))

    def rest(self, label: np.ndarray) -> np.ndarray:
        """What `whole` leaves of a label, in whole parts too, so that averages are as good as the labels."""
        left = (label - self.low) * self.unit - self.whole(label) if self.unit else np.zeros(len(label))
        return np.rint(left * REST)

    def label(self, whole: float, rest: float) -> float:
        return self.low + ((whole + rest / REST) / self.unit if self.unit else 0.0)


def scale(low: float, high: float, rows: int) -> Scale:
    """For labels from `low` to `high`; without an average, if one is infinite."""
    wide = high - low
    if not np.isfinite(wide):
        return Scale(low + high, 0.0)
    return Scale(low, 2.0 ** min(33, 61 - int(rows).bit_length()) / wide if wide else 0.0)


class Top:
    """A tree so far: nodes' features, values, left children, draws and impurities; the right child is the next."""

    def __init__(self, seed: int, tree: int):
        self.seed, self.tree = seed, tree
        self.feature, self.value, self.left, self.depth = [LEAF], [0.0], [0], [0]
        self.draws, self.impurity = [0], [0.0]
        # Nodes to be split here, and those that a task grows whole.
        self.open, self.rest = [0], []

    def route(self, columns: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The node of each of these rows."""
        feature, value, left = np.array(self.feature), np.array(self.value), np.array(self.left)
        node = np.zeros(len(rows), np.int64)
        for _ in range(max(self.depth)):
            at = np.flatnonzero(feature[node] != LEAF)
            own = node[at]
            node[at] = left[own] + (columns[feature[own], rows[at]] > value[own])
        return node

    def split(self, node: int, feature: int, value: float, left: int, most: int) -> None:
        self.feature[node], self.value[node], self.left[node] = feature, value, len(self.feature)
        for draws in (left, self.draws[node] - left):
            child = len(self.feature)
            for column, own in (
                (self.feature, LEAF), (self.value, 0.0), (self.left, child), (self.depth, self.depth[node] + 1),
                (self.draws, draws), (self.impurity, 0.0),
            ):
                column.append(own)
            (self.open if draws > most else self.rest).append(child)


class Chunk:
    """A chunk with the gaps filled."""

    def __init__(self, name: tuple[int, int], blob: bytes, fill: Sequence[float]):
        self.name = name
        self.packed = [
            (np.where(np.isnan(own), gap, own), at)
            for (own, at), gap in zip(pickle.loads(blob), [*fill, np.nan], strict=True)
        ]
        columns = [own[at] for own, at in self.packed]
        self.columns, self.label = np.stack(columns[:-1]), columns[-1]

    def drawn(self, top: Top) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rows that a tree draws, how often, and their nodes."""
        weight = growing.drawn(top.seed, top.tree, self.name, len(self.label))
        rows = np.flatnonzero(weight)
        return rows, weight[rows], top.route(self.columns, rows)

    def sent(self, top: Top) -> Iterator[tuple[int, bytes]]:
        """The rows of each node that a task grows whole, packed, the draws before the label."""
        rows, weight, node = self.drawn(top)
        for wanted in top.rest:
            some = np.flatnonzero(node == wanted)
            if len(some):
                columns = [(own, at[rows[some]]) for own, at in self.packed]
                columns.insert(-1, (np.arange(256.0), weight[some]))
                yield wanted, pickle.dumps([_present(*column) for column in columns], protocol=5)


def _present(values: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the values that no row has."""
    present = np.bincount(codes, minlength=len(values)) > 0
    places = growing._narrow(np.cumsum(present) - 1, len(values))
    return values[present], places[codes]


def received(blobs: dict[tuple[int, int], bytes], features: int) -> tuple[growing.Rows, np.ndarray]:
    """The rows of a node and their draws."""
    rows = growing.unpack(blobs, [0.0] * (features + 1))
    draws = rows.values[-1][rows.codes[-1]].astype(np.uint8)
    return rows._replace(values=rows.values[:-1], codes=rows.codes[:-1]), draws


class Bins(NamedTuple):
    """Of each feature where its bins end, and the least and the largest label of a bin's rows."""

    edges: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]


def ranges(chunks: Iterator[Chunk], edges: Sequence[np.ndarray], scaled: Scale) -> Bins:
    low, high = ([np.full(len(edge) + 1, sign * np.inf) for edge in edges] for sign in (1, -1))
    for chunk in chunks:
        whole = scaled.whole(chunk.label)
        for number, (edge, column) in enumerate(zip(edges, chunk.columns, strict=True)):
            at = np.searchsorted(edge, column)
            np.minimum.at(low[number], at, whole)
            np.maximum.at(high[number], at, whole)
    return Bins(list(edges), low, high)


def ends(columns: np.ndarray, bins: int = 256) -> list[np.ndarray]:
    """Where bins end, from some of the rows: any places will do, these have about as many rows each."""
    found = []
    for column in columns:
        known = np.unique(column)
        if len(known) > bins:
            known = np.unique(np.quantile(column, np.arange(1, bins) / bins, method="lower"))
        found.append(known)
    return found


def slots(top: Top) -> np.ndarray:
    """Of each node its place among the open ones, or -1."""
    found = np.full(len(top.feature), -1)
    found[top.open] = np.arange(len(top.open))
    return found


Sums = tuple[np.ndarray, np.ndarray]


def tally(chunks: Iterator[Chunk], tops: Sequence[Top], edges: Sequence[np.ndarray], scaled: Scale) -> list[Sums]:
    """For each tree the draws and labels by open node and bin, the features' bins one after the other,
    and the labels' squares and rests by open node."""
    bins = [len(edge) + 1 for edge in edges]
    begins = growing._runs(np.array(bins))
    sums = [(np.zeros((2, len(top.open), sum(bins)), np.int64), np.zeros((2, len(top.open)))) for top in tops]
    for chunk in chunks:
        whole, rest = scaled.whole(chunk.label), scaled.rest(chunk.label)
        binned = [np.searchsorted(edge, column) for edge, column in zip(edges, chunk.columns, strict=True)]
        for top, (total, (squares, rests)) in zip(tops, sums, strict=True):
            if not top.open:
                continue
            rows, weight, node = chunk.drawn(top)
            slot = slots(top)[node]
            rows, weight, slot = rows[slot >= 0], weight[slot >= 0].astype(np.float64), slot[slot >= 0]
            pull = weight * whole[rows]
            squares += np.bincount(slot, pull * whole[rows], len(top.open))
            rests += np.bincount(slot, weight * rest[rows], len(top.open))
            for begin, count, column in zip(begins, bins, binned, strict=True):
                key = slot * count + column[rows]
                for part, added in zip(total, (weight, pull), strict=True):
                    found = np.bincount(key, added, count * len(top.open)).reshape(-1, count)
                    part[:, begin : begin + count] += found.astype(np.int64)
    return sums


def gain(left: np.ndarray, pulled: np.ndarray, draws: int, pull: int) -> np.ndarray:
    """What a split makes the squared error less; a side without draws makes none."""
    right = draws - left
    with np.errstate(divide="ignore", invalid="ignore"):
        found = (pulled - pull * (left / draws)) ** 2 * draws / (left * 1.0 * right)
    return np.where((left > 0) & (right > 0), found, -np.inf)


class Found(NamedTuple):
    """The best split of a node so far, and the bins that may hold a better one: feature, bin, draws and
    labels before it."""

    gain: float
    feature: int
    value: float
    left: int
    draws: int
    pull: int
    square: float
    rest: float
    bins: list[tuple[int, int, int, int]]


def bound(sums: Sums, ranged: Bins) -> list[Found]:
    """Of each open node of a tree the best split between bins, and the bins to be looked into."""
    edges = ranged.edges
    found, bins = [], [len(edge) + 1 for edge in edges]
    begins = growing._runs(np.array(bins))
    for draws_of, pull_of, square, rest in zip(*sums[0], *sums[1], strict=True):
        draws, pull = int(draws_of[: bins[0]].sum()), int(pull_of[: bins[0]].sum())
        best, most = (-np.inf, LEAF, 0.0, 0), []
        for number, (begin, count) in enumerate(zip(begins, bins, strict=True)):
            left, pulled = (np.cumsum(part[begin : begin + count]) for part in (draws_of, pull_of))
            here = gain(left, pulled, draws, pull)
            at = int(here.argmax())
            if here[at] > best[0]:
                best = float(here[at]), number, float(edges[number][at]), int(left[at])
            own, pull_own = draws_of[begin : begin + count], pull_of[begin : begin + count]
            before, pulled_before = left - own, pulled - pull_own
            # A place in a bin has as many labels as its draws allow. Gains are convex in draws and labels,
            # so none is over those of the corners: the ends, all large labels first, all small ones first.
            low, high = ranged.low[number], ranged.high[number]
            with np.errstate(divide="ignore", invalid="ignore"):
                large = np.clip((pull_own - own * low) / (high - low), 0, own)
                small = np.clip((own * high - pull_own) / (high - low), 0, own)
            # Not a number where all labels are one, or no row is: the gains are then, and are left out.
            corners = [
                gain(before + large, pulled_before + large * high, draws, pull),
                gain(before + small, pulled_before + small * low, draws, pull),
            ]
            most.append((np.fmax(*corners), before, pulled_before, own > 1))
        inside = [
            (number, int(at), int(before[at]), int(pulled[at]))
            for number, (corner, before, pulled, several) in enumerate(most)
            for at in np.flatnonzero(several & (corner >= best[0] * (1 - 1e-9)) & (corner > draws))
        ]
        found.append(Found(*best, draws, pull, float(square), float(rest), inside))
    return found


def values(chunk: Chunk, tops: Sequence[Top], found: Sequence[list[Found]], edges: Sequence[np.ndarray], scaled: Scale) -> Iterator[tuple[int, bytes]]:
    """For each tree with bins to be looked into its place and the chunk's sums by open node, feature and value there."""
    whole = scaled.whole(chunk.label)
    known = [np.unique(own[at], return_inverse=True) for own, at in chunk.packed[:-1]]
    binned = [np.searchsorted(edge, own) for edge, (own, _) in zip(edges, known, strict=True)]
    for place, (top, nodes) in enumerate(zip(tops, found, strict=True)):
        asked = sorted({number for node in nodes for number, *_ in node.bins})
        if not asked:
            continue
        rows, weight, node = chunk.drawn(top)
        slot, parts, weight = slots(top)[node], [], weight.astype(np.float64)
        for number in asked:
            wanted = np.zeros((len(nodes) + 1, len(edges[number]) + 1), bool)
            for at, one in enumerate(nodes):
                wanted[at, [inside for own, inside, *_ in one.bins if own == number]] = True
            (own, codes), asked_of = known[number], wanted[:, binned[number]]
            some = np.flatnonzero(asked_of[slot, codes[rows]])
            if not len(some):
                continue
            key, size = slot[some] * len(own) + codes[rows[some]], len(nodes) * len(own)
            draws = np.bincount(key, weight[some], size)
            pull = np.bincount(key, weight[some] * whole[rows[some]], size)
            at = np.flatnonzero(draws)
            parts.append((number, at // len(own), own[at % len(own)], draws[at].astype(np.int64), pull[at].astype(np.int64)))
        if parts:
            yield place, pickle.dumps(parts, protocol=5)


def settle(blobs: Sequence[bytes], nodes: Sequence[Found], edges: Sequence[np.ndarray]) -> list[Found]:
    """Of each open node of a tree the best of all splits, from all chunks' sums by value."""
    parts = [part for blob in blobs for part in pickle.loads(blob)]
    settled = []
    for place, node in enumerate(nodes):
        best = node[:4]
        for number in sorted({own for own, *_ in node.bins}):
            own = [[part[at][part[1] == place] for at in (2, 3, 4)] for part in parts if part[0] == number]
            if not own:
                continue
            value, draws, pull = (np.concatenate(column) for column in zip(*own, strict=True))
            known, code = np.unique(value, return_inverse=True)
            total = [np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)]
            np.add.at(total[0], code, draws)
            np.add.at(total[1], code, pull)
            bins = np.searchsorted(edges[number], known)
            for _, at, before, pulled in (one for one in node.bins if one[0] == number):
                inside = np.flatnonzero(bins == at)
                if not len(inside):
                    continue
                left, pulls = before + np.cumsum(total[0][inside]), pulled + np.cumsum(total[1][inside])
                here = gain(left, pulls, node.draws, node.pull)
                top = int(here.argmax())
                better = float(here[top]), number, float(known[inside[top]]), int(left[top])
                if better[0] > best[0] or better[0] == best[0] and better[1:3] < best[1:3]:
                    best = better
        settled.append(Found(*best, *node[4:8], []))
    return settled


def advance(top: Top, nodes: Sequence[Found], scaled: Scale, most: int, depth: int) -> None:
    """Split the open nodes, but those at the last level or that no split makes better: these are leaves."""
    now, top.open = top.open, []
    for node, one in zip(now, nodes, strict=True):
        top.draws[node] = one.draws
        if one.draws <= most:
            top.rest.append(node)
        # Rounding alone makes a gain of a quarter for each draw at most.
        elif top.depth[node] < depth and one.feature != LEAF and one.gain > one.draws:
            top.split(node, one.feature, one.value, one.left, most)
        else:
            mean = one.pull / one.draws
            top.value[node] = scaled.label(mean, one.rest / one.draws)
            if scaled.unit:
                top.impurity[node] = max(one.square / one.draws - mean * mean, 0.0) / scaled.unit**2


def joined(top: Top, grown: dict[int, Tree]) -> Tree:
    """The first splits and what was grown below them as one tree, level by level."""
    left_of = {node: growing.children(tree.feature) for node, tree in grown.items()}
    feature, value, count, impurity, above = [], [], [], [], []
    queue = deque([(None, 0)])
    while queue:
        root, at = queue.popleft()
        if root is None and at in grown:
            root, at = at, 0
        if root is None:
            own, left = (top.feature[at], top.value[at], top.draws[at], top.impurity[at]), top.left[at]
            above.append(len(feature))
        else:
            own, left = (part[at] for part in grown[root]), left_of[root][at]
        for column, part in zip((feature, value, count, impurity), own, strict=True):
            column.append(part)
        if feature[-1] != LEAF:
            queue.extend([(root, left), (root, left + 1)])
    tree = Tree(np.array(feature, np.int8), np.array(value, float), np.array(count, np.int64), np.array(impurity, float))
    _spread_above(tree, [at for at in above if feature[at] != LEAF])
    return tree


def _spread_above(tree: Tree, above: list[int]) -> None:
    """Put in the impurity of the first nodes, from those below."""
    left, total = growing.children(tree.feature), tree.count * tree.value
    for at in np.flatnonzero(tree.feature != LEAF)[::-1]:
        total[at] = total[left[at]] + total[left[at] + 1]
    for at in sorted(above, reverse=True):
        sides = [left[at], left[at] + 1]
        mean = total[at] / tree.count[at]
        error = sum(tree.count[s] * (tree.impurity[s] + (total[s] / tree.count[s] - mean) ** 2) for s in sides)
        tree.impurity[at] = error / tree.count[at]


# How many numbers the sums of the trees that are split together may be, and how many times the rows
# the draws that are sent at once.
TOGETHER, SENT = 1 << 23, 16
_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def grown(
    chunks: DataFrame,
    fill: Sequence[float],
    scaled: Scale,
    rows: int,
    seeds: Sequence[tuple[int, int]],
    depth: int,
    most: int,
    room: int,
) -> DataFrame:
    """A tree for each seed and number of `seeds`, its place among them as `which`. A task grows nodes of
    `most` draws at most, with tables of `room` numbers at most."""
    spark = chunks.sparkSession
    tasks = 2 * spark.sparkContext.defaultParallelism
    trees = [Top(*seed) for seed in seeds]
    ranged = _bins(chunks, fill, scaled, rows)
    numbers = 2 * sum(len(edge) + 1 for edge in ranged.edges)
    while any(top.open for top in trees):
        for together in _groups([len(top.open) * numbers for top in trees], TOGETHER):
            group = [trees[at] for at in together]
            for top, nodes in zip(group, _best(chunks, fill, scaled, group, ranged, tasks), strict=True):
                advance(top, nodes, scaled, most, depth)
    below = scratch_path(spark, "subtrees")
    before = spark.conf.get(_CLEANED, None)
    # Else what each lot has sent stays on disk as long as the application.
    spark.conf.set(_CLEANED, "true")
    try:
        for together in _groups([sum(top.draws[node] for node in top.rest) for top in trees], SENT * rows):
            sent = {at: trees[at] for at in together if trees[at].rest}
            if sent:
                _grown_below(chunks, fill, sent, depth, room).write.mode("append").parquet(below)
    finally:
        spark.conf.unset(_CLEANED) if before is None else spark.conf.set(_CLEANED, before)
    # Every tree has a row, whether anything was grown below its first splits or not.
    found = spark.range(len(trees)).selectExpr("CAST(id AS INT) AS which")
    if any(top.rest for top in trees):
        found = found.unionByName(spark.read.parquet(below), allowMissingColumns=True)
    else:
        found = found.selectExpr("*", "CAST(NULL AS INT) AS node", *[f"CAST(NULL AS BINARY) AS {name}" for name in Tree._fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, dict[int, Tree]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = known.setdefault(row["which"], {})
                if row["node"] is not None:
                    own[row["node"]] = growing.read([row[name] for name in Tree._fields])
        for which, parts in known.items():
            told = {name: [part] for name, part in zip(Tree._fields, growing.written(joined(trees[which], parts)), strict=True)}
            yield pa.RecordBatch.from_pydict({"which": pa.array([which], pa.int32()), **told})

    columns = ", ".join(f"{name} binary" for name in Tree._fields)
    whole = found.repartitionById(tasks, F.pmod("which", F.lit(tasks)).cast("int"))
    return whole.mapInArrow(run, f"which int, {columns}")


def _groups(sizes: Sequence[int], most: int) -> Iterator[list[int]]:
    """Places one after the other, as many at a time as have `most` together; none of size 0."""
    group, total = [], 0
    for at, size in enumerate(sizes):
        if group and total + size > most:
            yield group
            group, total = [], 0
        if size:
            group.append(at)
            total += size
    if group:
        yield group


def _read(batches: Iterator[pa.RecordBatch], fill: Sequence[float]) -> Iterator[Chunk]:
    for batch in batches:
        for part, chunk, blob in zip(*(batch[name] for name in ("part", "chunk", "blob")), strict=True):
            yield Chunk((part.as_py(), chunk.as_py()), blob.as_py(), fill)


def _told(which: int, blob: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"which": pa.array([which], pa.int32()), "blob": pa.array([blob], pa.binary())})


_TOLD = "which int, blob binary"


def _bins(chunks: DataFrame, fill: Sequence[float], scaled: Scale, rows: int) -> Bins:
    step = max(1, rows >> 16)

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _read(batches, fill):
            yield _told(0, pickle.dumps(chunk.columns[:, ::step], protocol=5))

    found = chunks.mapInArrow(some, _TOLD).collect()
    edges = ends(np.concatenate([pickle.loads(row["blob"]) for row in found], axis=1))

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _told(0, pickle.dumps(ranges(_read(batches, fill), edges, scaled), protocol=5))

    found = [pickle.loads(row["blob"]) for row in chunks.mapInArrow(ranged, _TOLD).collect()]
    low = [np.min(own, axis=0) for own in zip(*(one.low for one in found), strict=True)]
    high = [np.max(own, axis=0) for own in zip(*(one.high for one in found), strict=True)]
    return Bins(edges, low, high)


def _best(
    chunks: DataFrame, fill: Sequence[float], scaled: Scale, group: Sequence[Top], ranged: Bins, tasks: int
) -> list[list[Found]]:
    """The best split of each open node of these trees."""
    edges = ranged.edges

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for which, sums in enumerate(tally(_read(batches, fill), group, edges, scaled)):
            yield _told(which, pickle.dumps(sums, protocol=5))

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                sums = pickle.loads(row["blob"])
                before = total.setdefault(row["which"], [np.zeros_like(part) for part in sums])
                for part, added in zip(before, sums, strict=True):
                    part += added
        for which, sums in total.items():
            yield _told(which, pickle.dumps(bound(sums, ranged), protocol=5))

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartitionById(tasks, F.pmod("which", F.lit(tasks)).cast("int"))

    def collected(df: DataFrame) -> dict[int, list[Found]]:
        return {row["which"]: pickle.loads(row["blob"]) for row in df.collect()}

    found = collected(dealt(chunks.mapInArrow(told, _TOLD)).mapInArrow(bounded, _TOLD))
    nodes = [found[which] for which in range(len(group))]
    if not any(node.bins for own in nodes for node in own):
        return nodes

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _read(batches, fill):
            for which, blob in values(chunk, group, nodes, edges, scaled):
                yield _told(which, blob)

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[int, list[bytes]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                blobs.setdefault(row["which"], []).append(row["blob"])
        for which, own in blobs.items():
            yield _told(which, pickle.dumps(settle(own, nodes[which], edges), protocol=5))

    better = collected(dealt(chunks.mapInArrow(inside, _TOLD)).mapInArrow(settled, _TOLD))
    return [better.get(which, own) for which, own in enumerate(nodes)]


def _grown_below(chunks: DataFrame, fill: Sequence[float], sent: dict[int, Top], depth: int, room: int) -> DataFrame:
    """What a task each grows from the nodes of these trees that are small enough."""
    items = [(which, node) for which, top in sent.items() for node in top.rest]
    task_of = {item: task for task, item in enumerate(items)}
    kinds = pa.schema([(name, pa.int32()) for name in ("task", "part", "chunk")] + [("blob", pa.binary())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _read(batches, fill):
            for which, top in sent.items():
                told = [(task_of[which, node], *chunk.name, blob) for node, blob in chunk.sent(top)]
                if told:
                    yield pa.RecordBatch.from_arrays([pa.array(own, kind.type) for own, kind in zip(zip(*told), kinds)], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[int, dict[tuple[int, int], bytes]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                blobs.setdefault(row["task"], {})[row["part"], row["chunk"]] = row["blob"]
        for task in list(blobs):
            which, node = items[task]
            rows, draws = received(blobs.pop(task), len(fill))
            tree = growing.grow(rows, draws, depth - sent[which].depth[node], room)
            told = {name: [part] for name, part in zip(Tree._fields, growing.written(tree), strict=True)}
            yield pa.RecordBatch.from_pydict({"which": pa.array([which], pa.int32()), "node": pa.array([node], pa.int32()), **told})

    columns = ", ".join(f"{name} binary" for name in Tree._fields)
    dealt = chunks.mapInArrow(send, "task int, part int, chunk int, blob binary").repartitionById(len(items), F.col("task"))
    return dealt.mapInArrow(run, f"which int, node int, {columns}")
