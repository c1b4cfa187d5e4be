"""Embedding near-dedup by a pivot-permutation index.

Every vector is described by its NEAREST reference points (pivots) of PIVOTS, in order of
nearness. Vectors that lie close together see the same pivots as near. A vector is filed
in an inverted list for each SHARED of its nearest pivots taken together, so two vectors meet
in a list exactly if they share that many, and what meets is verified by its cosine. Lists
are compared in blocks of limited size, and links are counted and joined up where they are
found, so no pair leaves its task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.common import stored
from meterline.llm.components import components

PIVOTS = 256
NEAREST = 7
SHARED = 3
# Pivots are taken from so many vectors, those of the least hashes, and no closer than this.
SAMPLE = 4096
APART = 0.7
# Rows of a list that are compared at a time with as many others, and rows of lists held together.
BLOCK = 1024
TOGETHER = 8192


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one, in double precision; no row may be zero."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def choose_pivots(sample: list[np.ndarray]) -> dict[int, np.ndarray]:
    """PIVOTS pivots for each dimension in the sample, filled up with random directions."""
    by_size: dict[int, list[np.ndarray]] = {}
    for vector in sample:
        by_size.setdefault(len(vector), []).append(vector)
    return {size: _apart(unit(np.array(vectors)), size) for size, vectors in by_size.items()}


def _apart(vectors: np.ndarray, size: int) -> np.ndarray:
    chosen = random_pivots(size)
    count = 0
    for vector in vectors:
        if count < PIVOTS and (count == 0 or (chosen[:count] @ vector).max() < APART):
            chosen[count] = vector
            count += 1
    return chosen


def random_pivots(size: int) -> np.ndarray:
    return unit(np.random.default_rng(size).standard_normal((PIVOTS, size)))


def _vectors(column: pa.ListArray) -> list[np.ndarray]:
    flat = column.values.to_numpy()
    offsets = column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def _describe(classes: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """vec, weight, vector and `pivots`: the nearest pivots of each vector, nearest first."""
    kind = classes.schema["vector"].dataType.simpleString()
    shared = classes.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch.column("vector"))
            sizes = np.array([len(v) for v in vectors], np.int64)
            nearest = np.zeros((len(vectors), NEAREST), np.int32)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                points = shared.value.get(int(size))
                points = random_pivots(int(size)) if points is None else points
                closeness = unit(np.array([vectors[row] for row in rows])) @ points.T
                nearest[rows] = np.argsort(-closeness, axis=1, kind="stable")[:, :NEAREST]
            ends = pa.array(np.arange(0, nearest.size + 1, NEAREST, dtype=np.int32))
            columns = [batch.column("vec"), batch.column("weight"), batch.column("vector")]
            columns.append(pa.ListArray.from_arrays(ends, pa.array(nearest.ravel())))
            yield pa.RecordBatch.from_arrays(columns, ["vec", "weight", "vector", "pivots"])

    return classes.mapInArrow(run, f"vec long, weight long, vector {kind}, pivots array<int>")


def _filed(described: DataFrame) -> DataFrame:
    """list and vec: a vector's lists, one for each SHARED of its pivots in ascending order."""
    held = F.sort_array("pivots")
    sets = [
        F.array(*[F.get(F.col("_pivots"), F.lit(place)) for place in places])
        for places in combinations(range(NEAREST), SHARED)
    ]
    names = described.select("vec", F.size("vector").alias("_size"), held.alias("_pivots"))
    each = names.select("vec", "_size", F.explode(F.array(*sets)).alias("_set"))
    number = F.aggregate("_set", F.col("_size").cast("long"), lambda total, pivot: total * PIVOTS + pivot)
    return each.select(number.alias("list"), "vec")


def _links(rows: pa.Table, threshold: float) -> pa.RecordBatch:
    """vec, links (their weights) and root of the vectors of whole blocks that link within them."""
    rows = rows.combine_chunks()
    vectors = _vectors(rows.column("vector").chunk(0))
    size = len(vectors[0])
    points = unit(np.array(vectors)) if all(len(v) == size for v in vectors) else None
    vec, weight = rows.column("vec").to_numpy(), rows.column("weight").to_numpy()
    names = np.stack([rows.column(name).to_numpy() for name in ("list", "block")], 1)
    side = rows.column("side").to_numpy()
    seen = np.zeros((len(vec), PIVOTS), bool)
    seen[np.arange(len(vec))[:, None], np.array(rows.column("pivots").to_pylist())] = True

    cuts = np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1
    lefts, rights = [], []
    for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(vec)], strict=True):
        if end - begin < 2:
            continue
        # All of a list's vectors have one dimension, as its name holds it.
        mine = points[begin:end] if points is not None else unit(np.array(vectors[begin:end]))
        sides = side[begin:end]
        left = np.flatnonzero(sides == 0)
        right = np.flatnonzero(sides == 1)
        whole = not len(right)
        right = left if whole else right
        a, b = np.nonzero(mine[left] @ mine[right].T >= threshold)
        if whole:
            a, b = a[a < b], b[a < b]
        if not len(a):
            continue
        a, b = begin + left[a], begin + right[b]
        # Of all lists in which two meet, that of their first shared pivots counts.
        last = int(names[begin, 0]) % PIVOTS
        both = seen[a, : last + 1] & seen[b, : last + 1]
        counts = both.sum(1) == SHARED
        lefts.append(a[counts])
        rights.append(b[counts])
    left = np.concatenate(lefts) if lefts else np.zeros(0, np.int64)
    right = np.concatenate(rights) if rights else np.zeros(0, np.int64)

    links = np.bincount(left, weight[right], len(vec)) + np.bincount(right, weight[left], len(vec))
    root = vec.copy()
    while True:
        before = root.copy()
        np.minimum.at(root, left, before[right])
        np.minimum.at(root, right, before[left])
        if (root == before).all():
            break
    hit = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [pa.array(vec[hit]), pa.array(links[hit].astype(np.int64)), pa.array(root[hit])], ["vec", "links", "root"]
    )


def _compare(described: DataFrame, threshold: float) -> DataFrame:
    """vec, links and root from every block of every list with two vectors or more."""
    filed = _filed(described)
    sizes = filed.groupBy("list").agg(F.count(F.lit(1)).alias("_held")).filter("_held > 1")
    filed = filed.join(stored(sizes, "vector_lists"), "list")
    # A list of several blocks: each vector goes to the pairs of its block with all others.
    filed = filed.withColumn("_blocks", F.ceil(F.col("_held") / F.lit(BLOCK)))
    filed = filed.withColumn("_mine", F.pmod(F.xxhash64("vec"), F.col("_blocks")))
    filed = filed.select("list", "vec", "_blocks", "_mine", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other"))
    low, high = F.least("_mine", "_other"), F.greatest("_mine", "_other")
    placed = filed.select(
        "list", (low * F.col("_blocks") + high).alias("block"), (F.col("_mine") > low).cast("int").alias("side"), "vec"
    )
    rows = placed.join(described, "vec").select("list", "block", "side", "vec", "weight", "vector", "pivots")
    rows = rows.repartition("list", "block").sortWithinPartitions("list", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            name = np.stack([batch.column(n).to_numpy() for n in ("list", "block")], 1)
            if held:
                last = [held[-1].column(n)[-1].as_py() for n in ("list", "block")]
                if size >= TOGETHER and last != name[0].tolist():
                    yield _links(pa.Table.from_batches(held), threshold)
                    held, size = [], 0
            at = 0
            for cut in (np.flatnonzero((name[1:] != name[:-1]).any(1)) + 1).tolist():
                if size + cut - at >= TOGETHER:
                    yield _links(pa.Table.from_batches([*held, batch.slice(at, cut - at)]), threshold)
                    held, size, at = [], 0, cut
            held.append(batch.slice(at))
            size += batch.num_rows - at
        if held:
            yield _links(pa.Table.from_batches(held), threshold)

    return rows.mapInArrow(run, "vec long, links long, root long")


def near_duplicates(embeddings: DataFrame, threshold: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of `embeddings` (vec_id, embedding).

    Two vectors link if their cosine is at least `threshold`. Links found are right; two that
    share fewer than SHARED of their NEAREST pivots are missed. `n_links` counts the other
    vec_ids linked directly, `component_id` is the least one that links reach, and `kept` says
    that it is the row's own. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, nor do vectors of different dimension or a null vec_id,
    which has no component and is not kept. Repeated rows count once and come out each.
    """
    kind = embeddings.schema["embedding"].dataType
    number = kind.elementType if isinstance(kind, T.ArrayType) else T.DoubleType()
    number = number if isinstance(number, (T.FloatType, T.DoubleType)) else T.DoubleType()
    vector = F.col("embedding").cast(T.ArrayType(number))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("vector", lambda x: x != 0)
    good = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~bad & some)

    # Equal vectors are one class, compared once and counted by its size.
    ids = good.withColumns({"one": F.xxhash64("vector"), "two": F.xxhash64(F.lit(1), "vector")})
    ids = ids.select("vec_id", "one", "two").distinct()
    classes = ids.groupBy("one", "two").agg(F.min("vec_id").alias("vec"), F.count(F.lit(1)).alias("weight"))
    classes = stored(classes, "vector_classes")
    members = ids.join(classes.withColumnsRenamed({"vec": "class"}), ["one", "two"])
    members = stored(members.select("vec_id", "class", "weight"), "vector_members")

    one_each = good.withColumns({"one": F.xxhash64("vector"), "two": F.xxhash64(F.lit(1), "vector")})
    one_each = one_each.join(classes, ["one", "two"]).filter("vec_id = vec").select("vec", "weight", "vector")
    one_each = one_each.dropDuplicates(["vec", "weight"])
    sample = good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").toPandas()["vector"]
    described = stored(_describe(one_each, choose_pivots([np.asarray(v) for v in sample])), "vectors")
    found = stored(_compare(described, threshold), "vector_links")

    roots = components(found.select(F.col("vec").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("vec").agg(F.sum("links").alias("_links"))
    of_class = counts.join(roots.withColumnRenamed("node", "vec"), "vec", "left")
    of_class = of_class.withColumnRenamed("vec", "class")
    linked = members.join(of_class, "class", "left").groupBy("vec_id").agg(
        F.sum(F.coalesce("_links", F.lit(0)) + F.col("weight") - 1).alias("_n"),
        F.min(F.coalesce("component", "class")).alias("_component"),
    )
    everyone = rows.select("vec_id").join(linked, "vec_id", "left")
    component = F.coalesce("_component", "vec_id")
    return everyone.select(
        "vec_id",
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
