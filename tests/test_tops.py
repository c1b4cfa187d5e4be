"""Trees whose first splits are made on chunks apart are those grown in one place."""

import numpy as np
import pytest

from meterline import schema
from meterline.operators import forest, growing, tops
from meterline.plans import training


def in_one_place(blobs, fill, depth):
    rows = growing.unpack(blobs, fill)
    return growing.grow(rows, growing.weights(rows, 7, 3), depth)


def apart(blobs, fill, depth, most, bins=6):
    """As `tops.grown`, without tasks."""
    chunks = [tops.Chunk(name, blob, fill) for name, blob in blobs.items()]
    label = np.concatenate([chunk.label for chunk in chunks])
    scaled = tops.scale(label.min(), label.max(), len(label))
    ranged = tops.ranges(chunks, tops.ends(chunks[0].columns, bins), scaled)
    top, looked_into = tops.Top(7, 3), 0
    while top.open:
        nodes = tops.bound(tops.tally(chunks, [top], ranged.edges, scaled)[0], ranged)
        looked_into += sum(len(node.bins) for node in nodes)
        inside = [blob for chunk in chunks for _, blob in tops.values(chunk, [top], [nodes], ranged.edges, scaled)]
        tops.advance(top, tops.settle(inside, nodes, ranged.edges), scaled, most, depth)
    sent = {node: {} for node in top.rest}
    for chunk in chunks:
        for node, blob in chunk.sent(top):
            sent[node][chunk.name] = blob
    received = {node: tops.received(own, len(fill)) for node, own in sent.items()}
    assert all(draws.sum() <= most for _, draws in received.values())
    below = {node: growing.grow(rows, draws, depth - top.depth[node]) for node, (rows, draws) in received.items()}
    return tops.joined(top, below), looked_into


def test_first_splits_apart_are_those_of_one_place():
    random, looked_into = np.random.default_rng(11), 0
    for trial in range(40):
        size = int(random.integers(150, 500))
        columns = [random.integers(0, 40, size) * 1.0, random.normal(size=size).round(2), random.integers(0, 2, size) * 1.0]
        columns[1][::9] = np.nan
        # By turns a label of one feature, one of chance, one value far from the others, and almost none.
        label = [columns[0] * 3, random.normal(size=size), (columns[0] == 17) * 1e6, np.zeros(size)][trial % 4]
        label = label + random.integers(0, 2, size) * (trial % 4 < 3)
        blobs = {
            (0, at): growing.pack([column[at : at + 60] for column in (*columns, label)]) for at in range(0, size, 60)
        }
        depth = int(random.integers(1, 7))
        one = in_one_place(blobs, [0.0, 0.5, 0.0], depth)
        other, inside = apart(blobs, [0.0, 0.5, 0.0], depth, int(random.integers(20, 120)))
        looked_into += inside
        assert one.feature.tolist() == other.feature.tolist() and one.count.tolist() == other.count.tolist()
        leaves = one.feature == growing.LEAF
        assert other.value[leaves] == pytest.approx(one.value[leaves], rel=1e-9, abs=1e-9)
        assert other.impurity == pytest.approx(one.impurity, rel=1e-5, abs=1e-3)
    assert looked_into > 40


def test_a_table_of_more_rows_than_a_task_takes(spark, tmp_path, monkeypatch):
    """In all tasks together and in one each: the same trees, of rows drawn alike."""
    others = [f"CAST(id % {n + 3} AS DOUBLE) AS {name}" for n, name in enumerate(schema.FEATURES) if name != "fare_amount"]
    fare = "(id * 7919 % 6007) / 10.0D"
    fares = spark.range(6_000).selectExpr("id AS trip", *others, f"{fare} AS fare_amount", f"floor({fare} / 7) + id % 3 AS total_amount")
    monkeypatch.setattr(growing, "CHUNK", 400)
    monkeypatch.setattr(forest, "NODES", 2 * 2**6)
    found, rmse = [], []
    for number, whole in enumerate((forest.WHOLE, 1_500)):
        monkeypatch.setattr(forest, "WHOLE", whole)
        result = training.train(fares, "trip", str(tmp_path / f"m{number}"), trees=3, depth=5, partitions=3)
        rows = spark.read.parquet(*result.model.paths).orderBy("seed", "tree").collect()
        found.append([(row["feature"], row["count"]) for row in rows])
        rmse.append(result.rmse)
    assert found[0] == found[1] and len(found[0]) == 3
    assert rmse[0] == pytest.approx(rmse[1], rel=0.02)
