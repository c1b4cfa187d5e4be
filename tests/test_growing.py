"""Trees grown by hand beside those of `growing`, and what fitting and scoring them costs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline import schema
from meterline.operators import forest, growing
from meterline.operators.columns import features_and_label
from meterline.plans import training


def rows_of(columns, label, fill=(), chunk=7):
    """The rows in chunks of a few."""
    parts = range(0, len(label), chunk)
    blobs = {(0, at): growing.pack([column[at : at + chunk] for column in (*columns, label)]) for at in parts}
    return growing.unpack(blobs, fill or [0.0] * len(columns))


def by_hand(columns, label, weight, depth):
    """Every split tried: (feature, threshold, left, right), or a leaf's prediction."""
    mean = (weight * label).sum() / weight.sum()
    whole = (weight * (label - mean) ** 2).sum()
    best = None
    for number, column in enumerate(columns if depth else ()):
        known = np.unique(column)
        for left, right in zip(known, known[1:], strict=False):
            error = 0
            for side in (column <= left, column > left):
                error += (weight[side] * (label[side] - np.average(label[side], weights=weight[side])) ** 2).sum()
            if whole - error > 1e-9 * whole and (best is None or whole - error > best[0] * (1 + 1e-12)):
                best = whole - error, number, left, (left + right) / 2
    if best is None:
        return mean
    _, number, left, middle = best
    sides = [columns[number] <= left, columns[number] > left]
    return number, middle, *(by_hand([c[s] for c in columns], label[s], weight[s], depth - 1) for s in sides)


def told(tree, at=0):
    if tree.feature[at] == growing.LEAF:
        return tree.value[at]
    left = growing.children(tree.feature)[at]
    return int(tree.feature[at]), tree.value[at], told(tree, left), told(tree, left + 1)


def flat(tree):
    return [x for part in tree for x in flat(part)] if isinstance(tree, tuple) else [tree]


@pytest.mark.parametrize("room", [1 << 25, 0])
def test_a_tree_has_the_best_of_all_splits(room):
    random = np.random.default_rng(5)
    for _ in range(25):
        size = int(random.integers(2, 70))
        columns = [random.integers(0, 5, size) * 1.0, random.normal(size=size).round(1), random.integers(0, 2, size) * 1.0]
        label = random.normal(size=size).round(2) * 1e5
        weight = random.poisson(1.0, size).astype(np.uint8)
        weight[0] = 1
        some = weight > 0
        mine = growing.grow(rows_of(columns, label), weight, 5, room)
        theirs = by_hand([c[some] for c in columns], label[some], weight[some].astype(float), 5)
        assert flat(told(mine)) == pytest.approx(flat(theirs))


def test_one_value_among_thousands_is_told_apart():
    """Not with a bin for several values."""
    values = np.arange(20_000) % 5_000 * 1.0
    label = np.where(values == 2_345, 1_000.0, 0.0)
    mine = growing.grow(rows_of([values], label, chunk=6_000), np.ones(20_000, np.uint8), 2)
    trees = [(np.where(mine.feature < 0, 1, mine.feature).astype(np.int8), mine.value, growing.children(mine.feature))]
    assert growing.predict(trees, [values]).tolist() == label.tolist()


def test_odd_labels_and_values():
    ones = np.ones(6, np.uint8)
    infinite = np.array([-np.inf, 0.0, 1.0, 2.0, 1e308, np.inf])
    mine = growing.grow(rows_of([infinite], np.array([1.0, 2, 3, 4, 5, 6])), ones, 4)
    trees = [(np.where(mine.feature < 0, 1, mine.feature).astype(np.int8), mine.value, growing.children(mine.feature))]
    assert growing.predict(trees, [infinite]).tolist() == [1, 2, 3, 4, 5, 6]
    # One label, no value that tells rows apart, labels without an average: a leaf.
    for label in ([0.1] * 6, [1.0, 2, 3, 4, 5, 6], [1.0, 2, 3, 4, 5, np.inf]):
        same = infinite if label[0] == label[1] else np.zeros(6)
        assert len(growing.grow(rows_of([same], np.array(label)), ones, 4).feature) == 1
    gaps = rows_of([np.array([np.nan, 1, 2, np.nan, 3, 2])], np.arange(6.0), [2.0])
    assert gaps.values[0][gaps.codes[0]].tolist() == [2, 1, 2, 2, 3, 2]


@pytest.fixture(scope="module")
def fares(spark):
    """Trips whose total follows from one fare in 2000."""
    others = [f"1.0D AS {name}" for name in schema.FEATURES if name != "fare_amount"]
    total = "CASE WHEN id % 2000 = 777 THEN 90.0D ELSE 10.0D END AS total_amount"
    return spark.range(20_000).selectExpr("id AS trip", *others, "CAST(id % 2000 AS DOUBLE) AS fare_amount", total)


def test_every_fare_can_be_told_apart(spark, fares, tmp_path):
    """In bins, as many as there were, several fares share one and are told the same."""
    path = str(tmp_path / "model")
    result = training.train(fares, "trip", path, trees=3, depth=4, partitions=4)
    assert result.rmse < 1e-6 and result.saved
    scored = training.score_table(path, fares.filter("trip < 2000"), "trip").collect()
    assert {row["trip"]: row["prediction"] for row in scored} == {n: 90.0 if n == 777 else 10.0 for n in range(2000)}
    # As MLlib's model, whose root says how many rows it had.
    tree = forest.load(path).stages[-1].trees[0]
    assert (tree.depth, tree.numNodes) == (2, 5)


def jobs_of(spark, group, work):
    """How many jobs this makes."""
    spark.sparkContext.setJobGroup(group, group)
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.fixture(scope="module")
def stored(spark, fares):
    """A forest in lots, as those of the queries' larger tables are."""
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(forest, "NODES", 2 * 2**5)
        rows = features_and_label(fares, "trip")
        return rows, forest.fit(forest.spread(rows, "trip", 2), 7, 4)


def test_a_fit_has_as_many_jobs_at_any_depth(spark, fares, monkeypatch):
    """each level of each lot had its own, which took most of the time."""
    monkeypatch.setattr(forest, "NODES", 1)
    rows = forest.spread(features_and_label(fares.withColumn("total_amount", F.rand(3)), "trip"), "trip", 2)
    few, many = (jobs_of(spark, f"fit {depth}", lambda d=depth: forest.fit(rows, 4, d)) for depth in (2, 9))
    assert many <= few + 2 and many < 20


def test_a_forest_in_lots_is_scored_in_one_pass(spark, stored):
    """each lot had a pass of its own, and stored the rows."""
    rows, model = stored
    assert len(model.paths) == 4
    assert jobs_of(spark, "score", lambda: model.transform(rows).agg(F.sum("prediction")).collect()) < 12


def test_a_forest_in_lots_is_copied_as_it_is(spark, stored, tmp_path, monkeypatch):
    """each lot was put together by the driver and written again."""
    rows, model = stored
    monkeypatch.setattr(forest.PipelineModel, "load", lambda *_: pytest.fail("no lot is to be held by the driver"))
    forest.save(model, str(tmp_path / "copy"))
    both = [{row["trip"]: row["prediction"] for row in m.transform(rows).collect()} for m in (model, forest.load(str(tmp_path / "copy")))]
    assert both[0] == both[1] and len(both[0]) == 20_000


def test_a_table_is_scored_by_trees_sent_in_parts(spark, stored, tmp_path, monkeypatch):
    """the driver held a lot at a time; now what is sent is bounded, with the same predictions."""
    rows, model = stored
    path = str(tmp_path / "kept")
    forest.save(model, path)
    monkeypatch.setattr(forest.PipelineModel, "load", lambda *_: pytest.fail("no lot is to be held by the driver"))
    trips = rows.withColumn("fare_amount", F.expr("CASE WHEN trip % 3 > 0 THEN fare_amount END"))
    whole = {row["trip"]: row["prediction"] for row in training.score_table(path, trips, "trip").collect()}
    monkeypatch.setattr(forest, "SENT_NODES", 12)
    parts = {row["trip"]: row["prediction"] for row in training.score_table(path, trips, "trip").collect()}
    assert whole == pytest.approx(parts) and len(whole) == 20_000
