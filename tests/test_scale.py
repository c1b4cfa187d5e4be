"""What one task or the session holds while tables grow."""

import pytest
from pyspark.sql import functions as F

from meterline.__main__ import arguments, run
from meterline.operators import audits, forest
from meterline.operators.columns import features_and_label
from meterline.plans import catalog, training
from meterline.sinks.months import append_month


def test_key_audit_counts_no_more_keys_in_a_task_however_well_they_compress(spark, monkeypatch):
    monkeypatch.setattr(audits, "KEY_ROWS", 1_000, raising=False)
    twice = spark.range(10_000).unionAll(spark.range(10_000))
    found = audits.duplicate_keys(twice, ["id"], "t")
    held = found.groupBy(F.spark_partition_id()).count().collect()
    assert sum(row["count"] for row in held) == 10_000
    assert max(row["count"] for row in held) < 1_000


def test_key_audit_of_hot_and_missing_keys_over_many_batches(spark, monkeypatch):
    monkeypatch.setattr(audits, "KEY_ROWS", 5_000, raising=False)
    keys = spark.range(60_000).selectExpr(
        "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'hot' ELSE CAST(id AS STRING) END AS a", "CASE WHEN id % 3 < 2 THEN 1.5D ELSE 0D END AS b"
    )
    found = {row["key_value"]: row["row_count"] for row in audits.duplicate_keys(keys, ["a", "b"], "t").collect()}
    assert found == {"NULL|1.5": 20_000, "hot|1.5": 20_000}
    alone = audits.duplicate_keys(spark.createDataFrame([(None,), (1,)], "k int"), ["k"], "t").collect()
    assert [(row["key_value"], row["row_count"]) for row in alone] == [("NULL", 1)]
    assert audits.duplicate_keys(keys.filter("false"), ["a", "b"], "t").collect() == []


@pytest.fixture(scope="module")
def fares(spark):
    return spark.range(400).selectExpr(
        "id AS trip",
        "CAST(id % 265 + 1 AS INT) AS PULocationID",
        "CAST(id * 7 % 265 + 1 AS INT) AS DOLocationID",
        "CASE WHEN id % 5 <> 0 THEN id % 5 END AS passenger_count",
        "id % 40 * 1.0D AS fare_amount",
        "1.0D AS extra",
        "id % 7 * 1.0D AS tip_amount",
        "id % 40 / 3.0D AS trip_distance",
        "CASE WHEN id % 50 = 49 THEN NULL ELSE id % 40 + id % 7 + 1.0D END AS total_amount",
    )


def test_more_trees_than_can_be_held_are_fitted_saved_and_scored_in_lots(spark, fares, tmp_path, monkeypatch):
    small = {"trees": 5, "depth": 4, "partitions": 2}
    whole = training.train(fares, "trip", str(tmp_path / "whole"), **small)
    monkeypatch.setattr(forest, "NODES", 2 * 2**5)  # two trees
    store = str(tmp_path / "store")
    first = training.train_once(fares, "trip", store, **small)
    assert [forest.tree_count(forest.load(path)) for path in first.model.paths] == [2, 2, 1]
    assert forest.tree_count(first.model) == 5 and first.saved and abs(first.rmse - whole.rmse) < 5
    again = training.train_once(fares, "trip", store, **small)
    assert again.reused and again[1:4] == first[1:4]

    rows = features_and_label(fares, "trip")
    own = {row["trip"]: row["prediction"] for row in first.model.transform(rows).collect()}
    scored = training.score_table(first.path, fares, "trip").collect()
    assert {row["trip"]: row["prediction"] for row in scored} == own and len(own) == 400
    # The average of all trees, each of a lot of its own.
    lots = [forest.load(path) for path in first.model.paths]
    sums = {}
    for model in lots:
        for row in model.transform(rows).collect():
            sums[row["trip"]] = sums.get(row["trip"], 0) + row["prediction"] * model.stages[-1].getNumTrees
    assert all(own[trip] == pytest.approx(total / 5) for trip, total in sums.items())
    assert len({model.stages[-1].getSeed() for model in lots}) == 3

    # Saved over another model, of either kind, only the last one is there.
    path = str(tmp_path / "one")
    for model in (whole.model, first.model, whole.model):
        forest.save(model, path)
        assert forest.is_saved(spark, path) and type(forest.load(path)) is type(model)


def test_a_session_of_750_mb_holds_the_trees_fitted_at_once(spark):
    for rows in (10_000, 100_000, 10**9):
        trees = forest.at_once(rows)
        assert trees * min(2 * rows, 2 ** (forest.DEPTH + 1)) >> 11 <= 320
    assert forest.at_once(10**9) == 10 and forest.at_once(1_000) >= 100
    assert 16 <= catalog.fitting_memory(spark, 10**9, forest.at_once(10**9)) <= 256


def test_the_train_run_keeps_a_forest_in_lots(spark, raw, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(forest, "NODES", 2 * 2**5)
    landed, model = str(tmp_path / "landed"), str(tmp_path / "model")
    append_month(raw(*[{"fare_amount": float(n), "total_amount": n + 5.0} for n in range(60)]), landed, ("2024", "01"))
    words = ["--out", f"{tmp_path}/out", "--model", model, "--store", f"{tmp_path}/store", "--trees", "3", "--depth", "4"]
    run(arguments(["train", "--root", landed, "--year", "2024", "--months", "1", *words]), spark)
    saved = "not saved" not in capsys.readouterr().out
    # The rows' keys follow from the landed file's name, so the error is another one in each run.
    assert forest.is_saved(spark, model) == saved
    assert not saved or forest.load(model).trees == [2, 1]
