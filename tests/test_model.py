import pytest
from pyspark.sql import functions as F

from meterline import schema
from meterline.operators import forest
from meterline.operators.columns import features_and_label
from meterline.plans import training
from meterline.sinks.months import append_month


@pytest.fixture(scope="module")
def fares(spark):
    """Trips whose total follows from their fare and tip, with gaps in the inputs."""
    return spark.range(600).selectExpr(
        "id AS trip",
        "CAST(id % 265 + 1 AS INT) AS PULocationID",
        "CAST(CASE WHEN id % 11 <> 0 THEN id * 7 % 265 + 1 END AS INT) AS DOLocationID",
        "CASE WHEN id % 5 <> 0 THEN id % 5 END AS passenger_count",
        "id % 40 * 1.0D AS fare_amount",
        "1.0D AS extra",
        "CASE id % 97 WHEN 0 THEN double('NaN') ELSE id % 7 * 1.0D END AS tip_amount",
        "id % 40 / 3.0D AS trip_distance",
        "CASE WHEN id % 50 = 49 THEN NULL ELSE id % 40 + id % 7 + 1.0D END AS total_amount",
    )


def test_train_gate_save_load_score(spark, fares, tmp_path):
    path = str(tmp_path / "model")
    result = training.train(fares, "trip", path, trees=5, depth=6)
    assert result.saved and result.rmse < 10
    scored = training.score_table(path, fares.drop("total_amount"), "trip")
    assert scored.columns == ["trip", "input_problem", "prediction"]
    assert scored.count() == 600 and scored.filter("prediction IS NULL").count() == 0
    spread = fares.agg(F.min("total_amount"), F.max("total_amount")).first()
    assert scored.filter(~F.col("prediction").between(*spread)).count() == 0
    # Missing or out-of-range inputs are still scored, and named.
    assert scored.filter("input_problem = 'DOLocationID_in_range'").count() == 55


def test_gate(spark, tmp_path):
    class Unsaved:
        def write(self):
            raise AssertionError("a model that is not good enough is not saved")

    for error in (10.0, 12.5, None, float("nan")):
        assert forest.save_if_good(Unsaved(), error, str(tmp_path)) is False
    with pytest.raises(Exception, match="(?i)does not exist|path"):
        forest.load(str(tmp_path / "none"))


def test_settings():
    imputer, assembler, regressor = forest.forest().getStages()
    assert imputer.getInputCols() == schema.FEATURES
    assert assembler.getInputCols() == imputer.getOutputCols()
    values = [regressor.getNumTrees(), regressor.getMaxDepth(), regressor.getSeed(), regressor.getMinInstancesPerNode()]
    assert values == [100, 15, 42, 1]
    assert regressor.getFeatureSubsetStrategy() == "all" and regressor.getMaxBins() >= 266


def test_snapshot_is_read_back_with_a_key_per_row(spark, raw, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    append_month(raw(*[{}] * 50), landed, ("2025", "01"))
    append_month(raw({"fare_amount": 99.0}), landed, ("2025", "02"))
    training.snapshot(spark, landed, out)
    rows = training.read_snapshot(spark, out)
    assert rows.columns == ["row_key", *schema.FEATURES, schema.LABEL]
    assert rows.count() == rows.select("row_key").distinct().count() == 50  # copies, each with its own key
    csv = spark.read.csv(f"{out}/training.csv", header=True, inferSchema=True)
    assert csv.columns == [*schema.FEATURES, schema.LABEL] and csv.count() == 50


def test_the_model_does_not_depend_on_how_its_rows_are_laid_out(spark, fares, tmp_path):
    predictions = []
    for parts in (1, 7):
        laid = fares.repartition(parts, "fare_amount")
        result = training.train(laid, "trip", str(tmp_path / f"m{parts}"), trees=3, depth=4, partitions=3)
        scored = result.model.transform(features_and_label(fares, "trip")).orderBy("trip")
        predictions.append([row["prediction"] for row in scored.collect()])
    assert predictions[0] == predictions[1]


def test_two_snapshots_split_alike(spark, raw, tmp_path):
    landed = str(tmp_path / "landed")
    for month in ("01", "02"):
        append_month(raw(*[{}] * 40).repartition(3), landed, ("2025", month))
    sides = []
    for name in ("one", "two"):
        training.snapshot(spark, landed, str(tmp_path / name), 2025, [1, 2])
        rows = training.read_snapshot(spark, str(tmp_path / name))
        assert rows.select("row_key").distinct().count() == 80
        sides.append({row["row_key"] for row in forest.split(rows, "row_key")[1].collect()})
    assert sides[0] == sides[1] and 0 < len(sides[0]) < 80


def test_a_model_is_found_again_until_its_rows_or_settings_change(spark, fares, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    small = {"trees": 3, "depth": 4, "partitions": 2}
    first = training.train_once(fares, "trip", store, **small)
    assert not first.reused and first.saved and first.rmse < 10
    with monkeypatch.context() as patched:
        patched.setattr(training, "train", lambda *_: pytest.fail("nothing is to be fitted"))
        # The rows' order and layout do not matter, nor does the memory.
        again = training.train_once(fares.repartition(7, "fare_amount"), "trip", store, memory_mb=64, **small)
    assert again.reused and again[1:4] == first[1:4]
    rows = features_and_label(fares, "trip")
    both = [{row["trip"]: row["prediction"] for row in model.transform(rows).collect()} for model in (first.model, again.model)]
    assert both[0] == both[1]
    for frame, settings in ((fares.filter("trip <> 3"), small), (fares, {**small, "depth": 3})):
        with pytest.warns(UserWarning, match="stale"):
            assert not training.train_once(frame, "trip", store, **settings).reused
    # Another name has no models yet, so none of it is stale; a model not good enough is kept, and said to be so.
    wild = fares.withColumn("total_amount", F.xxhash64("trip") % 100_000 * 1.0)
    odd = training.train_once(wild, "trip", store, "odd", **small)
    assert not odd.saved and not training.train_once(wild, "trip", store, "odd", **small).saved
    # A model whose files are gone is fitted again.
    import shutil

    shutil.rmtree(first.path)
    with pytest.warns(UserWarning, match="stale"):
        assert not training.train_once(fares, "trip", store, **small).reused


def test_a_forest_predicts_the_average_of_its_trees(spark, fares, tmp_path):
    """Every tree walked by hand from its text, not by the model's own prediction."""
    import re

    result = training.train(fares, "trip", str(tmp_path / "m"), trees=3, depth=3, partitions=2)
    rows = result.model.transform(features_and_label(fares, "trip")).select("features", "prediction").limit(50).collect()

    def walk(lines, features):
        at = 0
        while True:
            depth = len(lines[at]) - len(lines[at].lstrip())
            leaf = re.match(r"\s*Predict: (.*)", lines[at])
            if leaf:
                return float(leaf[1])
            feature, limit = re.match(r"\s*If \(feature (\d+) <= (.*)\)", lines[at]).groups()
            if features[int(feature)] <= float(limit):
                at += 1
            else:
                marker = " " * depth + "Else"
                at = next(i for i in range(at + 1, len(lines)) if lines[i].startswith(marker)) + 1

    trees = [tree.toDebugString.splitlines()[1:] for tree in result.model.stages[-1].trees]
    for row in rows:
        assert row["prediction"] == pytest.approx(sum(walk(lines, row["features"]) for lines in trees) / 3)
