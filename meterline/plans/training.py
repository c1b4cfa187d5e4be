"""Train, judge and keep the fare model; score rows with it."""

from __future__ import annotations

import hashlib
import json
import uuid
import warnings
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators import forest
from meterline.operators.columns import features_and_label, training_columns
from meterline.operators.rules import model_input_rules, tag
from meterline.sinks.snapshots import write_csv, write_parquet
from meterline.sources.trips import exists, read_months

# The months the model learns from.
YEAR = 2025
MONTHS = [1]


class Trained(NamedTuple):
    model: forest.Forest
    rmse: float | None
    saved: bool


def snapshot(spark: SparkSession, landed: str, out: str, year: int = YEAR, months: Iterable[int] = MONTHS) -> None:
    """Write the training columns of the chosen months as Parquet and CSV.

    The Parquet copy has a `row_key` besides, the landed file and row of each trip: trips have
    no key, and a place in the snapshot would be another one in the next.
    """
    columns = training_columns(read_months(spark, landed, year, months, place="row_key"), "row_key")
    write_parquet(columns, f"{out}/training.parquet")
    write_csv(spark.read.parquet(f"{out}/training.parquet").drop("row_key"), f"{out}/training.csv")


def train(
    frame: DataFrame,
    key: str,
    model_path: str,
    trees: int = forest.TREES,
    depth: int = forest.DEPTH,
    memory_mb: int = 256,
    partitions: int = forest.PARTITIONS,
) -> Trained:
    """Fit on four fifths of the labelled rows of `frame`, measure on the rest, save if good enough.

    `frame` has the features, the label and a row `key`. Fitting passes over it several
    times: give it a stored frame such as a snapshot, not one that is costly to compute. Rows
    without a label are left out of both sides. The model depends on the rows, their keys and
    the settings, not on the machine. More trees than a driver holds are kept in lots.
    """
    rows = forest.labelled(features_and_label(frame, key))
    learn, test = forest.split(rows, key)
    model = forest.fit(forest.spread(learn, key, partitions), trees, depth, memory_mb)
    error = forest.evaluate(model, test)
    return Trained(model, error, forest.save_if_good(model, error, model_path))


class Fitted(NamedTuple):
    model: forest.Forest
    rmse: float | None
    saved: bool
    path: str
    reused: bool


FIT_LOG = "fingerprint string, name string, path string, rmse double, saved boolean"


def fingerprint(frame: DataFrame, key: str, **settings) -> str:
    """What a fit follows from: the rows with their keys, in any order, the settings and the Spark version."""
    rows = forest.labelled(features_and_label(frame, key))
    total = F.sum(F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)"))
    seen = rows.agg(F.count(F.lit(1)).alias("rows"), total.alias("total")).first()
    told = {"rows": seen["rows"], "total": str(seen["total"]), "spark": frame.sparkSession.version, **settings}
    return hashlib.sha256(json.dumps(told, sort_keys=True).encode()).hexdigest()


def train_once(
    frame: DataFrame,
    key: str,
    store: str,
    name: str = "fare",
    trees: int = forest.TREES,
    depth: int = forest.DEPTH,
    memory_mb: int = 256,
    partitions: int = forest.PARTITIONS,
) -> Fitted:
    """As `train`, or the model that an earlier call, in whatever application, fitted to the same
    rows with the same settings, found in the folder `store` by their fingerprint.

    If the store has models of this name for other rows or settings only, they are stale: a
    warning says so, and a new one is fitted. Models and their log rows are only ever added, and a
    row is added once its model is written, so a fit that dies leaves nothing to be found.
    Two calls at once may both fit; either model will do. The model is kept in the store even
    if it is not good enough; `saved` tells whether it is.
    """
    spark = frame.sparkSession
    settings = {"trees": trees, "depth": depth, "splits": "all", "partitions": partitions, "seed": forest.SEED}
    mark = fingerprint(frame, key, **settings)
    log = f"{store.rstrip('/')}/log"
    known = spark.read.schema(FIT_LOG).parquet(log).filter(F.col("name") == name) if exists(spark, log) else None
    if known is not None:
        for row in known.filter(F.col("fingerprint") == mark).orderBy("path").collect():
            if forest.is_saved(spark, row["path"]):
                return Fitted(forest.load(row["path"]), row["rmse"], row["saved"], row["path"], True)
        if not known.isEmpty():
            warnings.warn(f"the stored models {name!r} are stale: fitted to other rows or settings", stacklevel=2)
    path = f"{store.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    result = train(frame, key, path, trees, depth, memory_mb, partitions)
    if not result.saved:
        forest.save(result.model, path)
    rows = [(mark, name, path, result.rmse, result.saved)]
    spark.createDataFrame(rows, FIT_LOG).coalesce(1).write.mode("append").parquet(log)
    return Fitted(result.model, result.rmse, result.saved, path, False)


def score_table(model_path: str, df: DataFrame, *keep: str) -> DataFrame:
    """Predictions for any table with the features; `input_problem` names the first one out of range."""
    judged = tag(df, model_input_rules(), "input_problem")
    return forest.score(forest.load(model_path), judged, *keep, "input_problem")


def read_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """The Parquet snapshot with its `row_key`. Copies of a trip fall on either side, as single rows do."""
    return spark.read.parquet(f"{out}/training.parquet")
