"""The fare model: split, random forest, gate, save, load, score."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from meterline import schema
from meterline.operators import growing, tops
from meterline.operators.metrics import MAX_RMSE, passes_gate, rmse
from meterline.session import scratch_path
from meterline.sources.trips import exists, remove_folder

# The model's settings and the error it must stay under.
TREES = 100
DEPTH = 15
SEED = 42
TEST_PERCENT = 20

# Of MLlib's settings, which a model kept by MLlib states; our trees try every split.
BINS = 300
# How many parts the rows are fitted in. A row's place in them says how often each tree draws it, so
# the count belongs to the settings.
PARTITIONS = 16
# How many nodes the trees of one lot may have: MLlib holds a lot whole in the driver, at half a KB each.
NODES = 10 << 16
# How many nodes are sent to the tasks that score, at 13 bytes each.
SENT_NODES = 1 << 23
# How many draws of rows a task grows trees on, at some 200 bytes of work each. The first splits of trees
# with more are made by all tasks together.
WHOLE = 1 << 20
# Between the seeds of one lot of trees and the next.
SEED_STEP = 10_007


def hash_percent(key: Column) -> Column:
    """A number from 0 to 99 that depends on the key alone, not on the layout of the data."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 6), 16, 10).cast("int") % 100


def split(df: DataFrame, key: str, test_percent: int = TEST_PERCENT) -> tuple[DataFrame, DataFrame]:
    """(train, test) by the hash of a row key: a retried or re-ordered task splits the same way."""
    tested = hash_percent(F.col(key)) < test_percent
    return df.filter(~tested), df.filter(tested)


def labelled(df: DataFrame) -> DataFrame:
    """Rows a model can learn from: those with a label."""
    return df.filter(F.col("label").isNotNull() & ~F.isnan("label"))


def spread(df: DataFrame, key: str, partitions: int = PARTITIONS) -> DataFrame:
    """The same rows in the same places, whatever the number of cores and the files' layout."""
    return df.repartition(partitions, key).sortWithinPartitions(*df.columns)


def imputer() -> Imputer:
    filled = [f"{name}_filled" for name in schema.FEATURES]
    return Imputer(strategy="median", inputCols=schema.FEATURES, outputCols=filled)


def forest(
    trees: int = TREES, depth: int = DEPTH, seed: int = SEED, memory_mb: int = 256, bins: int = BINS
) -> Pipeline:
    """Fill gaps with the median, assemble, and a forest that tries every feature at each split: the
    stages of a fitted model as MLlib keeps it. `fit` grows its trees without bins."""
    gaps = imputer()
    return Pipeline(
        stages=[
            gaps,
            VectorAssembler(inputCols=gaps.getOutputCols(), outputCol="features"),
            RandomForestRegressor(
                featuresCol="features",
                labelCol="label",
                numTrees=trees,
                maxDepth=depth,
                seed=seed,
                maxBins=bins,
                featureSubsetStrategy="all",
                minInstancesPerNode=1,
                maxMemoryInMB=memory_mb,
                cacheNodeIds=True,
            ),
        ]
    )


def at_once(rows: int, depth: int = DEPTH) -> int:
    """How many trees are a lot. A tree has two nodes per row at most, and as many
    as its depth allows, so the count follows from the rows and the depth, not from the machine."""
    return max(1, NODES // max(1, min(2 * rows, 2 ** (depth + 1))))


class StoredForest:
    """A forest of more trees than a driver holds: saved lots of some trees each. A lot has a row for each
    tree: its lot's seed and depth, what fills the gaps, its nodes level by level."""

    def __init__(self, paths: Sequence[str], trees: Sequence[int]):
        self.paths, self.trees = list(paths), list(trees)

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` with the average of all trees as `prediction`, in one pass over the rows. Trees of more
        than SENT_NODES nodes take several; between them the rows are stored with the sum so far, in
        the shared folder."""
        spark, held, before = df.sparkSession, df.withColumn("_sum", F.lit(0.0)), None
        passes = list(self._passes(spark))
        for place, seeds in enumerate(passes):
            held = held.select(*df.columns, (F.col("_sum") + self._summed(spark, seeds)).alias("_sum"))
            if place + 1 < len(passes):
                now = scratch_path(spark, "scored")
                held.write.parquet(now)
                held = spark.read.parquet(now)
                if before:
                    remove_folder(spark, before)
                before = now
        return held.select(*df.columns, (F.col("_sum") / sum(self.trees)).alias("prediction"))

    def _passes(self, spark: SparkSession) -> Iterator[list[tuple[int, int]]]:
        """The trees, as seeds and numbers, that are sent together."""
        sizes = spark.read.parquet(*self.paths).selectExpr("seed", "tree", "length(feature) AS nodes")
        together, nodes = [], 0
        for row in sizes.orderBy("seed", "tree").collect():
            if together and nodes + row["nodes"] > SENT_NODES:
                yield together
                together, nodes = [], 0
            together.append((row["seed"], row["tree"]))
            nodes += row["nodes"]
        yield together

    def _summed(self, spark: SparkSession, chosen: list[tuple[int, int]]) -> Column:
        """The sum of these trees' predictions, as a column of a frame with the features."""
        first, last = (F.struct(F.lit(seed).alias("seed"), F.lit(tree).alias("tree")) for seed, tree in (chosen[0], chosen[-1]))
        rows = spark.read.parquet(*self.paths).filter(F.struct(F.col("seed"), F.col("tree")).between(first, last))
        found = rows.select("seed", "tree", "fill", "feature", "value").toArrow()
        order = sorted(range(found.num_rows), key=list(zip(*(found[name].to_pylist() for name in ("seed", "tree")), strict=True)).__getitem__)
        trees = []
        for at in order:
            feature = np.frombuffer(found["feature"][at].as_buffer(), np.int8)
            # A leaf asks for the column behind the features, see `growing.predict`.
            asked = np.where(feature == growing.LEAF, len(schema.FEATURES), feature).astype(np.int8)
            trees.append((asked, np.frombuffer(found["value"][at].as_buffer(), np.float64).copy(), growing.children(feature)))
        fill = found["fill"][0].as_py()
        shared = spark.sparkContext.broadcast(trees)

        @F.arrow_udf("double")
        def summed(*columns: pa.Array) -> pa.Array:
            given = [numbers(column) for column in columns]
            given = [np.where(np.isnan(own), gap, own) for own, gap in zip(given, fill, strict=True)]
            return pa.array(growing.predict(shared.value, given))

        return summed(*[F.col(name).cast("double") for name in schema.FEATURES])


def numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of doubles, gaps as NaN."""
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


Forest = PipelineModel | StoredForest


def tree_count(model: Forest) -> int:
    if isinstance(model, StoredForest):
        return sum(model.trees)
    return model.stages[-1].getNumTrees


def packed(rows: DataFrame) -> DataFrame:
    """The rows in chunks as `growing` takes them, each named by its part and place."""
    names, most = [*schema.FEATURES, "label"], growing.CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, chunk, held = TaskContext.get().partitionId(), 0, None

        def told(table: pa.Table) -> pa.RecordBatch:
            columns = [numbers(table[name]) for name in names]
            own = {"part": part, "chunk": chunk, "size": table.num_rows, "low": columns[-1].min(), "high": columns[-1].max()}
            return pa.RecordBatch.from_pylist([own | {"blob": growing.pack(columns)}], schema=kinds)

        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, more]) if held else more
            while held.num_rows >= most:
                yield told(held.slice(0, most))
                held, chunk = held.slice(most), chunk + 1
        if held and held.num_rows:
            yield told(held)

    kinds = pa.schema(
        [("part", pa.int32()), ("chunk", pa.int32()), ("size", pa.int64())]
        + [("low", pa.float64()), ("high", pa.float64()), ("blob", pa.binary())]
    )
    return rows.select(*names).mapInArrow(run, "part int, chunk int, size long, low double, high double, blob binary")


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, memory_mb: int = 256) -> Forest:
    """A forest of `trees`, on rows drawn with replacement, with every split between two values of a
    feature tried. If it is too large to be held by the driver, its trees are in lots, each
    from a seed of its own, which lie in the shared folder.

    On WHOLE rows at most a tree is grown by one task, and the tasks have a copy of the packed rows each,
    some 20 bytes for a row. On more, see `tops`. A running task may hold `memory_mb` of tables of split
    statistics; larger ones are not made, and the rows sorted instead, with the same result.
    """
    spark = rows.sparkSession
    fill = list(imputer().fit(rows).surrogateDF.select(*schema.FEATURES).first())
    tasks = 2 * spark.sparkContext.defaultParallelism
    stored = scratch_path(spark, "packed")
    place = F.pmod(F.col("part") + F.col("chunk"), F.lit(tasks)).cast("int")
    packed(rows).repartitionById(tasks, place).write.parquet(stored)
    chunks = spark.read.parquet(stored)
    size, low, high = chunks.agg(F.sum("size"), F.min("low"), F.max("high")).first()
    lot = at_once(size, depth)
    lots = [min(lot, trees - begin) for begin in range(0, trees, lot)]
    seeds = [(SEED + SEED_STEP * (number // lot), number % lot) for number in range(trees)]
    room = (memory_mb << 20) // 64
    blobs = chunks.select("part", "chunk", "blob")
    # As MLlib does, a single tree learns from every row once.
    if size > WHOLE and trees > 1:
        grown = tops.grown(blobs, fill, tops.scale(low, high, size), size, seeds, depth, WHOLE, room)
    else:
        grown = grown_whole(blobs, fill, seeds, depth, room, min(trees, tasks))
    known = spark.createDataFrame(
        [(which, which // lot, tree, seed, depth, fill) for which, (seed, tree) in enumerate(seeds)],
        "which int, lot int, tree int, seed long, depth int, fill array<double>",
    )
    root = scratch_path(spark, "trees")
    grown.join(F.broadcast(known), "which").drop("which").write.partitionBy("lot").parquet(root)
    remove_folder(spark, stored)
    paths = [f"{root}/lot={number}" for number in range(len(lots))]
    return StoredForest(paths, lots) if len(lots) > 1 else held_whole(spark, paths[0])


def grown_whole(
    chunks: DataFrame, fill: Sequence[float], seeds: Sequence[tuple[int, int]], depth: int, room: int, tasks: int
) -> DataFrame:
    """A tree for each seed and number of `seeds`, its place among them as `which`, grown from a copy of all
    rows in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: dict[int, dict[tuple[int, int], bytes]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                blobs.setdefault(row["task"], {})[row["part"], row["chunk"]] = row["blob"]
        for task in list(blobs):
            rows = growing.unpack(blobs.pop(task), fill)
            for which in range(task, len(seeds), tasks):
                ones = np.ones(len(rows.label), np.uint8)
                tree = growing.grow(rows, growing.weights(rows, *seeds[which]) if len(seeds) > 1 else ones, depth, room)
                told = {name: [part] for name, part in zip(tree._fields, growing.written(tree), strict=True)}
                yield pa.RecordBatch.from_pydict({"which": pa.array([which], pa.int32()), **told})

    copies = chunks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    columns = ", ".join(f"{name} binary" for name in growing.Tree._fields)
    return copies.repartitionById(tasks, F.col("task")).mapInArrow(run, f"which int, {columns}")


def _nodes(batches: Iterator[pa.RecordBatch], kinds: pa.Schema) -> Iterator[pa.RecordBatch]:
    """MLlib's node rows of trees, at most a few thousand at a time."""
    for batch in batches:
        for row in batch.to_pylist():
            tree = growing.read([row[name] for name in growing.Tree._fields])
            inner, left = tree.feature != growing.LEAF, growing.children(tree.feature)
            total, gain = tree.count * tree.value, np.full(len(left), -1.0)
            for at in np.flatnonzero(inner)[::-1]:
                total[at] = total[left[at]] + total[left[at] + 1]
            mean, spare = total / tree.count, tree.count * tree.impurity
            parts = np.flatnonzero(inner)
            gained = spare[parts] - spare[left[parts]] - spare[left[parts] + 1]
            gain[parts] = np.maximum(gained / tree.count[parts], 0)
            for begin in range(0, len(left), 4096):
                nodes = [
                    {
                        "id": at,
                        "prediction": mean[at],
                        "impurity": tree.impurity[at],
                        "impurityStats": [tree.count[at], total[at], spare[at] + total[at] * mean[at]],
                        "rawCount": tree.count[at],
                        "gain": gain[at],
                        "leftChild": left[at] if inner[at] else -1,
                        "rightChild": left[at] + 1 if inner[at] else -1,
                        "split": {
                            "featureIndex": tree.feature[at],
                            "leftCategoriesOrThreshold": [tree.value[at]] if inner[at] else [],
                            "numCategories": -1,
                        },
                    }
                    for at in range(begin, min(begin + 4096, len(left)))
                ]
                yield pa.RecordBatch.from_pydict({"treeID": [row["tree"]] * len(nodes), "nodeData": nodes}, schema=kinds)


def held_whole(spark: SparkSession, path: str) -> PipelineModel:
    """The lot of trees at `path` as one model of MLlib."""
    lot = spark.read.parquet(path)
    trees, (seed, depth, fill) = lot.count(), lot.select("seed", "depth", "fill").first()
    # MLlib makes the model around the nodes, fitted to what fills the gaps; its own have one node a tree.
    rows = spark.createDataFrame([(*fill, 0.0)] * 2, ", ".join(f"{name} double" for name in [*schema.FEATURES, "label"]))
    made = scratch_path(spark, "model")
    around = forest(trees, depth, seed).fit(rows.coalesce(1))
    around.write().save(made)
    nodes = f"{made}/stages/2_{around.stages[-1].uid}/data"
    kinds = spark.read.parquet(nodes).schema
    arrow = to_arrow_schema(kinds)
    lot.mapInArrow(lambda batches: _nodes(batches, arrow), kinds).write.mode("overwrite").parquet(nodes)
    return PipelineModel.load(made)


def score(model: Forest, df: DataFrame, *keep: str) -> DataFrame:
    """`keep` and the predicted label for any frame with the seven features, numbers of any type."""
    # Under other names meanwhile, since a feature may be kept as well.
    kept = [f"{name} AS _kept_{name}" for name in keep]
    inputs = df.selectExpr(*kept, *[f"CAST({name} AS DOUBLE) AS {name}" for name in schema.FEATURES])
    return model.transform(inputs).selectExpr(*[f"_kept_{name} AS {name}" for name in keep], "prediction")


def evaluate(model: Forest, test: DataFrame) -> float:
    """RMSE on rows of features and label."""
    return model.transform(test).agg(rmse(F.col("label"), F.col("prediction")).alias("rmse")).first()["rmse"]


def save_if_good(model: Forest, error: float | None, path: str, threshold: float = MAX_RMSE) -> bool:
    """Save the model only if its error is strictly under the threshold; says whether it did."""
    judged = SparkSession.active().range(1).select(passes_gate(F.lit(error).cast("double"), threshold))
    good = judged.first()[0]
    if good:
        save(model, path)
    return good


# Lists the lots of a stored forest; written last, so that it stands for a whole one.
_LOTS = "lots"


def save(model: Forest, path: str) -> None:
    """Save the model in place of what is at `path`; of a stored forest the lots, as they are."""
    if not isinstance(model, StoredForest):
        model.write().overwrite().save(path)
        return
    spark = SparkSession.active()
    remove_folder(spark, path)
    lots = [(f"lot-{place:04d}", trees) for place, trees in enumerate(model.trees)]
    for (name, _), held in zip(lots, model.paths, strict=True):
        spark.read.parquet(held).write.parquet(f"{path}/{name}")
    spark.createDataFrame(lots, "name string, trees int").coalesce(1).write.parquet(f"{path}/{_LOTS}")


def is_saved(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/metadata") or exists(spark, f"{path}/{_LOTS}")


def load(path: str) -> Forest:
    """A saved model, or a lot of a stored forest; a missing one raises."""
    spark = SparkSession.active()
    if exists(spark, f"{path}/{_LOTS}"):
        lots = spark.read.parquet(f"{path}/{_LOTS}").orderBy("name").collect()
        return StoredForest([f"{path}/{row['name']}" for row in lots], [row["trees"] for row in lots])
    if exists(spark, path, whole=False) and not exists(spark, f"{path}/metadata"):
        return held_whole(spark, path)
    return PipelineModel.load(path)
