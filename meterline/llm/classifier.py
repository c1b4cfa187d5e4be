"""A quality classifier: random-indexing word vectors pooled per document, and a small network.

Every token has a sparse random index vector that follows from its hash. A token's word
vector is the sum of the index vectors it has met as neighbours, over all documents. A
document is the mean of its tokens' vectors. Tokens are a text's words, A to Z lowered, and
their shapes (`Ab.` is a capital, small letters and a full stop; a word that repeats the one
before has a shape of its own), so that words never seen before still say something.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm import words as W
from meterline.llm.common import chunks, utf8

# Word vectors are kept for hashed tokens, so their table has a fixed size at any scale:
# BUCKETS * DIMENSIONS numbers, 4 MB in the driver and 2 MB in each task.
BUCKETS = 1 << 14
DIMENSIONS = 32
INDEXED = 4
REACH = 2
# The network is fitted on at most so many labelled documents, those with the least hashes.
SAMPLE = 20_000
HIDDEN = 32
FOLDS = 5


def _byte_classes() -> np.ndarray:
    """A class for each byte: capitals, small letters, digits; other marks are their own."""
    classes = np.arange(256, dtype=np.uint8)
    classes[65:91], classes[97:123], classes[48:58] = 65, 97, 48
    # Letters beyond ASCII are judged by their second byte, as Latin capitals come first.
    classes[0x80:0x9F], classes[0x9F:0xC0], classes[0xC0:] = 65, 97, 0
    return classes


_CLASSES = _byte_classes()


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words and of all their shapes, and where each text's words begin."""
    words = W.split(data, offsets)
    hashes = W.hash_words(W.lower(data), words)
    classes = _CLASSES[data]
    kept = classes > 0
    kept[1:] &= (classes[1:] != classes[:-1]) | ~kept[:-1]
    kept[words.starts] = True
    place = np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])
    runs = W.Words(place[words.starts], place[words.ends], words.bounds)
    shapes = W.hash_words(classes[kept], runs, seed=1)
    if len(hashes):
        again = np.zeros(len(hashes), bool)
        again[1:] = hashes[1:] == hashes[:-1]
        again[words.bounds[:-1][words.bounds[:-1] < len(hashes)]] = False
        shapes = np.where(again, W.U(0), shapes)
    return (hashes % W.U(BUCKETS)).astype(np.int64), (shapes % W.U(BUCKETS)).astype(np.int64), words.bounds


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """For each bucket the INDEXED places of its index vector that are not zero, and their signs."""
    drawn = W.mix(np.arange(1, BUCKETS * INDEXED + 1, dtype=np.uint64)).reshape(BUCKETS, INDEXED)
    signs = np.where(drawn >> W.U(63), 1.0, -1.0)
    return (drawn % W.U(DIMENSIONS)).astype(np.int64), signs


def add_contexts(sums: np.ndarray, sequence: np.ndarray, text: np.ndarray) -> None:
    """Add to `sums` (flat, BUCKETS * DIMENSIONS) the index vectors of all neighbours within REACH."""
    places, signs = index_vectors_once()
    for step in range(1, REACH + 1):
        together = text[step:] == text[:-step]
        left, right = sequence[:-step][together], sequence[step:][together]
        for own, other in ((left, right), (right, left)):
            for k in range(INDEXED):
                at = own * DIMENSIONS + places[other, k]
                sums += np.bincount(at, signs[other, k], minlength=BUCKETS * DIMENSIONS)


_INDEX: list[tuple[np.ndarray, np.ndarray]] = []


def index_vectors_once() -> tuple[np.ndarray, np.ndarray]:
    if not _INDEX:
        _INDEX.append(index_vectors())
    return _INDEX[0]


def word_vectors(docs: DataFrame) -> np.ndarray:
    """The word vectors of all buckets over all of `docs`, each of length one (or zero if unmet).

    Tasks add up their own documents first and give one row per bucket, which Spark adds up
    in hash aggregates; what reaches the driver is one table of a fixed size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS * DIMENSIONS)
        for batch in batches:
            for part in chunks(batch):
                words, shapes, bounds = tokens(*utf8(part.column("text")))
                sequence = np.stack([shapes, words], 1).ravel()
                text = np.repeat(np.arange(part.num_rows), 2 * np.diff(bounds))
                add_contexts(sums, sequence, text)
        table = sums.reshape(BUCKETS, DIMENSIONS)
        met = np.flatnonzero(np.abs(table).sum(1))
        columns = [pa.array(met, pa.int32()), *[pa.array(table[met, d], pa.float64()) for d in range(DIMENSIONS)]]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", *names])

    names = [f"d{d}" for d in range(DIMENSIONS)]
    partial = docs.select("text").mapInArrow(run, "bucket int, " + ", ".join(f"{name} double" for name in names))
    # Sums of whole numbers, so the order of adding does not matter.
    summed = partial.groupBy("bucket").agg(*[F.sum(name).alias(name) for name in names]).toPandas()
    vectors = np.zeros((BUCKETS, DIMENSIONS))
    vectors[summed["bucket"].to_numpy(np.int64)] = summed[names].to_numpy(np.float64)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(length > 0, length, 1)).astype(np.float32)


def pool(part: pa.RecordBatch, vectors: np.ndarray) -> np.ndarray:
    """For each text the means of its word vectors and of its shape vectors; zeros without words."""
    words, shapes, bounds = tokens(*utf8(part.column("text")))
    counts = np.diff(bounds)
    pooled = np.zeros((part.num_rows, 2 * DIMENSIONS), np.float32)
    full = np.flatnonzero(counts)
    if len(full):
        for half, buckets in enumerate((words, shapes)):
            sums = np.add.reduceat(vectors[buckets], bounds[full], axis=0)
            pooled[full, half * DIMENSIONS : (half + 1) * DIMENSIONS] = sums / counts[full, None]
    return pooled


@dataclass
class Network:
    """Two layers and a temperature; `mean` and `scale` put the inputs on one footing."""

    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float = 1.0

    def logits(self, inputs: np.ndarray) -> np.ndarray:
        layer = np.maximum((inputs - self.mean) / self.scale @ self.hidden + self.hidden_bias, 0)
        return layer @ self.out + self.out_bias

    def probabilities(self, inputs: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(inputs.astype(np.float64)) / self.temperature, -30, 30)))


def _loss(logits: np.ndarray, labels: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - labels * logits))


def fit(inputs: np.ndarray, labels: np.ndarray, epochs: int = 60, seed: int = 7) -> Network:
    """Fit on four fifths of the rows; the temperature makes the others' probabilities fit best.

    Without rows of both labels, every probability is the labels' smoothed share.
    """
    width = inputs.shape[1] if inputs.ndim == 2 else 2 * DIMENSIONS
    random = np.random.default_rng(seed)
    net = Network(
        np.zeros(width), np.ones(width), random.normal(0, np.sqrt(2 / width), (width, HIDDEN)), np.zeros(HIDDEN),
        random.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), 0.0,
    )
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2)
        net.out[:] = 0
        net.out_bias = float(np.log(share / (1 - share)))
        return net
    inputs, labels = inputs.astype(np.float64), labels.astype(np.float64)
    order = random.permutation(len(labels))
    held = order[: len(order) // 5] if len(order) >= 50 else order
    learn = order[len(order) // 5 :] if len(order) >= 50 else order
    net.mean, net.scale = inputs[learn].mean(0), inputs[learn].std(0) + 1e-6
    scaled = (inputs - net.mean) / net.scale

    weights = [net.hidden, net.hidden_bias, net.out, np.zeros(1)]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    step = 0
    for _ in range(epochs):
        for batch in np.array_split(random.permutation(learn), max(1, len(learn) // 256)):
            x, y = scaled[batch], labels[batch]
            layer = np.maximum(x @ weights[0] + weights[1], 0)
            error = (1 / (1 + np.exp(-np.clip(layer @ weights[2] + weights[3][0], -30, 30))) - y) / len(batch)
            back = np.outer(error, weights[2]) * (layer > 0)
            slopes = [x.T @ back + 1e-4 * weights[0], back.sum(0), layer.T @ error, error.sum(keepdims=True)]
            step += 1
            for weight, slope, (first, second) in zip(weights, slopes, moments, strict=True):
                first += 0.1 * (slope - first)
                second += 0.001 * (slope * slope - second)
                weight -= 0.005 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    net.out_bias = float(weights[3][0])
    raw = net.logits(inputs[held])
    choices = np.exp(np.linspace(np.log(0.25), np.log(8), 64))
    net.temperature = float(min(choices, key=lambda t: _loss(raw / t, labels[held])))
    return net


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; rows of fold 0 are held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Pooled vectors and labels of at most `sample` labelled documents outside fold 0.

    A document with contradicting labels teaches nothing.
    """
    known = (
        labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL")
        .filter(fold(F.col("doc_id")) != 0)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_low"), F.max("quality").alias("_high"))
        .filter("_low = _high")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
        .select("doc_id", F.col("_low").cast("int").alias("label"))
    )
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                pooled = pa.array(list(pool(part, shared.value)), pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pooled], ["doc_id", "label", "pooled"]
                )

    # The sample's size is a parameter, so it may go to every task.
    chosen = docs.join(F.broadcast(known), "doc_id").select("doc_id", "label", "text")
    rows = chosen.mapInArrow(run, "doc_id long, label int, pooled array<float>").toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    inputs = np.array(rows["pooled"].tolist(), np.float32).reshape(-1, 2 * DIMENSIONS)
    return inputs, rows["label"].to_numpy(np.int64)


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of `docs`, which has doc_id and text.

    `labels` has doc_id and quality (0 or 1; others are passed over). Only texts are inputs;
    labels of rows whose fold is 0 are not learnt from. A null or empty text has no tokens and
    gets the score of that. Repeated rows are scored alike.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    vectors = word_vectors(rows)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    network = fit(*training_rows(rows, known, vectors, sample))
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, network = shared.value
        for batch in batches:
            for part in chunks(batch):
                scores = network.probabilities(pool(part, vectors))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
                )

    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
