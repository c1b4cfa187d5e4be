"""Vector code compression: product quantisation in whole numbers, by exact matrix products.

Vectors become integers, cut into parts; each part is replaced by the place of its nearest
entry in that part's codebook. Distances come from matrix products in float64, which are
exact as long as no sum reaches 2^53. So integers are broken into limbs that keep every
product of two limbs below that, and the products are put together again in 64-bit integers.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline.llm.common import stored

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
# So many vectors at a time are compared with a codebook.
_ROWS = 1024


def limb_bits(length: int) -> int:
    """How wide limbs may be for a sum of `length` products of two of them to stay below 2^53."""
    return (53 - max(1, length).bit_length()) // 2


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """Matrices of numbers below 2^bits in size; shifted by 0, bits, 2 bits, ... they add up to
    `values`. The last one has the sign."""
    parts = []
    while values.size and np.abs(values).max() >= 1 << bits:
        parts.append(values & ((1 << bits) - 1))
        values = values >> bits
    return [part.astype(np.float64) for part in (*parts, values)]


def products(left: np.ndarray, right: np.ndarray, bits: int | None = None) -> np.ndarray:
    """All dot products of the rows of two int64 matrices, exact where they fit 64 bits."""
    bits = bits or limb_bits(left.shape[1])
    total = np.zeros((len(left), len(right)), np.int64)
    columns = limbs(right.T, bits)
    for i, one in enumerate(limbs(left, bits)):
        for j, other in enumerate(columns):
            total += (one @ other).astype(np.int64) << (bits * (i + j))
    return total


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each point the first of the entries at the least squared distance, and that distance."""
    places, errors = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
    sizes = (entries * entries).sum(1)
    for at in range(0, len(points), _ROWS):
        some = points[at : at + _ROWS]
        apart = (some * some).sum(1)[:, None] - 2 * products(some, entries) + sizes
        places[at : at + _ROWS] = best = apart.argmin(1)
        errors[at : at + _ROWS] = apart[np.arange(len(some)), best]
    return places, errors


@dataclass(frozen=True)
class Codebooks:
    """`entries` by part, entry and position; `length` numbers of a vector, the rest of the last part is zero."""

    entries: np.ndarray
    length: int
    scale: int

    def cut(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors as integers by part, vector and position."""
        parts, _, width = self.entries.shape
        whole = np.zeros((len(vectors), parts * width), np.int64)
        whole[:, : self.length] = np.floor(vectors * self.scale)
        return whole.reshape(-1, parts, width).swapaxes(0, 1)

    def digest(self) -> str:
        """Lowercase hex SHA-256 of all numbers, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _largest(length: int, scale: int) -> float:
    """Vectors whose numbers stay within this have squared distances that fit 64 bits."""
    return math.isqrt((1 << 61) // length) // scale


def usable(vectors: DataFrame, scale: int) -> tuple[DataFrame, int]:
    """The rows whose vector can be coded, with it as array<double>, and the length of these vectors (0: none can).

    A vector that is null, empty, or holds null, NaN or an infinity is left out. All others
    have as many numbers as the one of the least vec_id. One of another length, or with a
    number so large that a squared distance could leave 64 bits, is left out as well.
    """
    numbers = vectors.withColumn("embedding", F.col("embedding").cast("array<double>"))
    finite = numbers.filter(F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & (F.size("embedding") > 0))
    first = finite.orderBy(F.asc_nulls_last("vec_id"), "embedding").select(F.size("embedding").alias("n")).first()
    length = first["n"] if first else 0
    bound = _largest(length, scale) if length else 0.0
    fits = F.forall("embedding", lambda x: F.abs(x) <= F.lit(float(bound)))
    return finite.filter((F.size("embedding") == length) & fits), length


def _matrix(column: pa.ListArray, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, length)


def fit(kept: DataFrame, length: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks of the `kept` rows of `usable`, started from those of the least vec_ids.

    Each round tasks add up the parts nearest to every entry; Spark adds up the tasks'
    sums, and the driver sees one number for each number of the codebooks. Entries become
    their parts' averages, rounded down; one that no part is nearest to stays.
    """
    seeds = kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).select("embedding").collect()
    width = -(-length // parts) if length else 1
    books = Codebooks(np.zeros((parts, 0, width), np.int64), length, scale)
    if not seeds:
        return books
    books = Codebooks(books.cut(np.array([row["embedding"] for row in seeds], np.float64)), length, scale)
    for _ in range(rounds):
        books = Codebooks(_averages(kept, books), length, scale)
    return books


def _averages(kept: DataFrame, books: Codebooks) -> np.ndarray:
    parts, entries, width = books.entries.shape
    shared = kept.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        # Of each entry its parts' sums, and last their number.
        sums = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            cut = books.cut(_matrix(batch.column("embedding"), books.length))
            for part in range(parts):
                places, _ = nearest(cut[part], books.entries[part])
                np.add.at(sums[part, :, width], places, 1)
                np.add.at(sums[part, :, :width], places, cut[part])
        flat = sums.ravel()
        slots = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(flat[slots])], ["slot", "total"])

    partial = kept.select("embedding").mapInArrow(run, "slot long, total long")
    summed = partial.groupBy("slot").agg(F.sum("total").alias("total")).toPandas()
    sums = np.zeros(parts * entries * (width + 1), np.int64)
    sums[summed["slot"].to_numpy(np.int64)] = summed["total"].to_numpy(np.int64)
    sums = sums.reshape(parts, entries, width + 1)
    counts = sums[:, :, width:]
    return np.where(counts > 0, sums[:, :, :width] // np.maximum(counts, 1), books.entries)


def encode(kept: DataFrame, books: Codebooks) -> DataFrame:
    """The rows of `kept` with `code`, two hex digits a part, and `error`, the squared distances' sum, for the vector."""
    names = [name for name in kept.columns if name not in ("embedding", "code", "error")]
    shared = kept.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        digits = 2 * len(books.entries)
        for batch in batches:
            cut = books.cut(_matrix(batch.column("embedding"), books.length))
            found = [nearest(part, entries) for part, entries in zip(cut, books.entries, strict=True)]
            text = np.stack([places for places, _ in found], 1).astype(np.uint8).tobytes().hex()
            codes = pa.array([text[at : at + digits] for at in range(0, len(text), digits)], pa.string())
            errors = pa.array(sum(errors for _, errors in found), pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in names], codes, errors], [*names, "code", "error"])

    schema = kept.select(*names).schema.add("code", "string").add("error", "long")
    return kept.mapInArrow(run, schema)


def decode(coded: DataFrame, books: Codebooks) -> DataFrame:
    """`coded` with `decoded`, the vector that its code stands for."""
    names = [name for name in coded.columns if name != "decoded"]
    shared = coded.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        parts = len(books.entries)
        for batch in batches:
            places = np.frombuffer(bytes.fromhex("".join(batch.column("code").to_pylist())), np.uint8).reshape(-1, parts)
            flat = books.entries[np.arange(parts), places].reshape(len(places), -1)[:, : books.length] / books.scale
            vectors = pa.FixedSizeListArray.from_arrays(pa.array(flat.ravel()), max(1, books.length))
            columns = [*[batch.column(name) for name in names], vectors.cast(pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, [*names, "decoded"])

    return coded.select(*names).mapInArrow(run, coded.select(*names).schema.add("decoded", T.ArrayType(T.DoubleType())))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """The vectors that can be coded (see `usable`) with `code` and `error`, and the codebooks.

    `vectors` has vec_id and embedding, and is read once for each round and twice more; its
    other columns stay (`code` and `error` are replaced, embedding goes). Every row is a
    vector of its own, also one of a repeated or null vec_id; null ids come last, and equal
    ids in the order of their vectors. Fewer vectors than `entries` (256 at most) make as many
    entries. A length that `parts` does not divide is filled up with zeros. Without vectors
    the result is empty. Sums are exact: Spark raises an error rather than leave 64 bits.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part")
    kept, length = usable(vectors, scale)
    books = fit(kept, length, parts, entries, rounds, scale)
    return encode(kept, books), books


def digests(coded: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, code, error, the sum of errors of equal labels (nulls together; null beyond 64 bits), and the codebooks' digest.

    Errors are added up by tasks first, and the sums meet their rows from a table, so a label
    that a third of the rows share is split.
    """
    held = stored(coded.select("vec_id", "label", "code", "error"), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = held.groupBy("label").agg(total.try_cast("long").alias("label_error"))
    sums = stored(sums.withColumnRenamed("label", "_label"), "label_errors")
    return held.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )
