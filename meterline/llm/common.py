"""Reading, storing and chunking, shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession

from meterline.session import scratch_path

# White space as the contracts of this folder mean it: space, and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"

# Unicode's White_Space for character classes, and the Latin-1 part of it, of
# letters and of numbers.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LATIN_SPACE = r"\t-\r \x85\xa0"
LATIN_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
LATIN_NUMBERS = "0-9²³¹¼½¾"
UNASSIGNED = regex.compile(r"\p{Cn}")

_ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Rows can be long texts: so many at a time go to a Python worker.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    # Python workers of a local session find this package where the driver found it.
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """`df` written to the shared scratch folder and read from there: its lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(column: pa.Array) -> list[str]:
    """The texts of a string column; null counts as empty."""
    return pc.fill_null(column, "").to_pylist()


def is_latin(text: str) -> bool:
    """Whether all of a text is Latin-1."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets between its texts; null counts as empty."""
    held = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = held.buffers()
    if len(held) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(held) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[held.offset : held.offset + len(held) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: str = "text", size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of `batch` with about `size` bytes of text each, or one text if that is longer."""
    _, offsets = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
