"""Quality rules: lines that too many documents of a host share, and rules on single texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm import words as W
from meterline.llm.common import BLANKS, chunks, stored, texts, utf8

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# A line is boilerplate of its host if this many distinct documents of the host hold it,
# and this share of them.
LINE_DOCS = 10
LINE_PERCENT = 2
# A document is depleted if fewer of its words than this share lie outside boilerplate.
KEPT_PERCENT = 30

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


def _line_hash(line: str, host: str) -> int:
    """One number for a line of a host: blanks at both ends and the case of A to Z do not count."""
    # bytes.lower() changes A to Z alone.
    key = line.strip(BLANKS).encode().lower()
    return xxhash.xxh64_intdigest(key, xxhash.xxh64_intdigest(host.encode())) - (1 << 63)


def _worded_lines(text: str) -> list[str]:
    return [line for line in text.split("\n") if line.strip(BLANKS)]


def host_lines(docs: DataFrame, keep: str) -> DataFrame:
    """`keep`, host and line (the hash of a host and a line of it that has a word) with the place of
    the line in its text, once per row and line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                rows, places, lines = [], [], []
                hosts = texts(part.column("host"))
                for row, (text, host) in enumerate(zip(texts(part.column("text")), hosts, strict=True)):
                    for place, line in enumerate(text.split("\n")):
                        if line.strip(BLANKS):
                            rows.append(row)
                            places.append(place)
                            lines.append(_line_hash(line, host))
                at = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(keep).take(at),
                        part.column("host").take(at),
                        pa.array(lines, pa.int64()),
                        pa.array(places, pa.int32()),
                    ],
                    [keep, "host", "line", "place"],
                )

    return docs.select(keep, "host", "text").mapInArrow(run, f"{keep} long, host string, line long, place int")


def boilerplate(docs: DataFrame, line_docs: int, line_percent: float) -> DataFrame:
    """The hashes of lines that at least `line_docs` and `line_percent` % of their host's documents hold.

    Rows of one doc_id are one document, and so are those without one. One row per document
    and line is left before lines are counted, and tasks add up their own counts first, so
    neither a host nor a line with most of the rows makes a large group.
    """
    held = host_lines(docs, "doc_id").select("doc_id", "host", "line").distinct()
    counts = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("_docs"))
    each = docs.select("doc_id", F.col("host").alias("_host")).distinct()
    sizes = each.groupBy("_host").agg(F.count(F.lit(1)).alias("_all"))
    return (
        counts.filter(F.col("_docs") >= line_docs)
        .join(sizes, F.col("host").eqNullSafe(F.col("_host")))
        .filter(F.col("_docs") * 100 >= F.col("_all") * line_percent)
        .select("line")
        .distinct()
    )


def _rows(docs: DataFrame, host: str) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.col("text").cast("string").alias("text"),
    )


def common_lines(
    docs: DataFrame, host: str = "source", line_docs: int = LINE_DOCS, line_percent: float = LINE_PERCENT
) -> DataFrame:
    """The table of `boilerplate` for `docs`; written, so that Spark sees if it can go to every task."""
    return stored(boilerplate(_rows(docs, host), line_docs, line_percent), "boilerplate")


def drop_boilerplate(docs: DataFrame, common: DataFrame, host: str = "source") -> DataFrame:
    """`docs` with their columns and `kept_text`, the text without its lines in `common`.

    A text that has none of them stays as it is, null included; one that has no other lines
    is empty. Hashes and places are shuffled to find the lines, texts once to drop them.
    """
    name = F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col(host).cast("string"), F.lit("")), "text")
    found = host_lines(_rows(docs, host).withColumn("_name", F.xxhash64("doc_id", "host", "text")), "_name")
    places = found.join(common, "line").groupBy("_name").agg(F.collect_set("place").alias("_places"))
    lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_places"))
    kept = F.array_join(F.transform(left, lambda place: F.get(lines, place)), "\n")
    return (
        docs.withColumns({"text": F.col("text").cast("string"), "_name": name})
        .join(places, "_name", "left")
        .withColumn("kept_text", F.when(F.col("_places").isNull(), F.col("text")).otherwise(kept))
        .select(*[column for column in docs.columns if column not in ("_name", "_places", "kept_text")], "kept_text")
    )


def _repeated_words(hashes: np.ndarray, words: W.Words) -> np.ndarray:
    """Which words lie in a run of three that its text has twice or more."""
    repeated = np.zeros(len(words.starts), bool)
    at = np.flatnonzero(W.runs_inside(words, 3))
    owner = words.text_of_word()[at].astype(np.uint64)
    keys = W.mix(W.hash_runs(hashes, 3)[at] + owner * W.U(0x9E3779B97F4A7C15))
    ranked = np.sort(keys)
    twice = ranked[1:][ranked[1:] == ranked[:-1]]
    if len(twice):
        place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
        first = at[twice[place] == keys]
        for word in range(3):
            repeated[first + word] = True
    return repeated


_MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _measure(part: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = utf8(part.column("text"))
    words = W.split(data, offsets)

    def between(marked: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marked, dtype=np.int64)])
        return sums[cuts[1:]] - sums[cuts[:-1]]

    n_dup, n_lines, lines, line_words = [], [], [], []
    hosts = texts(part.column("host"))
    for text, host in zip(texts(part.column("text")), hosts, strict=True):
        full = _worded_lines(text)
        n_dup.append(len(full) - len(set(full)))
        n_lines.append(len(full))
        lines += [_line_hash(line, host) for line in full]
        line_words += [len(line.encode().split()) for line in full]
    # Bytes 128 to 191 continue a letter that began before them.
    begun = (data & 0xC0) != 0x80
    measures = [
        np.diff(words.bounds),
        between(begun & ~W.BLANK[data], offsets),
        between(_SYMBOLS[data], offsets),
        n_dup,
        between(_repeated_words(W.hash_words(data, words), words), words.bounds),
    ]
    listed = pa.ListArray.from_arrays(
        pa.array(np.cumsum([0, *n_lines], dtype=np.int32)),
        pa.StructArray.from_arrays([pa.array(lines, pa.int64()), pa.array(line_words, pa.int32())], ["line", "words"]),
    )
    return pa.RecordBatch.from_arrays(
        [part.column("row"), part.column("doc_id"), *[pa.array(m, pa.int64()) for m in measures], listed],
        ["row", "doc_id", *_MEASURES, "lines"],
    )


def judge(
    docs: DataFrame,
    host: str = "source",
    line_docs: int = LINE_DOCS,
    line_percent: float = LINE_PERCENT,
    kept_percent: float = KEPT_PERCENT,
    common: DataFrame | None = None,
) -> DataFrame:
    """One row for each of `docs` with doc_id, its measures and whether it is kept.

    `n_words`, `word_chars` (code points in words), `n_symbols` (of #*$%&|<>), `n_dup_lines`
    (lines with a word equal to an earlier one) and `n_repeat_words` (words in three-word
    windows the text has twice or more) look at the text alone; `base_failed` says that it has
    under 50 words or over half of them repeat. `n_boilerplate` counts words in lines that
    enough documents of the host share; with too few words outside of these the document is
    depleted. `kept` is neither failed nor depleted.

    A null text has no words and so is not kept. A null host is a host of its own, equal to
    the empty one. Repeated rows are judged each, and are one document where a line's are
    counted. `common` is what `common_lines` gives, if it has been called before.
    """
    rows = _rows(docs, host)
    common = common_lines(docs, host, line_docs, line_percent) if common is None else common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                yield _measure(part)

    types = ", ".join(f"{name} long" for name in ["row", "doc_id", *_MEASURES])
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    measured = numbered.mapInArrow(run, f"{types}, lines array<struct<line: long, words: int>>")
    per_line = measured.select("row", "doc_id", *_MEASURES, F.explode_outer("lines").alias("_in"))
    per_line = per_line.select("row", "doc_id", *_MEASURES, "_in.line", "_in.words")
    found = per_line.join(common.withColumn("_common", F.lit(True)), "line", "left")
    in_common = F.sum(F.when(F.col("_common"), F.col("words")).otherwise(0))
    judged = found.groupBy("row", "doc_id", *_MEASURES).agg(in_common.alias("n_boilerplate")).drop("row")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    left = F.col("n_words") - F.col("n_boilerplate")
    depleted = left * 100 < F.col("n_words") * kept_percent
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)
