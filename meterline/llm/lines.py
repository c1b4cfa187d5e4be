"""Line dedup, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import BLANKS, stored

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def split_lines(text: Column) -> Column:
    """The lines of a text, cut at line feeds; null or empty gives one empty line."""
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """What makes two lines the same: blanks at both ends and the case of A to Z do not count."""
    bare = F.btrim(line, F.lit(BLANKS))
    # lower() also changes letters outside A to Z, and translate() goes letter by letter.
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def repeated_lines(docs: DataFrame, min_docs: int, min_length: int = 1) -> DataFrame:
    """doc_id, text_hash and places: which lines of a row have a key of at least `min_length`
    code points that at least `min_docs` distinct doc_ids hold. Rows without any are absent.

    Lines are hashed to 128 bits, so only hashes and places are shuffled, never texts. They
    are counted after one row per document and key is left, and tasks add up their own
    counts first: a line that a third of all documents share is one row per task. It meets
    its documents in a sort-merge join, whose large partitions Spark splits.
    """
    lines = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.transform(split_lines(F.col("text")), line_key)).alias("place", "key"),
    ).filter(F.char_length("key") >= min_length)
    lines = stored(lines.withColumn("key", F.unhex(F.md5("key"))), "lines")
    per_doc = lines.select("key", "doc_id").distinct()
    frequent = per_doc.groupBy("key").agg(F.count(F.lit(1)).alias("_docs")).filter(F.col("_docs") >= min_docs)
    # From a table, so that Spark sees its size, and splits large partitions if it is large.
    hits = lines.join(stored(frequent.select("key"), "frequent_lines"), "key")
    return hits.groupBy("doc_id", "text_hash").agg(F.collect_set("place").alias("places"))


def drop_repeated_lines(docs: DataFrame, min_docs: int = 10, min_length: int = 1) -> DataFrame:
    """`docs` with the text left after all its repeated lines are dropped, and how many lines
    it had and lost, as columns `kept_text`, `n_lines` and `n_dropped`.

    Every row stays, with all its columns, which must include doc_id and text; columns of
    the three names are replaced. A null or empty text is one empty line, whose key is too
    short to be dropped. A null doc_id counts as one document. Repeated rows are one
    document and get the same result each. A row that loses all lines keeps an empty text.
    """
    rows = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    dropped = repeated_lines(rows.select("doc_id", "text"), min_docs, min_length)
    dropped = dropped.select(*[F.col(name).alias(f"_dropped_{name}") for name in dropped.columns])
    same = F.col("doc_id").eqNullSafe(F.col("_dropped_doc_id")) & (
        F.xxhash64("text") == F.col("_dropped_text_hash")
    )
    lines = split_lines(F.col("text"))
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    left = F.array_except(places, F.coalesce("_dropped_places", F.array().cast("array<int>")))
    kept = F.array_join(F.transform(left, lambda place: F.get(lines, place)), "\n")
    return (
        rows.join(dropped, same, "left")
        .withColumns(
            {
                "kept_text": F.when(F.col("_dropped_places").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept),
                "n_lines": F.size(lines).cast("long"),
                "n_dropped": F.coalesce(F.size("_dropped_places"), F.lit(0)).cast("long"),
            }
        )
        .drop("_dropped_doc_id", "_dropped_text_hash", "_dropped_places")
    )


def digests(dropped: DataFrame) -> DataFrame:
    return dropped.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
