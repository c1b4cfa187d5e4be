"""From raw documents to token ids: five stages, each reading what the one before it has written."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import bpe, jaccard, lines, mixing, quality
from meterline.llm.common import stored, table
from meterline.operators.numbering import assign_ids

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_ids(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    ids = chosen.select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")


def _placed(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """`docs` with columns that give its rows' order: the files' numbers and the places in them.

    Spark reads large files first and packs small ones together, so the order must be asked for.
    """
    try:
        file, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
        number = F.regexp_extract(file, r"^part-(\d+)", 1).try_cast("long")
        placed = docs.select("doc_id", "text", number.alias("_part"), file.alias("_file"), row.alias("_row"))
        return placed, ["_part", "_file", "_row"]
    except AnalysisException:
        # Not read from files: the rows are in the order of their partitions.
        return docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row")), ["_row"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their hosts' boilerplate lines; a doc_id with
    several rows stays if one of them does."""
    common = quality.common_lines(docs)
    kept = _with_ids(docs.select(*COLUMNS), quality.judge(docs, common=common).filter("kept"))
    left = quality.drop_boilerplate(kept, common)
    size = F.when(F.col("kept_text").eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(F.char_length("kept_text"))
    return left.withColumns({"text": F.col("kept_text"), "n_chars": size.cast("long")}).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; `n_chars` follows the text."""
    left = lines.drop_repeated_lines(docs.select(*COLUMNS), min_docs=10)
    return left.withColumns({"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}).select(
        *COLUMNS
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the least doc_id; a null one is in no group."""
    return _with_ids(docs.select(*COLUMNS), jaccard.join(docs).filter("doc_id <=> component_id"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix; the files written hold them in that order, and `encode` keeps it."""
    return mixing.in_mixed_order(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests of the token ids and of the text decoded from them, and `place`: from 0
    up, the row's place in the mix, which is the order in which the files of the stage before hold their rows."""
    placed, place = _placed(docs)
    coded = bpe.encode_decode(placed, public_tokenizers.path("word_bpe_49k.json"), keep=place)
    # Written before they are numbered, which looks at its rows twice, as coding is the costly part.
    digests = stored(bpe.digests(coded, keep=place), "pipeline_digests")
    return assign_ids(digests, place, "place", start=0).drop(*place).orderBy("place")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# The Jaccard groups and the byte-pair merges are beyond SQL that would end on whole tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
