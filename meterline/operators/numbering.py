"""Row identities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.session import scratch_path

# monotonically_increasing_id: partition number above, row number in the partition below.
_POSITION_BITS = 33


def assign_ids(
    df: DataFrame,
    order_by: Sequence[str] | None = None,
    into: str = "trip_id",
    start: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Add the ids start, start+1, ... without gaps, in the order of `order_by` if given.

    Every row is written once with its place in its partition; the ids then follow from the
    row counts of the partitions before it. The written copy keeps the places fixed if an
    executor is lost or the ids are read again, and no task sees more than one partition.

    Without `order_by` rows are numbered where they lie: no shuffle, and nothing to be
    skewed. With it they are range-partitioned first; its columns together must be unique,
    and as the ranges are cut on all of them, many rows sharing the first are still split.
    """
    spark = df.sparkSession
    placed = df
    if order_by:
        placed = df.repartitionByRange(*([partitions] if partitions else []), *order_by)
        placed = placed.sortWithinPartitions(*order_by)
    path = scratch_path(spark, "numbering")
    (
        placed.withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", _POSITION_BITS).cast("int"))
        .write.parquet(path)
    )
    placed = spark.read.parquet(path)
    # One row per partition, so this is as small as the shuffle is wide.
    counts = {row["_part"]: row["n"] for row in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = start, []
    for part in sorted(counts):
        offsets.append((part, before - (part << _POSITION_BITS)))
        before += counts[part]
    if not offsets:
        return df.withColumn(into, F.lit(None).cast("bigint"))
    shifts = spark.createDataFrame(offsets, "_part int, _shift bigint")
    return (
        placed.join(F.broadcast(shifts), "_part")
        .withColumn(into, F.col("_place") + F.col("_shift"))
        .drop("_part", "_place", "_shift")
    )


def sparse_ids(df: DataFrame, into: str = "trip_id", start: int = 1) -> DataFrame:
    """Unique ids from `start` up, with gaps, for a frame that is written once and read from there.

    One pass with no copy kept, as a load needs at scale; computing the frame anew may
    number its rows anew.
    """
    return df.withColumn(into, F.monotonically_increasing_id() + F.lit(start))


def next_id(table: DataFrame, id_column: str = "trip_id") -> int:
    """The id after the highest in `table`, to go on numbering an append from."""
    return (table.agg(F.max(id_column).alias("top")).first()["top"] or 0) + 1
