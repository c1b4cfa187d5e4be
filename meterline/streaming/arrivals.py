"""The fact load for files that keep arriving: each landed file is loaded once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from meterline import schema
from meterline.operators.fact import fact_rows


def arriving_trips(spark: SparkSession, landed: str, files_per_batch: int = 1000) -> DataFrame:
    """Raw trips of files under `landed` as they appear; they are landed under the one layout."""
    return (
        spark.readStream.schema(schema.LANDED_TRIP)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .parquet(landed)
    )


def load_arrivals(raw: DataFrame, out: str, checkpoint: str, year: int) -> StreamingQuery:
    """Write fact rows of all files that are there and not yet loaded, then stop.

    The checkpoint remembers which files were taken and the sink which batches were
    written, so a run that is repeated or resumed after a failure adds no row twice. Rows
    are judged one by one: there is no state to keep and no shuffle.
    """
    return (
        fact_rows(raw, year)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
