"""Append to a database table over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameWriter

# Rows per insert batch and connections writing at once.
BATCH_ROWS = 20_000
WRITERS = 8


def staged(df: DataFrame, writers: int | None = WRITERS) -> DataFrame:
    """Rows dealt evenly to `writers` partitions, one connection each; None leaves them as they are.

    The count bounds the database's connections, not the work before it, which keeps its
    own parallelism up to the shuffle. Raise it with what the database can take.
    """
    return df.repartition(writers) if writers else df


def jdbc_writer(
    df: DataFrame,
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str = "org.postgresql.Driver",
    batch_rows: int = BATCH_ROWS,
    writers: int | None = WRITERS,
    options: Mapping[str, str] | None = None,
) -> DataFrameWriter:
    """The configured append; `.save()` runs it.

    Each partition commits on its own, so a task that is retried after its commit inserts
    its rows twice. Give the rows their identity first (`operators.numbering.assign_ids`):
    the table's primary key then refuses the second copy. Keep speculation off.
    """
    settings = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": str(batch_rows),
        **(options or {}),
    }
    return staged(df, writers).write.format("jdbc").mode("append").options(**settings)


def append_jdbc(df: DataFrame, **settings) -> None:
    jdbc_writer(df, **settings).save()
