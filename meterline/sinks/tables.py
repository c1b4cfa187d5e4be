"""Warehouse tables as typed Parquet folders under one root, and the log that says which of them count.

Every write goes to a folder of its own. A table is what its rows in the log name: the last
folder that replaced it and those added since. A log entry is one small file, so a change, even of several
tables, is there as a whole or not at all: whoever dies before it leaves folders that nobody
reads, and the rows from before stay readable meanwhile.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline import schema
from meterline.operators.upsert import new_rows
from meterline.sources.trips import exists, remove_folder, subfolders


class Change(NamedTuple):
    """A row of the log: `folder` replaces a table or is added to it; none empties it.

    Facts also tell the landed month they come from, its size in bytes, and the identities used, from first_id
    up to but without next_id. One folder may hold several months.
    """

    table: str
    replaces: bool
    folder: str | None
    year: int | None = None
    folder_year: int | None = None
    month: int | None = None
    first_id: int | None = None
    next_id: int | None = None
    landed: int | None = None


LOG = T.StructType(
    [
        T.StructField("at", T.LongType()),
        T.StructField("table", T.StringType()),
        T.StructField("replaces", T.BooleanType()),
        T.StructField("folder", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("folder_year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("first_id", T.LongType()),
        T.StructField("next_id", T.LongType()),
        T.StructField("landed", T.LongType()),
    ]
)


def typed(df: DataFrame, table: T.StructType) -> DataFrame:
    """`df` with the columns, order and types of `table`."""
    return df.selectExpr(*[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in table])


def read_log(spark: SparkSession, root: str) -> list[Row]:
    """All changes of all tables under `root` in their order: a row for each write, so they fit the driver."""
    log = _path(root, "table_log")
    if not exists(spark, log):
        return []
    return sorted(spark.read.schema(LOG).parquet(log).collect(), key=lambda row: (row["at"], row["folder"] or ""))


def counted(log: list[Row]) -> list[Row]:
    """The changes that make up the tables now: each one's last replacement and what was added since."""
    last = {row["table"]: row["at"] for row in log if row["replaces"]}
    return [row for row in log if row["at"] >= last.get(row["table"], 0)]


def commit(spark: SparkSession, root: str, changes: list[Change]) -> None:
    """Enter the changes, all at once. One writer at a time changes a root's tables."""
    at = max((row["at"] for row in read_log(spark, root)), default=0) + 1
    rows = [(at, *change) for change in changes]
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(_path(root, "table_log"))


def read_tables(spark: SparkSession, root: str, names: Iterable[str] = tuple(schema.TABLES)) -> dict[str, DataFrame]:
    """The named tables; one that was never made is empty. The log is read once."""
    rows = counted(read_log(spark, root))

    def read(name: str) -> DataFrame:
        # Several months may share a folder.
        folders = list(dict.fromkeys(_path(root, row["folder"]) for row in rows if row["table"] == name and row["folder"]))
        if not folders:
            nothing = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema.TABLES[name]]
            return spark.range(0).select(*nothing)
        return spark.read.schema(schema.TABLES[name]).parquet(*folders)

    return {name: read(name) for name in names}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_tables(spark, root, [name])[name]


def recreate_tables(spark: SparkSession, root: str, names: Iterable[str] = tuple(schema.TABLES)) -> None:
    """Leave each named table present and empty; with the facts goes what was loaded of them."""
    changes = [Change(name, True, None) for name in names]
    if changes:
        commit(spark, root, changes)


def ensure_tables(spark: SparkSession, root: str) -> None:
    """Make the tables that are missing under `root`."""
    there = {row["table"] for row in read_log(spark, root)}
    recreate_tables(spark, root, [name for name in schema.TABLES if name not in there])


def loads(spark: SparkSession, root: str) -> list[Row]:
    """The landed months that are in the facts, with the identities they used."""
    return [row for row in counted(read_log(spark, root)) if row["table"] == "fact_trip" and row["month"] is not None]


def each_table(work: Callable[[str], None], names: Iterable[str]) -> list:
    """Run `work` for every table at once: small jobs that would mostly wait for each other."""
    with ThreadPoolExecutor(max_workers=len(schema.TABLES)) as side_by_side:
        return list(side_by_side.map(work, names))


def write_folder(df: DataFrame, root: str, name: str) -> str:
    """Write rows of a table into a folder of their own, and return its name. Nobody reads it until a change names it."""
    folder = f"{name}/{uuid.uuid4().hex}"
    typed(df, schema.TABLES[name]).write.parquet(_path(root, folder))
    return folder


def append_table(df: DataFrame, root: str, name: str) -> None:
    commit(df.sparkSession, root, [Change(name, False, write_folder(df, root, name))])


def insert_missing(spark: SparkSession, root: str, batches: Mapping[str, DataFrame]) -> None:
    """Append the rows of each batch whose key its table lacks; running it again adds nothing."""
    there = read_tables(spark, root, batches)

    def write(name: str) -> Change:
        key = schema.PRIMARY_KEYS[name]
        rest = [column for column in schema.TABLES[name].names if column != key]
        return Change(name, False, write_folder(new_rows(there[name], batches[name], [key], rest), root, name))

    commit(spark, root, each_table(write, batches))


def truncate_and_reload(
    spark: SparkSession, root: str, reload: Mapping[str, DataFrame], also_empty: Iterable[str] = ()
) -> None:
    """Empty the tables in `also_empty` and replace those in `reload`, all in one change.

    Nothing is emptied that is not named: emptying facts along with their zones, as a
    cascading truncate would, has to be asked for. If a write fails, all tables stay as they were.
    """
    changes = [Change(name, True, None) for name in also_empty]
    changes += [Change(name, True, write_folder(rows, root, name)) for name, rows in reload.items()]
    commit(spark, root, changes)


def clear_unused(spark: SparkSession, root: str) -> int:
    """Remove the folders no table is made of any more, and say how many.

    Only while nobody writes under `root`, as a folder being written is in no table yet,
    nor reads what was there before the last change.
    """
    used = {row["folder"] for row in counted(read_log(spark, root))}
    unused = [f"{name}/{part}" for name in schema.TABLES for part in subfolders(spark, _path(root, name)) if f"{name}/{part}" not in used]
    for folder in unused:
        remove_folder(spark, _path(root, folder))
    return len(unused)


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"
