"""Land raw monthly files under year=/month=."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterline import schema
from meterline.sinks.months import append_month, replace_month
from meterline.sinks.snapshots import checksum
from meterline.sources.trips import as_layout, damaged, exists, period_columns, period_of, read_file, widest


class Landed(NamedTuple):
    """What one month got: its files, and how many rows they hold together."""

    period: tuple[str, str]
    files: list[str]
    rows: int


def uniform(df: DataFrame, *keep: str) -> DataFrame:
    """`keep` and the raw columns under the one landed layout, whatever this month's file has.

    Only the optional columns may be missing, and no column may be unknown: either raises, as
    the trips would be taken for others than they are. A number that its column's type cannot
    hold becomes NULL, and the accept rules find it.
    """
    held = {name.lower(): name for name in df.columns}
    known = {field.name.lower(): field for field in schema.LANDED_TRIP}
    missing = [f.name for key, f in known.items() if key not in held and f.name not in schema.OPTIONAL_RAW_COLUMNS]
    unknown = [name for key, name in held.items() if key not in known and name not in keep]
    if missing or unknown:
        raise ValueError(f"raw trips lack {missing} and have unknown {unknown}")
    columns = list(keep)
    for key, field in known.items():
        kind = field.dataType.simpleString()
        if key in held:
            columns.append(f"TRY_CAST(`{held[key]}` AS {kind}) AS {field.name}")
        else:
            columns.append(f"CAST({schema.OPTIONAL_RAW_COLUMNS[field.name]} AS {kind}) AS {field.name}")
    return df.selectExpr(*columns)


def land_file(
    spark: SparkSession, path: str, root: str, repeatable: bool = True, one_layout: bool = False
) -> tuple[str, str]:
    """Land one raw file as `land_files` does, and return its month."""
    return land_files(spark, [path], root, None, repeatable, one_layout)[0].period


def land_files(
    spark: SparkSession,
    paths: Sequence[str],
    root: str,
    quarantine: str | None = None,
    repeatable: bool = True,
    one_layout: bool = False,
) -> list[Landed]:
    """Put raw files into the months their names state, each month written once from all its files.

    `repeatable` replaces what a month holds, so that a rerun does not double it; give all
    files of a month in one call. Without it the rows are added. Files are landed as they are,
    those of a month under the widest types of their columns, or with `one_layout` as
    `uniform` makes them: a tree of such files is read with `layout=schema.LANDED_TRIP`, with
    no look at its files beforehand. Every month is read back and compared.

    A file whose name states no month that exists, or that cannot be opened, raises before anything
    is landed, unless there is a `quarantine`. The rows of the first kind go there with their
    file's path; of the second, the path and the error go to `_damaged` in it. The other files
    land.
    """
    bad = damaged(spark, paths)
    if bad and quarantine is None:
        raise ValueError(f"cannot be opened: {bad}")
    if bad:
        aside = spark.createDataFrame(sorted(bad.items()), "file_path string, error string")
        aside.coalesce(1).write.mode("append").parquet(f"{quarantine.rstrip('/')}/_damaged")
    paths = [path for path in paths if path not in bad]
    by_month: dict[tuple[str, str], list[str]] = {}
    nameless = []
    for path in dict.fromkeys(paths):
        try:
            by_month.setdefault(_existing_month(path), []).append(path)
        except ValueError:
            if quarantine is None:
                raise
            nameless.append(path)
    for path in nameless:
        stated = period_columns(F.lit(path))
        aside = read_file(spark, path).withColumns({key: stated[key] for key in ("year", "month")})
        aside.withColumn("file_path", F.lit(path)).write.mode("append").parquet(quarantine)
    return [
        Landed(period, files, _put(_together(spark, files, one_layout), root, period, repeatable))
        for period, files in sorted(by_month.items())
    ]


def _existing_month(path: str) -> tuple[str, str]:
    year, month = period_of(path)
    if not "01" <= month <= "12":
        raise ValueError(f"no such month: {path!r}")
    return year, month


def _together(spark: SparkSession, files: Sequence[str], one_layout: bool) -> DataFrame:
    frames = [read_file(spark, path) for path in files]
    if one_layout:
        frames = [uniform(frame) for frame in frames]
    common = widest([frame.schema for frame in frames])
    return reduce(DataFrame.unionByName, [as_layout(frame, common) for frame in frames])


def _put(rows: DataFrame, root: str, period: tuple[str, str], repeatable: bool) -> int:
    """Write a month and read it back; rows that are not there as given raise."""
    spark, folder = rows.sparkSession, f"{root.rstrip('/')}/year={period[0]}/month={period[1]}"
    count = F.count(F.lit(1)).alias("rows")
    before = 0
    if not repeatable and exists(spark, folder, whole=False):
        before = spark.read.parquet(folder).count()
    given = Observation()
    write = replace_month if repeatable else append_month
    write(rows.observe(given, count, checksum(rows)), root, period)
    if repeatable:
        # Without rows nothing is written, not even a folder.
        there = exists(spark, folder, whole=False)
        held = spark.read.schema(rows.schema).parquet(folder) if there else rows.limit(0)
        found = held.agg(count, checksum(held)).first().asDict()
        good = found == given.get
    else:
        # Earlier files may have other types, so only rows are compared.
        there = exists(spark, folder, whole=False)
        good = (spark.read.parquet(folder).count() if there else 0) == before + given.get["rows"]
    if not good:
        raise RuntimeError(f"{folder} does not hold what was landed")
    return given.get["rows"]
