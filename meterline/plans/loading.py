"""Fill the warehouse from the landed months, and audit it."""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline import schema
from meterline.operators import audits
from meterline.operators.columns import complete_raw
from meterline.operators.dimensions import seed_dimensions
from meterline.operators.fact import fact_rows
from meterline.operators.numbering import next_id, sparse_ids
from meterline.operators.rules import count_violations, reject, trip_rules
from meterline.sinks.jdbc import append_jdbc
from meterline.sinks.months import replace_month
from meterline.sinks.tables import (
    Change,
    commit,
    ensure_tables,
    insert_missing,
    loads,
    read_table,
    read_tables,
    truncate_and_reload,
    write_folder,
)
from meterline.sources.trips import landed_bytes, landed_months, read_months


def load_dimensions(spark: SparkSession, root: str, zones: DataFrame, year: int) -> None:
    """Fill the dimensions under `root`, made first where they are missing.

    Zones are replaced by those given, as they come from a file that may have been corrected.
    The others get the rows they lack; rows already there stay.
    """
    ensure_tables(spark, root)
    seeds = seed_dimensions(spark, zones, year)
    insert_missing(spark, root, {name: rows for name, rows in seeds.items() if name != "dim_zone"})
    truncate_and_reload(spark, root, {"dim_zone": seeds["dim_zone"]})


def load_facts(
    spark: SparkSession,
    landed: str,
    root: str,
    year: int,
    folder_year: int | None = None,
    layout: T.StructType | None = None,
    months: Iterable[int] | None = None,
    rejects: str | None = None,
) -> list[int]:
    """Append the accepted trips of `year` in the chosen landed months (all if none are named) to
    fact_trip, and return the months loaded. A month that was loaded before is passed over, with
    a warning if what is landed of it has another size than it had then.

    They are read from that year's folders, or from those of `folder_year`, as a file may
    hold trips of another year; `layout` as for `read_months`. Nothing is shuffled or
    written twice: trips are judged, numbered and written where they are read. The trips
    turned away go to `rejects`, if given, each month's in place of what it held before.

    The rows go to a folder of their own, and one entry in the tables' log makes them part of
    the facts, together with the months they come from and the identities they used, where
    the next load goes on. A load that dies before that has loaded nothing: no reader sees
    its rows, and the next load takes its months again.
    """
    folder_year = folder_year or year
    log = loads(spark, root)
    done = {(row["folder_year"], row["month"]): row["landed"] for row in log if row["year"] == year}
    wanted = sorted(set(months)) if months is not None else landed_months(spark, landed, folder_year)
    fresh = [month for month in wanted if (folder_year, month) not in done]
    sizes = {month: landed_bytes(spark, landed, folder_year, month) for month in wanted}
    for month in wanted:
        if done.get((folder_year, month), sizes[month]) not in (None, sizes[month]):
            warnings.warn(
                f"{folder_year}-{month:02d} was landed anew or added to since it was loaded; not loaded again",
                stacklevel=2,
            )
    if not fresh:
        return []
    raw = read_months(spark, landed, folder_year, fresh, layout)
    if rejects:
        replace_month(reject(complete_raw(raw), trip_rules(year)), rejects)

    start = max((row["next_id"] for row in log), default=0) or next_id(read_table(spark, root, "fact_trip"))
    seen = Observation()
    facts = sparse_ids(fact_rows(raw, year), start=start).observe(seen, F.max("trip_id").alias("last"))
    folder = write_folder(facts, root, "fact_trip")
    following = (seen.get["last"] or start - 1) + 1
    origins = [(year, folder_year, month, start, following, sizes[month]) for month in fresh]
    commit(spark, root, [Change("fact_trip", False, folder, *origin) for origin in origins])
    return fresh


def export_facts(
    spark: SparkSession,
    landed: str,
    year: int,
    months: Iterable[int] | None = None,
    first_id: int | None = None,
    **connection,
) -> None:
    """Append the accepted trips of `year` to a database table, which numbers them itself.

    With `first_id` they are numbered here, from it up, so that the table's primary key
    refuses rows that a retried task sends again. `connection` is what
    `sinks.jdbc.jdbc_writer` takes.
    """
    facts = fact_rows(read_months(spark, landed, year, months), year)
    append_jdbc(facts if first_id is None else sparse_ids(facts, start=first_id), **connection)


def rejected_trips(spark: SparkSession, landed: str, year: int, months: Iterable[int] | None = None) -> DataFrame:
    """The trips `load_facts` turns away, each with its first failing rule."""
    return reject(complete_raw(read_months(spark, landed, year, months)), trip_rules(year))


def audit_warehouse(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, finding, row_count) of all that breaks a declared constraint of the eight tables."""
    tables = read_tables(spark, root)
    keys = audits.table_key_audit(tables).selectExpr(
        "table_name", "concat(constraint_name, ' ', key_value) AS finding", "row_count"
    )
    found = [keys]
    for name, df in tables.items():
        missing = audits.missing_values(df, audits.required_columns(schema.TABLES[name]), name)
        found.append(missing.selectExpr("table_name", "concat('missing ', column_name)", "missing"))
    for name, checks in audits.table_checks().items():
        broken = count_violations(tables[name], checks, name)
        found.append(broken.selectExpr("table_name", "concat('check ', check_name)", "violations"))
    lost = audits.orphans(tables["fact_trip"], tables)
    found.append(lost.selectExpr("'fact_trip'", "concat('reference ', foreign_key, ' ', key_value)", "row_count"))
    return reduce(DataFrame.union, found).filter("row_count > 0")
