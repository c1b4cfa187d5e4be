"""The runs from the command line: python -m meterline land|seed|load|audit|export|train|score.

Object-store access, memory and master come from spark-submit or spark-defaults.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from meterline import schema
from meterline.operators import forest
from meterline.plans import landing, loading, training
from meterline.session import build_session
from meterline.sinks.tables import recreate_tables
from meterline.sources.zones import read_zones


def arguments(words: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="meterline", description=__doc__)
    year = int(os.environ.get("YEAR", "2025"))
    runs = parser.add_subparsers(dest="run", required=True)

    land = runs.add_parser("land", help="put raw files under year=/month=")
    land.add_argument("files", nargs="+")
    land.add_argument("--root", required=True)
    land.add_argument("--one-layout", action="store_true", help="give every month the same columns and types")
    land.add_argument("--append", action="store_true", help="add to the months instead of replacing them")
    land.add_argument("--quarantine", help="where files go whose name states no month")

    seed = runs.add_parser("seed", help="fill the dimensions")
    seed.add_argument("--warehouse", required=True)
    seed.add_argument("--zones", required=True, help="zone lookup CSV")
    seed.add_argument("--year", type=int, default=year)
    seed.add_argument("--recreate", action="store_true", help="drop all eight tables first, facts included")

    load = runs.add_parser("load", help="append accepted trips to the fact table")
    load.add_argument("--root", required=True)
    load.add_argument("--warehouse", required=True)
    load.add_argument("--year", type=int, default=year)
    load.add_argument("--months", type=int, nargs="+", help="all landed ones unless named")
    load.add_argument("--rejects", help="where the trips go that are turned away")
    load.add_argument("--one-layout", action="store_true", help="the months were landed with --one-layout")

    audit = runs.add_parser("audit", help="what breaks the constraints of the eight tables")
    audit.add_argument("--warehouse", required=True)
    audit.add_argument("--output", required=True)

    export = runs.add_parser("export", help="append accepted trips to a database table")
    export.add_argument("--root", required=True)
    export.add_argument("--year", type=int, default=year)
    export.add_argument("--url", default=os.environ.get("JDBC_URL"))
    export.add_argument("--table", default=os.environ.get("TARGET_TABLE", "dw.fact_trip"))
    export.add_argument("--user", default=os.environ.get("JDBC_USER"))
    export.add_argument("--months", type=int, nargs="+", help="all landed ones unless named")
    export.add_argument("--first-id", type=int, help="number the trips here, from this id up")
    export.add_argument("--writers", type=int, default=None, help="connections at once; 0 leaves the layout alone")

    train = runs.add_parser("train", help="snapshot months, fit, save if good enough")
    train.add_argument("--root", required=True)
    train.add_argument("--out", required=True)
    train.add_argument("--model", required=True)
    train.add_argument("--year", type=int, default=training.YEAR)
    train.add_argument("--months", type=int, nargs="+", default=training.MONTHS)
    train.add_argument("--trees", type=int, default=forest.TREES)
    train.add_argument("--depth", type=int, default=forest.DEPTH)
    train.add_argument("--partitions", type=int, default=forest.PARTITIONS, help="parts the rows are fitted in")
    train.add_argument("--store", help="a folder of fitted models, where one of the same rows and settings is looked for first")
    train.add_argument("--memory-mb", type=int, default=256, help="split statistics per running task")

    score = runs.add_parser("score", help="predict for every row of a Parquet table")
    score.add_argument("--model", required=True)
    score.add_argument("--input", required=True)
    score.add_argument("--output", required=True)
    score.add_argument("--keep", nargs="*", default=[])
    return parser.parse_args(words)


def run(given: argparse.Namespace, spark: SparkSession) -> None:
    if given.run == "land":
        for month in landing.land_files(
            spark, given.files, given.root, given.quarantine, not given.append, given.one_layout
        ):
            print(f"{'-'.join(month.period)}: {month.rows} rows of {len(month.files)} files")
    elif given.run == "seed":
        if given.recreate:
            recreate_tables(spark, given.warehouse)
        loading.load_dimensions(spark, given.warehouse, read_zones(spark, given.zones), given.year)
    elif given.run == "load":
        layout = schema.LANDED_TRIP if given.one_layout else None
        months = loading.load_facts(
            spark, given.root, given.warehouse, given.year, layout=layout, months=given.months, rejects=given.rejects
        )
        print(f"months loaded: {months}")
    elif given.run == "audit":
        found = loading.audit_warehouse(spark, given.warehouse)
        found.coalesce(1).write.mode("overwrite").option("header", True).csv(given.output)
    elif given.run == "export":
        connection = {"url": given.url, "table": given.table, "user": given.user}
        connection["password"] = os.environ.get("JDBC_PASSWORD", "")
        if given.writers is not None:
            connection["writers"] = given.writers or None
        loading.export_facts(spark, given.root, given.year, given.months, given.first_id, **connection)
    elif given.run == "train":
        training.snapshot(spark, given.root, given.out, given.year, given.months)
        rows = training.read_snapshot(spark, given.out)
        settings = {"trees": given.trees, "depth": given.depth, "memory_mb": given.memory_mb}
        settings["partitions"] = given.partitions
        if given.store:
            result = training.train_once(rows, "row_key", given.store, **settings)
            if result.saved:
                forest.save(result.model, given.model)
        else:
            result = training.train(rows, "row_key", given.model, **settings)
        print(f"RMSE {result.rmse}: model {'saved' if result.saved else 'not saved'}")
    elif given.run == "score":
        rows = spark.read.parquet(given.input)
        training.score_table(given.model, rows, *given.keep).write.mode("overwrite").parquet(given.output)


def main() -> None:
    given = arguments()
    spark = build_session(f"meterline {given.run}")
    run(given, spark)
    spark.stop()


if __name__ == "__main__":
    main()
