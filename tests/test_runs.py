"""The command line from raw files to scores."""

import pytest

from meterline.__main__ import arguments, run
from meterline.plans.catalog import raw_trips, table
from meterline.sinks.jdbc import jdbc_writer
from meterline.sinks.tables import read_table
from meterline.sources.derived import zones_from_places

SF_DIR = "/root/testdata/sf0.001"


def test_raw_files_to_scores(spark, tmp_path, capsys):
    def call(*words):
        run(arguments([str(word) for word in words]), spark)

    trips = raw_trips(spark, SF_DIR).drop("event_id")
    for month, rows in (("01", trips), ("02", trips.drop("cbd_congestion_fee"))):
        rows.write.parquet(str(tmp_path / f"t_2024-{month}.parquet"))
    zones = zones_from_places(spark, table(spark, SF_DIR, "region"), table(spark, SF_DIR, "nation"))
    zones.write.option("header", True).csv(str(tmp_path / "zones"))
    landed, warehouse, model = tmp_path / "landed", tmp_path / "warehouse", tmp_path / "model"

    for _ in range(2):
        call("land", *tmp_path.glob("t_2024-*.parquet"), "--root", landed, "--one-layout")
    call("seed", "--warehouse", warehouse, "--zones", tmp_path / "zones", "--year", 2024)
    for months in ([1], [1, 2]):
        call("load", "--root", landed, "--warehouse", warehouse, "--year", 2024, "--one-layout",
             "--months", *months, "--rejects", tmp_path / "rejects")
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 2 * (1000 - 814)
    call("audit", "--warehouse", warehouse, "--output", tmp_path / "audit")
    assert spark.read.csv(str(tmp_path / "audit"), header=True).columns == ["table_name", "finding", "row_count"]
    assert read_table(spark, str(warehouse), "fact_trip").count() == 2 * 814
    assert read_table(spark, str(warehouse), "dim_date").count() == 367

    call("train", "--root", landed, "--out", tmp_path / "training", "--model", model, "--year", 2024,
         "--months", 1, 2, "--trees", 5, "--depth", 6)
    assert "saved" in capsys.readouterr().out
    call("score", "--model", model, "--input", tmp_path / "t_2024-01.parquet", "--output", tmp_path / "scored",
         "--keep", "PULocationID")
    scored = spark.read.parquet(str(tmp_path / "scored"))
    assert scored.columns == ["PULocationID", "input_problem", "prediction"]
    assert scored.count() == 1000 and scored.filter("prediction IS NULL").count() == 0


def test_export_takes_its_connection_from_the_environment(spark, raw, tmp_path, monkeypatch):
    given = {}
    monkeypatch.setattr("meterline.plans.loading.append_jdbc", lambda df, **c: given.update(c, rows=df.count()))
    for name, value in {"JDBC_URL": "jdbc:x", "JDBC_USER": "u", "JDBC_PASSWORD": "p", "YEAR": "2024"}.items():
        monkeypatch.setenv(name, value)
    raw({}, {"VendorID": None}).write.parquet(str(tmp_path / "a_2024-03.parquet"))
    run(arguments(["land", str(tmp_path / "a_2024-03.parquet"), "--root", str(tmp_path / "landed")]), spark)
    run(arguments(["export", "--root", str(tmp_path / "landed"), "--writers", "3"]), spark)
    assert given == {"url": "jdbc:x", "table": "dw.fact_trip", "user": "u", "password": "p", "writers": 3, "rows": 1}
    assert set(given) - {"rows"} <= set(jdbc_writer.__annotations__)


def test_a_run_has_to_be_named():
    with pytest.raises(SystemExit):
        arguments([])
