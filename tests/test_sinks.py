import pytest
from pyspark.sql import functions as F

from meterline import schema
from meterline.operators import dimensions
from meterline.operators.upsert import insert_or_ignore, new_rows
from meterline.plans import loading
from meterline.sinks import jdbc, snapshots, tables
from meterline.sinks.months import append_month


def zones(spark):
    return spark.createDataFrame([(i, "b", "z", None) for i in range(1, 266)], schema.DIM_ZONE)


def test_existing_row_wins_and_first_of_the_batch(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    rows = [(1, "a", 1), (2, "late", 9), (2, "early", 3), (None, "n", 1)]
    batch = spark.createDataFrame(rows, "k int, v string, o int")
    once = insert_or_ignore(target, batch, ["k"], ["o"])
    assert sorted(map(str, once.collect())) == sorted(
        ["Row(k=1, v='old')", "Row(k=2, v='early')", "Row(k=None, v='n')"]
    )
    assert new_rows(once, batch, ["k"], ["o"]).count() == 0


def test_recreated_tables_are_empty_and_typed(spark, tmp_path):
    tables.recreate_tables(spark, str(tmp_path))
    for name, layout in schema.TABLES.items():
        found = tables.read_table(spark, str(tmp_path), name)
        assert found.count() == 0
        assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in layout]


def test_seeding_twice_is_seeding_once(spark, tmp_path):
    root = str(tmp_path)
    tables.recreate_tables(spark, root)
    tables.append_table(spark.createDataFrame([(1, "Mine")], schema.DIM_VENDOR), root, "dim_vendor")
    for _ in range(2):
        loading.load_dimensions(spark, root, zones(spark), 2024)
    counts = {name: tables.read_table(spark, root, name).count() for name in schema.TABLES}
    assert counts == {
        "dim_vendor": 5,
        "dim_ratecode": 7,
        "dim_payment_type": 7,
        "dim_store_and_fwd": 2,
        "dim_zone": 265,
        "dim_date": 367,
        "dim_time": 86400,
        "fact_trip": 0,
    }
    assert tables.read_table(spark, root, "dim_vendor").filter("vendor_id = 1").first()["vendor_name"] == "Mine"


def test_reload_empties_only_what_is_named(spark, raw, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "warehouse")
    append_month(raw({}, {}, {"VendorID": None}), landed, ("2024", "03"))
    tables.recreate_tables(spark, root)
    rejects = str(tmp_path / "rejects")
    assert loading.load_facts(spark, landed, root, 2024, rejects=rejects) == [3]
    assert loading.load_facts(spark, landed, root, 2024, rejects=rejects) == []
    append_month(raw({}, {}, {}), landed, ("2024", "04"))
    append_month(raw({}), landed, ("2024", "05"))
    assert loading.load_facts(spark, landed, root, 2024, months=[4]) == [4]
    facts = tables.read_table(spark, root, "fact_trip")
    assert facts.count() == facts.select("trip_id").distinct().count() == 5
    assert facts.agg(F.min("trip_id")).first()[0] == 1
    assert loading.rejected_trips(spark, landed, 2024, [3]).first()["reject_reason"] == "VendorID_present"
    assert [row["reject_reason"] for row in spark.read.parquet(rejects).collect()] == ["VendorID_present"]

    tables.truncate_and_reload(spark, root, {"dim_zone": zones(spark)})
    assert tables.read_table(spark, root, "fact_trip").count() == 5
    tables.truncate_and_reload(spark, root, {"dim_zone": zones(spark)}, ["fact_trip"])
    assert tables.read_table(spark, root, "fact_trip").count() == 0
    assert tables.read_table(spark, root, "dim_zone").count() == 265


def died(*_, **__):
    raise OSError


def test_a_load_that_dies_before_its_entry_has_loaded_nothing(spark, raw, tmp_path, monkeypatch):
    """All rows are written, the entry is not: none of them is seen, and the next load takes them, once."""
    landed, root = str(tmp_path / "landed"), str(tmp_path / "warehouse")
    append_month(raw({}, {}), landed, ("2024", "03"))
    tables.recreate_tables(spark, root)
    with monkeypatch.context() as patched, pytest.raises(OSError):
        patched.setattr(loading, "commit", died)
        loading.load_facts(spark, landed, root, 2024)
    assert tables.read_table(spark, root, "fact_trip").count() == 0
    assert loading.load_facts(spark, landed, root, 2024) == [3]
    assert loading.load_facts(spark, landed, root, 2024) == []
    assert tables.read_table(spark, root, "fact_trip").count() == 2
    assert tables.clear_unused(spark, root) == 1
    assert tables.read_table(spark, root, "fact_trip").count() == 2


def test_a_load_that_dies_between_its_files_has_loaded_nothing(spark, raw, tmp_path, monkeypatch):
    """One file is in its place, the others are not, and another month is loaded before the next attempt."""
    landed, root = str(tmp_path / "landed"), str(tmp_path / "warehouse")
    append_month(raw({}, {}), landed, ("2024", "03"))
    append_month(raw({}, {}, {}), landed, ("2024", "04"))
    tables.recreate_tables(spark, root, ["fact_trip"])
    assert loading.load_facts(spark, landed, root, 2024, months=[4]) == [4]

    def half(df, root, name):
        tables.write_folder(df.limit(1), root, name)
        raise OSError

    with monkeypatch.context() as patched, pytest.raises(OSError):
        patched.setattr(loading, "write_folder", half)
        loading.load_facts(spark, landed, root, 2024, months=[3])
    assert tables.read_table(spark, root, "fact_trip").count() == 3
    append_month(raw({}), landed, ("2024", "05"))
    assert loading.load_facts(spark, landed, root, 2024, months=[5]) == [5]
    assert loading.load_facts(spark, landed, root, 2024) == [3]
    assert loading.load_facts(spark, landed, root, 2024) == []
    facts = tables.read_table(spark, root, "fact_trip")
    assert facts.count() == facts.select("trip_id").distinct().count() == 6
    loads = {row["month"]: (row["first_id"], row["next_id"]) for row in tables.loads(spark, root)}
    assert set(loads) == {3, 4, 5} and all(first < following for first, following in loads.values())


def test_a_reload_that_fails_leaves_all_tables_as_they_were(spark, raw, tmp_path):
    root = str(tmp_path / "warehouse")
    loading.load_dimensions(spark, root, zones(spark), 2024)
    bad = zones(spark).withColumn("borough", F.raise_error(F.lit("unreadable")).cast("string"))
    with pytest.raises(Exception, match="unreadable"):
        tables.truncate_and_reload(spark, root, {"dim_vendor": dimensions.vendors(spark).limit(1), "dim_zone": bad}, ["dim_date"])
    counts = {name: rows.count() for name, rows in tables.read_tables(spark, root).items()}
    assert (counts["dim_zone"], counts["dim_vendor"], counts["dim_date"]) == (265, 5, 367)
    # A reader that has the old rows keeps them through a reload, until they are cleared away.
    old = tables.read_table(spark, root, "dim_zone")
    tables.truncate_and_reload(spark, root, {"dim_zone": zones(spark).limit(7)})
    assert (old.count(), tables.read_table(spark, root, "dim_zone").count()) == (265, 7)
    # The failed write's two folders, and the old zones.
    assert tables.clear_unused(spark, root) == 3 and tables.read_table(spark, root, "dim_zone").count() == 7


def test_rows_added_to_a_loaded_month_are_reported(spark, raw, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "warehouse")
    append_month(raw({}), landed, ("2024", "03"))
    tables.recreate_tables(spark, root, ["fact_trip"])
    assert loading.load_facts(spark, landed, root, 2024) == [3]
    append_month(raw({}), landed, ("2024", "03"))
    with pytest.warns(UserWarning, match="2024-03 was landed anew or added to"):
        assert loading.load_facts(spark, landed, root, 2024) == []


def test_seeding_takes_corrected_zones_and_makes_missing_tables(spark, tmp_path):
    root = str(tmp_path / "new")
    for name in ("old", "new"):
        given = spark.createDataFrame([(1, "b", name, None)], schema.DIM_ZONE)
        loading.load_dimensions(spark, root, given, 2024)
    assert [row["zone_name"] for row in tables.read_table(spark, root, "dim_zone").collect()] == ["new"]


def test_audit_of_a_warehouse(spark, raw, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "warehouse")
    append_month(raw({}, {"VendorID": 99}, {"store_and_fwd_flag": "x"}), landed, ("2024", "03"))
    loading.load_dimensions(spark, root, zones(spark), 2024)
    loading.load_facts(spark, landed, root, 2024)
    facts = tables.read_table(spark, root, "fact_trip")
    tables.append_table(facts.limit(1).cache(), root, "fact_trip")
    found = {(row["table_name"], row["finding"]) for row in loading.audit_warehouse(spark, root).collect()}
    assert {name for name, _ in found} == {"fact_trip"}
    told = {finding for _, finding in found}
    assert {"check flag_is_y_or_n", "reference vendor_id 99", "reference store_and_fwd_flag x"} < told
    assert any(finding.startswith("primary_key ") for finding in told)


def test_verified_write(spark, raw, tmp_path):
    report = snapshots.write_verified(raw({}, {"fare_amount": 3.0}), str(tmp_path / "t"))
    assert report == (2, 2, True, True) and report.good
    empty = snapshots.write_verified(raw({}).filter("false"), str(tmp_path / "e"))
    assert empty.rows_written == 0 and empty.good
    assert snapshots.preview(raw(*[{}] * 9)).count() == 5


@pytest.fixture
def options(spark, monkeypatch):
    """The options a JDBC writer was given; no database is reached."""
    seen = {}
    from pyspark.sql import DataFrameWriter

    def keep(writer, **settings):
        seen.update(settings)
        return writer

    monkeypatch.setattr(DataFrameWriter, "options", keep)
    return seen


def test_jdbc_settings(spark, options):
    rows = spark.range(100, numPartitions=3)
    jdbc.jdbc_writer(rows, "jdbc:postgresql://host/db", "dw.fact_trip", "u", "p", options={"sessionInitStatement": "x"})
    assert options == {
        "url": "jdbc:postgresql://host/db",
        "dbtable": "dw.fact_trip",
        "user": "u",
        "password": "p",
        "driver": "org.postgresql.Driver",
        "batchsize": "20000",
        "sessionInitStatement": "x",
    }
    assert jdbc.staged(rows).rdd.getNumPartitions() == 8
    assert jdbc.staged(rows, 2).rdd.getNumPartitions() == 2
    assert jdbc.staged(rows, None).rdd.getNumPartitions() == 3


def test_usage_keeps_unused_keys(spark):
    rows = spark.createDataFrame([(1,), (1,), (5,), (None,)], "v long")
    counts = dimensions.usage(dimensions.vendors(spark), "vendor_id", rows, "v").orderBy("vendor_id").collect()
    assert [row["trips"] for row in counts] == [0, 2, 0, 0, 0]
