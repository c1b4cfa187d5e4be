import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterline import schema
from meterline.operators.fact import fact_rows
from meterline.plans.landing import land_file, land_files, uniform
from meterline.sinks.months import append_month, replace_month
from meterline.sources.trips import damaged, period_columns, period_of, read_months, read_year, widest
from meterline.sources.zones import read_zones


@pytest.mark.parametrize(
    "path, period",
    [
        ("x_2025-01.parquet", ("2025", "01")),
        ("s3a://b/year_2024-02/x_2025-13.parquet", ("2025", "13")),
        ("x_2025-1.parquet", None),
        ("x_2025-01.parquet.bak", None),
        ("x_2025-01.parquet\n", None),
        ("x2025-01.parquet", None),
    ],
)
def test_period(spark, path, period):
    columns = period_columns(F.lit(path))
    row = spark.range(1).select(*[column.alias(name) for name, column in columns.items()]).first()
    assert (row["year"], row["month"]) == (period or ("", ""))
    assert row["period_valid"] == (period is not None and period[1] <= "12")
    if period:
        assert period_of(path) == period
    else:
        with pytest.raises(ValueError):
            period_of(path)


def test_land_file(spark, raw, tmp_path):
    source, root = str(tmp_path / "trips_2024-03.parquet"), str(tmp_path / "landed")
    raw({}, {}).write.parquet(source)
    assert land_file(spark, source, root) == ("2024", "03")
    land_file(spark, source, root)
    assert read_year(spark, root, 2024).count() == 2
    land_file(spark, source, root, repeatable=False)
    rows = read_year(spark, root, 2024)
    assert rows.count() == 4
    assert (tmp_path / "landed" / "year=2024" / "month=03").is_dir()
    assert rows.select("year", "month").distinct().collect() == [(2024, 3)]


def test_land_files_sets_aside_what_has_no_month(spark, raw, tmp_path):
    names = ["a_2024-01.parquet", "a_2024-02.parquet", "a_2024-13.parquet", "a.parquet"]
    for count, name in enumerate(names, 1):
        raw(*[{}] * count).coalesce(1).write.parquet(str(tmp_path / "in" / "parts" / name))
    # Spark writes folders; the period is taken from the file, so give the files themselves their names.
    files = tmp_path / "files"
    files.mkdir()
    for name in names:
        (part,) = (tmp_path / "in" / "parts" / name).glob("part-*.parquet")
        (files / name).write_bytes(part.read_bytes())
    root, aside = str(tmp_path / "landed"), str(tmp_path / "aside")
    land_files(spark, [str(files / name) for name in names], root, aside)
    landed = spark.read.parquet(root).groupBy("year", "month").count().collect()
    assert sorted(map(tuple, landed)) == [(2024, 1, 1), (2024, 2, 2)]
    assert spark.read.parquet(aside).groupBy("month").count().orderBy("month").collect() == [("", 4), ("13", 3)]


def test_a_month_in_several_files_is_landed_whole(spark, raw, tmp_path):
    first, second = str(tmp_path / "a_2024-05.parquet"), str(tmp_path / "b_2024-05.parquet")
    raw(*[{}] * 3).write.parquet(first)
    raw(*[{"passenger_count": 4}] * 2).withColumn("passenger_count", F.expr("passenger_count + 0.5D")).drop(
        "airport_fee"
    ).write.parquet(second)
    root = str(tmp_path / "landed")
    for _ in range(2):
        (month,) = land_files(spark, [first, second, first], root)
        assert month == (("2024", "05"), [first, second], 5)
    rows = read_year(spark, root, 2024).collect()
    assert sorted(row["passenger_count"] for row in rows) == [1, 1, 1, 4.5, 4.5]
    assert sum(row["airport_fee"] is None for row in rows) == 2
    assert land_files(spark, [second], root, repeatable=False)[0].rows == 2
    assert read_year(spark, root, 2024).count() == 7
    with pytest.raises(ValueError):
        land_files(spark, [first, "a_2024-13.parquet"], root)


def test_replacing_a_month_leaves_the_others(spark, raw, tmp_path):
    root = str(tmp_path)
    append_month(raw({}, {}), root, ("2024", "01"))
    append_month(raw({}), root, ("2024", "02"))
    for _ in range(2):
        replace_month(raw({}, {}, {}), root, ("2024", "01"))
    counts = spark.read.parquet(root).groupBy("month").count().orderBy("month").collect()
    assert counts == [(1, 3), (2, 1)]


def test_months_of_different_layouts(spark, raw, tmp_path):
    root = str(tmp_path)
    fee = raw({"airport_fee": 1.75})
    append_month(fee.withColumnRenamed("airport_fee", "Airport_fee").drop("cbd_congestion_fee"), root, ("2024", "01"))
    append_month(raw({}).withColumn("passenger_count", F.lit(3.0)), root, ("2024", "02"))
    append_month(raw({}).withColumn("RatecodeID", F.lit(4).cast("int")), root, ("2024", "03"))
    rows = read_year(spark, root, 2024)
    types = {field.name.lower(): field.dataType for field in rows.schema}
    assert (types["passenger_count"], types["ratecodeid"]) == (T.DoubleType(), T.LongType())
    kept = fact_rows(rows, 2024, "month").orderBy("month").collect()
    shown = ["month", "passenger_count", "ratecode_id", "airport_fee", "cbd_congestion_fee"]
    assert [tuple(float(row[name]) for name in shown) for row in kept] == [
        (1, 1, 1, 1.75, 0),
        (2, 3, 1, 0, 0.75),
        (3, 1, 4, 0, 0.75),
    ]


def test_a_damaged_file_is_set_aside_and_the_others_land(spark, raw, tmp_path):
    files = [str(tmp_path / f"t_2024-{month:02d}.parquet") for month in range(1, 11)]
    for at, path in enumerate(files):
        raw(*[{}] * (at % 3)).coalesce(1).write.parquet(f"{path}.folder")
        (part,) = (tmp_path / f"{path}.folder").glob("*.parquet")
        (tmp_path / path).write_bytes(part.read_bytes())
    whole = (tmp_path / files[4]).read_bytes()
    (tmp_path / files[4]).write_bytes(whole[: len(whole) // 2])
    root, aside = str(tmp_path / "landed"), str(tmp_path / "aside")
    with pytest.raises(ValueError, match="t_2024-05"):
        land_files(spark, files, root)
    assert not (tmp_path / "landed").exists()
    folder = files[9] + ".folder"
    given = [*files[:9], str(tmp_path / "gone_2024-11.parquet")]
    months = land_files(spark, given, root, aside)
    # Files without rows are not damaged.
    assert {month.period[1]: month.rows for month in months} == {f"{at + 1:02d}": at % 3 for at in range(9) if at != 4}
    told = {row["file_path"]: row["error"] for row in spark.read.parquet(f"{aside}/_damaged").collect()}
    assert set(told) == {files[4], given[-1]} and all(told.values())
    assert damaged(spark, [folder]) == {}


def test_files_of_one_month_that_disagree(spark, raw, tmp_path):
    root = str(tmp_path)
    for count in (2.0, 3):
        append_month(raw({}, {}).withColumn("passenger_count", F.lit(count)), root, ("2024", "01"))
    append_month(raw({}).drop("cbd_congestion_fee"), root, ("2024", "01"))
    rows = read_months(spark, root, 2024, [1])
    assert rows.count() == 5
    assert rows.agg(F.sum("passenger_count")).first()[0] == 11.0


def test_known_layout_needs_no_look_at_the_files(spark, raw, tmp_path):
    append_month(raw({}).drop("cbd_congestion_fee"), str(tmp_path), ("2024", "01"))
    (row,) = read_months(spark, str(tmp_path), 2024, layout=schema.RAW_TRIP).collect()
    assert (row["cbd_congestion_fee"], row["fare_amount"], row["month"]) == (None, 12.0, 1)


def test_chosen_months(spark, raw, tmp_path):
    root = str(tmp_path)
    for month in ("01", "02", "11"):
        append_month(raw({}), root, ("2024", month))
    months = read_months(spark, root, 2024, [1, 3, 11]).select("month").distinct().orderBy("month").collect()
    assert [row[0] for row in months] == [1, 11]
    with pytest.raises(FileNotFoundError):
        read_months(spark, root, 2024, [5])
    with pytest.raises(FileNotFoundError):
        read_year(spark, root, 2023)


def test_types_that_cannot_be_brought_together():
    one, other = T.StructType().add("a", "string"), T.StructType().add("A", "long")
    with pytest.raises(TypeError, match="column A"):
        widest([one, other])


def test_one_layout(spark, raw, tmp_path):
    df = raw({}).withColumnRenamed("airport_fee", "Airport_fee").withColumn("passenger_count", F.lit(1.5))
    typed = uniform(df.drop("cbd_congestion_fee").withColumn("VendorID", F.expr("double('NaN')")))
    assert [(f.name, f.dataType) for f in typed.schema] == [(f.name, f.dataType) for f in schema.LANDED_TRIP]
    row = typed.first()
    assert (row["passenger_count"], row["cbd_congestion_fee"], row["VendorID"]) == (1.5, 0, None)
    for wrong in (df.drop("total_amount"), df.withColumn("tip", F.lit(1))):
        with pytest.raises(ValueError, match="total_amount|tip"):
            uniform(wrong)

    root = str(tmp_path / "landed")
    for month, trips in (("01", raw({})), ("02", df.drop("cbd_congestion_fee"))):
        trips.write.parquet(str(tmp_path / f"a_2024-{month}.parquet"))
        land_file(spark, str(tmp_path / f"a_2024-{month}.parquet"), root, one_layout=True)
    rows = read_months(spark, root, 2024, layout=schema.LANDED_TRIP).orderBy("month").collect()
    assert [(r["month"], r["passenger_count"], r["cbd_congestion_fee"]) for r in rows] == [(1, 1.0, 0.75), (2, 1.5, 0.0)]


def test_zones(spark, tmp_path):
    path = tmp_path / "zones.csv"
    lines = [
        '"LocationID","Borough","Zone","service_zone"',
        '1,"EWR","Newark, ""the"" Airport","EWR"',
        '264,"Unknown","N/A","N/A"',
        '265,"N/A",,""',
    ]
    path.write_bytes("\r\n".join(lines).encode() + b"\r\n")
    rows = sorted(tuple(row) for row in read_zones(spark, str(path)).collect())
    assert rows == [
        (1, "EWR", 'Newark, "the" Airport', "EWR"),
        (264, "Unknown", "N/A", "N/A"),
        (265, "N/A", None, ""),
    ]
    path.write_text("LocationID,Borough,Zone,service_zone\nx,a,b,c\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        read_zones(spark, str(path)).collect()
