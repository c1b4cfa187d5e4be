"""Raw trip files, one by one or as a tree of year=/month= folders."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: how a file name states its period.
PERIOD_PATTERN = r".*_(\d{4})-(\d{2})\.parquet"


def read_file(spark: SparkSession, path: str) -> DataFrame:
    """One raw file with the schema it carries."""
    return spark.read.parquet(path)


def damaged(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Which of the raw files cannot be opened, each with the error's first line.

    One pass over the footers of all of them, no column is read. What gave no row there is empty or
    damaged, and is opened by itself to tell which.
    """
    paths = list(dict.fromkeys(paths))
    missing = [path for path in paths if not exists(spark, path, whole=False)]
    there = [path for path in paths if path not in set(missing)]
    found = {path: "no such file" for path in missing}
    if not there:
        return found
    nothing = T.StructType([])
    rows = spark.read.schema(nothing).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true").parquet(*there)
    read = [row[0] for row in rows.select("_metadata.file_path").groupBy("file_path").count().collect()]
    # A path may be a folder of files, and stands in the result with its store's name before it.
    opened = {path for path in there if any(f"{name}/".find(f"{path.rstrip('/')}/") >= 0 for name in read)}

    def error_of(path: str) -> str | None:
        try:
            spark.read.schema(nothing).parquet(path).count()
        except Exception as error:
            return (str(error).strip() or type(error).__name__).splitlines()[0]
        return None

    with ThreadPoolExecutor(max_workers=8) as side_by_side:
        asked = [path for path in there if path not in opened]
        found |= {path: error for path, error in zip(asked, side_by_side.map(error_of, asked), strict=True) if error}
    return found


def period_of(path: str) -> tuple[str, str]:
    """(year, month) text from a file name, with the month's zero; raises if it states none."""
    found = re.fullmatch(PERIOD_PATTERN, path, flags=re.ASCII)
    if not found:
        raise ValueError(f"no year and month in the file name {path!r}")
    return found[1], found[2]


def period_columns(path: Column) -> dict[str, Column]:
    """`year` and `month` (text, empty if the path states none) and whether the period exists.

    The name's pattern accepts any two digits as a month, so `period_valid` also checks those.
    """
    anchored = rf"^{PERIOD_PATTERN}\z"
    year = F.regexp_extract(path, anchored, 1)
    month = F.regexp_extract(path, anchored, 2)
    return {"year": year, "month": month, "period_valid": month.between("01", "12")}


def with_file_period(df: DataFrame) -> DataFrame:
    """Rows read from files, with the period each one's file name states."""
    return df.withColumns(period_columns(F.col("_metadata.file_path")))


def read_year(spark: SparkSession, root: str, year: int) -> DataFrame:
    """Every month of `year` under `root`."""
    return read_months(spark, root, year)


def read_months(
    spark: SparkSession,
    root: str,
    year: int,
    months: Iterable[int] | None = None,
    layout: T.StructType | None = None,
    place: str | None = None,
) -> DataFrame:
    """The chosen months (all if none are named) with `year` and `month` columns.

    A chosen month that was never landed adds nothing; if none was, that is an error. Only
    the folders asked for are listed. Files may lack columns, spell them in another case or
    store a number as whole in one month and as a fraction in the next: each set of like
    files is read with its own schema, and the sets are put together under the widest type
    per column. Merging the schemas of all files at once would fail on the last kind, and
    reading by one file's schema would lose the columns that file lacks.

    With a `layout` the files are not asked: it is the schema of them all, missing columns
    read as NULL, and no footer is opened before the scan. Use it on a tree whose types are
    known, such as one that `plans.landing` landed with one layout, which turns away files
    that lack a column.

    `place` adds a column of that name: a hash of the landed file and the row in it, which
    stays the same however often and in whatever order the tree is read.
    """
    folders = _month_folders(spark, root, year, months)
    if layout is not None:
        return _read_as(spark, root, layout, folders, layout, place)
    groups: dict[T.StructType, list[str]] = {}
    # A year has few folders; asking for their layouts side by side hides the wait for each.
    with ThreadPoolExecutor(max_workers=min(len(folders), 12)) as side_by_side:
        for layouts in side_by_side.map(lambda folder: _layouts(spark, root, [folder]), folders):
            for found, paths in layouts:
                groups.setdefault(found, []).extend(paths)
    common = widest(list(groups))
    parts = [_read_as(spark, root, found, paths, common, place) for found, paths in groups.items()]
    return reduce(DataFrame.unionByName, parts)


def widest(layouts: Sequence[T.StructType]) -> T.StructType:
    """All columns of the layouts, by name without case, each with a type that holds them all."""
    fields: dict[str, T.StructField] = {}
    for layout in layouts:
        for field in layout:
            held = fields.get(field.name.lower())
            kind = field.dataType if held is None else _wider(field.name, held.dataType, field.dataType)
            fields[field.name.lower()] = T.StructField(held.name if held else field.name, kind, True)
    return T.StructType(list(fields.values()))


_WHOLE = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
_FRACTION = [T.FloatType(), T.DoubleType()]


def _wider(name: str, one: T.DataType, other: T.DataType) -> T.DataType:
    if one == other:
        return one
    if one in _WHOLE and other in _WHOLE:
        return max(one, other, key=_WHOLE.index)
    if {type(one), type(other)} <= {type(kind) for kind in _WHOLE + _FRACTION}:
        return T.DoubleType()
    if {type(one), type(other)} == {T.TimestampType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if isinstance(one, T.NullType) or isinstance(other, T.NullType):
        return other if isinstance(one, T.NullType) else one
    raise TypeError(f"column {name} is {one.simpleString()} in one file and {other.simpleString()} in another")


def _month_folders(spark: SparkSession, root: str, year: int, months: Iterable[int] | None) -> list[str]:
    base = f"{root.rstrip('/')}/year={year}"
    if months is None:
        wanted = [f"{base}/month=*"]
    else:
        wanted = [f"{base}/month={{{month},{month:02d}}}" for month in sorted(set(months))]
    found = [folder for pattern in wanted for folder in _matches(spark, pattern)]
    if not found:
        raise FileNotFoundError(f"no month folder matches {wanted}")
    return found


def exists(spark: SparkSession, folder: str, whole: bool = True) -> bool:
    """Whether a write into `folder` was finished; without `whole`, whether it is there."""
    return bool(_matches(spark, f"{folder}/_SUCCESS" if whole else folder))


def landed_months(spark: SparkSession, root: str, year: int) -> list[int]:
    """The months of `year` that have a folder under `root`."""
    return sorted({int(folder.rstrip("/").rsplit("month=", 1)[1]) for folder in _month_folders(spark, root, year, None)})


def landed_bytes(spark: SparkSession, root: str, year: int, month: int) -> int:
    """The size of all that is landed of a month; 0 if it has no folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = hadoop(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = _matches(spark, f"{root.rstrip('/')}/year={year}/month={{{month},{month:02d}}}")
    return sum(files.getContentSummary(hadoop(folder)).getLength() for folder in folders)


def _matches(spark: SparkSession, pattern: str) -> list[str]:
    # Folder names only; listing their files is left to the read.
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [str(status.getPath()) for status in files.globStatus(hadoop) or []]


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """The names of what lies directly in `folder`."""
    return [path.rstrip("/").rsplit("/", 1)[1] for path in _matches(spark, f"{folder}/*")]


def remove_folder(spark: SparkSession, folder: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def _layouts(spark: SparkSession, root: str, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """Schemas found under `paths`, with the paths of each; Spark reads the footers in tasks.

    Files that lack columns merge into one layout. Files of one folder that disagree on a
    type are rare; they are halved until those left together agree.
    """
    reader = spark.read.option("basePath", root).option("mergeSchema", "true")
    try:
        return [(_without_partitions(reader.parquet(*paths).schema), paths)]
    except AnalysisException:
        raise
    except Exception as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    if len(paths) == 1:
        paths = sorted(spark.read.option("basePath", root).parquet(*paths).inputFiles())
    middle = len(paths) // 2
    return _layouts(spark, root, paths[:middle]) + _layouts(spark, root, paths[middle:])


def _without_partitions(layout: T.StructType) -> T.StructType:
    return T.StructType([field for field in layout if field.name not in ("year", "month")])


def _read_as(
    spark: SparkSession,
    root: str,
    layout: T.StructType,
    paths: list[str],
    common: T.StructType,
    place: str | None = None,
) -> DataFrame:
    df = spark.read.schema(layout).option("basePath", root).parquet(*paths)
    kept = ["year", "month"]
    if place:
        df = df.withColumn(place, F.xxhash64("year", "month", "_metadata.file_name", "_metadata.row_index"))
        kept.append(place)
    return as_layout(df, common, *kept)


def as_layout(df: DataFrame, common: T.StructType, *keep: str) -> DataFrame:
    """The columns of `common`, missing ones NULL, with its names and types; and `keep`."""
    held = {field.name.lower(): field for field in df.schema}
    columns = []
    for field in common:
        mine, kind = held.get(field.name.lower()), field.dataType.simpleString()
        if mine is None:
            columns.append(f"CAST(NULL AS {kind}) AS `{field.name}`")
        elif mine.dataType == field.dataType:
            columns.append(f"`{mine.name}` AS `{field.name}`")
        else:
            columns.append(f"CAST(`{mine.name}` AS {kind}) AS `{field.name}`")
    return df.selectExpr(*columns, *keep)
