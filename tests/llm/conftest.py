import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""

    def make(*rows):
        full = [(row[0], row[1], "en", row[2] if len(row) > 2 else "s", len(row[1] or "")) for row in rows]
        return spark.createDataFrame(full, DOCS)

    return make


def by_id(df):
    """Rows as dicts, by doc_id; a null one first, rows of one doc_id in a fixed order."""
    rows = [row.asDict(recursive=True) for row in df.collect()]
    return sorted(rows, key=lambda row: (row["doc_id"] is not None, row["doc_id"] or 0, str(row)))
