import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        # Names that operators use for columns of their own.
        T.StructField("size", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("words", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """Documents from (id, text) or (id, text, lang, source)."""
        full = [(*row, *([None] * (4 - len(row))), "x", "y", "z", "c") for row in rows]
        return spark.createDataFrame(full, DOCS)

    return make
