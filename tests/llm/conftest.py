from __future__ import annotations

import pytest
from pyspark.sql import types as T

from netdays.llm.common import prepare


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def docs(llm):
    """Rows of (doc_id, text, lang), with columns whose names the operators use inside."""

    def make(rows):
        full = [(i, t, lang, "x", 1, None) for i, t, lang in (r if len(r) == 3 else (*r, None) for r in rows)]
        schema = T.StructType([
            T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
            T.StructField("component", T.StringType()), T.StructField("rank", T.IntegerType()), T.StructField("start", T.StringType()),
        ])
        return llm.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def small(llm):
    """The documents of the smallest table."""
    return llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
