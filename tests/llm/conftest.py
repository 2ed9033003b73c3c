import pytest
from pyspark.sql import types as T

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs_of(spark):
    """Documents from texts or (id, text) pairs, all of one source."""

    def make(rows, source="s"):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame([(i, t, "en", source, len(t or "")) for i, t in pairs], DOCS)

    return make


@pytest.fixture
def clashing():
    """Adds columns whose names the operators use themselves."""

    def add(df):
        for name in ("fingerprint", "component_id", "lines", "host", "score", "block", "ids", "found", "digest", "start", "root"):
            df = df.withColumn(name, df["doc_id"].cast(T.StringType()))
        return df

    return add
