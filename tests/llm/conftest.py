import pytest
from pyspark.sql import types as T

FIELDS = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType())]
SCHEMA = T.StructType([T.StructField(n, t) for n, t in FIELDS])


@pytest.fixture(scope="session")
def make(spark):
    """A documents table of texts; ids count from 0 unless given as (id, text)."""

    def build(texts, extra=False, lang="en", source="s"):
        rows = [(t if isinstance(t, tuple) else (i, t)) for i, t in enumerate(texts)]
        df = spark.createDataFrame([(i, t, lang, source, len(t or "")) for i, t in rows], SCHEMA)
        if extra:
            for name in ("fp", "n", "row", "block", "keep_id", "slot", "shard", "kept", "key", "pattern", "score", "length"):
                df = df.withColumn(name, df["text"])
        return df

    return build
