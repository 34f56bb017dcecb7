import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, source]) rows, with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    def make(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if clash:
            for name in ("size", "at", "fp", "row", "t", "text2", "hash", "n_words", "spans", "base", "x", "score"):
                df = df.withColumn(name, F.lit("clash"))
        return df
    return make
