import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


@pytest.fixture()
def documents(spark):
    """A documents table from (doc_id, text, lang, source) tuples, written as Parquet.

    Further columns carry the names that the operators use inside.
    """
    from strata.llm.common import staged

    def make(rows, extra=()):
        full = [(*r, len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in extra:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return staged(spark, df.repartition(3), "docs")

    return make
