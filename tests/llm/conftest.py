import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """documents rows from (doc_id, text[, lang])."""

    def make(rows, schema=DOCS, extra=()):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, schema)
        for name in extra:
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit("extra"))
        return df

    return make
