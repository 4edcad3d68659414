import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """documents(rows): a table of (doc_id, text[, lang, source]) rows; given columns may clash with the operators' own."""

    def make(rows, extra=()):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC_SCHEMA)
        from pyspark.sql import functions as F

        for name in extra:
            df = df.withColumn(name, F.lit("clash"))
        return df

    return make


CLASHING = ("row", "n", "rep", "digest", "kept", "size", "rank", "g", "a", "start", "token", "score", "part", "grp", "norm", "toxic")


@pytest.fixture()
def clashing():
    return CLASHING
