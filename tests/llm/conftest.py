import pytest


@pytest.fixture
def docs(spark):
    """A function from texts, or (doc_id, text) pairs, to a documents table."""

    def make(rows, schema="doc_id long, text string, lang string, source string, n_chars int"):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return make


def clashing(df):
    """``df`` with columns of names that operators use inside and in their results."""
    from pyspark.sql import functions as F

    names = "id digest row key fp first component place tokens n k1 removed_lines n_lines score words shard item n_words size"
    return df.withColumns({n: F.lit(n) for n in names.split() if n not in df.columns})
