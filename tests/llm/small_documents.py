"""A table like documents, from short rows."""

import pytest

@pytest.fixture
def documents(spark):
    """``documents((id, text, source), ...)``; the source may be left out."""

    def make(*rows, extra=()):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        filled = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(filled, schema)
        for name in extra:
            df = df.selectExpr("*", f"'x' as `{name}`")
        return df

    return make
