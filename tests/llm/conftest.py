import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows."""
    def make(rows, extra=None):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name, value in (extra or {}).items():
            df = df.selectExpr("*", f"{value} as `{name}`")
        return df
    return make
