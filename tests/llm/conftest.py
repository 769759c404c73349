import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Documents from texts, or from (id, text) pairs, with clashing extra columns on request."""

    def make(rows, extra=()):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        data = [(i, t, "en", "src", len(t or "")) + ("x",) * len(extra) for i, t in pairs]
        schema = DOC + "".join(f", `{e}` string" for e in extra)
        return spark.createDataFrame(data, schema).repartition(2)

    return make
