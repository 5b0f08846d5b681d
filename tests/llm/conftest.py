import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Build a documents table from (doc_id, text) or (doc_id, text, source) tuples, with extra clashing columns."""

    def build(rows, extra=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for name in ("id", "class", "size", "key", "band", "component", "spans", "bin", "space", "length", "n_words", "kept", "hash"):
                df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return build


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def corpus(spark, sf):
    return [(r["doc_id"], r["text"], r["source"], r["lang"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
