import pytest

#: Extra columns whose names the operators use themselves.
CLASH = ["node", "comp", "bid", "keys", "kept", "key", "shard", "slot", "size", "seq", "n", "n_lines", "n_words", "features",
         "licence", "dir", "own", "tokenizer", "class_id", "score", "n_dropped", "start", "n_hit", "dc_items", "removed", "lang", "source"]


@pytest.fixture(scope="session")
def frame(spark):
    """DataFrame of (doc_id, text) rows, with clashing columns."""
    def make(rows, clash=True):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df.selectExpr("*", *(f"'{c}' AS {c}" for c in CLASH), "cast(length(text) AS long) AS n_chars") if clash else df
    return make


@pytest.fixture
def same():
    def check(df, columns, want):
        got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
        assert got == sorted(want, key=str)
    return check
