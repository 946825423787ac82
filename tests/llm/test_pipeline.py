"""The queries against DuckDB, and the pipeline's stages against brute force."""

import llm_brute as brute
import corpus_pipeline
import pytest
from gavel.llm import quality_rules, tokens
from gavel.llm.queries import ORACLE, QUERIES
from parity import digest, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_duckdb(spark, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = duck(SF).sql(ORACLE[name])
    columns = rel.columns
    other = [tuple(r[columns.index(c)] for c in df.columns) for r in rel.fetchall()]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, rows)[0] == digest(df.columns, other)[0]


def test_stages_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]


def test_pipeline_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality_rules.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in quality_rules.with_statistics(docs, model).collect()}
    rows = []
    for r in docs.collect():
        words, *_, repeated = brute.statistics(r["text"])
        if words >= 20 and 100 * repeated <= 30 * words and scores[r["doc_id"]] >= 0:
            rows.append((r["doc_id"], r["text"]))

    def key(line):
        return line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(brute.LOWER)
    owner = {}
    for i, text in rows:
        for k in map(key, text.split("\n")):
            owner[k] = min(owner.get(k, i), i)
    rows = [(i, "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or owner[key(x)] == i)) for i, t in rows]
    rows = [r for r, (i, least, _) in zip(rows, brute.classes(rows)) if i == least]
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r for r, hit in zip(rows, brute.contamination(rows, bench)) if not hit[-1]]

    got = corpus_pipeline.run(spark, SF).groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()
    assert sorted(map(tuple, got)) == sorted((i, len(tokens.pieces().encode(t)) // 2 + 1) for i, t in rows)


def test_stages_on_awkward_rows(spark, frame):
    """Every stage but the last keeps the columns, whatever the rows."""
    sf = SF
    docs = frame(brute.awkward())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
