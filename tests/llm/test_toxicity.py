"""Toxicity: word bags and passages against plain Python, misspelt words, held-out accuracy."""

import random
import zlib

import llm_brute as brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gavel.llm import toxicity

BITS = 32 - toxicity.BUCKET_BITS


def bucket(gram):
    rolling = 0
    for c in gram:
        rolling = (rolling * 0x01000193 + ord(c)) % 2**32
    h = (rolling + len(gram)) * 0x9E3779B1 % 2**32
    h ^= h >> 15
    return h * 0x85EBCA77 % 2**32 >> BITS


def margin(text, table):
    """Highest mean over WINDOW words; None without words."""
    each = []
    for word in brute.words((text or "").lower()):
        bag = [f" {word} "[k:k + n] for n in toxicity.GRAMS for k in range(len(word) + 3 - n)]
        each.append(np.mean([table[bucket(g)] for g in bag]))
    size = min(len(each), toxicity.WINDOW)
    return max((np.mean(each[k:k + size]) for k in range(len(each) - size + 1)), default=None) if each else None


TABLE = np.random.default_rng(1).normal(0, 3, 1 << toxicity.BUCKET_BITS).astype(np.float32)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\tİ ", max_size=40)), min_size=1, max_size=6))
def test_scores_are_the_highest_passage(texts):
    got = toxicity.Model(TABLE, -0.5).scores(texts)
    want = [1 / (1 + np.exp(0.5 - (margin(t, TABLE) or 0))) for t in texts]
    assert np.allclose(got, want, rtol=1e-4, atol=1e-6)


@pytest.mark.parametrize("text", ["", "B", "aB", "a b", "aBa"])
def test_texts_shorter_than_the_n_grams(text):
    """The only text of a batch, with fewer code points than the longest n-gram."""
    got = toxicity.Model(TABLE, -0.5).scores([text])
    assert np.allclose(got, [1 / (1 + np.exp(0.5 - (margin(text, TABLE) or 0)))], rtol=1e-4, atol=1e-6)


def planted(n, seed, bad):
    rng = random.Random(seed)
    texts, marks = [], []
    for k in range(n):
        words = brute.prose(seed * 100_000 + k, rng.randrange(10, 400), 600).split(" ")
        if k % 5 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        texts.append(" ".join(words))
        marks.append(float(k % 5 == 0))
    return texts, np.array(marks)


def test_misspelt_words_are_found():
    texts, toxic = planted(600, 3, ["scoundrel", "wretched", "imbecile"])
    model = toxicity.fit(texts, toxic)
    for bad, recall in ((["scoundrel", "imbecile"], 0.98), (["scoundrrel", "scoundrels", "wretchedly"], 0.9), (["imbecille", "wretcched"], 0.6)):
        other, marks = planted(200, 4, bad)
        found = model.scores(other) >= toxicity.THRESHOLD
        assert found[marks == 1].mean() > recall and found[marks == 0].mean() < 0.03
    clean = brute.prose(77, 30_000, 600)
    assert model.scores([clean])[0] < toxicity.THRESHOLD <= model.scores([clean + " you scoundrel scoundrels " + clean])[0]
    assert model.scores(["", None, " \n"]).max() < toxicity.THRESHOLD


def test_query(frame, spark):
    rows = brute.awkward()
    texts, toxic = planted(300, 8, ["scoundrel", "wretched"])
    rows += [(10_000 + k, t) for k, t in enumerate(texts)]
    marks = [(10_000 + k, 1, int(y)) for k, y in enumerate(toxic)] + [(None, 1, 1), (1, 1, None), (99_999, 1, 1), (10_000, 0, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int").selectExpr("*", "'t' AS text", "0 AS score", "1 AS tx_label")
    got = toxicity.query(frame(rows), labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in rows)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    found = {r["doc_id"]: r["predicted"] for r in got}
    held = [k for k in range(300) if zlib.crc32(str(10_000 + k).encode()) % 4 == 2]
    assert sum(found[10_000 + k] == toxic[k] for k in held) >= 0.95 * len(held)
    learnt, _ = toxicity.labelled_sample(frame(rows), labels)
    assert not {texts[k] for k in held} & set(learnt) and len(learnt) == 300 - len(held)


def test_query_without_labels_or_rows(frame, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = brute.awkward()
    assert {(r["score"], r["predicted"]) for r in toxicity.query(frame(rows), labels).collect()} == {(0.0, 0)}
    assert toxicity.query(frame([]), labels).count() == 0
    only = spark.createDataFrame([(1, 1, 1), (2, 0, 1)], labels.schema)
    assert {r["score"] for r in toxicity.query(frame(rows), only).collect()} <= {1.0, 0.0}


def test_sample_is_bounded(frame, spark):
    rows = [(k, f"text {k}") for k in range(400)] + [(1000, "x" * (toxicity.MAX_CHARS + 1))]
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(400)] + [(1000, 1, 1)], "doc_id long, quality int, toxic int")
    texts, toxic = toxicity.labelled_sample(frame(rows), labels, max_labelled=20)
    assert len(texts) <= 40 and toxic.sum() <= 20


@pytest.mark.parametrize("lang,recall,clean", [("en", 0.8, 0.98)])
def test_held_out(spark, lang, recall, clean):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = (toxicity.query(docs, labels).where("held_out").join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
           .where(f"lang = '{lang}'").selectExpr("avg(predicted) FILTER (WHERE toxic = 1) AS r", "avg(1 - predicted) FILTER (WHERE toxic = 0) AS c").first())
    assert out["r"] > recall and out["c"] > clean
