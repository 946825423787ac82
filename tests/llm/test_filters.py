"""Line dedup, near-dedup, suffix dedup, quality rules and decontamination against brute force."""

import llm_brute as brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gavel.llm import decontamination, line_dedup, near_dedup, quality_rules, suffix_dedup
from gavel.llm.common import utf8
from gavel.sources.scratch import noted

ROWS = brute.awkward()
ITEMS = [(1, " ".join(brute.words(ROWS[0][1])[40:60])), (1, " ".join(brute.words(ROWS[0][1])[100:114])), (2, "One line"), (3, None), (4, ""),
         (None, "a b c"), (5, "ab" * 900), (6, " ".join(brute.words(brute.prose(7, 20000))[5000:5030])), (7, "no such words at all in any of the documents of this fixture here")]


def items(spark, rows=ITEMS):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' AS dc_words", "'y' AS doc_id")


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# ------------------------------------------------------------- line dedup

def test_line_dedup(frame, same):
    same(line_dedup.query(frame(ROWS)), ["doc_id", "n_lines", "n_dropped", "kept_sha256"], brute.lines(ROWS))


@pytest.mark.parametrize("batches,fanout", [(1, 2), (5, 2), (6, 3)])
def test_line_dedup_any_batches(frame, same, batches, fanout):
    out = line_dedup.dedup_lines(frame(ROWS), batches=batches, fanout=fanout)
    same(out.select("doc_id", "ld_out.n_lines", "ld_out.n_dropped"), ["doc_id", "n_lines", "n_dropped"], [r[:3] for r in brute.lines(ROWS)])


def test_line_index_levels(frame):
    index = line_dedup.build_index(frame([r for r in ROWS if r[0]]), batches=6, fanout=2)
    assert all(len(level) < 2 for level in index.levels)
    keys = index.owners()
    assert keys.count() == keys.select("ld_hi", "ld_lo").distinct().count()


def test_line_dedup_stage_columns_and_empty(frame):
    docs = frame(ROWS)
    out = line_dedup.stage(docs)
    assert out.columns == docs.columns and out.count() == len(ROWS)
    changed = out.where("doc_id = 2").first()
    assert changed["text"] == ROWS[1][1].split("\n")[-1] and changed["n_chars"] == len(changed["text"]) < 10
    assert line_dedup.query(frame([])).count() == 0


# -------------------------------------------------------------- near-dedup

def test_near_dedup(frame, same):
    same(near_dedup.query(frame(ROWS)), ["doc_id", "class_id", "class_size"], brute.classes(ROWS))


def test_near_dedup_chain_and_families(frame, same):
    """A chain of near copies, and families that share a long passage, in a shuffled order."""
    rows, text = [], brute.prose(50, 200)
    for k in range(30):
        rows.append((1000 - k, text))
        text = brute.edited(text, k, 2)
    passage = brute.prose(51, 150)
    rows += [(2000 + 10 * f + k, brute.edited(passage + " " + brute.prose(60 + f, 60), 10 * f + k, 1)) for f in range(5) for k in range(6)]
    same(near_dedup.query(frame(rows)), ["doc_id", "class_id", "class_size"], brute.classes(rows))


@pytest.mark.parametrize("words,pairs,lost", [(8, 400, 0), (12, 200, 0), (14, 200, 1), (30, 100, 0)])
def test_near_dedup_recall_by_length(frame, words, pairs, lost):
    """Pairs of similarity 0.8 or little more: as many words more as that allows, at either end."""
    shingle_count = words - 4
    more = shingle_count // 4
    rows = []
    for k in range(pairs):
        text = " ".join(f"p{k}w{j}" for j in range(words))
        extra = " ".join(f"p{k}x{j}" for j in range(more))
        rows += [(2 * k, text), (2 * k + 1, f"{text} {extra}" if k % 2 else f"{extra} {text}")]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.query(frame(rows, clash=False)).collect()}
    assert sum(got[2 * k + 1] != 2 * k for k in range(pairs)) <= lost


def test_near_dedup_passages_in_many_documents(frame, same):
    """Documents that share one, two or three of a few passages, below and above the threshold, and copies of some."""
    passages = [brute.prose(300 + k, 60) for k in range(4)]
    rows = []
    for k in range(60):
        shared = [passages[(k + j) % 4] for j in range(1 + k % 3)]
        rows.append((k, " ".join([*shared, brute.prose(400 + k, 6 if k % 5 == 0 else 90)])))
    rows += [(100 + k, brute.edited(rows[k][1], k, 1)) for k in range(0, 60, 4)]
    same(near_dedup.query(frame(rows)), ["doc_id", "class_id", "class_size"], brute.classes(rows))


def _families(members):
    """Near copies of one text in families that are linked within but not to each other, in few buckets."""
    rows, base = [], brute.prose(70, 120)
    for f in range(6):
        rows += [(100 * f + k, brute.edited(brute.edited(base, 500 + f, 5), 10 * f + k, 1)) for k in range(members)]
    return rows


def test_near_dedup_settles_a_pivot_at_once(frame, same, monkeypatch):
    """Groups of more than FEW members need no round of new buckets, so no row for each of their shingles."""
    def none(*args):
        raise AssertionError("a new round of buckets")
    monkeypatch.setattr(near_dedup, "_sharing_outside", none)
    rows = _families(8)
    assert len(rows) > near_dedup.FEW
    same(near_dedup.query(frame(rows, clash=False)), ["doc_id", "class_id", "class_size"], brute.classes(rows))


@pytest.mark.parametrize("few,many,shingles", [(3, 3, 1 << 20), (3, 1024, 2000)])
def test_near_dedup_large_groups(frame, same, monkeypatch, few, many, shingles):
    """Groups over the limits of members and of shingles are settled by covers and new buckets, with the same classes."""
    for name, value in (("FEW", few), ("MANY", many), ("MANY_SHINGLES", shingles)):
        monkeypatch.setattr(near_dedup, name, value)
    rows = _families(5)
    same(near_dedup.query(frame(rows, clash=False)), ["doc_id", "class_id", "class_size"], brute.classes(rows))


@pytest.mark.parametrize("n,size,values", [(1, 5, 9), (5, 0, 3), (33, 40, 60), (100, 30, 3000), (80, 300, 1500)])
def test_common_counts(n, size, values):
    rng = np.random.default_rng(n)
    texts = [np.unique(rng.integers(0, values, size if k % 7 else size // 2)).astype(np.uint64) for k in range(n)]
    got = near_dedup.common_counts(texts)
    assert all(got[i, j] == len(np.intersect1d(texts[i], texts[j])) for i in range(n) for j in range(n) if i != j)


def test_near_dedup_stage(frame):
    out = near_dedup.stage(frame(ROWS))
    assert out.columns == frame(ROWS).columns
    got = sorted((r["doc_id"], r["text"]) for r in out.where("doc_id IS NOT NULL AND text IS NOT NULL").collect())
    want = {}
    for (i, text), (_, least, _) in zip(ROWS, brute.classes(ROWS)):
        if i is not None and i == least and text is not None:
            want[(i, text)] = None
    assert got == sorted(want)
    assert out.where("text IS NULL").count() == 2
    assert near_dedup.stage(frame([])).count() == 0


def test_similarity_is_order_sensitive():
    a = np.arange(100, dtype=np.uint64)
    b = np.concatenate([a[50:], a[:50]])
    assert near_dedup.similarity(a, a, 0.6) == 1
    assert near_dedup.similarity(a, b, 0.6) == 0
    assert near_dedup.similarity(a, a[:90], 0.6) == 0.9
    assert near_dedup.similarity(a, a[:0], 0.6) == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 12), unique=True, max_size=12), st.lists(st.integers(0, 12), unique=True, max_size=12))
def test_similarity_is_the_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    common = table[-1][-1]
    want = common / (len(a) + len(b) - common) if common else 0.0
    got = near_dedup.similarity(np.array(a, np.uint64), np.array(b, np.uint64), 0.6)
    assert got == (want if want >= 0.6 else 0.0)


# ------------------------------------------------------------ suffix dedup

def test_suffix_dedup(frame, same):
    same(suffix_dedup.query(frame(ROWS)), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], brute.suffixes(ROWS))


def test_suffix_dedup_boundaries(frame, same, spark, monkeypatch):
    """Passages just below, at and above the length, in many contexts, with one suffix to a bucket or so."""
    passage = brute.prose(70, 200)
    rows = [(k, brute.prose(700 + k, 30) + passage[:n] + brute.prose(800 + k, 30)) for k, n in enumerate([399, 400, 400, 401, 402, 399, 650, 650, 900, 30])]
    monkeypatch.setattr(suffix_dedup, "BUCKET_ROWS", 300)
    same(suffix_dedup.query(frame(rows)), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], brute.suffixes(rows))
    assert suffix_dedup.query(frame([])).count() == 0


def test_suffix_dedup_of_texts_over_a_slice(frame, same, monkeypatch):
    """Texts longer than a slice and shorter ones share passages, at slice ends too."""
    monkeypatch.setattr(suffix_dedup, "SLICE", 3000)
    monkeypatch.setattr("gavel.llm.common.CHUNK_BYTES", 1000)
    passage, repeats = brute.prose(70, 200), "ab" * 700
    long = brute.prose(71, 2000)
    rows = [(1, long), (2, brute.prose(72, 50) + long[2700:3400]), (3, brute.prose(73, 900) + passage), (4, passage + repeats), (5, repeats + long[5000:5500]),
            (6, long[100:4200] + brute.prose(74, 30))]
    same(suffix_dedup.query(frame(rows)), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], brute.suffixes(rows))


def test_suffix_dedup_hot_anchor(frame, same, spark):
    """The ranges of one anchor, and of one context, are dealt to several tasks."""
    rows = [(1, "ab" * 3000 + brute.prose(75, 80)), (2, brute.prose(76, 80) + "ab" * 3000), (3, brute.prose(77, 400)), (4, brute.prose(77, 400))]
    tasks = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in tasks}
    try:
        for k, v in tasks.items():
            spark.conf.set(k, v)
        with noted() as made:
            same(suffix_dedup.query(frame(rows)), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], brute.suffixes(rows))
        shared = spark.read.parquet(f"{made[0].root}/shared")
        contexts = spark.read.parquet(f"{made[0].root}/contexts").select("sx_context", F.col("sx_copies").alias("n"))
        copies = suffix_dedup.spread_join(shared, contexts, "sx_context", "sx_doc", "sx_at").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = [r["count"] for r in shared.groupBy(F.input_file_name()).count().collect()]
    assert max(files) < 0.5 * sum(files) and sum(files) > 5000
    assert max(r["count"] for r in copies) < 0.5 * sum(r["count"] for r in copies)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 2)), max_size=30))
def test_multikey_order(rows):
    keys = [np.array(k, np.int64) for k in zip(*rows)] or [np.zeros(0, np.int64)] * 3
    got = [rows[k] for k in suffix_dedup.multikey_order(keys)]
    assert got == sorted(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=40), st.integers(1, 9))
def test_sliding_min(values, width):
    got = suffix_dedup.sliding_min(np.array(values, np.uint64), width)
    assert got.tolist() == [min(values[k:k + width]) for k in range(len(values) - width + 1)]


# ----------------------------------------------------------- quality rules

@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab #|é\n\t\x85", max_size=60)), min_size=1, max_size=6))
def test_statistics(texts):
    counts, features = quality_rules.statistics(*utf8(pa.array(texts, pa.string())))
    assert [tuple(c) for c in counts] == [brute.statistics(t) for t in texts]
    assert np.isfinite(features).all()


def test_quality_query(frame, spark, same):
    good = labels(spark, [(i, int(i % 2 == 0), 0) for i, _ in ROWS if i] + [(None, 1, 0), (9999, 1, 0), (1, None, 0)])
    out = quality_rules.query(frame(ROWS), good)
    counts = [(i, *brute.statistics(t)) for i, t in ROWS]
    same(out, ["doc_id", *quality_rules.COUNTS, "base_failed"], [(*c, c[1] < 20 or 100 * c[5] > 30 * c[1]) for c in counts])
    assert out.where("base_failed AND kept").count() == 0


def test_quality_without_labels_is_the_base_rules(frame, spark):
    out = quality_rules.query(frame(ROWS), labels(spark, []))
    assert out.where("kept = base_failed").count() == 0
    assert quality_rules.query(frame([]), labels(spark, [])).count() == 0
    kept = quality_rules.stage(frame(ROWS), labels(spark, []))
    assert kept.columns == frame(ROWS).columns and kept.count() == out.where("kept").count()


def test_trees_are_monotonic():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = (x[:, 0] + 0.3 * rng.random(3000) * np.sin(9 * x[:, 1]) < 0.5).astype(float)
    model = quality_rules.fit(x, y, np.array([-1, 0, 0]), trees=30)
    grid = np.repeat(rng.random((50, 3)), 41, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 41), 50)
    assert (np.diff(model.margin(grid).reshape(50, 41), axis=1) <= 1e-12).all()
    assert ((model.margin(x) > 0) == (y > 0)).mean() > 0.9


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, marked = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    x, y = quality_rules.labelled_sample(docs, marked)
    cut = len(y) * 2 // 3
    model = quality_rules.fit(x[:cut], y[:cut], quality_rules.signs())
    assert ((model.margin(x[cut:]) >= 0) == (y[cut:] == 1)).mean() > 0.98


# --------------------------------------------------------- decontamination

COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_decontamination(frame, spark, same):
    same(decontamination.query(frame(ROWS), items(spark)), COLUMNS, brute.contamination(ROWS, ITEMS))


def test_decontamination_beyond_broadcast(frame, spark, same, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 3)
    same(decontamination.query(frame(ROWS), items(spark)), COLUMNS, brute.contamination(ROWS, ITEMS))


def test_decontamination_passage_of_many_items(frame, spark, same):
    """A passage of 14 words in 80 items and 200 documents: rows grow with documents plus items, not with their product."""
    passage = " ".join(f"b{k}" for k in range(14))
    bench = [(k, f"{passage} {brute.prose(k, 20 + k % 3)}") for k in range(80)] + [(200, passage)]
    rows = [(k, f"{brute.prose(1000 + k, 30)} {passage if k % 4 else bench[k % 80][1]}") for k in range(200)]
    same(decontamination.query(frame(rows), items(spark, bench)), COLUMNS, brute.contamination(rows, bench))
    classed, members = decontamination.item_classes(items(spark, bench))
    assert members.count() <= 81 + 80 + 20  # the shared class, each item's own, and few at the edges


def test_decontamination_empty_and_stage(frame, spark, same):
    assert decontamination.query(frame([]), items(spark)).count() == 0
    same(decontamination.query(frame(ROWS), items(spark, [])), COLUMNS, brute.contamination(ROWS, []))
    docs = frame(ROWS)
    out = decontamination.stage(docs, items(spark))
    assert out.columns == docs.columns
    assert out.count() == sum(not r[-1] for r in brute.contamination(ROWS, ITEMS))


def test_every_shared_span_is_found(frame, spark, same):
    """Windows at every place of a text, one word changed elsewhere."""
    text = brute.words(brute.prose(90, 60, 25))
    rows = [(k, " ".join(["q"] * k + text[k:k + 13] + ["r"] * 5)) for k in range(47)] + [(99, " ".join(text[:12] + ["s"] + text[13:25]))]
    bench = [(1, " ".join(text))]
    same(decontamination.query(frame(rows), items(spark, bench)), COLUMNS, brute.contamination(rows, bench))


# -------------------------------------------------------------- components

@pytest.mark.parametrize("few", [0, 200_000])
def test_components_either_way(spark, monkeypatch, few):
    from gavel.llm import components
    from gavel.llm.common import Scratch
    monkeypatch.setattr(components, "FEW", few)
    pairs = [(f"{k:03d}", f"{k + 1:03d}") for k in range(0, 30) if k % 7] + [("099", "005"), ("050", "099"), ("070", "071"), ("071", "070")]
    edges = spark.createDataFrame(pairs, "a string, b string").selectExpr("cast(a as binary) a", "cast(b as binary) b")
    nodes = spark.createDataFrame([(f"{k:03d}",) for k in range(101)], "node string").selectExpr("cast(node as binary) node")
    got = {bytes(r["node"]).decode(): bytes(r["comp"]).decode() for r in components.components(nodes, edges, Scratch(spark, "t"), f"few{few}").collect()}
    least = {f"{k:03d}": f"{k:03d}" for k in range(101)}
    for _ in range(101):
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    assert got == least
