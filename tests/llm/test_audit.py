"""Filter interaction audit against brute force over all orders."""

import re
from itertools import permutations

import llm_brute as brute

from gavel.llm import filter_audit

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(doc, rows):
    i, text, _ = doc
    text = text or ""
    w = brute.words(text)
    out = "A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w))
    out += "C" * (100 * len(re.findall("[A-Z]", text)) > 3 * len(text)) + "D" * bool(re.search(r"[#$%&*|]", text))
    return out + "E" * any(i is not None and j is not None and j < i and (t or "") == text for j, t, _ in rows)


def audited(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    masks = [(lang or "", fails((i, t, lang), rows), i in good, i in toxic) for i, t, lang in rows]
    out, shapley = [], {}
    for part in {m[0] for m in masks}:
        for order in map("".join, permutations("ABCDE")):
            left = [m for m in masks if m[0] == part]
            whole = left
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out.append([part, order, step, len(left), len(gone), sum(f in m[1] for m in whole) - len(gone),
                            sum(m[1] == f for m in whole), sum(m[2] for m in gone), sum(m[3] for m in gone)])
    return [(*r, shapley[r[0], r[1][r[2] - 1]]) for r in out]


def test_audit(spark, same):
    langs = ["en", "de", None, "", "e'n"]
    rows = [(i, t, langs[k % 5]) for k, (i, t) in enumerate(brute.awkward())]
    rows += [(500, "A B C D" * 60, "en"), (501, "word " * 250, "en"), (502, "x #", "en"), (503, "x #", "de"), (503, "x #", "de"), (None, "x #", "en")]
    rows += [(600 + k, "TOO MANY " * 120, "fr") for k in range(9)] + [(700 + k, f"fine{k} " + brute.prose(k, 400), "fr") for k in range(4)]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, None), (3, None, 1), (501, 0, 1), (502, 1, 1), (None, 1, 1), (601, 1, 0), (9999, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr(
        "*", "'x' AS part", "'y' AS mask", "1 AS n", "true AS good", "'z' AS quality", "'a' AS filter_order", "'b' AS fa_id")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'q' AS part", "'r' AS text", "2 AS fa_id")
    out = filter_audit.query(docs, marks)
    same(out, COLUMNS, audited(rows, labels))
    assert out.count() == 600 * len({r[0] for r in audited(rows, labels)})


def test_audit_without_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.query(docs, labels).count() == 0
    one = spark.createDataFrame([(1, None, None)], docs.schema)
    rows = filter_audit.query(one, labels).collect()
    assert len(rows) == 600 and {r["part"] for r in rows} == {""}
    assert all(r["removed"] == (r["filter_order"][r["step"] - 1] == "A") for r in rows)
