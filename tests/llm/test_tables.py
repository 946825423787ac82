"""Sharding, token counts, licence scan, packing, pseudonyms and the pipeline."""

import zlib
from collections import Counter, defaultdict

import llm_brute as brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gavel.llm import license_scan, packing, pseudonyms, sharding, token_counts, tokens

ROWS = brute.awkward()


# ----------------------------------------------------------------- sharding

def test_sharding(frame):
    got = sharding.query(frame(ROWS)).collect()
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in ROWS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r["shard"]].append(r["slot"])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 24
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert sharding.query(frame([])).count() == 0


def test_shards_are_near_equal_and_edits_move_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = sharding.slot_bytes(sharding.records(docs))
    maps = sharding.ShardMap(spark)
    old = maps.store(sharding.first_map(sizes))
    new = maps.store(sharding.edit_map(old, sizes, 25))
    for slot_map, shards in ((old, 24), (new, 25)):
        load = [r["b"] for r in slot_map.groupBy("shard").agg({"sh_bytes": "sum"}).toDF("shard", "b").collect()]
        assert len(load) == shards and max(load) < 1.02 * min(load)
    assert old.count() == new.count() == sizes.count()
    moved = old.join(new.selectExpr("sh_slot", "shard AS later"), "sh_slot").where("shard != later").count()
    assert moved < old.count() / 2
    assert len(maps.versions) == 2


def test_query_places_by_the_edited_map(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(sharding, "place", lambda recs, slot_map, place=sharding.place: stored.append(slot_map) or place(recs, slot_map))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sharding.query(docs)
    assert "version=1" in stored[0].inputFiles()[0]
    load = [r["b"] for r in got.groupBy("shard").agg({"size": "sum"}).toDF("shard", "b").collect()]
    assert len(load) == 24 and max(load) < 1.02 * min(load) and got.count() == docs.count()


# ------------------------------------------------------------------- tokens

def test_ids_are_the_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = ["it's we'll IT'S", "  x\n\n y ", " \x1c\x1d y\x85z", "1²¼ab٣", "日本 語x", "<|endoftext|> a", "<|endoftext|>", "a <|endoftext|><|endoftext|> b<|endoftext|>", "<|endoftext |> <|ENDOFTEXT|>", "日<|endoftext|>", "\t\n\n \n", "ⅷ x", "ɏɐ", "a  b", ""]
    table = tokens.pieces()
    for text in odd + [t for _, t in ROWS if t]:
        assert np.frombuffer(table.encode(text), "<u2").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(table.encode("<|endoftext|>"), "<u2").tolist() == [50256]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_pieces_equal_the_library(text):
    table = tokens.pieces()
    assert np.frombuffer(table.encode(text), "<u2").tolist() == table.library.encode(text, add_special_tokens=False).ids


def test_full_piece_table_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_PIECES", 50)
    table = tokens.Pieces()
    texts = [brute.prose(3 + k, 200, 60) for k in range(4)] + [None, "", "<|endoftext|>"]
    for _ in range(2):
        got = [np.frombuffer(i, "<u2").tolist() for i in table.encode_all(texts)]
        assert got == [table.library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert len(table) <= 50


def counts_of(rows):
    first = {}
    for _, text in sorted((r for r in rows if r[1] is not None and r[0] is not None), key=lambda r: r[0], reverse=True):
        first[text] = _
    out = Counter()
    for i, text in rows:
        if text is not None and first.get(text, i) != i:
            continue
        n = len(tokens.pieces().encode(text)) // 2
        out["words_v1", "docs"] += 1
        out["words_v1", "tokens"] += len(brute.words(text))
        out["byte_bpe_50k", "docs"] += 1
        out["byte_bpe_50k", "tokens"] += n
    return out


def test_token_counts(frame):
    got = Counter()
    for r in token_counts.query(frame(ROWS)).collect():
        assert (r["source"], r["lang"]) == ("source", "lang")
        got[r["tokenizer"], "docs"] += r["n_docs"]
        got[r["tokenizer"], "tokens"] += r["n_tokens"]
    assert got == counts_of(ROWS)
    assert token_counts.query(frame([])).count() == 0


def test_token_counts_of_all_documents(spark):
    rows = [(1, "a b", "s", "x"), (2, "a b", "s", "y"), (3, "a b", "s", "y"), (4, "c", "s", "x"), (5, None, "s", None)]
    got = token_counts.query(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).where("tokenizer = 'words_v1'")
    want = {"x": (2, 3, 0, 0, 2, 3), "y": (2, 4, 2, 4, 0, 0), None: (1, 0, 0, 0, 1, 0)}
    assert {r["lang"]: (r["all_docs"], r["all_tokens"], r["copy_docs"], r["copy_tokens"], r["n_docs"], r["n_tokens"]) for r in got.collect()} == want


def test_ledger_is_idempotent(spark):
    rows = spark.createDataFrame([("s", None, "t", 1, 5), ("s", None, "t", 1, 7), (None, "l", "t", 1, 1)], token_counts._DELTA)
    ledger = token_counts.Ledger(spark)
    assert ledger.totals().count() == 0
    assert ledger.commit("a", rows)
    assert not ledger.commit("a", rows)
    ledger._enter(("a", "~/another try"))  # entered twice by a retry: the first in order counts
    ledger._enter(("a", ledger.committed()["a"]))
    want = sorted([(None, "l", "t", 1, 1), ("s", None, "t", 2, 12)], key=str)
    assert sorted(map(tuple, ledger.totals().collect()), key=str) == want
    assert ledger.commit("b", rows.selectExpr("source", "lang", "tokenizer", "-d_docs AS d_docs", "-d_tokens AS d_tokens"))
    assert ledger.totals().count() == 0
    again = token_counts.Ledger(spark)
    again.commit("a", rows)
    compact = again.compact()
    assert sorted(map(tuple, compact.totals().collect()), key=str) == want
    assert not compact.commit("a", rows)  # a replay after the compaction
    assert compact.commit("c", rows)
    twice = compact.compact()
    assert not twice.commit("a", rows) and not twice.commit("c", rows)
    doubled = sorted(((s, lang, t, 2 * d, 2 * n) for s, lang, t, d, n in want), key=str)
    assert sorted(map(tuple, twice.totals().collect()), key=str) == doubled


# ----------------------------------------------------------------- licences

def test_licences(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/x.py", "code only"), ("a/b/y.py", "x\n  released UNDER the mit license\n" + "z " * 40),
            ("a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."), ("a/b/c/d/z.py", "nothing"),
            ("top.py", None), ("other/q.py", ""), (None, "text"), ("a/b/w.py", "the license of the work under the sun"), ("ab/v.py", "other")]
    df = spark.createDataFrame(rows, "file string, text string").selectExpr("*", "'x' AS licence", "'y' AS score", "1 AS dir")
    got = {r["file"]: (r["licence"], r["from_dir"], r["is_licence_file"]) for r in license_scan.scan(df, ["file"], "file").collect()}
    assert got == {"a/LICENSE": ("MIT", None, True), "a/x.py": ("MIT", "a", False), "a/b/y.py": ("MIT", None, False), "a/b/COPYING": ("GPL-3.0", None, True),
                   "a/b/c/d/z.py": ("GPL-3.0", "a/b", False), "top.py": (None, None, False), "other/q.py": (None, None, False), None: (None, None, False),
                   "a/b/w.py": ("GPL-3.0", "a/b", False), "ab/v.py": (None, None, False)}


def test_licences_of_header_blocks_and_whole_files(spark):
    import textwrap
    texts = dict(license_scan.full_texts())
    gpl = next(t for licence, t in license_scan.HEADERS if licence == "GPL-3.0")
    wrapped = textwrap.wrap(" ".join(next(t for licence, t in license_scan.TEMPLATES if t.startswith("Permission")).split()), 70)
    code = "import os\n\n\ndef f(x):\n    return os.path.join(x, str(x))\n"
    rows = [(f"{licence}/LICENSE", text) for licence, text in texts.items()]
    rows += [("s/gpl.py", "#!/usr/bin/env python\n#\n" + "\n".join("# " + x for x in textwrap.wrap(" ".join(gpl.split()), 70)) + "\n" + code),
             ("s/mit.c", "/*\n" + "\n".join(" * " + x for x in wrapped) + "\n */\n" + code), ("s/late.py", code + "\n" + "\n".join(wrapped) + "\n\n" + code),
             ("s/none.py", code), ("MIT/x.py", code)] + [(f"other/{i}", brute.prose(i, 50)) for i in range(40)]
    df = spark.createDataFrame(rows, "file string, text string")
    got = {r["file"]: (r["licence"], r["from_dir"], r["is_licence_file"]) for r in license_scan.scan(df, ["file"], "file").collect()}
    want = {f"{licence}/LICENSE": (licence, None, True) for licence in texts}
    want |= {"s/gpl.py": ("GPL-3.0", None, True), "s/mit.c": ("MIT", None, True), "s/late.py": ("MIT", None, True), "MIT/x.py": ("MIT", "MIT", False)}
    assert {k: got[k] for k in want} == want
    assert all(got[f"other/{i}"] == (None, None, False) for i in range(40))


def test_licence_weights_of_common_words(spark):
    rows = [("a/x", "Released under the MIT License. Repo LICENSE file.")] + [
        (f"b/{i}", " ".join(w for w, share in (("repo", 10), ("released", 5), ("mit", 3), ("license", 10), ("file", 20)) if i % 100 < share)
         + f" the under rare{i}") for i in range(1000)]
    found = license_scan.scan(spark.createDataFrame(rows, "file string, text string"), ["file"], "file").where("file = 'a/x'").first()
    assert found["licence"] == "MIT"


def test_licence_query_on_awkward_rows(frame):
    got = license_scan.query(frame(ROWS))
    assert got.count() == len(ROWS) and got.where("licence IS NOT NULL").count() == 0
    assert license_scan.query(frame([])).count() == 0


# ------------------------------------------------------------------ packing

def test_packing(frame):
    pieces = packing.query(frame(ROWS)).collect()
    table = tokens.pieces()
    whole = Counter()
    for i, text in ROWS:
        ids = np.append(np.frombuffer(table.encode(text), "<u2"), 0).astype("<u4")
        whole[i, len(ids)] += 1
    streams, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        streams[p["doc_id"], p["doc_tokens"]].append((p["start"], p["length"], p["ids_crc32"]))
    assert Counter({k: sum(x[1] for x in v) // k[1] for k, v in streams.items()}) == whole
    for i, text in ROWS:
        ids = np.append(np.frombuffer(table.encode(text), "<u2"), 0).astype("<u4")
        assert any(zlib.crc32(ids[s:s + n].tobytes()) == crc for s, n, crc in streams[i, len(ids)])
    padding = 0
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))]
        used = sum(n for _, n in held)
        assert used <= 1024
        padding += 0 if used & (used - 1) == 0 else 1024 - used
    assert padding == 0
    assert packing.query(frame([])).count() == 0


def test_hilbert_steps_to_neighbours():
    for dimensions, bits in ((2, 4), (3, 3), (4, 2)):
        points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions, indexing="ij"), -1).reshape(-1, dimensions)
        key = packing.hilbert(points, bits)
        assert sorted(key) == list(range(len(points)))
        assert (np.abs(np.diff(points[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("total", [0, 1, 7, 1023, 1024, 1025, 5000])
def test_cuts(total):
    size = np.diff(np.append(0, packing.cuts(total)))
    assert size.sum() == total and all(n == 1024 or n & (n - 1) == 0 for n in size)


# --------------------------------------------------------------- pseudonyms

KEY = b"a key for tests"


@pytest.mark.parametrize("text,kinds", [
    ("card 4111 1111 1111 1111, 4111111111111111; no card 4111111111111112", {"card": 2}), ("+1 (017) 555-7713 or +44 20 7946 0958", {"phone": 2}),
    ("a.b-c_9@Mail.example.com", {"email": 1}), ("GB82 WEST 1234 5698 7654 32 not GB82 WEST 1234 5698 7654 33", {"iban": 1}),
    ("1990-02-28 28/02/1990 12/31/1999 31.12.1999 not 1990-02-29 or 31/31/1999", {"date": 4}), ("123-45-6789 not 000-12-3456 666-12-3456", {"ssn": 1}),
    ("10.0.0.1 not 300.1.1.1 or 1.2.3.4.5", {"ip": 1}), ('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"', {"secret": 1}), ("nothing 12 here", {}), ("", {})])
def test_pseudonyms(text, kinds):
    out, counts = pseudonyms.pseudonymise(text, KEY)
    assert {k: n for k, n in counts.items() if n} == kinds
    assert pseudonyms.restore(out, KEY) == text and len(out) >= len(text) - 12
    assert (out != text) == bool(kinds)
    if kinds and text:
        assert pseudonyms.pseudonymise(text, b"other key")[0] != out


def test_equal_values_stay_linked():
    one = pseudonyms.pseudonymise("x 4111 1111 1111 1111 y", KEY)[0]
    two = pseudonyms.pseudonymise("4111111111111111", KEY)[0]
    assert one[2:21].replace(" ", "") == two and int(two[-1]) == pseudonyms.luhn_digit(two[:-1])


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_feistel_is_a_permutation_without_fixed_points(size):
    network = pseudonyms.Feistel(KEY, "t", size)
    image = [network.moved(x) for x in range(size)]
    assert sorted(image) == list(range(size))
    assert size == 1 or all(x != y for x, y in enumerate(image))
    assert [network.moved(y, -1) for y in image] == list(range(size))


@settings(max_examples=100, deadline=None)
@given(st.dates(min_value=__import__("datetime").date(1900, 1, 1), max_value=__import__("datetime").date(2099, 12, 31)), st.sampled_from(["%Y-%m-%d", "%d/%m/%Y", "%d.%m.%Y"]))
def test_dates_stay_dates(day, form):
    text = day.strftime(form)
    out, counts = pseudonyms.pseudonymise(text, KEY)
    assert counts["date"] == 1 and out != text and len(out) == len(text) and pseudonyms.restore(out, KEY) == text


def test_pseudonym_query(frame, same):
    rows = [*ROWS, (900, "mail me: x.y@mail.example.com"), (901, "x.y@mail.example.com")]
    got = pseudonyms.query(frame(rows))
    same(got, ["doc_id", "text", "n_email"], [(i, None if t is None else pseudonyms.pseudonymise(t, pseudonyms.EXAMPLE_KEY)[0], int(i in (900, 901))) for i, t in rows])
    assert pseudonyms.query(frame([])).count() == 0


@pytest.mark.parametrize("text, kind, kept", [
    ("pay BE68 5390 0754 7034 EUR", "iban", " EUR"), ("AT61 1904 3002 3457 3201 2024", "iban", " 2024"), ("BE68 5390 0754 7034 NOW 2024", "iban", " NOW 2024"),
    ("at 2024-01-02T10:00", "date", "T10:00"), ("on 02.01.2024T1000Z", "date", "T1000Z"), ("call +49 30 1234 5678 9012 2024", "phone", " 2024"),
    ("XX12 4111 1111 1111 1111", "card", "")])
def test_values_followed_by_more(text, kind, kept):
    new, counts = pseudonyms.pseudonymise(text, pseudonyms.EXAMPLE_KEY)
    assert {k: n for k, n in counts.items() if n} == {kind: 1}
    assert new.endswith(kept) and len(new) == len(text)
    assert new.removesuffix(kept) != text.removesuffix(kept)
    assert pseudonyms.restore(new, pseudonyms.EXAMPLE_KEY) == text
