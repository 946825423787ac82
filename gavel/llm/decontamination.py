"""Benchmark decontamination by winnowing, with DataFrame functions only.

Words are the runs left by lower-casing A-Z and cutting at ASCII characters
that are no letter or digit.  Both sides are winnowed: of every ``SPAN -
GRAM + 1`` consecutive ``GRAM``-word hashes the smallest is kept, so any shared
span of ``SPAN`` words shares a kept hash.  Joining the fingerprints gives the
candidate documents; their hits are extended to the exact windows, named by two
64-bit hashes over two hashes of each word (128 bits together).  Items of fewer than ``SPAN`` words are one window
of their own length; as winnowing guarantees nothing for these, all document
grams of such a length are their fingerprints.

Items are handled in classes: windows that the same items hold are one class, a
hit document collects the classes of its windows, and only each distinct
collection of classes is expanded to item ids.  So a passage of many items in
many documents makes no (document, item) pairs.

The benchmark's fingerprints and windows are broadcast while they number at most
``BROADCAST_ROWS``; beyond that the joins shuffle both sides by hash.

Defined cases: null or empty text has no words, is never hit, and is no window;
rows that share a doc_id are judged each by their own text; an item_id that
occurs twice counts once; windows of an item with a null id hit words but
count as no item.  Other columns are carried through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.llm.common import Scratch, shielded, text_key

SPAN = 13
GRAM = 6
BROADCAST_ROWS = 500_000
MIN_SHARE = 20  # hit words times this reach the words of a contaminated document

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OTHER = "".join(chr(c) for c in range(1, 128) if not chr(c).isalnum() and c != 0x20)
_FROM = _UPPER + _OTHER + "\x00"
_TO = _UPPER.lower() + " " * (len(_OTHER) + 1)


def words(text: Column) -> Column:
    flat = F.translate(F.coalesce(text, F.lit("")), _FROM, _TO)
    return F.array_remove(F.split(flat, " "), "")


def _slices(array: str, width: int, make) -> Column:
    """``make`` of every run of ``width`` elements."""
    return F.when(F.size(array) >= width, F.transform(
        F.sequence(F.lit(1), F.size(array) - (width - 1)), lambda i: make(F.slice(array, i, width)))
    ).otherwise(F.array())


def _hashed(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` plus dc_hash: the text's word hashes."""
    return texts.select(*keys, F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("dc_hash"))


def _grams(width: int) -> Column:
    return _slices("dc_hash", width, lambda s: F.xxhash64(s, F.lit(width)))


def winnowed(hashed: DataFrame, span: int, gram: int) -> DataFrame:
    """Adds dc_prints: the smallest gram hash of every window of ``span`` words, each once."""
    return hashed.withColumn("dc_grams", _grams(gram)).withColumn(
        "dc_prints", F.array_distinct(_slices("dc_grams", span - gram + 1, F.array_min))).drop("dc_grams")


def windows(texts: DataFrame, keys: list[str], width: Column, places: bool = False) -> DataFrame:
    """``keys``, dc_width, dc_one and dc_two (together the name) of every window of ``width`` words, and its place from 0 if asked for."""
    hashed = (texts.select(*keys, words(F.col("text")).alias("dc_words")).withColumn("dc_width", width).where(F.size("dc_words") >= F.col("dc_width"))
              .select(*keys, "dc_width", F.transform("dc_words", lambda w: F.xxhash64(w)).alias("dc_hash"),
                      F.transform("dc_words", lambda w: F.xxhash64(F.lit(1), w)).alias("dc_other")))
    names = F.transform(F.sequence(F.lit(1), F.size("dc_hash") - F.col("dc_width") + 1), lambda i: F.struct(
        F.xxhash64(F.slice("dc_hash", i, F.col("dc_width"))).alias("dc_one"), F.xxhash64(F.slice("dc_other", i, F.col("dc_width"))).alias("dc_two")))
    exploded = F.posexplode(names).alias("dc_at", "dc_name") if places else F.explode(names).alias("dc_name")
    return hashed.select(*keys, "dc_width", exploded).select(*keys, "dc_width", *(["dc_at"] if places else []), "dc_name.*")


def item_classes(benchmark: DataFrame, span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """The distinct windows with their dc_class, and each class's items (dc_class, dc_item)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("dc_item"), "text")
    n = F.size("dc_words")
    held = windows(items, ["dc_item"], F.when(n > 0, F.least(n, F.lit(span)))).distinct()
    name = ["dc_width", "dc_one", "dc_two"]
    classed = held.groupBy(*name).agg(F.count("dc_item").alias("n"), F.bit_xor(F.xxhash64("dc_item")).alias("one"),
                                      F.bit_xor(F.xxhash64(F.lit(1), "dc_item")).alias("two")).select(*name, F.struct("n", "one", "two").alias("dc_class"))
    some = classed.groupBy("dc_class").agg(F.min(F.struct(*name)).alias("window")).select("dc_class", "window.*")
    members = some.join(held, name).where("dc_item IS NOT NULL").select("dc_class", "dc_item").distinct()
    return classed, members


def _fingerprints(texts: DataFrame, keys: list[str], span: int, gram: int, short: list[int], own_width: bool) -> DataFrame:
    """``keys``, dc_print: winnowed prints, and all grams of the lengths in ``short``.

    own_width: texts are items, where a short gram counts only if it is the whole item.
    """
    prints = winnowed(_hashed(texts, keys), span, gram)
    lists = ["dc_prints"]
    for width in short:
        grams = F.array_distinct(_grams(width))
        if own_width:
            grams = F.when(F.size("dc_hash") == width, grams)
        prints = prints.withColumn(f"dc_short{width}", F.coalesce(grams, F.array()))
        lists.append(f"dc_short{width}")
    return prints.select(*keys, F.explode(F.concat(*lists)).alias("dc_print"))


def _bounded(side: DataFrame) -> DataFrame:
    """Broadcast if it has at most ``BROADCAST_ROWS`` rows (three numbers each)."""
    return F.broadcast(side) if side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else side


def candidates(docs: DataFrame, benchmark: DataFrame, keys: list[str], short: list[int],
               span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Distinct ``keys`` of the documents that share a fingerprint with an item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("dc_item"), "text")
    theirs = _fingerprints(items, ["dc_item"], span, gram, short, True).select("dc_print").distinct()
    return _fingerprints(docs, keys, span, gram, short, False).join(_bounded(theirs), "dc_print", "left_semi").select(*keys).distinct()


def hits(docs: DataFrame, benchmark: DataFrame, keys: list[str], span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Per hit document: ``keys``, n_hit, dc_items (sorted ids) and dc_spans (start, end of merged hit words)."""
    scratch = Scratch(docs.sparkSession, "decontamination")
    classed, members = item_classes(benchmark, span)
    classed = scratch.keep(classed, "windows")
    widths = sorted(r[0] for r in classed.select("dc_width").distinct().collect())  # at most ``span`` numbers
    which = candidates(docs, benchmark, keys, [w for w in widths if w < span], span, gram).alias("p")
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"d.{k}")) for k in keys]
    texts = docs.alias("d").join(which, same, "left_semi").select(*keys, "text").dropDuplicates(keys)
    widths = F.explode(F.array(*map(F.lit, widths))) if widths else F.explode(F.array().cast("array<int>"))
    found = windows(texts.withColumn("dc_wide", widths), [*keys, "dc_wide"], F.col("dc_wide"), places=True).drop("dc_wide")
    exact = found.join(_bounded(classed), ["dc_width", "dc_one", "dc_two"])
    merged = F.aggregate(
        F.array_sort("dc_all"), F.struct(F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans")),
        lambda s, x: F.struct(_merge(s["spans"], x).alias("spans")), lambda s: s["spans"])
    out = exact.groupBy(*keys).agg(
        F.collect_set(F.struct(F.col("dc_at").alias("start"), (F.col("dc_at") + F.col("dc_width")).alias("end"))).alias("dc_all"),
        F.array_sort(F.collect_set("dc_class")).alias("dc_classes"))
    out = scratch.keep(out.select(*keys, merged.alias("dc_spans"), "dc_classes"), "hits")

    # each distinct collection of classes is expanded once
    collection = F.md5(F.to_json("dc_classes"))
    expanded = (out.groupBy(collection.alias("dc_collection")).agg(F.first("dc_classes").alias("dc_classes"))
                .select("dc_collection", F.explode("dc_classes").alias("dc_class")).join(members, "dc_class")
                .groupBy("dc_collection").agg(F.array_sort(F.collect_set("dc_item")).alias("dc_items")))
    out = out.withColumn("dc_collection", collection).join(expanded, "dc_collection", "left")
    items = F.coalesce("dc_items", F.array().cast("array<string>"))
    return out.select(*keys, "dc_spans", items.alias("dc_items"),
                      F.aggregate("dc_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"]).alias("n_hit"))


def _merge(spans: Column, x: Column) -> Column:
    last = F.element_at(spans, -1)
    joined = F.concat(F.slice(spans, F.lit(1), F.size(spans) - 1),
                      F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))))
    return F.when((F.size(spans) > 0) & (F.element_at(F.concat(spans, F.array(x)), F.greatest(F.size(spans), F.lit(1)))["end"] >= x["start"]),
                  joined).otherwise(F.concat(spans, F.array(x)))


def judged(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns of ``docs`` plus dc_n_words, dc_n_hit, dc_items, dc_spans and dc_contaminated."""
    docs, names = shielded(docs, "doc_id", "text")
    keyed = docs.withColumns({"dc_id": F.col("doc_id"), "dc_text": text_key()})
    keys = ["dc_id", "dc_text"]
    hit = hits(keyed.select(*keys, "text"), benchmark, keys).withColumnsRenamed({"dc_id": "dc_id2", "dc_text": "dc_text2"})
    counted = keyed.withColumn("dc_n_words", F.size(words(F.col("text"))).cast("long"))
    joined = counted.join(hit, F.col("dc_id").eqNullSafe(F.col("dc_id2")) & (F.col("dc_text") == F.col("dc_text2")), "left")
    joined = joined.withColumn("dc_n_hit", F.coalesce("n_hit", F.lit(0).cast("long")))
    joined = joined.withColumn("dc_contaminated", (F.col("dc_n_hit") > 0) & (F.col("dc_n_hit") * MIN_SHARE >= F.col("dc_n_words")))
    return joined.drop("dc_id", "dc_text", "dc_id2", "dc_text2", "n_hit").withColumnsRenamed(names)


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return judged(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", F.col("dc_n_words").alias("n_words"), F.col("dc_n_hit").alias("n_hit"),
        F.coalesce(F.size("dc_items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("dc_items", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("dc_contaminated").alias("contaminated"))


def stage(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated."""
    bad = judged(docs.select("doc_id", "text"), benchmark).where("dc_contaminated")
    bad = bad.select("doc_id", text_key().alias("dc_text")).distinct().alias("bad")
    same = F.col("doc.doc_id").eqNullSafe(F.col("bad.doc_id")) & (text_key("doc.text") == F.col("bad.dc_text"))
    return docs.alias("doc").join(bad, same, "left_anti")


SQL = r"""
WITH low AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT item_id, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i, w
  FROM items WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS k FROM iw),
ms AS (SELECT DISTINCT m FROM win),
dw AS (SELECT doc_id, m, unnest(range(1, len(w) - m + 2)) AS i, w FROM low, ms WHERE len(w) >= m),
hit AS (
  SELECT dw.doc_id, dw.i, dw.m, win.item_id
  FROM dw JOIN win ON win.m = dw.m AND win.k = array_to_string(dw.w[dw.i:dw.i + dw.m - 1], ' ')),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT low.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM low LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
