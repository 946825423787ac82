"""Filter interaction audit: what each of five filters removes, in every order in which they can be applied.

A document's failures are five bits, computed on its row: A too few words, B too
few distinct words, C too many capitals, D symbols, E a copy of a smaller
doc_id's text.  Documents that agree in part, bits and labels are one mask cell,
so the audit works on at most 288 cells a part (32 masks, three label values
each for quality and toxic), however many documents there are.  Each cell folds
across the constant array of the 120 orders with ``transform`` and ``aggregate``
into 600 structs (order, step) weighted by its count, and the cells' structs are
summed element by element.

E needs the least doc_id of each text.  It is joined back on (text hash, doc_id),
where it matches that one row: a group of copies is never dealt by its hash alone.

Defined cases: a null text is empty, and an empty text fails A (and E where a
smaller doc_id has one); a null lang is the part ""; a row without doc_id has no
smaller doc_id and no labels; rows that share a doc_id are audited each by
itself, and are no copies of one another; of several labels of a document any 1
counts; a null label is not 1; an empty table has no parts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT = 50  # per cent of the words
MAX_CAPITALS = 3  # per cent of the code points
SYMBOLS = "[#$%&*|]"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]

_BLANKS = "\t\n\x0b\x0c\r"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, _BLANKS, " " * len(_BLANKS)), " "), lambda w: w != "")


def row_failures(text: Column) -> Column:
    """The bits of the filters that look at one text (A to D); its words are in ``fa_words``."""
    n, distinct = F.size("fa_words"), F.size(F.array_distinct("fa_words"))
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    fails = {"A": n < MIN_WORDS, "B": 100 * distinct < MIN_DISTINCT * n, "C": 100 * capitals > MAX_CAPITALS * F.length(text),
             "D": text.rlike(SYMBOLS)}
    bits = [F.when(fail, _bit(letter)).otherwise(0) for letter, fail in fails.items()]
    return sum(bits[1:], bits[0])


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bits of all five filters), good and toxic of every document."""
    bits = row_failures(F.col("fa_text"))
    rows = (docs.select(F.col("doc_id").alias("fa_id"), F.coalesce("lang", F.lit("")).alias("part"),
                        F.coalesce("text", F.lit("")).alias("fa_text"))
            .withColumn("fa_words", words(F.col("fa_text")))
            .select("fa_id", "part", bits.alias("fa_bits"), F.unhex(F.md5("fa_text")).alias("fa_hash")))
    known, nameless = rows.where("fa_id IS NOT NULL"), rows.where("fa_id IS NULL")
    first = (known.groupBy("fa_hash").agg(F.min("fa_id").alias("fa_id"))
             .withColumn("fa_first", F.lit(True)))
    marks = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("fa_id"))
             .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")))
    copy = F.when(F.col("fa_first"), 0).otherwise(_bit("E"))
    known = (known.join(first, ["fa_hash", "fa_id"], "left").join(marks, "fa_id", "left")
             .select("part", (F.col("fa_bits") + copy).alias("mask"), "good", "toxic"))
    none = F.lit(None).cast("boolean")
    return known.unionByName(nameless.select("part", F.col("fa_bits").alias("mask"), none.alias("good"), none.alias("toxic")))


def fold() -> Column:
    """A cell's 600 structs: its count n wherever the (order, step) applies to its mask, else 0."""
    orders = " ".join(map("".join, permutations(FILTERS)))
    bit = f"shiftleft(1, locate(substr(o, i, 1), '{FILTERS}') - 1)"
    removed = f"(mask & {bit}) != 0 AND (mask & acc.seen) = 0"
    weights = {"kept": f"(mask & (acc.seen | {bit})) = 0", "removed": removed, "redundant": f"(mask & {bit}) != 0 AND (mask & acc.seen) != 0",
               "unique_fails": f"mask = {bit}", "good_lost": f"good AND {removed}", "toxic_lost": f"toxic AND {removed}"}
    struct = "named_struct('filter_order', o, 'step', i, " + ", ".join(f"'{c}', if({weights[c]}, n, 0L)" for c in COUNTS) + ")"
    kind = "array<struct<filter_order: string, step: int, " + ", ".join(f"{c}: bigint" for c in COUNTS) + ">>"
    return F.expr(f"""
        flatten(transform(split('{orders}', ' '), o -> aggregate(sequence(1, {len(FILTERS)}),
            named_struct('seen', 0, 'steps', cast(array() AS {kind})),
            (acc, i) -> named_struct('seen', acc.seen | {bit}, 'steps', array_append(acc.steps, {struct})),
            acc -> acc.steps)))""")


def audit(masks: DataFrame) -> DataFrame:
    """Per part, order and step the counts and the Shapley sum; ``masks`` as from ``failures``."""
    cells = masks.groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    steps = cells.select("part", F.inline(fold()))
    sums = steps.groupBy("part", "filter_order", "step").agg(*(F.sum(c).alias(c) for c in COUNTS))
    one_filter = Window.partitionBy("part", F.expr("substr(filter_order, step, 1)"))  # the 600 rows of a part
    return sums.withColumn("shapley", F.sum("removed").over(one_filter))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(failures(docs, labels)).select("part", "filter_order", "step", *COUNTS, "shapley")


SQL = rf"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM docs),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
masks AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {{
    'A': len(w) < {MIN_WORDS}, 'B': 100 * len(list_distinct(w)) < {MIN_DISTINCT} * len(w),
    'C': 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {MAX_CAPITALS} * length(t),
    'D': regexp_matches(t, '{SYMBOLS}'), 'E': coalesce(doc_id > least, false)}} AS fails
  FROM words LEFT JOIN marks USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5),
cells AS (
  SELECT part, good, toxic, concat(CASE WHEN fails['A'] THEN 'A' END, CASE WHEN fails['B'] THEN 'B' END, CASE WHEN fails['C'] THEN 'C' END,
                                   CASE WHEN fails['D'] THEN 'D' END, CASE WHEN fails['E'] THEN 'E' END) AS bad, count(*) AS n
  FROM masks GROUP BY ALL),
steps AS (
  SELECT part, filter_order, step::INTEGER AS step, good, toxic, n, bad, filter_order[step] AS letter,
         contains(bad, filter_order[step]) AS hit,
         translate(bad, filter_order[1:step - 1], '') != bad AS gone
  FROM cells, orders, range(1, 6) AS s(step)),
sums AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (WHERE NOT gone AND NOT hit), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (WHERE hit AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (WHERE hit AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (WHERE bad = letter), 0)::BIGINT AS unique_fails,
         coalesce(sum(n) FILTER (WHERE hit AND NOT gone AND good), 0)::BIGINT AS good_lost,
         coalesce(sum(n) FILTER (WHERE hit AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
  FROM steps GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM sums
"""
