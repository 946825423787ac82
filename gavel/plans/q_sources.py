"""Plans of sources, sinks and hooks (A1, A2, A5, A6, B1, E12, N1, N3, N4): what is written is read back from the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gavel.operators import assembly as A
from gavel.operators import extraction as X
from gavel.operators import hooks as H
from gavel.operators import metrics as M
from gavel.operators import tables as TB
from gavel.operators.resume import ResultStore
from gavel.plans import fixtures as V
from gavel.plans.registry import register
from gavel.sources import readers as R
from gavel.sources import sinks as W
from gavel.sources.scratch import Scratch


# ------------------------------------------------------------------ A1
@register("open_table", """
SELECT doc_id, text, '"' || lang || '"' AS lang, '{"chars":' || n_chars || ',"tags":["' || source || '",null,true]}' AS meta, 2 AS n_other FROM documents""")
def q_open_table(spark, sf):
    d = V.table(spark, sf, "documents")
    meta = F.parse_json(F.concat(F.lit('{"chars":'), F.col("n_chars").cast("string"), F.lit(',"tags":["'), F.col("source"), F.lit('",null,true]}')))
    path = f"{Scratch(spark, 'open').root}/table.jsonl"
    W.write_results(d.select("doc_id", "text", "lang", meta.alias("meta")), path, "json")
    t = R.read_open_table(spark, path, StructType.fromDDL("doc_id long, text string"))
    return t.select("doc_id", "text", F.col("other")["lang"].alias("lang"), F.col("other")["meta"].alias("meta"), F.size("other").alias("n_other"))


# ------------------------------------------------------------------ A2 / A5
@register("cached_join", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, p_brand, label FROM lineitem JOIN part ON l_partkey = p_partkey
JOIN (VALUES ('R', 'rejected'), ('A', 'accepted'), ('N', 'new')) AS f(flag, label) ON l_returnflag = flag""")
def q_cached_join(spark, sf):
    part = R.cache_tables(V.table(spark, sf, "part"), ["p_partkey", "p_brand"]).withColumnRenamed("p_partkey", "l_partkey")
    flags = R.inline_rows(spark, [{"l_returnflag": "R", "label": "rejected", "x": 1}, {"l_returnflag": "A", "label": "accepted", "x": 2},
                                  {"l_returnflag": "N", "label": "new", "x": 3}], ["l_returnflag", "label"])
    li = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag")
    return TB.attach_problem(li, part, ["l_partkey"]).join(flags, "l_returnflag").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "p_brand", "label")


# ------------------------------------------------------------------ A6
@register("written_results", """
SELECT form, doc_id, text, doc_id % 3 = 0 AS accepted, lang FROM documents, (SELECT unnest(['json', 'parquet']) AS form)""")
def q_written_results(spark, sf):
    rows = V.table(spark, sf, "documents").select("doc_id", "text", (F.col("doc_id") % 3 == 0).alias("accepted"), "lang")
    root, out = Scratch(spark, "results").root, None
    for form in ("json", "parquet"):
        W.write_results(rows, f"{root}/{form}", form, partition_by=["lang"])
        back = spark.read.schema(rows.schema).format(form).load(f"{root}/{form}").select(F.lit(form).alias("form"), *rows.columns)
        out = back if out is None else out.unionByName(back)
    return out


# ------------------------------------------------------------------ B1
@register("deep_page", "SELECT l_orderkey, l_partkey FROM (SELECT l_orderkey, l_partkey FROM lineitem ORDER BY 1, 2 LIMIT 500 OFFSET 5000)")
def q_deep_page(spark, sf):
    li = V.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.struct("l_orderkey", "l_partkey").alias("id"))
    return TB.Pages(li, "id").page(5000, 500, ["l_orderkey", "l_partkey", "id"]).drop("id")


# ------------------------------------------------------------------ E12
@register("contest_cases", """
SELECT doc_id, string_split(text, '. ') || ['end'] AS inputs, list_transform(string_split(text, '. '), lambda s: lower(s)) || ['END'] AS outputs,
       list_transform(string_split(text, ' '), lambda w: len(w) || ',[' || len(w) || '.5,"w"]') AS parsed
FROM documents""")
def q_contest_cases(spark, sf):
    case = lambda i, o: F.struct(i.alias("input"), o.alias("output"))
    public = F.transform(F.split("text", r"\. ", -1), lambda s: case(s, F.lower(s)))
    private = F.array(case(F.lit("end"), F.lit("END")))
    n = lambda w: F.length(w).cast("string")
    calls = F.transform(F.split("text", " "), lambda w: case(F.concat(n(w), F.lit("\n["), n(w), F.lit('.5, "w"]')), n(w)))
    stdin, parsed = A.contest_cases(public, private, False), A.contest_cases(calls, F.lit(None).cast("array<struct<input:string,output:string>>"), True)
    return V.table(spark, sf, "documents").select(
        "doc_id", stdin["input"].alias("inputs"), stdin["output"].alias("outputs"),
        F.transform(parsed["input"], lambda lines: F.array_join(F.transform(lines, lambda v: F.to_json(v)), ",")).alias("parsed"))


# ------------------------------------------------------------------ N1 / N3 / N4
def _shouted(text: str) -> list[tuple[int, str, str]]:
    """A caller's blocks: the text between the first and the last line, as a block of the highest priority."""
    lines = text.split("\n")
    return [(99, "python", "\n".join(lines[1:-1]))] if len(lines) > 2 else []


@register("hooked_blocks", """
SELECT doc_id, 'python' AS language, text AS code FROM documents""")
def q_hooked_blocks(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", F.concat(F.lit("head\n"), "text", F.lit("\ntail")).alias("completion"))
    picked = X.pick(d, "completion", "python", out="w", custom=H.blocks_hook(_shouted)(F.col("completion")))
    return picked.select("doc_id", F.coalesce("w.language", F.lit("")).alias("language"), F.coalesce("w.code", F.lit("")).alias("code"))


@register("hooked_metrics", """
SELECT p_brand AS brand, avg((l_returnflag <> 'R')::INTEGER) AS share, count(*) AS n, CASE WHEN p_brand LIKE '%1' THEN 'ones' ELSE 'others' END AS dataset
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def q_hooked_metrics(spark, sf):
    @H.register_metric("share_by_brand")
    def share(results):
        return results.groupBy(F.col("category").alias("brand")).agg(F.avg(F.col("accepted").cast("int")).alias("share"), F.count("*").alias("n"))

    if "ones" not in H.list_datasets():
        H.register_dataset(H.DatasetProfile("ones", judge=lambda df: df.withColumn("dataset", F.lit("ones")), match=lambda b: b.endswith("1")))
        H.register_dataset(H.DatasetProfile("others", judge=lambda df: df.withColumn("dataset", F.lit("others")), match=lambda b: True))
    out = H.METRICS["share_by_brand"](V.verdicts(spark, sf))
    ones = F.col("brand").endswith("1")
    return H.dataset_for("Brand#11").judge(out.where(ones)).unionByName(H.dataset_for("Brand#12").judge(out.where(~ones)))


# ------------------------------------------------------------------ C4 / C5
@register("resumed_samples", """
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN [text || ' again'] WHEN 1 THEN [text || ' first'] WHEN 2 THEN [text || ' last', lang] ELSE CAST([] AS VARCHAR[]) END AS sample
FROM documents""")
def q_resumed_samples(spark, sf):
    """A sampler's batches: a first one, its replay with other samples, a revision, empty samples, and what was pending after these."""
    d = V.table(spark, sf, "documents").select("doc_id", "text", "lang")
    part = F.col("doc_id") % 4
    text = lambda tail: F.array(F.concat("text", F.lit(tail))).alias("sample")
    folder = Scratch(spark, "samples").root
    store = ResultStore(spark, folder, "doc_id")
    store.commit("b1", d.where(part < 2).select("doc_id", text(" first")))
    store.commit("b1", d.select("doc_id", text(" replayed")))
    store.commit("b2", d.where(part == 0).select("doc_id", text(" again")))
    store.commit("b3", d.select("doc_id", F.array().cast("array<string>").alias("sample")))
    resumed = ResultStore(spark, folder, "doc_id")
    todo = resumed.pending(d).where(part == 2)
    resumed.commit("b4", todo.select("doc_id", F.array(F.concat("text", F.lit(" last")), "lang").alias("sample")))
    return resumed.results(d)


# ------------------------------------------------------------------ H9
@register("counted_write", """
SELECT 'before' AS stage, count(*) AS n FROM documents UNION ALL SELECT 'after', count(*) FILTER (WHERE length(text) > 500) FROM documents""")
def q_counted_write(spark, sf):
    path = f"{Scratch(spark, 'counted').root}/kept"
    return M.write_counted(V.table(spark, sf, "documents"), F.length("text") > 500, lambda kept: W.write_results(kept, path, "parquet"))
