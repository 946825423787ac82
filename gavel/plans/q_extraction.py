"""Phase 2 plans: code-block extraction over completions built from ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.functions.lang import alias_sql_case
from gavel.operators import extraction as X
from gavel.plans import fixtures as V
from gavel.plans import sql_views as S
from gavel.plans.registry import register, with_ctes

WSC = S.WS  # chr()-built blank set for trim() in DuckDB


def _t(x: str) -> str:
    return S.py_strip_sql(x)


def _lang(tag: str) -> str:
    return alias_sql_case(_t(tag))


# the block rules spelled for RE2
_B = X.WS
_FENCED = r"(?s)```([^\n]*)\n(.*?)\n" + _B + "*```"
_OPEN = r"(?s)```([^\n]*)\n(.*)"
_BARE_PY = r"(?m)(?:^(?:import|from|#)[^\n]+\n)*^(?:def|class) [^\n]+\n(?:" + _B + r"+[^\n]+\n)+"

_BLOCK_LISTS = f"""
b AS (
  SELECT doc_id, completion,
    regexp_extract_all(completion, '{_FENCED}', 1) AS ft,
    regexp_extract_all(completion, '{_FENCED}', 2) AS fb,
    regexp_extract_all(array_to_string(list_filter(string_split(completion, chr(10)),
        lambda l: {_t('l')} <> ''), chr(10)) || chr(10), '{_BARE_PY}', 0) AS hb,
    regexp_extract_all(completion, '{_OPEN}', 1) AS ot,
    regexp_extract_all(completion, '{_OPEN}', 2) AS ob
  FROM completions)"""

_BLOCK_ROWS = f"""
blocks AS (
  SELECT doc_id, 30 AS priority, 0 AS src, i AS pos, {_lang('ft[i]')} AS language, fb[i] AS code
  FROM (SELECT doc_id, ft, fb, unnest(range(1, len(ft) + 1)) AS i FROM b)
  UNION ALL
  SELECT doc_id, 10, 1, i, 'python', hb[i] FROM (SELECT doc_id, hb, unnest(range(1, len(hb) + 1)) AS i FROM b)
  UNION ALL
  SELECT doc_id, 20, 2, i, {_lang('ot[i]')}, ob[i]
  FROM (SELECT doc_id, ot, ob, unnest(range(1, len(ot) + 1)) AS i FROM b)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY priority DESC, (language = 'python') DESC, src, pos) AS rn
  FROM blocks)"""


# ------------------------------------------------------------------ D1 / D2
@register("fenced_blocks", with_ctes(S.completions_sql(), _BLOCK_LISTS) + f"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS block_idx, 30 AS priority, {_lang('ft[i]')} AS language, fb[i] AS code
FROM (SELECT doc_id, ft, fb, unnest(range(1, len(ft) + 1)) AS i FROM b)""")
def q_fenced_blocks(spark, sf):
    c = V.completions(spark, sf).select("doc_id", X.fenced_blocks(F.col("completion")).alias("blocks"))
    return X.explode_blocks(c, "blocks", ["doc_id"])


@register("open_blocks", with_ctes(S.completions_sql(), _BLOCK_LISTS) + f"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS block_idx, 20 AS priority, {_lang('ot[i]')} AS language, ob[i] AS code
FROM (SELECT doc_id, ot, ob, unnest(range(1, len(ot) + 1)) AS i FROM b)""")
def q_open_blocks(spark, sf):
    c = V.completions(spark, sf).select("doc_id", X.open_blocks(F.col("completion")).alias("blocks"))
    return X.explode_blocks(c, "blocks", ["doc_id"])


# ------------------------------------------------------------------ D4 (+ D3 python)
@register("pick_code", with_ctes(S.completions_sql(), _BLOCK_LISTS, _BLOCK_ROWS) + """
SELECT c.doc_id, r.priority, r.language, coalesce(r.code, '') AS code
FROM completions c LEFT JOIN ranked r ON c.doc_id = r.doc_id AND r.rn = 1""")
def q_pick_code(spark, sf):
    c = X.pick(V.completions(spark, sf), "completion", "python", out="win")
    return c.select("doc_id", F.col("win.priority").alias("priority"), F.col("win.language").alias("language"),
                    F.coalesce(F.col("win.code"), F.lit("")).alias("code"))


# ------------------------------------------------------------------ D25 (+ D6 type)
@register("extraction_census", with_ctes(S.completions_sql(), _BLOCK_LISTS, _BLOCK_ROWS) + """
SELECT CASE WHEN len(ft) > 0 THEN 'fenced' WHEN len(ot) > 0 THEN 'incomplete_fenced'
            WHEN len(hb) > 0 THEN 'heuristic' ELSE 'empty' END AS extracted_type,
       r.language, count(*) AS n
FROM b LEFT JOIN ranked r ON b.doc_id = r.doc_id AND r.rn = 1
GROUP BY 1, 2""")
def q_extraction_census(spark, sf):
    won = X.pick(V.completions(spark, sf), "completion", "python", out="win")
    kind = (F.when(F.col("win.priority") == X.PRIO_FENCED, "fenced")
            .when(F.col("win.priority") == X.PRIO_OPEN, "incomplete_fenced")
            .when(F.col("win.priority") == X.PRIO_HEURISTIC, "heuristic").otherwise("empty"))
    typed = won.select(kind.alias("extracted_type"), F.col("win.language").alias("language"))
    return X.extraction_census(typed)


# ------------------------------------------------------------------ D11 / D12
_STRIPPED = f"""
s AS (SELECT doc_id, CASE WHEN contains(completion, '</think>')
                         THEN ltrim(string_split(completion, '</think>')[-1], {WSC}) ELSE completion END AS t
      FROM completions)"""


@register("strip_reasoning", with_ctes(S.completions_sql(), _STRIPPED) + "SELECT doc_id, t AS text FROM s")
def q_strip_reasoning(spark, sf):
    c = V.completions(spark, sf)
    return c.select("doc_id", X.strip_reasoning(F.col("completion")).alias("text"))


@register("last_def_block", with_ctes(S.completions_sql(), _STRIPPED, """
x AS (SELECT doc_id, t, lines,
             list_filter(list_transform(lines, lambda ln, i: CASE WHEN contains(ln, '```') THEN i END),
                         lambda y: y IS NOT NULL) AS idx
      FROM (SELECT doc_id, t, string_split(t, chr(10)) AS lines FROM s))""", """
y AS (SELECT *, len(idx) AS n,
        coalesce(list_filter(range(greatest(len(idx), 2), 1, -2),
          lambda j: contains(array_to_string(lines[idx[j - 1]:idx[j]], chr(10)), 'def'))[1], len(idx)) AS j
      FROM x)""") + """
SELECT doc_id,
  CASE WHEN n >= 2 THEN array_to_string(lines[idx[j - 1]:idx[j]], chr(10))
       WHEN NOT contains(t, '```') AND contains(t, 'def') THEN '```python' || chr(10) || t || chr(10) || '```' || chr(10)
  END AS code
FROM y""")
def q_last_def_block(spark, sf):
    c = V.completions(spark, sf).select("doc_id", X.strip_reasoning(F.col("completion")).alias("t"))
    return X.last_def_block_df(c, "t").select("doc_id", "code")


# ------------------------------------------------------------------ D13
STOP_TOKENS = [" th", "\n\n", "re: [0-9]{2,}", " er", ". "]


def _stop_sql() -> str:
    steps = ["s0 AS (SELECT doc_id, text AS s FROM documents)"]
    k = 0
    for tok in STOP_TOKENS:
        if tok == "\n\n":
            continue
        prev, k = f"s{k}", k + 1
        if tok.startswith("re:"):
            pat = tok[3:].strip()
            expr = (f"CASE WHEN regexp_matches(s, '{pat}') THEN left(s, strpos(s, regexp_extract(s, '{pat}', 0)) - 1)"
                    f" ELSE s END")
        else:
            lit = "'" + tok.replace("'", "''") + "'"
            expr = f"CASE WHEN strpos(s, {lit}) > 0 THEN left(s, strpos(s, {lit}) - 1) ELSE s END"
        steps.append(f"s{k} AS (SELECT doc_id, {expr} AS s FROM {prev})")
    return with_ctes(*steps) + f"SELECT doc_id, s AS text FROM s{k}"


@register("stop_trim", _stop_sql())
def q_stop_trim(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    toks = F.array(*[F.lit(t) for t in STOP_TOKENS])
    return d.select("doc_id", X.stop_trim(F.col("text"), toks).alias("text"))


# ------------------------------------------------------------------ D14 / D15 / D8
_CODE_TAILS = """
code AS (SELECT doc_id, text ||
    CASE doc_id % 3 WHEN 0 THEN chr(10) || '}' || chr(10) || 'tail' WHEN 1 THEN chr(10) || 'end tail' ELSE '' END ||
    CASE WHEN doc_id % 2 = 0 THEN 'void main() {}' || chr(10) || 'public static void Main() {}' ELSE '' END AS c
  FROM documents)"""


def _code_tails(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    i = F.col("doc_id")
    tail = (F.when(i % 3 == 0, F.lit("\n}\ntail")).when(i % 3 == 1, F.lit("\nend tail")).otherwise(F.lit("")))
    mains = F.when(i % 2 == 0, F.lit("void main() {}\npublic static void Main() {}")).otherwise(F.lit(""))
    return d.select("doc_id", F.concat(F.col("text"), tail, mains).alias("c"))


@register("end_tokens", with_ctes(_CODE_TAILS) + """
SELECT doc_id,
  CASE WHEN strpos(c, chr(10) || '}') > 0 THEN left(c, strpos(c, chr(10) || '}') - 1) || chr(10) || '}' ELSE c END
    AS cpp,
  CASE WHEN strpos(c, chr(10) || 'end') > 0 THEN left(c, strpos(c, chr(10) || 'end') - 1) || chr(10) || 'end' ELSE c END
    AS lua,
  CASE WHEN strpos(c, 'void main') > 0 THEN left(c, strpos(c, 'void main') - 1) ELSE c END AS d_main,
  CASE WHEN strpos(c, 'public static void Main') > 0 THEN left(c, strpos(c, 'public static void Main') - 1)
       ELSE c END AS csharp_main
FROM code""")
def q_end_tokens(spark, sf):
    c = _code_tails(spark, sf)
    return c.select("doc_id", X.keep_to_end_token(F.col("c"), "cpp").alias("cpp"),
                    X.keep_to_end_token(F.col("c"), "lua").alias("lua"),
                    X.cut_main(F.col("c"), "d").alias("d_main"),
                    X.cut_main(F.col("c"), "csharp").alias("csharp_main"))


_ENTRY = """
code AS (SELECT doc_id, CASE doc_id % 4
    WHEN 0 THEN text || chr(10) || 'if __name__ == "__main__":' || chr(10) || '    main()'
    WHEN 1 THEN text || chr(10) || 'int main() {' || chr(10) || '}'
    WHEN 2 THEN 'package main' || chr(10) || text
    ELSE text || chr(10) || '# Example usage' || chr(10) || 'f()' END AS c
  FROM documents)"""


def _cut_sql(x: str, marker: str) -> str:
    m = "'" + marker.replace("'", "''") + "'"
    return f"(CASE WHEN strpos({x}, {m}) > 0 THEN {_t(f'left({x}, strpos({x}, {m}) - 1)')} ELSE {x} END)"


@register("strip_entrypoint", with_ctes(_ENTRY) + f"""
SELECT doc_id,
  {_cut_sql(_cut_sql('c', X.MAIN_GUARD), '# Example usage')} AS py,
  {_cut_sql(_cut_sql('c', 'int main()'), '# Example usage')} AS cpp,
  {_cut_sql("replace(c, 'package main', '')", '# Example usage')} AS go
FROM code""")
def q_strip_entrypoint(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    i, t = F.col("doc_id"), F.col("text")
    c = (F.when(i % 4 == 0, F.concat(t, F.lit('\nif __name__ == "__main__":\n    main()')))
         .when(i % 4 == 1, F.concat(t, F.lit("\nint main() {\n}")))
         .when(i % 4 == 2, F.concat(F.lit("package main\n"), t))
         .otherwise(F.concat(t, F.lit("\n# Example usage\nf()"))))
    d = d.select("doc_id", c.alias("c"))
    return d.select("doc_id", X.strip_entrypoint(F.col("c"), "python").alias("py"),
                    X.strip_entrypoint(F.col("c"), "cpp").alias("cpp"),
                    X.strip_entrypoint(F.col("c"), "go").alias("go"))


# ------------------------------------------------------------------ D17
_ANSWERS = """
ans AS (SELECT doc_id, CASE doc_id % 4
    WHEN 0 THEN '[ANSWER]' || chr(10) || 'assert f(' || text || ') == ' || reverse(text)
                || chr(10) || '[/ANSWER] trailing'
    WHEN 1 THEN text || ' == ' || reverse(text) || '# done extra == x'
    WHEN 2 THEN 'no tags ' || text
    ELSE '[ANSWER]' || text || '[ANSWER]' || text END AS c
  FROM documents)"""


def _answer_sql(mode: str) -> str:
    c = "split_part(split_part(c, '# done', 1), '[/ANSWER]', 1)"
    c = f"(CASE WHEN contains({c}, '[ANSWER]') THEN {_t(f'split_part({c}, {chr(39)}[ANSWER]{chr(39)}, 2)')} ELSE {c} END)"
    c = (f"(CASE WHEN contains({c}, 'assert f') THEN 'f' || {_t(f'split_part({c}, {chr(39)}assert f{chr(39)}, 2)')}"
         f" ELSE {c} END)")
    side = 1 if mode == "input" else 2
    return f"(CASE WHEN contains({c}, '==') THEN {_t(f'split_part({c}, {chr(39)}=={chr(39)}, {side})')} ELSE {c} END)"


@register("answer_of", with_ctes(_ANSWERS) +
          f"SELECT doc_id, {_answer_sql('input')} AS answer_input, {_answer_sql('output')} AS answer_output FROM ans")
def q_answer_of(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    i, t = F.col("doc_id"), F.col("text")
    c = (F.when(i % 4 == 0, F.concat(F.lit("[ANSWER]\nassert f("), t, F.lit(") == "), F.reverse(t),
                                     F.lit("\n[/ANSWER] trailing")))
         .when(i % 4 == 1, F.concat(t, F.lit(" == "), F.reverse(t), F.lit("# done extra == x")))
         .when(i % 4 == 2, F.concat(F.lit("no tags "), t))
         .otherwise(F.concat(F.lit("[ANSWER]"), t, F.lit("[ANSWER]"), t)))
    d = d.select("doc_id", c.alias("c"))
    return d.select("doc_id", X.answer_of(F.col("c"), "input").alias("answer_input"),
                    X.answer_of(F.col("c"), "output").alias("answer_output"))


# ------------------------------------------------------------------ D21
_FIRST_LINE = """
src AS (SELECT doc_id, CASE doc_id % 4
    WHEN 0 THEN chr(10) || chr(10) || '# comment line' || chr(10) || text
    WHEN 1 THEN '\"\"\"doc' || chr(10) || 'still doc' || chr(10) || '\"\"\"' || chr(10) || text
    WHEN 2 THEN '   ' || chr(10) || chr(9) || chr(10) || text
    ELSE '/* c' || chr(10) || ' more */' || chr(10) || '// x' || chr(10) || text END AS c
  FROM documents)"""


def _first_line_sql(language: str) -> str:
    q3 = "chr(34) || chr(34) || chr(34)"
    s3 = "chr(39) || chr(39) || chr(39)"
    st = _t("x")
    if language == "python":
        opens = f"(starts_with({st}, {q3}) OR starts_with({st}, {s3}))"
        closes = f"(ends_with({st}, {q3}) OR ends_with({st}, {s3}))"
        single = "'#'"
    else:
        opens = f"starts_with({st}, '/*')"
        closes = f"ends_with({st}, '*/')"
        single = "'//'"
    lines = "string_split(regexp_replace(c, '^\\n+', ''), chr(10))"
    fold = (f"list_reduce(list_prepend('N', {lines}), lambda acc, x: CASE WHEN left(acc, 1) = 'F' THEN acc "
            f"WHEN {st} = '' THEN acc WHEN acc = 'N' AND {opens} THEN 'M' WHEN acc = 'M' AND {closes} THEN 'N' "
            f"WHEN acc = 'M' THEN acc WHEN starts_with({st}, {single}) THEN acc ELSE 'F' || x END)")
    return f"(CASE WHEN left({fold}, 1) = 'F' THEN substr({fold}, 2) ELSE {lines}[1] END)"


@register("first_code_line", with_ctes(_FIRST_LINE) +
          f"SELECT doc_id, {_first_line_sql('python')} AS line_python, {_first_line_sql('java')} AS line_java FROM src")
def q_first_code_line(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    i, t = F.col("doc_id"), F.col("text")
    c = (F.when(i % 4 == 0, F.concat(F.lit("\n\n# comment line\n"), t))
         .when(i % 4 == 1, F.concat(F.lit('"""doc\nstill doc\n"""\n'), t))
         .when(i % 4 == 2, F.concat(F.lit("   \n\t\n"), t))
         .otherwise(F.concat(F.lit("/* c\n more */\n// x\n"), t)))
    d = d.select("doc_id", c.alias("c"))
    return d.select("doc_id", X.first_code_line(F.col("c"), "python").alias("line_python"),
                    X.first_code_line(F.col("c"), "java").alias("line_java"))


# ------------------------------------------------------------------ D22 / D23
_CLASSIFIED = """
raw AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'the model said no json here'
    ELSE '<think>hm</think>' || chr(10) || (CASE WHEN doc_id % 5 = 0 THEN '' ELSE '```json' || chr(10) END) ||
         '{"needs_special_judge": ' || (CASE WHEN quality = 1 THEN 'true' ELSE 'false' END) ||
         ', "categories": ' || (CASE WHEN toxic = 1 THEN '["toxic"]' ELSE '[]' END) ||
         ', "reason": "doc ' || CAST(doc_id AS VARCHAR) || '"' ||
         (CASE WHEN doc_id % 3 = 0 THEN ', "confidence": 0.5' ELSE '' END) || '}' ||
         (CASE WHEN doc_id % 5 = 0 THEN '' ELSE chr(10) || '```' END) END AS raw
  FROM labels)"""


def _classified(spark, sf):
    lab = V.table(spark, sf, "labels")
    i = F.col("doc_id")
    fence_open = F.when(i % 5 == 0, F.lit("")).otherwise(F.lit("```json\n"))
    fence_close = F.when(i % 5 == 0, F.lit("")).otherwise(F.lit("\n```"))
    body = F.concat(F.lit('{"needs_special_judge": '), F.when(F.col("quality") == 1, "true").otherwise("false"),
                    F.lit(', "categories": '), F.when(F.col("toxic") == 1, '["toxic"]').otherwise("[]"),
                    F.lit(', "reason": "doc '), i.cast("string"), F.lit('"'),
                    F.when(i % 3 == 0, F.lit(', "confidence": 0.5')).otherwise(F.lit("")), F.lit("}"))
    raw = F.when(i % 7 == 0, F.lit("the model said no json here")).otherwise(
        F.concat(F.lit("<think>hm</think>\n"), fence_open, body, fence_close))
    return lab.select("doc_id", raw.alias("raw"))


@register("parse_classification", with_ctes(_CLASSIFIED, f"""
s AS (SELECT doc_id, {_t("string_split(raw, '</think>')[-1]")} AS s FROM raw)""", f"""
j AS (SELECT doc_id, CASE WHEN starts_with(s, '```json') THEN {_t('substr(s, 8, greatest(length(s) - 10, 0))')}
                          WHEN starts_with(s, '```') THEN {_t('substr(s, 4, greatest(length(s) - 6, 0))')}
                          ELSE s END AS body FROM s)""", """
k0 AS (SELECT doc_id, coalesce(json_valid(body), false) AS valid, body FROM j)""", """
k AS (SELECT doc_id, CASE WHEN ok THEN body END AS body, ok
      FROM (SELECT doc_id, body, valid AND json_type(CASE WHEN valid THEN body END) = 'OBJECT' AS ok FROM k0))""") + """
SELECT doc_id,
  CASE WHEN ok THEN coalesce(CAST(json_extract(body, '$.needs_special_judge') AS BOOLEAN), false)
                    OR coalesce(len(from_json(json_extract(body, '$.categories'), '["VARCHAR"]')), 0) > 0
       ELSE false END AS needs_special_judge,
  CASE WHEN ok THEN coalesce(from_json(json_extract(body, '$.categories'), '["VARCHAR"]'), [])
       ELSE CAST([] AS VARCHAR[]) END AS categories,
  CASE WHEN ok THEN coalesce(json_extract_string(body, '$.reason'), '') ELSE 'failed to classify' END AS reason,
  CASE WHEN ok THEN CAST(json_extract(body, '$.confidence') AS DOUBLE) ELSE 0.0 END AS confidence
FROM k""")
def q_parse_classification(spark, sf):
    return X.parse_classification(_classified(spark, sf), "raw").drop("raw")


_PROGRAMS = """
raw AS (SELECT doc_id, CASE doc_id % 4
    WHEN 0 THEN '<think>draft ```python' || chr(10) || 'nope' || chr(10) || '```</think>' || chr(10) ||
                '```python' || chr(10) || text || chr(10) || '```'
    WHEN 1 THEN '```' || chr(10) || '  ' || text || chr(10) || '```' || chr(10) || 'trailer'
    WHEN 2 THEN '```js' || chr(10) || text || chr(10) || '```'
    ELSE text END AS raw
  FROM documents)"""


@register("parse_judge_program", with_ctes(_PROGRAMS) + f"""
SELECT doc_id, {_t(f"regexp_extract({_t(chr(39) * 0 + "string_split(raw, '</think>')[-1]")}, '{X.JUDGE_PROGRAM_RE}', 1)")}
  AS program FROM raw""")
def q_parse_judge_program(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    i, t = F.col("doc_id"), F.col("text")
    raw = (F.when(i % 4 == 0, F.concat(F.lit("<think>draft ```python\nnope\n```</think>\n```python\n"), t,
                                       F.lit("\n```")))
           .when(i % 4 == 1, F.concat(F.lit("```\n  "), t, F.lit("\n```\ntrailer")))
           .when(i % 4 == 2, F.concat(F.lit("```js\n"), t, F.lit("\n```")))
           .otherwise(t))
    return d.select("doc_id", X.parse_judge_program(raw).alias("program"))


# ------------------------------------------------------------------ D16
def _py_post_sql(x: str) -> str:
    guard = "'if __name__ == \"__main__\":'"
    c = f"(CASE WHEN strpos({x}, {guard}) > 0 THEN {_t(f'left({x}, strpos({x}, {guard}) - 1)')} ELSE {x} END)"
    eu = "'# Example usage'"
    return f"(CASE WHEN strpos({c}, {eu}) > 0 THEN {_t(f'left({c}, strpos({c}, {eu}) - 1)')} ELSE {c} END)"


def _stop_cut_sql(x: str, tok_sql: str) -> str:
    return f"(CASE WHEN strpos({x}, {tok_sql}) > 0 THEN left({x}, strpos({x}, {tok_sql}) - 1) ELSE {x} END)"


_MBPP_COMPLETIONS = S.completions_sql().replace("completions AS (", "completions0 AS (", 1) + """,
completions AS (SELECT doc_id, lang,
    CASE WHEN strpos(c2, '[DONE]') > 0 THEN left(c2, strpos(c2, '[DONE]') - 1) ELSE c2 END AS completion
  FROM (SELECT doc_id, lang,
               CASE WHEN doc_id % 6 = 0 THEN left(completion, 40) || '[DONE]' || substr(completion, 41)
                    ELSE completion END AS c2 FROM completions0))"""

_FIRST = ("replace(CASE WHEN len(ft) > 0 THEN fb[1] WHEN len(ot) > 0 THEN ob[1] WHEN len(hb) > 0 THEN hb[1] "
          "ELSE '' END, chr(13), '')")


@register("mbpp_code", with_ctes(_MBPP_COMPLETIONS, _BLOCK_LISTS) + f"""
SELECT doc_id, {_stop_cut_sql(_stop_cut_sql(_py_post_sql(_FIRST), "chr(10) || 'assert'"),
                              "chr(10) || chr(34) || chr(34) || chr(34)")} AS code
FROM b""")
def q_mbpp_code(spark, sf):
    c = V.completions(spark, sf)
    i = F.col("doc_id")
    c2 = F.when(i % 6 == 0, F.concat(F.left("completion", F.lit(40)), F.lit("[DONE]"),
                                      F.substring("completion", 41, 1 << 30))).otherwise(F.col("completion"))
    c = c.select("doc_id", c2.alias("t"))
    return X.mbpp_code_df(c, "t").select("doc_id", "code")


# ------------------------------------------------------------------ E4
HE_STOP = ["\ndef ", "\nclass ", "\nif ", "\nprint("]


def _he_stop_sql(x: str) -> str:
    out = x
    for tok in HE_STOP:
        lit = " || ".join(["chr(10)"] + [f"'{tok[1:]}'"]) if tok.startswith("\n") else f"'{tok}'"
        out = f"(CASE WHEN strpos({out}, {lit}) > 0 THEN left({out}, strpos({out}, {lit}) - 1) ELSE {out} END)"
    return out


def _he_preamble_sql() -> str:
    from gavel.operators.assembly import IMPORT_PREAMBLE
    from gavel.plans.q_prompts import _q
    return _q("\n".join(IMPORT_PREAMBLE["python"]) + "\n")


@register("humaneval_program", with_ctes(S.completions_sql(), _BLOCK_LISTS, _BLOCK_ROWS) + f"""
SELECT c.doc_id,
  {_he_preamble_sql()} || 'def f(x):' || chr(10) || {_he_stop_sql('c.completion')} || chr(10) || 'assert f(1)'
    || chr(10) || 'check(f)' AS pretrain_program,
  {_he_preamble_sql()} || coalesce(r.code, '') || chr(10) || 'assert f(1)' || chr(10) || 'check(f)' AS func_program
FROM completions c LEFT JOIN ranked r ON c.doc_id = r.doc_id AND r.rn = 1""")
def q_humaneval_program(spark, sf):
    from gavel.operators import assembly as A
    c = V.completions(spark, sf).select(
        "doc_id", "completion", F.lit("def f(x):").alias("prompt"), F.lit("assert f(1)").alias("tests"),
        F.array(*[F.lit(t) for t in HE_STOP]).alias("stops"), F.lit("f").alias("entry_point"))
    a = A.humaneval_program_df(c, "completion", "prompt", "tests", "stops", "python", "pretrain", "entry_point",
                               out="pretrain_program")
    b = A.humaneval_program_df(a, "completion", "prompt", "tests", "stops", "python", "func", "entry_point",
                               out="func_program")
    return b.select("doc_id", "pretrain_program", "func_program")
