"""Phase 5 plans: prompt tables over ``documents``, ``benchmark`` and ``conversations``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gavel.operators import prompts as P
from gavel.plans import fixtures as V
from gavel.plans import sql_views as S
from gavel.plans.registry import register


def _q(s: str) -> str:
    """A SQL string literal; control characters spelled with chr()."""
    if not s:
        return "''"
    out, buf = [], []
    for ch in s:
        if ord(ch) < 32:
            if buf:
                out.append("'" + "".join(buf).replace("'", "''") + "'")
                buf = []
            out.append(f"chr({ord(ch)})")
        else:
            buf.append(ch)
    if buf:
        out.append("'" + "".join(buf).replace("'", "''") + "'")
    return "(" + " || ".join(out) + ")"


def _t(x: str) -> str:
    return S.py_strip_sql(x)


# ------------------------------------------------------------------ F1
def _oj_sql() -> str:
    cases = []
    for lang in ["cpp", "python", "java"]:
        cases.append(f"WHEN loc = 'zh' AND language = '{lang}' THEN {_q(P.OJ_LANGUAGE_PROMPTS['zh'][lang])}")
        cases.append(f"WHEN language = '{lang}' THEN {_q(P.OJ_LANGUAGE_PROMPTS['en'][lang])}")
    dz = _q(P.OJ_LANGUAGE_PROMPTS["zh"]["default"])
    de = _q(P.OJ_LANGUAGE_PROMPTS["en"]["default"])
    cases.append(f"WHEN loc = 'zh' THEN replace({dz}, '{{language}}', language)")
    cases.append(f"ELSE replace({de}, '{{language}}', language)")
    return f"""
SELECT doc_id, text || chr(10) || chr(10) || (CASE {' '.join(cases)} END) AS prompt
FROM (SELECT doc_id, text, CASE WHEN lang = 'fr' THEN 'zh' WHEN lang IN ('en', 'zh') THEN lang ELSE 'en' END AS loc,
             CASE doc_id % 5 WHEN 0 THEN 'python' WHEN 1 THEN 'cpp' WHEN 2 THEN 'java' WHEN 3 THEN 'go'
                  ELSE 'rust' END AS language
      FROM documents)"""


@register("oj_prompt", _oj_sql())
def q_oj_prompt(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text", "lang")
    i = F.col("doc_id")
    loc = F.when(F.col("lang") == "fr", F.lit("zh")).otherwise(F.col("lang"))
    language = (F.when(i % 5 == 0, "python").when(i % 5 == 1, "cpp").when(i % 5 == 2, "java")
                .when(i % 5 == 3, "go").otherwise("rust"))
    return d.select("doc_id", P.oj_prompt(F.col("text"), loc, language).alias("prompt"))


# ------------------------------------------------------------------ F2
@register("freeform_prompt", f"""
SELECT doc_id, '```' || split_part(language, '.', 1) || chr(10) || text || chr(10) || '```' || chr(10) || chr(10) ||
  CASE WHEN lang = 'fr' THEN {_q(P.FREEFORM_INSTRUCTION['zh'])} ELSE {_q(P.FREEFORM_INSTRUCTION['en'])} END AS prompt
FROM (SELECT doc_id, text, lang, CASE doc_id % 3 WHEN 0 THEN 'python' WHEN 1 THEN 'cpp.x' ELSE 'java' END AS language
      FROM documents)""")
def q_freeform_prompt(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text", "lang")
    i = F.col("doc_id")
    language = F.when(i % 3 == 0, "python").when(i % 3 == 1, "cpp.x").otherwise("java")
    locale = F.when(F.col("lang") == "fr", F.lit("zh")).otherwise(F.lit("en"))
    return d.select("doc_id", P.freeform_prompt(F.col("text"), language, locale).alias("prompt"))


# ------------------------------------------------------------------ F11 / F12
def _role_case(which: str, template: str = "chatml") -> str:
    m = P.CHAT_TEMPLATES[template][which]
    return "(CASE role " + " ".join(f"WHEN '{r}' THEN {_q(v)}" for r, v in m.items()) + " END)"


_CHAT_SQL = f"""
chat AS (SELECT conv_id, string_agg({_role_case('start')} || text || {_role_case('end')}, '' ORDER BY turn)
                         || {_q(P.CHAT_TEMPLATES['chatml']['start']['assistant'] + '<think>' + chr(10))} AS prompt
         FROM conversations GROUP BY conv_id)"""


@register("chat_render", "WITH " + _CHAT_SQL + " SELECT conv_id, prompt FROM chat")
def q_chat_render(spark, sf):
    return P.render_chat(V.chat_messages(spark, sf), think=True)


def _segment_sql(p: str, start: str, end: str) -> str:
    s, e = _q(start), _q(end)
    rest = f"substr({p}, strpos({p}, {s}) + length({s}))"
    body = f"(CASE WHEN strpos({rest}, {e}) > 0 THEN left({rest}, strpos({rest}, {e}) - 1) ELSE {rest} END)"
    seg = f"(CASE WHEN strpos({p}, {s}) > 0 THEN {_t(body)} ELSE '' END)"
    return f"nullif({seg}, '')"


_T = P.CHAT_TEMPLATES["chatml"]


@register("chat_parse", "WITH " + _CHAT_SQL + f"""
SELECT conv_id, {_segment_sql('prompt', _T['start']['system'], _T['end']['system'])} AS system_content,
       {_segment_sql('prompt', _T['start']['user'], _T['end']['user'])} AS user_content
FROM chat""")
def q_chat_parse(spark, sf):
    r = P.render_chat(V.chat_messages(spark, sf), think=True)
    msgs = r.select("conv_id", P.parse_chat(F.col("prompt")).alias("m"))

    def content(role):
        return F.try_element_at(F.filter("m", lambda x: x["role"] == role), F.lit(1))["content"]
    return msgs.select("conv_id", content("system").alias("system_content"), content("user").alias("user_content"))


@register("chat_prompt", f"""
SELECT item_id, {_q(_T['start']['system'])} || {_q(P.CHAT_TEMPLATES['chatml_qwen3']['system'])} || {_q(_T['end']['system'])}
  || {_q(_T['start']['user'])} || text || {_q(_T['end']['user'])} || {_q(_T['start']['assistant'])} || '<think>' || chr(10)
  AS prompt FROM benchmark""")
def q_chat_prompt(spark, sf):
    b = V.table(spark, sf, "benchmark")
    return b.select("item_id", P.render_prompt(F.col("text"), "chatml_qwen3", think=True).alias("prompt"))


# ------------------------------------------------------------------ F10
CONTEXT_BUDGET = 10000


@register("context_pack", f"""
WITH r AS (SELECT source, doc_id, text, n_chars,
                  sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
           FROM documents)
SELECT source, count(*) AS n_snippets, CAST(sum(n_chars) AS BIGINT) AS used,
       string_agg(text, '' ORDER BY md5(text), text) AS context
FROM r WHERE run <= {CONTEXT_BUDGET} GROUP BY source""")
def q_context_pack(spark, sf):
    d = V.table(spark, sf, "documents").select("source", "doc_id", "text", "n_chars")
    return P.context_pack(d, "source", "doc_id", "text", "n_chars", CONTEXT_BUDGET)


# ------------------------------------------------------------------ F13 / F15
@register("clip_text", f"""
SELECT doc_id, '<problem_to_be_classified>' || chr(10) ||
  CASE WHEN length({_t('text')}) > 800 THEN left({_t('text')}, 800) || '...[TRUNCATED]' || chr(10) || right({_t('text')}, 100)
       ELSE {_t('text')} END || chr(10) || '</problem_to_be_classified>' AS prompt
FROM documents""")
def q_clip_text(spark, sf):
    d = V.table(spark, sf, "documents")
    return d.select("doc_id", P.clip_text(F.col("text"), 800, 100).alias("prompt"))


@register("completion_budget", """
SELECT doc_id, CASE WHEN pt IS NULL THEN 2048 ELSE least(2048, greatest(1, 4096 - pt)) END AS max_tokens
FROM (SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE n_chars // 4 END AS pt FROM documents)""")
def q_completion_budget(spark, sf):
    d = V.table(spark, sf, "documents")
    pt = F.when(F.col("doc_id") % 9 == 0, F.lit(None).cast("long")).otherwise(F.expr("n_chars div 4"))
    return d.select("doc_id", P.completion_budget(pt, F.lit(2048).cast("long"), F.lit(4096).cast("long"))
                    .alias("max_tokens"))


# ------------------------------------------------------------------ F3
_MBPP_SRC = """
mb AS (SELECT item_id, text AS content,
              list_transform(string_split(text, '. '), lambda x: 'assert ' || x) AS tests
       FROM benchmark)"""


@register("mbpp_prompt", "WITH " + _MBPP_SRC + f"""
SELECT item_id,
  {_q(P.MBPP_TASK_HEAD)} || content || {_q(P.MBPP_TASK_TESTS)} || array_to_string(tests, chr(10)) AS prompt,
  {_q(chr(10).join(P.MBPP_FEWSHOT) + chr(10) + P.MBPP_TASK_HEAD)} || content || {_q(P.MBPP_TASK_TESTS)}
    || tests[1] || chr(10) || tests[2] || chr(10) || '[BEGIN]' || chr(10) AS fewshot_prompt
FROM mb""")
def q_mbpp_prompt(spark, sf):
    b = V.table(spark, sf, "benchmark")
    tests = F.transform(F.split("text", r"\. ", -1), lambda x: F.concat(F.lit("assert "), x))
    m = b.select("item_id", F.col("text").alias("content"), tests.alias("tests"))
    return m.select("item_id", P.mbpp_prompt("content", "tests").alias("prompt"),
                    P.mbpp_prompt("content", "tests", fewshot=True).alias("fewshot_prompt"))


# ------------------------------------------------------------------ F6
_MHPP_SRC = """
mh AS (SELECT doc_id,
    CASE WHEN doc_id % 3 = 0 THEN text
         ELSE 'def f():' || chr(10) || '    ' || chr(34) || chr(34) || chr(34) || text || chr(34) || chr(34) || chr(34)
              || chr(10) || '    pass' END AS content,
    'assert f(' || CAST(doc_id AS VARCHAR) || ') == 1' || chr(10) || 'assert g()' AS tests
  FROM documents)"""


@register("mhpp_prompt", "WITH " + _MHPP_SRC + """
SELECT doc_id,
  (CASE WHEN strpos(reverse(content), chr(34) || chr(34) || chr(34)) > 0
        THEN left(content, length(content) - strpos(reverse(content), chr(34) || chr(34) || chr(34)) - 2)
        ELSE left(content, greatest(length(content) - 1, 0)) END)
  || chr(10) || '    e.g. ' || split_part(tests, chr(10), 1) || ' ' || chr(34) || chr(34) || chr(34) AS prompt
FROM mh""")
def q_mhpp_prompt(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text")
    i = F.col("doc_id")
    content = F.when(i % 3 == 0, F.col("text")).otherwise(
        F.concat(F.lit('def f():\n    """'), F.col("text"), F.lit('"""\n    pass')))
    tests = F.concat(F.lit("assert f("), i.cast("string"), F.lit(") == 1\nassert g()"))
    m = d.select("doc_id", content.alias("content"), tests.alias("tests"))
    return m.select("doc_id", P.mhpp_prompt("content", "tests").alias("prompt"))


# ------------------------------------------------------------------ F4
_MBXP_SRC = """
mx AS (SELECT doc_id, text AS question,
    CASE WHEN doc_id % 3 = 0 THEN 'ctx ' || source WHEN doc_id % 3 = 1 THEN '' END AS context,
    source || '/' || CAST(doc_id AS VARCHAR) AS task_id, 'labels fs ' || lang AS labels_fewshot
  FROM documents)"""

MBXP_CUSTOM = {"src1": "custom fs one", "src2": "custom fs two"}


def _layout_sql(q: str, ctx: str, fs: str, language: str, wrap: bool) -> str:
    qh, ah = P.QA_HINTS[language]
    wi, wr = P.WRAP_PROMPT[language]
    nl = "chr(10)"
    present = lambda x: f"({x} IS NOT NULL AND {x} <> '')"
    both = f"{ctx} || {nl} || {nl} || {_q(P.SECTION_SEP)} || {nl} || {nl} || {fs} || {nl} || {nl} || {_q(qh)} || {q} || {nl} || {nl} || {_q(ah)} || {nl}"
    ctx_only = (f"{ctx} || {nl} || {nl} || {_q(wi)} || {nl} || {q} || {nl} || {_q(wr)} || {nl}" if wrap else
                f"{ctx} || {nl} || {nl} || {_q(qh)} || {q} || {nl} || {nl} || {_q(ah)} || {nl}")
    fs_only = f"{fs} || {nl} || {nl} || {_q(qh)} || {q} || {nl} || {nl} || {_q(ah)} || {nl}"
    bare = f"{_q(wi)} || {nl} || {q} || {nl} || {_q(wr)} || {nl}" if wrap else q
    return (f"(CASE WHEN {present(ctx)} AND {present(fs)} THEN {both} WHEN {present(ctx)} THEN {ctx_only} "
            f"WHEN {present(fs)} THEN {fs_only} ELSE {bare} END)")


_FS_SQL = ("coalesce(CASE split_part(task_id, '/', 1) " +
           " ".join(f"WHEN '{k}' THEN {_q(v)}" for k, v in MBXP_CUSTOM.items()) + " END, labels_fewshot)")


@register("mbxp_prompt", "WITH " + _MBXP_SRC + f"""
SELECT doc_id,
  {_layout_sql('question', 'context', 'CAST(NULL AS VARCHAR)', 'en', False)} AS prompt,
  {_layout_sql('question', 'context', 'CAST(NULL AS VARCHAR)', 'zh', True)} AS wrapped_prompt,
  {_layout_sql('question', 'context', _FS_SQL, 'en', False)} AS fewshot_prompt
FROM mx""")
def q_mbxp_prompt(spark, sf):
    d = V.table(spark, sf, "documents")
    i = F.col("doc_id")
    m = d.select("doc_id", F.col("text").alias("question"),
                 F.when(i % 3 == 0, F.concat(F.lit("ctx "), F.col("source"))).when(i % 3 == 1, F.lit(""))
                 .alias("context"),
                 F.concat(F.col("source"), F.lit("/"), i.cast("string")).alias("task_id"),
                 F.concat(F.lit("labels fs "), F.col("lang")).alias("labels_fewshot"))
    none = F.lit(None).cast("string")
    fs = P.choose_fewshot("task_id", "labels_fewshot", MBXP_CUSTOM)
    return m.select("doc_id", P.layout_prompt("question", "context", none, "en").alias("prompt"),
                    P.layout_prompt("question", "context", none, "zh", wrap=True).alias("wrapped_prompt"),
                    P.layout_prompt("question", "context", fs, "en").alias("fewshot_prompt"))


# ------------------------------------------------------------------ F5
_AUTOEVAL_SRC = """
ae AS (SELECT doc_id, text AS question,
    CASE WHEN doc_id % 3 = 0 THEN 'ctx ' || source END AS context, 'fs ' || lang AS fewshot,
    CASE doc_id % 4 WHEN 0 THEN 'Q: ${question}' || chr(10) || 'C: $context $$money $unknown $questions'
                    WHEN 1 THEN NULL WHEN 2 THEN '' ELSE '$fewshot|$locale|${question}' END AS template
  FROM documents)"""


def _subst_sql(t: str, values: dict[str, str]) -> str:
    out = f"replace({t}, '$$', chr({0xE0FF}))"
    for i, (k, _v) in enumerate(values.items()):
        out = f"replace({out}, '${{{k}}}', chr({0xE000 + i}))"
        out = f"regexp_replace({out}, '\\$' || '{k}' || '([^_A-Za-z0-9]|$)', chr({0xE000 + i}) || '\\1', 'g')"
    for i, (k, v) in enumerate(values.items()):
        out = f"replace({out}, chr({0xE000 + i}), coalesce({v}, ''))"
    return f"replace({out}, chr({0xE0FF}), '$')"


@register("autoeval_prompt", "WITH " + _AUTOEVAL_SRC + f"""
SELECT doc_id,
  CASE WHEN template IS NOT NULL AND template <> ''
       THEN {_subst_sql('template', {'question': 'question', 'fewshot': 'fewshot', 'context': 'context',
                                      'locale': "'en'"})}
       ELSE {_layout_sql('question', 'context', 'fewshot', 'en', False)} END AS prompt
FROM ae""")
def q_autoeval_prompt(spark, sf):
    d = V.table(spark, sf, "documents")
    i = F.col("doc_id")
    tmpl = (F.when(i % 4 == 0, F.lit("Q: ${question}\nC: $context $$money $unknown $questions"))
            .when(i % 4 == 1, F.lit(None).cast("string")).when(i % 4 == 2, F.lit(""))
            .otherwise(F.lit("$fewshot|$locale|${question}")))
    a = d.select("doc_id", F.col("text").alias("question"),
                 F.when(i % 3 == 0, F.concat(F.lit("ctx "), F.col("source"))).alias("context"),
                 F.concat(F.lit("fs "), F.col("lang")).alias("fewshot"), tmpl.alias("template"))
    return a.select("doc_id", P.autoeval_prompt("question", "template", "context", "fewshot", "en").alias("prompt"))


# ------------------------------------------------------------------ C8 / F7
CRUX_SHOTS = 3  # few-shot examples of a language


def _crux_tables(spark, sf):
    b = V.table(spark, sf, "benchmark")
    words = F.split("text", " ")
    half = F.floor(F.size(words) / 2).cast("int")
    inputs, outputs = (F.coalesce(F.nullif(F.array_join(w, " "), F.lit("")), F.lit("zz"))
                       for w in (F.slice(words, F.lit(1), half), F.slice(words, half + 1, F.size(words))))
    k = F.col("item_id") % 4
    ex = b.select(F.when(k == 0, "python").when(k == 1, "R").when(k == 2, "bash").otherwise("cpp").alias("language"),
                  F.col("item_id").alias("idx"), F.col("text").alias("code"), inputs.alias("inputs"), outputs.alias("outputs"))
    shot = F.row_number().over(Window.partitionBy("language").orderBy("idx"))
    ex = ex.withColumn("shot", shot).where(F.col("shot") <= CRUX_SHOTS).drop("shot")
    d = V.table(spark, sf, "documents")
    i = F.col("doc_id")
    lang = F.when(i % 4 == 0, "python").when(i % 4 == 1, "R").when(i % 4 == 2, "bash").otherwise("cpp")
    pr = d.select(F.concat(lang, F.lit("_"), i.cast("string")).alias("id"),
                  F.col("text").alias("code"),
                  F.concat(F.lit(" "), "text").alias("given"))
    return pr, ex


def _crux_sql() -> str:
    call = "(CASE language " + " ".join(f"WHEN '{k}' THEN {_q(v)}" for k, v in P.CRUX_CALL.items()) + " END)"

    def ex(mode):
        if mode == "input":
            hidden, ans = f"replace(code, inputs, {call})", "inputs"
        else:
            hidden, ans = "replace(code, outputs, '????')", "outputs"
        blk = (f"'```' || language || chr(10) || {_t(hidden)} || chr(10) || '```' || chr(10) || '[ANSWER]' || chr(10)"
               f" || {ans} || chr(10) || '[/ANSWER]' || chr(10)")
        return (f"ex_{mode} AS (SELECT language, rtrim(string_agg({blk}, '' ORDER BY idx), {S.WS}) AS examples "
                f"FROM ex GROUP BY language)")

    def prompt(mode):
        head = P.CRUX_INPUT_HEAD if mode == "input" else P.CRUX_OUTPUT_HEAD
        return (f"{_q(head[0])} || p.language || {_q(head[1])} || e_{mode}.examples || chr(10) || '```' || "
                f"p.language || chr(10) || p.code || p.given || chr(10) || '```' || chr(10)")
    return f"""
WITH ex AS (SELECT CASE item_id % 4 WHEN 0 THEN 'python' WHEN 1 THEN 'R' WHEN 2 THEN 'bash' ELSE 'cpp' END AS language,
                   item_id AS idx, text AS code,
                   coalesce(nullif(array_to_string(string_split(text, ' ')[1:len(string_split(text, ' ')) // 2], ' '), ''), 'zz') AS inputs,
                   coalesce(nullif(array_to_string(string_split(text, ' ')[len(string_split(text, ' ')) // 2 + 1:], ' '), ''), 'zz') AS outputs
            FROM benchmark
            QUALIFY row_number() OVER (PARTITION BY item_id % 4 ORDER BY item_id) <= {CRUX_SHOTS}),
{ex('input')},
{ex('output')},
p AS (SELECT (CASE doc_id % 4 WHEN 0 THEN 'python' WHEN 1 THEN 'R' WHEN 2 THEN 'bash' ELSE 'cpp' END)
             || '_' || CAST(doc_id AS VARCHAR) AS id,
             CASE doc_id % 4 WHEN 0 THEN 'python' WHEN 1 THEN 'R' WHEN 2 THEN 'bash' ELSE 'cpp' END AS language,
             text AS code, ' ' || text AS given FROM documents)
SELECT p.id, {prompt('input')} AS input_prompt, {prompt('output')} AS output_prompt
FROM p LEFT JOIN ex_input e_input ON p.language = e_input.language
       LEFT JOIN ex_output e_output ON p.language = e_output.language"""


@register("cruxeval_x_prompt", _crux_sql())
def q_cruxeval_x_prompt(spark, sf):
    pr, ex = _crux_tables(spark, sf)
    return P.crux_x_prompts(pr, ex).select("id", "input_prompt", "output_prompt")


# ------------------------------------------------------------------ E10
from gavel.operators.assembly import MBPP_NAMED_ENTRY_POINTS as _NAMED  # noqa: E402

_MBPP_EP = """
ep AS (SELECT item_id, t1, tests, text,
    CASE WHEN strpos(t1, 'math.isclose') > 0 THEN regexp_extract(t1, 'math\\.isclose\\((\\w+)\\(', 1)
         """ + " ".join(f"WHEN strpos(t1, '{n}') > 0 THEN '{n}'" for n in _NAMED) + """
         ELSE regexp_extract(t1, 'assert\\s+([A-Za-z_]\\w*)\\s*\\(', 1) END AS entry_point
  FROM (SELECT item_id, text, tests, tests[1] AS t1
        FROM (SELECT item_id, text,
                     list_append(list_transform(string_split(text, ' '), lambda w:
                                   CASE item_id % 3 WHEN 0 THEN 'assert ' || w || '(1) == 2'
                                       WHEN 1 THEN 'assert math.isclose(' || w || '(3), 4)'
                                       ELSE 'assert Diff([1], [2]) == ' || w END),
                      'assert True') AS tests FROM benchmark)))"""


@register("mbpp_check", "WITH " + _MBPP_EP + """
SELECT item_id, entry_point, 'def check(' || entry_point || '):' || chr(10) || '    '
       || array_to_string(tests, chr(10) || '    ') AS test,
       coalesce(list_filter(string_split(text, chr(10)), lambda l: strpos(l, entry_point) > 0)[1], '') AS signature
FROM ep""")
def q_mbpp_check(spark, sf):
    from gavel.operators import assembly as A
    b = V.table(spark, sf, "benchmark")
    i = F.col("item_id")
    tests = F.transform(F.split("text", " "), lambda w: (
        F.when(i % 3 == 0, F.concat(F.lit("assert "), w, F.lit("(1) == 2"))).when(i % 3 == 1, F.concat(F.lit("assert math.isclose("), w, F.lit("(3), 4)")))
        .otherwise(F.concat(F.lit("assert Diff([1], [2]) == "), w))))
    m = b.select("item_id", "text", F.array_append(tests, F.lit("assert True")).alias("tests"))
    m = m.withColumn("entry_point", A.mbpp_entry_point(F.element_at("tests", 1)))
    return m.select("item_id", "entry_point", A.mbpp_check_program("tests", "entry_point").alias("test"),
                    A.signature_line("text", "entry_point").alias("signature"))


# ------------------------------------------------------------------ F9
LEAN_TEMPLATE = "Prove {{ this }}: {source} / {lang}"


@register("dataset_prompts", f"""
SELECT doc_id,
  chr(10) || text || chr(10) || chr(10) || 'Please generate the code in the following format:' || chr(10) || '```python'
    || chr(10) || text || chr(10) || '```' || chr(10) AS aider,
  {_q(P.AIDER_WRAP[0])} || chr(10) || chr(10) || text || chr(10) || chr(10)
    || 'Please generate the code in the following format:' || chr(10) || '```python' || chr(10)
    || text || chr(10) || '```' || chr(10) || chr(10) || {_q(P.AIDER_WRAP[1])} || chr(10)
    AS aider_wrapped,
  CASE WHEN doc_id % 2 = 0 THEN 'fs ' || lang || chr(10) || chr(10) || {_q(P.SECTION_SEP)} || chr(10) || chr(10)
       || 'Question:' || chr(10) ELSE '' END
    || 'sys ' || source || chr(10) || 'q ' || lang || chr(10) || text || chr(10) || '```verilog'
    || chr(10) || 'module m;' || chr(10) || '```'
    || CASE WHEN doc_id % 2 = 0 THEN chr(10) || chr(10) || 'Answer:' ELSE '' END AS verilog,
  {_q(P.LEAN_PREFIX['en'] + chr(10) + chr(10) + '```lean' + chr(10))} || text || chr(10) || '```' AS lean,
  'Prove {{ this }}: ' || source || ' / ' || lang AS lean_templated
FROM documents""")
def q_dataset_prompts(spark, sf):
    d = V.table(spark, sf, "documents")
    i = F.col("doc_id")
    fs = F.when(i % 2 == 0, F.concat(F.lit("fs "), F.col("lang")))
    return d.select(
        "doc_id", P.aider_prompt(F.col("text"), F.col("text")).alias("aider"),
        P.aider_prompt(F.col("text"), F.col("text"), wrap=True).alias("aider_wrapped"),
        P.verilog_prompt(F.lit("module m;\n"), F.col("text"),
                         F.concat(F.lit("sys "), F.col("source")), F.concat(F.lit("q "), F.col("lang")), fs)
        .alias("verilog"),
        P.lean_prompt(F.col("text"), "en").alias("lean"),
        P.format_template(LEAN_TEMPLATE, d).alias("lean_templated"))
