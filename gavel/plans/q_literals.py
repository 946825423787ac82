"""Plans of nested literals (E8, E1) and of brace-matched spans."""

from __future__ import annotations

from pyspark.sql import functions as F

from gavel.operators import assembly as A
from gavel.operators import extraction as X
from gavel.plans import fixtures as V
from gavel.plans.registry import register


# ------------------------------------------------------------------ E8 / E1
# The words of whole texts as a list, and a map that holds lists, booleans, a null and numbers.
@register("nested_assertions", r"""
WITH shown AS (
  SELECT doc_id, replace(replace(replace(replace(text, '\', '\\'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') AS text FROM documents),
words AS (
  SELECT doc_id, '[' || coalesce(array_to_string(list_transform(string_split(text, ' '), lambda w:
    CASE WHEN contains(w, '''') AND NOT contains(w, '"') THEN '"' || w || '"' ELSE '''' || replace(w, '''', '\''') || '''' END), ', '), '') || ']' AS words,
    CASE WHEN contains(text, '''') AND NOT contains(text, '"') THEN '"' || text || '"' ELSE '''' || replace(text, '''', '\''') || '''' END AS spelled
  FROM shown),
nested AS (
  SELECT *, '{''z'': [True, None, [], ' || doc_id || '], ''a'': {''x'': -' || doc_id || '.5, ''y'': 1e+20}}' AS m FROM words)
SELECT doc_id, chr(10) || 'f' || chr(10) || 'res = g(*[' || words || ', ' || m || '])' || chr(10) || 'assert res == [' || m || '][0]' || chr(10) AS python,
  chr(10) || 'f' || chr(10) || 'const res = g(' || words || ', ' || m || ');' || chr(10) || 'const expected = ' || m || ';' || chr(10)
    || 'if (res !== expected) {' || chr(10) || '    throw new Error(`Test failed`);' || chr(10) || '}' || chr(10) AS nodejs,
  chr(10) || 'f' || chr(10) || 'res = g(' || words || ', ' || m || ')' || chr(10) || 'if res != ' || m || chr(10) || '    error("Test failed")' || chr(10)
    || 'end' || chr(10) AS julia,
  chr(10) || 'f' || chr(10) || 'res=$(g ' || words || ' ' || m || ')' || chr(10) || 'expected=' || m || chr(10) || 'if [ "$res" != "$expected" ]; then' || chr(10)
    || '    echo "Test failed, res: $res, expected: $expected" 1>&2' || chr(10) || '    exit 1' || chr(10) || 'fi' || chr(10) AS bash,
  'run(' || spelled || ')' AS as_repr
FROM nested""")
def q_nested_assertions(spark, sf):
    n = F.col("doc_id").cast("string")
    m = F.concat(F.lit('{"z": [true, null, [], '), n, F.lit('], "a": {"x": -'), n, F.lit('.50, "y": 1E20}}'))
    words = F.coalesce(F.to_json(F.split("text", " ")), F.lit("[]"))
    d = V.table(spark, sf, "documents").select(
        "doc_id", "text", F.concat(F.lit("["), words, F.lit(", "), m, F.lit("]")).alias("inputs"), F.concat(F.lit("["), m, F.lit("]")).alias("output"))
    return d.select("doc_id", *(A.function_assertion_json(F.lit("f"), F.lit("g"), "inputs", "output", lang).alias(lang)
                                for lang in ("python", "nodejs", "julia", "bash")),
                    A.append_test("text", F.lit("run(#<INSERT>)"), as_repr=True).alias("as_repr"))


# ------------------------------------------------------------------ D7
# A main or a method whose body holds the whole text, whose open braces are closed behind it, and blocks of its own.
@register("brace_spans", r"""
WITH body AS (SELECT doc_id, '{ ' || replace(coalesce(text, ''), '}', ')') || ' if (a) { b(); }' AS b FROM documents),
evened AS (SELECT doc_id, b, length(b) - length(replace(b, '{', '')) - (length(b) - length(replace(b, '}', ''))) AS open FROM body),
closed AS (SELECT doc_id, b || repeat('}', open::BIGINT) AS b FROM evened)
SELECT doc_id, 'func f() int { return 1 }' || chr(10) || '' || chr(10) || 'func h() {}' AS go,
  'fun f(): Int { return 1 }' || chr(10) || '' || chr(10) || '// end' AS kotlin,
  'public static int m(int a, String s) ' || b AS java,
  'internal static void M(' || chr(10) || 'int a) ' || b AS csharp,
  'fun main(a: X) { {' AS unclosed
FROM closed""")
def q_brace_spans(spark, sf):
    text = F.coalesce("text", F.lit(""))
    body = F.concat(F.lit("{ "), F.replace(text, F.lit("}"), F.lit(")")), F.lit(" if (a) { b(); }"))
    count = lambda c: F.length(body) - F.length(F.replace(body, F.lit(c), F.lit("")))
    closed = F.concat(body, F.repeat(F.lit("}"), count("{") - count("}")))
    d = V.table(spark, sf, "documents").select("doc_id", closed.alias("b"))
    codes = {"go": F.concat(F.lit("func f() int { return 1 }\n"), F.lit("func  main() "), "b", F.lit("\nfunc h() {}")),
             "kotlin": F.concat(F.lit("fun f(): Int { return 1 }\n"), F.lit("fun main(args: Array<String>) "), "b", F.lit("\n// end")),
             "java": F.concat(F.lit("class A {\n int z;\n "), F.lit("public static int m(int a, String s) "), "b", F.lit("\n}\n")),
             "csharp": F.concat(F.lit("namespace N { class A {\n"), F.lit("internal static void M(\nint a) "), "b", F.lit("\n}}"))}
    d = d.select("doc_id", *(c.alias(lang) for lang, c in codes.items()), F.lit("fun main(a: X) { {").alias("unclosed"))
    removed = lambda lang, c: X.without_main(F.col(c), lang).alias(c)
    return d.select("doc_id", removed("go", "go"), removed("kotlin", "kotlin"), X.inner_function(F.col("java"), "java").alias("java"),
                    X.inner_function(F.col("csharp"), "csharp").alias("csharp"), removed("kotlin", "unclosed"))
