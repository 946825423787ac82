"""Prompt operators against Python's own behaviour on small rows."""

from string import Template

from pyspark.sql import functions as F

from gavel.operators import prompts as P

from helpers import rows

TEMPLATES = ["Q: ${question}!", "$question$question", "$$question and $questions", "${fewshot}x $locale",
             "$unknown ${context} $", "a $ b", "$context$$", "no fields", "$Question"]


def test_fill_template_matches_string_template(spark):
    vals = {"question": "what $fewshot?", "fewshot": "FS", "context": "CTX", "locale": "en"}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEMPLATES)], "i int, t string")
    cols = {k: F.lit(v) for k, v in vals.items()}
    got = dict(rows(df.select("i", P.fill_template(F.col("t"), cols).alias("p")), "i", "p"))
    for i, t in enumerate(TEMPLATES):
        assert got[i] == Template(t).safe_substitute(**vals), t


def test_ordered_concat_two_stages(spark):
    data = [("a", turn, f"<{turn}>") for turn in range(0, 23)] + [("b", 5, "x"), ("b", 1, "y")]
    df = spark.createDataFrame(data, "k string, turn int, t string")
    got = dict(rows(P.ordered_concat(df, "k", "turn", "t", sep="|", fanout=4), "k", "text"))
    assert got["a"] == "|".join(f"<{i}>" for i in range(23)) and got["b"] == "y|x"


def test_context_pack_row(spark):
    import hashlib
    snippets = [("s0", 5), ("GOLD", 3), ("s2", 4), ("s3", 50), ("s4", 1)]
    df = spark.createDataFrame([(snippets, 1, "l1\nl2", 2)],
                               "sn array<struct<text string, size int>>, gold int, code string, cs int")
    out = df.select(P.context_pack_row(F.col("sn"), F.col("gold"), F.col("code"), F.col("cs"), 20).alias("p")).first()
    kept = sorted(["GOLD", "s0", "s2"], key=lambda x: hashlib.md5(x.encode()).hexdigest())
    assert out["p"] == "".join(kept) + "l1\nl2"


def test_mhpp_prompt_rfind_edges(spark):
    df = spark.createDataFrame([('def f():\n    """doc"""\n', "assert f()\nx"), ("abc", "t")], "c string, t string")
    got = [r["p"] for r in df.select(P.mhpp_prompt(F.col("c"), F.col("t")).alias("p")).collect()]

    def ref(c, t):
        c = c[:c.rfind('"""')]
        return f'{c}\n    e.g. {t.split(chr(10))[0]} """'
    assert got == [ref('def f():\n    """doc"""\n', "assert f()\nx"), ref("abc", "t")]


def test_parse_chat_round_trip(spark):
    df = spark.createDataFrame([("hello there",)], "u string")
    p = df.select(P.render_prompt(F.col("u"), "chatml_qwen3", think=True).alias("p"))
    msgs = p.select(P.parse_chat(F.col("p"), "chatml_qwen3").alias("m")).first()["m"]
    assert [(m["role"], m["content"]) for m in msgs] == [
        ("system", P.CHAT_TEMPLATES["chatml_qwen3"]["system"]), ("user", "hello there")]


def test_lcb_fewshot_prompt(spark):
    zero = ("intro\n### Question:\nAdd two numbers.\n\n### Format: You will use the following starter code\n"
            "```python\nclass Solution:\n    pass\n```\n\n### Answer:\n")
    blank = "### Question:\nQ2\n\n### Format: Read\n```python\n# YOUR CODE HERE\n```\n\n"
    df = spark.createDataFrame([(zero,), (blank,)], "p string")
    got = [r["f"] for r in df.select(P.lcb_fewshot_prompt(F.col("p"), "PREFIX\n").alias("f")).collect()]
    assert got[0] == ("PREFIX\nAdd two numbers.\n\n" + P.LCB_WITH_STARTER + "class Solution:\n    pass\n```"
                      + P.LCB_ANSWER)
    assert got[1] == "PREFIX\nQ2\n\n" + P.LCB_WITHOUT_STARTER + P.LCB_ANSWER


def test_crux_prompts(spark):
    df = spark.createDataFrame([(1, "def f(x): return x", "2", "3")], "id int, code string, input string, output string")
    direct = P.crux_prompts(df)
    assert [r["mode"] for r in direct.orderBy("mode").collect()] == ["input", "output"]
    got = direct.where("mode = 'output'").first()["prompt"]
    assert got.startswith("You are given a Python function") and got.endswith(
        'following the examples.\n\n[PYTHON]\ndef f(n):\n    return n\nassert f(17) == ??\n[/PYTHON]\n[ANSWER]\nassert f(17) == 17\n[/ANSWER]\n\n'
        '[PYTHON]\ndef f(s):\n    return s + "a"\nassert f("x9j") == ??\n[/PYTHON]\n[ANSWER]\nassert f("x9j") == "x9ja"\n[/ANSWER]\n\n'
        '[PYTHON]\ndef f(x): return x\nassert f(2) == ??\n[/PYTHON]\n[ANSWER]\n')
    got = P.crux_prompts(df, "input", reasoning=True).first()["prompt"]
    assert got.endswith('?? should be 16. \n[/THOUGHT]\n[ANSWER]\nassert f(16) == 17\n[/ANSWER]\n\n[PYTHON]\ndef f(x): return x\nassert f(??) == 3\n[/PYTHON]\n[THOUGHT]\n')
    got = P.crux_prompts(df, "output", alternative=True, wrap=True).first()["prompt"]
    assert got.startswith("Please respond in English and use Markdown format.####Instruction:\nBased on") and got.endswith(
        ' # done\n\ndef f(x): return x\nassert f(2) ==\nResponse:\n')
