"""Prompt tables.

Templates and instructions are fixed values held as literal map columns, so a
per-row locale / language lookup is a map access inside codegen, not a join.
Ordered concatenations over many rows go through ``ordered_concat``, which
splits each key into order-contiguous buckets first, so one huge group is
never collected by a single task.
"""

from __future__ import annotations

from itertools import chain

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gavel.functions.text import py_strip, split_nl


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _map(d: dict[str, str]) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in d.items()))


# ------------------------------------------------------------------ F1
# Per-locale, per-language instructions appended to contest problems.
OJ_LANGUAGE_PROMPTS = {
    "en": {
        "default": "Please implement complete executable code with an entry point in {language}. Your program should "
                   "read input from standard input and write output to standard output.",
        "cpp": "Please implement complete executable code including a main function in C++. Your program should read "
               "input from standard input and write output to standard output.",
        "python": "Please implement a complete Python script. Your program should read input from standard input and "
                  "write output to standard output.",
        "java": "Please implement a complete Java program with a public class named Main. Your class should include a "
                "public static void main(String[] args) method. Your program should read input from System.in and "
                "write output to System.out.",
    },
    "zh": {
        "default": "请使用 {language} 实现一个完整的可执行程序，包含程序入口。你的程序应该从标准输入读取数据，并将结果输出到标准输出。",
        "cpp": "请使用 C++ 实现一个完整的可执行程序，包含 main 函数。你的程序应该从标准输入读取数据，并将结果输出到标准输出。",
        "python": "请编写一个完整的 Python 脚本。你的程序应该从标准输入读取数据，并将结果输出到标准输出。",
        "java": "请实现一个完整的 Java 程序，包含一个名为 Main 的公共类。你的类中应包含 public static void main(String[] args) "
                "方法。你的程序应该从 System.in 读取输入，并将结果输出到 System.out。",
    },
}


def oj_prompt(content, locale, language) -> Column:
    """Problem text + language instruction; locale falls back to en, language to default (F1)."""
    loc, lang = _c(locale), _c(language)
    flat = {f"{lo}|{la}": t for lo, d in OJ_LANGUAGE_PROMPTS.items() for la, t in d.items()}
    m = _map(flat)
    eff_loc = F.when(loc.isin(*OJ_LANGUAGE_PROMPTS), loc).otherwise(F.lit("en"))
    tmpl = F.coalesce(F.element_at(m, F.concat(eff_loc, F.lit("|"), lang)),
                      F.element_at(m, F.concat(eff_loc, F.lit("|default"))))
    return F.concat(_c(content), F.lit("\n\n"), F.replace(tmpl, F.lit("{language}"), lang))


# ------------------------------------------------------------------ F2
# Freeform completion instructions.
FREEFORM_INSTRUCTION = {
    "zh": "请按照docstring的要求补全如上代码，写出完整的代码，代码要用markdown语法包裹。代码不要包含`Main`函数",
    "en": "Please complete the above code according to the requirements in the docstring. Write the complete code and "
          "wrap it in markdown syntax. The code should not contain `Main` function.",
}


def freeform_prompt(prompt, language, locale) -> Column:
    """Fenced prompt + instruction (F2); the language is cut at its first dot."""
    lang = F.split_part(_c(language), F.lit("."), F.lit(1))
    instr = F.when(_c(locale) == "zh", F.lit(FREEFORM_INSTRUCTION["zh"])).otherwise(F.lit(FREEFORM_INSTRUCTION["en"]))
    return F.concat(F.lit("```"), lang, F.lit("\n"), _c(prompt), F.lit("\n```\n\n"), instr)


# ------------------------------------------------------------------ F11 / F12
# Chat templates (role start / end markers, default system message).
CHAT_TEMPLATES = {
    "chatml": {
        "start": {"system": "<|im_start|>system\n", "user": "<|im_start|>user\n",
                  "assistant": "<|im_start|>assistant\n"},
        "end": {"system": "<|im_end|>\n", "user": "<|im_end|>\n", "assistant": "<|im_end|>\n"},
        "system": "",
    },
    "chatml_qwen3": {
        "start": {"system": "<|im_start|>system\n", "user": "<|im_start|>user\n",
                  "assistant": "<|im_start|>assistant\n"},
        "end": {"system": "<|im_end|>\n", "user": "<|im_end|>\n", "assistant": "<|im_end|>\n"},
        "system": "You are a helpful and harmless assistant. You are Qwen developed by Alibaba. "
                  "You should think step-by-step.",
    },
    "deepseek": {
        "start": {"system": "<｜begin▁of▁sentence｜>", "user": "<｜User｜>", "assistant": "<｜Assistant｜>"},
        "end": {"system": "", "user": "", "assistant": "<｜end▁of▁sentence｜>"},
        "system": "",
    },
    "llama-3-instruct": {
        "start": {"system": "<|start_header_id|>system<|end_header_id|>\n\n",
                  "user": "<|start_header_id|>user<|end_header_id|>\n\n",
                  "assistant": "<|start_header_id|>assistant<|end_header_id|>\n\n"},
        "end": {"system": "<|eot_id|>", "user": "<|eot_id|>", "assistant": "<|eot_id|>"},
        "system": "",
    },
}


def render_message(role, text, template: str = "chatml") -> Column:
    t = CHAT_TEMPLATES[template]
    return F.concat(F.element_at(_map(t["start"]), _c(role)), _c(text), F.element_at(_map(t["end"]), _c(role)))


def render_prompt(user_text, template: str = "chatml", think: bool = False) -> Column:
    """Single-turn prompt: optional system, user, assistant opener, optional think opener."""
    t = CHAT_TEMPLATES[template]
    parts = []
    if t["system"]:
        parts += [F.lit(t["start"]["system"] + t["system"] + t["end"]["system"])]
    parts += [F.lit(t["start"]["user"]), _c(user_text), F.lit(t["end"]["user"]), F.lit(t["start"]["assistant"])]
    if think:
        parts.append(F.lit("<think>\n"))
    return F.concat(*parts)


def ordered_concat(df: DataFrame, key: str, order_col: str, text_col: str, sep: str = "",
                   fanout: int = 1024, out: str = "text") -> DataFrame:
    """Concatenate ``text_col`` per key in ``order_col`` order, in two stages.

    Stage 1 groups by (key, order // fanout), so a key with very many rows is
    spread over many tasks; stage 2 joins at most one part per bucket.
    ``order_col`` must be an integer position.
    """
    b = df.select(key, order_col, text_col, F.floor(F.col(order_col) / fanout).alias("__b"))
    parts = b.groupBy(key, "__b").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order_col, text_col))),
                                 lambda x: x[text_col]), sep).alias("__p"))
    return parts.groupBy(key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__b", "__p"))), lambda x: x["__p"]), sep)
        .alias(out))


def render_chat(messages: DataFrame, key: str = "conv_id", order_col: str = "turn", role_col: str = "role",
                text_col: str = "text", template: str = "chatml", think: bool = False) -> DataFrame:
    """Multi-turn rendering (F11): messages in order, then the assistant opener."""
    t = CHAT_TEMPLATES[template]
    m = messages.withColumn("__m", render_message(F.col(role_col), F.col(text_col), template))
    body = ordered_concat(m, key, order_col, "__m", out="__body")
    tail = t["start"]["assistant"] + ("<think>\n" if think else "")
    head = (t["start"]["system"] + t["system"] + t["end"]["system"]) if t["system"] else ""
    return body.select(key, F.concat(F.lit(head), F.col("__body"), F.lit(tail)).alias("prompt"))


def _segment(prompt: Column, start: str, end: str | None) -> Column:
    """Text between the first ``start`` and the next ``end`` (or the end), stripped; '' when absent."""
    pos = F.instr(prompt, start)
    begin = pos + len(start)
    rest = F.substring(prompt, begin, 1 << 30)
    if end:
        e = F.instr(rest, end)
        body = F.when(e > 0, F.substring(rest, F.lit(1), e - 1)).otherwise(rest)
    else:
        body = rest
    return F.when(pos > 0, py_strip(body)).otherwise(F.lit(""))


def parse_chat(prompt, template: str = "chatml") -> Column:
    """Rendered prompt back to messages ``array<struct<role, content>>`` (F12):
    first system segment and first user segment, empty ones left out."""
    t = CHAT_TEMPLATES[template]
    p = _c(prompt)
    sys_c = _segment(p, t["start"]["system"], t["end"]["system"] or t["start"]["user"])
    usr_c = _segment(p, t["start"]["user"], t["end"]["user"] or t["start"]["assistant"])
    msgs = F.array(F.struct(F.lit("system").alias("role"), sys_c.alias("content")),
                   F.struct(F.lit("user").alias("role"), usr_c.alias("content")))
    return F.filter(msgs, lambda m: m["content"] != "")


# ------------------------------------------------------------------ F10
def context_pack(df: DataFrame, key: str, order_col: str, text_col: str, size_col: str, budget: int,
                 base_size: int = 0) -> DataFrame:
    """Context packing over a pool (F10, V7 form): snippets in ``order_col`` order
    until the budget would overflow, then stop (not skip); kept snippets ordered by
    MD5 and concatenated.

    Only snippets of a positive size use up the budget, and ``budget + 1`` of them
    overflow it for certain: their ``row_number()`` filter is planned as a partial
    per-key limit before the shuffle, which bounds what a hot key sends to the
    running sum.  Its first overflow is the key's cut-off for all snippets.
    """
    w = Window.partitionBy(key).orderBy(order_col)
    sized = (df.filter(F.col(size_col) > 0).select(key, order_col, size_col)
             .withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= budget + 1))
    run = sized.withColumn("__run", F.sum(size_col).over(w.rowsBetween(Window.unboundedPreceding, 0)) + base_size)
    stops = run.filter(F.col("__run") > budget).groupBy(F.col(key).alias("__key")).agg(F.min(order_col).alias("__stop"))
    kept = df.join(stops, F.col(key).eqNullSafe(F.col("__key")), "left").filter(
        (F.col("__stop").isNull() | (F.col(order_col) < F.col("__stop"))) & F.lit(base_size <= budget))
    return kept.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_snippets"),
        F.sum(size_col).alias("used"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.md5(F.col(text_col)).alias("h"),
                                                                      F.col(text_col).alias("t")))),
                                 lambda x: x["t"]), "").alias("context"))


def context_pack_row(snippets: Column, gold_idx: Column, code: Column, code_size: Column, budget: int) -> Column:
    """Per-row context packing (F10, reference form).

    ``snippets`` is ``array<struct<text string, size int>>``: the gold snippet goes
    first when its index is > 0, then the others in order until one would
    overflow; kept snippets are ordered by MD5 and prepended to the code (kept to
    its last 60 lines).
    """
    lines = split_nl(code)
    tail = F.array_join(F.slice(lines, F.greatest(F.size(lines) - 59, F.lit(1)), 60), "\n")
    gold = F.try_element_at(snippets, gold_idx + 1)
    use_gold = (gold_idx > 0) & gold.isNotNull()
    init = F.struct(F.when(use_gold, code_size + gold["size"]).otherwise(code_size).alias("size"),
                    F.lit(False).alias("stop"),
                    F.when(use_gold, F.array(gold["text"])).otherwise(F.array().cast("array<string>")).alias("kept"))

    def step(acc, x):
        i, s = x["i"], x["s"]
        skip = i == gold_idx
        over = (s["size"] + acc["size"]) > budget
        return (F.when(acc["stop"] | skip, acc)
                .when(over, F.struct(acc["size"].alias("size"), F.lit(True).alias("stop"), acc["kept"].alias("kept")))
                .otherwise(F.struct((acc["size"] + s["size"]).alias("size"), F.lit(False).alias("stop"),
                                    F.concat(acc["kept"], F.array(s["text"])).alias("kept"))))

    indexed = F.transform(snippets, lambda s, i: F.struct(i.alias("i"), s.alias("s")))
    st = F.aggregate(indexed, init, step)
    ordered = F.transform(F.array_sort(F.transform(st["kept"], lambda t: F.struct(F.md5(t).alias("h"),
                                                                                    t.alias("t")))),
                          lambda x: x["t"])
    return F.concat(F.array_join(ordered, ""), tail)


# ------------------------------------------------------------------ F13 / F14 / F15
def clip_text(text, head: int = 8000, tail: int = 1000, tag: str = "problem_to_be_classified") -> Column:
    """Stripped text; longer than ``head`` -> head + marker + tail; wrapped in tags."""
    s = py_strip(_c(text))
    clipped = F.when(F.length(s) > head,
                     F.concat(F.substring(s, 1, head), F.lit("...[TRUNCATED]\n"), F.right(s, F.lit(tail)))
                     ).otherwise(s)
    return F.concat(F.lit(f"<{tag}>\n"), clipped, F.lit(f"\n</{tag}>"))


# Tag and closing instruction of the prompt for a judge program.
JUDGE_TAG = "problem_that_require_special_judging"
JUDGE_REQUEST = "\n\nNow, write the python code for judging the correctness of the answer output.\n"


def judge_program_prompt(text) -> Column:
    """Prompt for a judge program: the text clipped at 12000 characters, and the request (F13, second form)."""
    return F.concat(clip_text(text, 12000, 1000, JUDGE_TAG), F.lit(JUDGE_REQUEST))


# Labels of a question and its answer, and what parts the shots.
SHOT_QUESTION, SHOT_ANSWER, SHOT_DELIMITER = "问题:\n", "\n答案:\n", "---\n"


def fewshot_prompt(shots: Sequence[tuple[str, str]], question) -> Column:
    """Fixed (prompt, response) shots with labels, then the question with its answer left open."""
    shown = [F.lit(SHOT_QUESTION + q + SHOT_ANSWER + a + "\n") for q, a in shots]
    return F.array_join(F.array(*shown, F.concat(F.lit(SHOT_QUESTION), _c(question), F.lit(SHOT_ANSWER))), SHOT_DELIMITER)


def completion_budget(prompt_tokens, max_tokens, context_len) -> Column:
    """``min(max_tokens, max(1, context - prompt tokens))``; unchanged when unknown."""
    pt, mt, cl = _c(prompt_tokens), _c(max_tokens), _c(context_len)
    return F.when(cl.isNull() | (cl == 0) | pt.isNull(), mt).otherwise(
        F.least(mt, F.greatest(F.lit(1), cl - pt)))


# ------------------------------------------------------------------ F4 / F5
# Question / answer hints, wrap-prompt texts and the separator.
QA_HINTS = {"zh": ("问题：", "答案："), "en": ("Question:", "Answer:")}
WRAP_PROMPT = {"zh": ("请用中文回答，并用Markdown格式。####Instruction:", "Response:"),
               "en": ("Please answer in English with Markdown format. ####Instruction:", "Response:")}
SECTION_SEP = "----------------"


def _present(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def layout_prompt(question, context, fewshot, language: str = "en", wrap: bool = False) -> Column:
    """Context / few-shot / question in four layouts with zh or en hints, optional wrapper (F4, F5 default)."""
    q, ctx, fs = _c(question), _c(context), _c(fewshot)
    qh, ah = QA_HINTS[language]
    wi, wr = WRAP_PROMPT[language]
    both = F.concat(ctx, F.lit(f"\n\n{SECTION_SEP}\n\n"), fs, F.lit(f"\n\n{qh}"), q, F.lit(f"\n\n{ah}\n"))
    ctx_only = (F.concat(ctx, F.lit(f"\n\n{wi}\n"), q, F.lit(f"\n{wr}\n")) if wrap
                else F.concat(ctx, F.lit(f"\n\n{qh}"), q, F.lit(f"\n\n{ah}\n")))
    fs_only = F.concat(fs, F.lit(f"\n\n{qh}"), q, F.lit(f"\n\n{ah}\n"))
    bare = F.concat(F.lit(f"{wi}\n"), q, F.lit(f"\n{wr}\n")) if wrap else q
    return (F.when(_present(ctx) & _present(fs), both).when(_present(ctx), ctx_only)
            .when(_present(fs), fs_only).otherwise(bare))


def choose_fewshot(task_id, labels_fewshot, custom: dict[str, str] | None) -> Column:
    """Few-shot text by task type (``task_id`` before '/'), then 'default', then the
    row's labels, else the job fails as the reference does (F4)."""
    custom = custom or {}
    task_type = F.split_part(_c(task_id), F.lit("/"), F.lit(1))
    pick = _map(custom)[task_type] if custom else F.lit(None).cast("string")
    out = F.coalesce(pick, F.lit(custom["default"]) if "default" in custom else F.lit(None).cast("string"),
                     _c(labels_fewshot))
    return F.coalesce(out, F.raise_error(F.concat(F.lit("Missing fewshot of "), _c(task_id))).cast("string"))




def fill_template(template, values: dict[str, Column]) -> Column:
    """``string.Template(t).safe_substitute(**values)`` (F5): ``$name`` and
    ``${name}`` are replaced, ``$$`` becomes ``$``, unknown names stay as written.

    Tokens are first swapped for private-use markers, so text inside an inserted
    value is never substituted again.
    """
    out = F.replace(_c(template), F.lit("$$"), F.lit("\ue0ff"))
    names = list(values)
    for i, k in enumerate(names):
        out = F.regexp_replace(out, r"\$(?:\{" + k + r"\}|" + k + r"(?![_a-zA-Z0-9]))", chr(0xE000 + i))
    for i, k in enumerate(names):
        out = F.replace(out, F.lit(chr(0xE000 + i)), F.coalesce(values[k], F.lit("")))
    return F.replace(out, F.lit("\ue0ff"), F.lit("$"))


def autoeval_prompt(question, template, context, fewshot, locale: str = "en") -> Column:
    """Template substitution when a template is given, else the default layout."""
    filled = fill_template(template, {"question": _c(question), "fewshot": _c(fewshot), "context": _c(context),
                                      "locale": F.lit(locale)})
    return F.when(_present(_c(template)), filled).otherwise(layout_prompt(question, context, fewshot, locale))


# ------------------------------------------------------------------ F3
# The three MBPP few-shot examples placed before the task.
MBPP_FEWSHOT = [
    "You are an expert Python programmer, and here is your task: Write a function to find the similar elements from "
    "the given two tuple lists. Your code should pass these tests:\n\nassert similar_elements((3, 4, 5, 6),(5, 7, 4, "
    "10)) == (4, 5)\nassert similar_elements((1, 2, 3, 4),(5, 4, 3, 7)) == (3, 4)\nassert similar_elements((11, 12, "
    "14, 13),(17, 15, 14, 13)) == (13, 14)\n[BEGIN]\ndef similar_elements(test_tup1, test_tup2):\r\n  res = "
    "tuple(set(test_tup1) & set(test_tup2))\r\n  return (res)\n[DONE]",
    "You are an expert Python programmer, and here is your task: Write a python function to identify non-prime "
    "numbers. Your code should pass these tests:\n\nassert is_not_prime(2) == False\nassert is_not_prime(10) == "
    "True\nassert is_not_prime(35) == True\n[BEGIN]\nimport math\r\ndef is_not_prime(n):\r\n    result = False\r\n"
    "    for i in range(2,int(math.sqrt(n)) + 1):\r\n        if n % i == 0:\r\n            result = True\r\n"
    "    return result\n[DONE]",
    "You are an expert Python programmer, and here is your task: Write a function to find the largest integers from "
    "a given list of numbers using heap queue algorithm. Your code should pass these tests:\n\nassert "
    "heap_queue_largest( [25, 35, 22, 85, 14, 65, 75, 22, 58],3)==[85, 75, 65] \nassert heap_queue_largest( [25, 35, "
    "22, 85, 14, 65, 75, 22, 58],2)==[85, 75]\nassert heap_queue_largest( [25, 35, 22, 85, 14, 65, 75, 22, 58],5)=="
    "[85, 75, 65, 58, 35]\n[BEGIN]\nimport heapq as hq\r\ndef heap_queue_largest(nums,n):\r\n  largest_nums = "
    "hq.nlargest(n, nums)\r\n  return largest_nums\n[DONE]",
]
MBPP_TASK_HEAD = "You are an expert Python programmer, and here is your task: "
MBPP_TASK_TESTS = " Your code should pass these tests:\n\n"


def mbpp_prompt(content, tests, fewshot: bool = False) -> Column:
    """MBPP prompt (F3): with all tests, or few-shot (three fixed examples, first two tests, [BEGIN])."""
    c, t = _c(content), _c(tests)
    if not fewshot:
        return F.concat(F.lit(MBPP_TASK_HEAD), c, F.lit(MBPP_TASK_TESTS), F.array_join(t, "\n"))
    return F.concat(F.lit("\n".join(MBPP_FEWSHOT) + "\n" + MBPP_TASK_HEAD), c, F.lit(MBPP_TASK_TESTS),
                    F.try_element_at(t, F.lit(1)), F.lit("\n"), F.try_element_at(t, F.lit(2)),
                    F.lit("\n[BEGIN]\n"))


# ------------------------------------------------------------------ F6
def mhpp_prompt(content, tests) -> Column:
    """MHPP prompt (F6): cut before the last docstring close (Python ``s[:s.rfind('\"\"\"')]``,
    which drops the last character when absent) and append the first test line as an example."""
    c = _c(content)
    q = '"""'
    hit = F.instr(F.reverse(c), q)
    cut = F.when(hit > 0, F.substring(c, F.lit(1), F.length(c) - hit - 2)) \
        .otherwise(F.substring(c, F.lit(1), F.greatest(F.length(c) - 1, F.lit(0))))
    first = F.split_part(_c(tests), F.lit("\n"), F.lit(1))
    return F.concat(cut, F.lit("\n    e.g. "), first, F.lit(' """'))


# ------------------------------------------------------------------ F7 (CruxEval)
# Instructions, and shots of (code, what is asked, thought, answer); every shot's thought is shown in
# the reasoning form only.
_COMPLETE_OUTPUT = (
    "You are given a Python function and an assertion containing an input to the function. Complete the assertion with a "
    "literal (no unsimplified expressions, no function calls) containing the output when executing the provided code on the "
    "given input, even if the function is incorrect or incomplete. Do NOT output any extra information. ")
CRUX_FORMS = {
    ("output", "direct"): (
        _COMPLETE_OUTPUT + "Provide the full assertion with the correct output in [ANSWER] and [/ANSWER] tags, following the examples.",
        [("def f(n):\n    return n", "assert f(17) == ??", None, "assert f(17) == 17"),
         ('def f(s):\n    return s + "a"', 'assert f("x9j") == ??', None, 'assert f("x9j") == "x9ja"')]),
    ("output", "reasoning"): (
        _COMPLETE_OUTPUT + "Execute the program step by step before arriving at an answer, and provide the full assertion with the "
        "correct output in [ANSWER] and [/ANSWER] tags, following the examples.",
        [('def f(s):\n    s = s + s\n    return "b" + s + "a"', 'assert f("hi") == ??',
          "Let's execute the code step by step:\n\n1. The function f is defined, which takes a single argument s.\n"
          '2. The function is called with the argument "hi", so within the function, s is initially "hi".\n'
          '3. Inside the function, s is concatenated with itself, so s becomes "hihi".\n'
          '4. The function then returns a new string that starts with "b", followed by the value of s (which is now "hihi"), and '
          'ends with "a".\n5. The return value of the function is therefore "bhihia".',
          'assert f("hi") == "bhihia"')]),
    ("input", "direct"): (
        "You will be given a function f and an output in the form f(??) == output. Find any input such that executing f on the input "
        "leads to the given output. There may be multiple answers, but you should only output one. In [ANSWER] and [/ANSWER] tags, "
        "complete the assertion with one such input that will produce the output when executing the function.",
        [("def f(my_list):\n    count = 0\n    for i in my_list:\n        if len(i) % 2 == 0:\n            count += 1\n    return count",
          "assert f(??) == 3", None, 'assert f(["mq", "px", "zy"]) == 3'),
         ("def f(s1, s2):\n    return s1 + s2", 'assert f(??) == "banana"', None, 'assert f("ba", "nana") == "banana"')]),
    ("input", "reasoning"): (
        "You will be given a function f and an output in the form f(??) == output. Your task is to find any input such that executing "
        "f on the input leads to the given output. There may be multiple answers, but only output one. First, think step by step. You "
        "MUST surround the answer with [ANSWER] and [/ANSWER] tags. Express your answer as a passing assertion containing the input "
        "and the given output.",
        [("def f(x):\n    return x + 1", "assert f(??) == 17",
          "To find an input such that executing f on the input leads to the given output, we can work backwards from the given "
          "assertion. We know that f(??) == 17. \n\nSince the function f(x) returns x + 1, for f(??) to be equal to 17, the value of "
          "?? should be 16. ", "assert f(16) == 17")]),
}
CRUX_ALTERNATIVE = (
    "Based on the given Python code, which may contain errors, complete the assert statement with the output when executing the code "
    "on the given test case. Do NOT output any extra information, even if the function is incorrect or incomplete. Output \"# done\" "
    "after the assertion.\n\ndef f(n):\n    return n\nassert f(17) == 17 # done\n\ndef f(s):\n    return s + \"a\"\n"
    "assert f(\"x9j\") == \"x9ja\" # done\n\n")
CRUX_WRAP = ("Please respond in English and use Markdown format.####Instruction:", "Response:")


def _crux_lead(mode: str, form: str) -> str:
    """Instruction and shots, up to the row's own code."""
    instruction, shots = CRUX_FORMS[mode, form]
    parts = [instruction + "\n"]
    for code, asked, thought, answer in shots:
        parts.append(f"[PYTHON]\n{code}\n{asked}\n[/PYTHON]\n" + (f"[THOUGHT]\n{thought}\n[/THOUGHT]\n" if thought else "")
                     + f"[ANSWER]\n{answer}\n[/ANSWER]\n")
    return "\n".join([*parts, "[PYTHON]\n"])


def crux_prompts(problems: DataFrame, mode: str | None = None, reasoning: bool = False, alternative: bool = False,
                 wrap: bool = False) -> DataFrame:
    """CruxEval prompts (F7) with their ``mode``; without a mode the input prompts and the output prompts.

    ``problems`` has code, input and output.  ``alternative`` changes the output
    prompt of the direct form.
    """
    def prompt(m: str) -> Column:
        form = "reasoning" if reasoning else "direct"
        given = F.concat(F.lit("assert f(??) == "), "output") if m == "input" else F.concat(F.lit("assert f("), "input", F.lit(") == ??"))
        if m == "output" and alternative and not reasoning:
            out = F.concat(F.lit(CRUX_ALTERNATIVE), "code", F.lit("\nassert f("), "input", F.lit(") =="))
        else:
            tail = "\n[/PYTHON]\n[THOUGHT]\n" if reasoning else "\n[/PYTHON]\n[ANSWER]\n"
            out = F.concat(F.lit(_crux_lead(m, form)), "code", F.lit("\n"), given, F.lit(tail))
        return F.concat(F.lit(CRUX_WRAP[0] + "\n"), out, F.lit(f"\n{CRUX_WRAP[1]}\n")) if wrap else out

    modes = [mode] if mode else ["input", "output"]
    each = F.array(*(F.struct(F.lit(m).alias("mode"), prompt(m).alias("prompt")) for m in modes))
    return problems.select("*", F.explode(each).alias("__p")).select(*problems.columns, "__p.mode", "__p.prompt")


# ------------------------------------------------------------------ C8 / F7 (CruxEval-X)
# How each language spells the call whose argument is hidden.
CRUX_CALL = {
    "cpp": "candidate(????)", "csharp": "F(????)", "D_ut": "candidate(????)", "go_test": "candidate(????)",
    "java": "f(????)", "julia": "candidate(????)", "nodejs": "candidate(????)", "lua": "candidate(????)",
    "php": "candidate(????)", "python": "candidate(????)", "perl": "$candidate->(????)", "R": "candidate(????)",
    "ruby": "candidate.call(????)", "racket": "(candidate ????)", "rust": "candidate(????)", "scala": "f(????)",
    "bash": "$(candidate ????)", "swift": "f(????)", "typescript": "candidate(????)",
}
# The two CruxEval-X instructions, split around the language name.
CRUX_INPUT_HEAD = ("You will be given a ", " function f and a check function, where you only know the output of the "
                   "test case. Find any input such that executing f on the input leads to the given output. There may "
                   "be multiple answers, but you should only output one. Think step by step before arriving at an "
                   "answer. Finally, surround the answer, with no additional words, with [ANSWER] and [/ANSWER] tags. "
                   "Express your answer as a function call that when executed will give the output. \n    Make Sure "
                   "The answer is WRAPPED in the format: [ANSWER] <your answer> [/ANSWER].\n\n")
CRUX_OUTPUT_HEAD = ("Based on the given code, which may contain errors, complete the \"????\" in assert statement with "
                    "the output when executing the ", " code on the given test case. Do NOT output any extra "
                    "information, even if the function is incorrect or incomplete. Do NOT output a description for "
                    "the assert.\n    Make Sure The answer is WRAPPED in the format: [ANSWER] <your answer> "
                    "[/ANSWER].\n\n")


def crux_examples(examples: DataFrame, mode: str, lang_col: str = "language", order_col: str = "idx",
                  code_col: str = "code", inputs_col: str = "inputs", outputs_col: str = "outputs") -> DataFrame:
    """Few-shot examples per language concatenated in order.

    Each example hides its input (input mode: replaced by the language's call
    spelling) or its output (output mode: replaced by ``????``) and shows the
    answer in [ANSWER] tags.  Concatenation goes through ``ordered_concat``.
    """
    from gavel.functions.text import py_rstrip
    lang = F.col(lang_col)
    if mode == "input":
        hidden = F.replace(F.col(code_col), F.col(inputs_col), F.element_at(_map(CRUX_CALL), lang))
        answer = F.col(inputs_col)
    else:
        hidden = F.replace(F.col(code_col), F.col(outputs_col), F.lit("????"))
        answer = F.col(outputs_col)
    block = F.concat(F.lit("```"), lang, F.lit("\n"), py_strip(hidden), F.lit("\n```\n[ANSWER]\n"), answer,
                     F.lit("\n[/ANSWER]\n"))
    joined = ordered_concat(examples.select(lang.alias("language"), F.col(order_col).alias("__o"),
                                            block.alias("__blk")), "language", "__o", "__blk", out="examples")
    return joined.select("language", py_rstrip(F.col("examples")).alias("examples"))


def crux_x_prompts(problems: DataFrame, examples: DataFrame, modes: Sequence[str] = ("input", "output"), id_col: str = "id",
                   code_col: str = "code", given_col: str = "given") -> DataFrame:
    """CruxEval-X prompts (F7, x variant), a column ``<mode>_prompt`` per mode: language from the
    id (all but the last ``_`` part), per-language examples joined in, code + given shown.
    A language without examples fails the job."""
    out = problems.withColumn("language", F.regexp_extract(F.col(id_col), r"^(.*)_[^_]*$", 1))
    heads = {"input": CRUX_INPUT_HEAD, "output": CRUX_OUTPUT_HEAD}
    for mode in modes:
        shots = f"__{mode}_shots"
        out = out.join(crux_examples(examples, mode).withColumnRenamed("examples", shots), "language", "left")
        shown = F.coalesce(shots, F.raise_error(F.concat(F.lit("no examples for language "), "language")).cast("string"))
        out = out.withColumn(f"{mode}_prompt", F.concat(
            F.lit(heads[mode][0]), F.col("language"), F.lit(heads[mode][1]), shown, F.lit("\n```"),
            F.col("language"), F.lit("\n"), F.col(code_col), F.col(given_col), F.lit("\n```\n"))).drop(shots)
    return out


# ------------------------------------------------------------------ F8
# The answer formats of contest prompts.
LCB_WITH_STARTER = ("### Format: You will use the following starter code to write the solution to the problem and "
                    "enclose your code within delimiters.\n```python\n")
LCB_WITHOUT_STARTER = ("### Format: Read the inputs from stdin solve the problem and write the answer to stdout (do not "
                       "directly test on the sample inputs). Enclose your code within delimiters as follows.\n"
                       "```python\n```")
LCB_ANSWER = "\n\n### Answer: (use the provided format with backticks)\n"


def lcb_fewshot_prompt(prompt, prefix: str) -> Column:
    """Contest few-shot prompt (F8): the question and starter code are parsed out
    of a zero-shot prompt and re-emitted after ``prefix`` (the few-shot examples,
    a job parameter).  A prompt without both sections fails the job, as in the reference."""
    p = _c(prompt)
    q = F.regexp_extract_all(p, F.lit(r"(?s)### Question:\n(.*)\n\n### Format:"), 1)
    sc = F.regexp_extract_all(p, F.lit(r"(?s)### Format: .*\n```python\n(.*)\n```\n\n"), 1)
    question = F.try_element_at(q, F.lit(1))
    starter = F.try_element_at(sc, F.lit(1))
    body = F.when(starter == "# YOUR CODE HERE", F.lit(LCB_WITHOUT_STARTER)).otherwise(
        F.concat(F.lit(LCB_WITH_STARTER), starter, F.lit("\n```")))
    out = F.concat(F.lit(prefix), question, F.lit("\n\n"), body, F.lit(LCB_ANSWER))
    return F.when(question.isNotNull() & starter.isNotNull(), out).otherwise(
        F.raise_error(F.lit("prompt has no question / format section")).cast("string"))


# ------------------------------------------------------------------ F9
AIDER_WRAP = ("Please answer in English with Markdown format. Below is the problem:", "Your response here:")


def aider_prompt(question, reference, wrap: bool = False) -> Column:
    """Aider prompt (F9): question, then the reference signature in a python fence; optional wrapper."""
    p = F.concat(F.lit("\n"), _c(question), F.lit("\n\nPlease generate the code in the following format:\n```python\n"),
                 _c(reference), F.lit("\n```\n"))
    if wrap:
        p = F.concat(F.lit(AIDER_WRAP[0] + "\n"), p, F.lit("\n" + AIDER_WRAP[1] + "\n"))
    return p


def verilog_prompt(code_preface, description, system_prompt, question_prompt, fewshot=None) -> Column:
    """Verilog prompt (F9), with an optional few-shot block and answer slot."""
    body = F.concat(_c(system_prompt), F.lit("\n"), _c(question_prompt), F.lit("\n"), _c(description),
                    F.lit("\n```verilog\n"), _c(code_preface), F.lit("```"))
    if fewshot is None:
        return body
    fs = _c(fewshot)
    with_fs = F.concat(fs, F.lit(f"\n\n{SECTION_SEP}\n\nQuestion:\n"), body, F.lit("\n\nAnswer:"))
    return F.when(_present(fs), with_fs).otherwise(body)


# Lean4 instruction per locale.
LEAN_PREFIX = {"zh": "请使用 Lean4 完成下面的证明：", "en": "Please finish the following theorem in Lean4:"}


def lean_prompt(content, locale: str = "zh-CN") -> Column:
    """Lean prompt (F9) without a template: instruction, then the theorem in a lean fence."""
    prefix = LEAN_PREFIX["en"] if locale == "en" else LEAN_PREFIX["zh"]
    return F.concat(F.lit(prefix + "\n\n```lean\n"), _c(content), F.lit("\n```"))


def template_fields(template: str) -> list[str]:
    """Column names a ``str.format`` template refers to (parsed once, on the driver)."""
    import re
    return re.findall(r"{(\w+)}", template)


def format_template(template: str, df: DataFrame) -> Column:
    """``template.format_map(row)`` for the fields it names (F9 with a template);
    ``{{`` / ``}}`` are literal braces."""
    out = F.lit(template.replace("{{", "\ue0fd").replace("}}", "\ue0fe"))
    for i, f in enumerate(template_fields(template)):
        out = F.replace(out, F.lit("{" + f + "}"), F.lit(chr(0xE000 + i)))
    for i, f in enumerate(template_fields(template)):
        out = F.replace(out, F.lit(chr(0xE000 + i)), F.col(f).cast("string"))
    return F.replace(F.replace(out, F.lit("\ue0fd"), F.lit("{")), F.lit("\ue0fe"), F.lit("}"))
