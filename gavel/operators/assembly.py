"""Program assembly: the table of programs an external executor runs.

Each function returns a Column so that several profiles can be assembled in
one projection; language and mode are job parameters, so only the selected
branch is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gavel.functions.pyrepr import py_repr_json, py_str_repr
from gavel.functions.text import py_lstrip, py_strip

INSERT_TOKEN = "#<INSERT>"

# Anti-abuse headers placed before user code.
PY_ANTIHACK_HEADER = """
# --- anti-hack code begin
import os
import sys
exit = None
os._exit = None
sys.exit = None
# --- anti-hack code end
"""

CPP_ANTIHACK_HEADER = """
// --- anti-hack code begin
#include <cstdlib>

void exit(int) {
    std::abort();
}
// --- anti-hack code end
"""

ANTIHACK_HEADERS = {"python": PY_ANTIHACK_HEADER, "cpp": CPP_ANTIHACK_HEADER}

# Import lines prepended to completion-style test programs.
IMPORT_PREAMBLE = {
    "python": ["import math", "import re", "import sys", "import copy", "import datetime", "import itertools",
               "import collections", "import heapq", "import statistics", "import functools", "import hashlib",
               "import numpy", "import numpy as np", "import string", "from typing import *",
               "from collections import *"],
    "cpp": ["using namespace std;", "#include<optional>", "#include<cassert>", "#include<stdlib.h>",
            "#include<algorithm>", "#include<cmath>", "#include<math.h>", "#include<numeric>", "#include<stdio.h>",
            "#include<vector>", "#include<set>", "#include<map>", "#include<queue>", "#include<stack>",
            "#include<list>", "#include<deque>", "#include<boost/any.hpp>", "#include<string>", "#include<climits>",
            "#include<cstring>", "#include<iostream>", "#include<sstream>", "#include<fstream>"],
    "java": ["import java.util.*;", "import java.lang.reflect.*;", "import org.javatuples.*;",
             "import java.security.*;", "import java.math.*;", "import java.io.*;", "import java.util.stream.*;"],
    "csharp": ["using System;", "using System.Numerics;", "using System.Diagnostics;",
               "using System.Collections.Generic;", "using System.Linq;", "using System.Text;",
               "using System.Security.Cryptography;", "using System.Collections.Generic;"],
    "go": ['import ("fmt")'],
    "d": ["import std.array;", "import std.algorithm;"],
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ------------------------------------------------------------------ E1
def append_test(code, test, as_repr: bool = False) -> Column:
    """Insert code at ``#<INSERT>`` (text between the first and second marker
    only); without a marker cut the code at the main guard and append the test (E1).
    ``as_repr``: the code goes in as a Python string literal."""
    c, t = _c(code), _c(test)
    spelled = py_str_repr if as_repr else (lambda x: x)
    has = F.instr(t, INSERT_TOKEN) > 0
    inserted = F.concat(F.split_part(t, F.lit(INSERT_TOKEN), F.lit(1)), spelled(c),
                        F.split_part(t, F.lit(INSERT_TOKEN), F.lit(2)))
    guard = F.instr(c, "if __name__ ==")
    cut = F.when(guard > 0, F.substring(c, F.lit(1), guard - 1)).otherwise(c)
    return F.when(has, inserted).otherwise(F.concat(spelled(cut), F.lit("\n"), t))


# ------------------------------------------------------------------ E2
def go_hoist_imports(code) -> Column:
    """Go: collect distinct packages and imports, remove them, re-emit at the top.

    The reference emits them in set order (undefined); here they are sorted.
    """
    c = _c(code)
    packages = F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(r"package\s+(\w+)"), 1)))
    single = F.regexp_extract_all(c, F.lit(r'import\s+("\w+")'), 1)
    multi = F.flatten(F.transform(F.regexp_extract_all(c, F.lit(r"(?s)import\s+\((.*?)\)"), 1),
                                  lambda blk: F.transform(F.split(blk, "\n", -1), lambda x: py_strip(x))))
    imports = F.array_sort(F.array_except(F.concat(single, multi), F.array(F.lit(""))))
    body = F.regexp_replace(c, r"package\s+(\w+)", "")
    body = F.regexp_replace(body, r'import\s+("\w+")', "")
    body = F.regexp_replace(body, r"(?s)import\s+\((.*?)\)", "")
    return F.concat(F.array_join(F.transform(packages, lambda p: F.concat(F.lit("package "), p)), "\n"),
                    F.lit("\n\n"),
                    F.array_join(F.transform(imports, lambda i: F.concat(F.lit("import "), i)), "\n"),
                    F.lit("\n\n"), body)


# ------------------------------------------------------------------ E3
def with_import_preamble(code, language: str) -> Column:
    """Prepend the language's import lines."""
    lines = IMPORT_PREAMBLE.get(language.split(".")[0], [])
    return F.concat(F.lit("\n".join(lines) + "\n"), _c(code))


# ------------------------------------------------------------------ E5
def mbpp_program(setup, completion, tests, fewshot: bool = False) -> Column:
    """Setup code + completion (cut at the main guard) + every test, or only the last one in few-shot mode (E5)."""
    code = F.concat_ws("\n", _c(setup), _c(completion))
    guard = F.instr(code, "if __name__ ==")
    code = F.when(guard > 0, F.substring(code, F.lit(1), guard - 1)).otherwise(code)
    t = _c(tests)
    if fewshot:
        tail = F.concat(F.lit("\n"), F.element_at(t, -1), F.lit("\n"))
    else:
        tail = F.array_join(F.transform(t, lambda x: F.concat(F.lit("\n"), x, F.lit("\n"))), "")
    return F.concat(code, F.coalesce(tail, F.lit("")))


# ------------------------------------------------------------------ E6
def mhpp_program(code_from_completion, code_from_prompt_and_completion, test) -> Column:
    """Code + test; a blank extraction retries on problem text + completion."""
    c = F.when(py_strip(_c(code_from_completion)) == "", _c(code_from_prompt_and_completion)) \
        .otherwise(_c(code_from_completion))
    return F.concat(c, F.lit("\n"), _c(test))


# ------------------------------------------------------------------ E7
def cruxeval_program(code, answer, given, mode: str) -> Column:
    """``assert answer == output`` (input mode) or ``assert answer == f(input)``."""
    if mode == "input":
        return F.concat(_c(code), F.lit("\nassert "), _c(answer), F.lit(" == "), _c(given))
    return F.concat(_c(code), F.lit("\nassert "), _c(answer), F.lit(" == f("), _c(given), F.lit(")"))


def cruxeval_x_program(code, answer, given, language, mode: str) -> Column:
    """CruxEval-X program (E7): the code and its test with the answer in place of the hidden part.

    In input mode the answer may be the bare argument or the whole call; the
    language's call is spelled around a bare one.
    """
    from gavel.operators.prompts import CRUX_CALL
    a, hidden = _c(answer), F.lit("????")
    if mode == "input":
        call = F.element_at(F.create_map(*(F.lit(x) for pair in CRUX_CALL.items() for x in pair)), _c(language))
        whole = F.contains(a, F.split_part(call, hidden, F.lit(1)))
        return F.concat(_c(code), F.replace(_c(given), call, F.when(whole, a).otherwise(F.replace(call, hidden, a))))
    return F.concat(_c(code), F.replace(_c(given), hidden, a))


# ------------------------------------------------------------------ E9
def marker_program(code, test, marker: str) -> Column:
    """Test program by marker: the test with every ``marker`` replaced by the code; without one, the test alone."""
    return F.replace(_c(test), F.lit(marker), _c(code))


def verilog_program(test, preface, completion) -> Column:
    """Verilog program: test bench, preface and completion, a line each."""
    return F.concat_ws("\n", _c(test), _c(preface), _c(completion))


def ncb_python_program(code, test) -> Column:
    """NaturalCodeBench python program: pytest import, code, test, with blank lines between."""
    return F.concat_ws("\n\n", F.lit("import pytest"), _c(code), _c(test))


# ------------------------------------------------------------------ E12
def contest_cases(public, private, functional: bool) -> Column:
    """Public then private cases; stdin cases keep text, functional ones parse
    each input / output line as JSON (E12). Cases are ``array<struct<input, output>>``."""
    cases = F.concat(F.coalesce(_c(public), F.array()), F.coalesce(_c(private), F.array()))
    if not functional:
        return F.struct(F.transform(cases, lambda c: c["input"]).alias("input"),
                        F.transform(cases, lambda c: c["output"]).alias("output"))
    return F.struct(
        F.transform(cases, lambda c: F.transform(F.split(c["input"], "\n", -1), lambda x: F.parse_json(x)))
        .alias("input"),
        F.transform(cases, lambda c: F.transform(F.split(c["output"], "\n", -1), lambda x: F.parse_json(x)))
        .alias("output"))


# ------------------------------------------------------------------ E14
def antihack_program(code, language: str) -> Column:
    """Anti-abuse header before python / cpp code; PHP gets its open tag when missing."""
    c = _c(code)
    if language in ANTIHACK_HEADERS:
        return F.concat(F.lit(ANTIHACK_HEADERS[language] + "\n\n"), c)
    if language == "php":
        s = py_lstrip(c)
        return F.when(F.startswith(s, F.lit("<?php")), s).otherwise(F.concat(F.lit("<?php\n"), s))
    return c


# ------------------------------------------------------------------ G15
def accept_judges(evals: DataFrame, key: str = "problem_id", attempt_col: str = "attempt",
                  kind_col: str = "kind", accepted_col: str = "accepted") -> DataFrame:
    """Judge-program acceptance (G15): an attempt is accepted when the gold
    solution passes and the empty one does not (missing gold -> not passed,
    missing empty -> counts as accepting); a problem is accepted when any attempt is."""
    per_attempt = (evals.groupBy(key, attempt_col)
                   .agg(F.bool_or(F.when(F.col(kind_col) == "gold", F.col(accepted_col))).alias("gold_ok"),
                        F.bool_or(F.when(F.col(kind_col) == "empty", F.col(accepted_col))).alias("empty_ok")))
    ok = F.coalesce(F.col("gold_ok"), F.lit(False)) & ~F.coalesce(F.col("empty_ok"), F.lit(True))
    return per_attempt.groupBy(key).agg(F.bool_or(ok).alias("accepted"))


# ------------------------------------------------------------------ G17 / G19
REPORT_SCHEMA = ("struct<testResults: array<struct<testFilePath: string, testResults: array<struct<"
                 "status: string, fullName: string, ancestorTitles: array<string>, title: string, "
                 "failureMessages: array<string>>>>>>")


def explode_test_report(df: DataFrame, report_col: str, keep: list[str]) -> DataFrame:
    """Test-report JSON -> one row per test: passed, full name, file, suite path, title, messages."""
    r = df.select(*keep, F.from_json(F.col(report_col), REPORT_SCHEMA).alias("__r"))
    suites = r.select(*keep, F.posexplode("__r.testResults").alias("suite_idx", "__s"))
    tests = suites.select(*keep, "suite_idx", F.col("__s.testFilePath").alias("file"),
                          F.posexplode("__s.testResults").alias("test_idx", "__t"))
    return tests.select(*keep, "suite_idx", "test_idx",
                        (F.col("__t.status") == "passed").alias("passed"),
                        F.col("__t.fullName").alias("full_name"), "file",
                        F.array_join(F.col("__t.ancestorTitles"), " > ").alias("suite"),
                        F.col("__t.title").alias("test"),
                        F.col("__t.failureMessages").alias("failure_messages"))


CELLS_SCHEMA = ("array<struct<stdout: string, stderr: string, display: array<map<string,string>>, "
                "error: array<map<string,string>>>>")


def explode_cells(df: DataFrame, cells_col: str, keep: list[str]) -> DataFrame:
    """Notebook outputs: one row per cell with its stdout, stderr, display and error items."""
    return (df.select(*keep, F.posexplode(cells_col).alias("cell_idx", "__c"))
            .select(*keep, "cell_idx", F.col("__c.stdout").alias("stdout"), F.col("__c.stderr").alias("stderr"),
                    F.col("__c.display").alias("display"), F.col("__c.error").alias("error")))


# ------------------------------------------------------------------ E10
# MBPP test names whose entry point is taken literally when present.
MBPP_NAMED_ENTRY_POINTS = ["text_match_three", "is_perfect_square", "similar_elements", "find_char_long",
                           "common_in_nested_lists", "extract_singly", "larg_nnum", "Diff", "max_height"]


def mbpp_entry_point(first_test) -> Column:
    """Entry point of an assert-style MBPP test (E10): the function inside
    ``math.isclose(...)``, else a listed name contained in the test, else the first
    ``assert name(`` call."""
    t = _c(first_test)
    ep = F.when(F.instr(t, "math.isclose") > 0, F.regexp_extract(t, r"math\.isclose\((\w+)\(", 1))
    for name in MBPP_NAMED_ENTRY_POINTS:
        ep = ep.when(F.instr(t, name) > 0, F.lit(name))
    return ep.otherwise(F.regexp_extract(t, r"assert\s+([A-Za-z_]\w*)\s*\(", 1))


def mbpp_check_program(tests, entry_point) -> Column:
    """``def check(<entry point>):`` with every assert indented under it."""
    return F.concat(F.lit("def check("), _c(entry_point), F.lit("):\n    "), F.array_join(_c(tests), "\n    "))


def signature_line(code, entry_point) -> Column:
    """First line of the reference solution that mentions the entry point (E10); '' when none."""
    lines = F.split(_c(code), "\n", -1)
    return F.coalesce(F.try_element_at(F.filter(lines, lambda ln: F.instr(ln, _c(entry_point)) > 0), F.lit(1)),
                      F.lit(""))


# ------------------------------------------------------------------ E4
def humaneval_program_df(df: DataFrame, completion_col: str, prompt_col: str, tests_col: str,
                         stop_tokens_col: str, language: str, mode: str = "pretrain",
                         entry_point_col: str | None = None, out: str = "program") -> DataFrame:
    """HumanEval / MultiPL-E test program.

    * ``pretrain``: completion cut by the row's stop tokens (D13) and kept to the
      language's end token (D14), appended to the prompt, then the tests;
    * ``func``: the winning code block (D4) without its main (D15), then the tests;
    * ``stop_token``: the first freeform block (D6), stop tokens, main removed, tests.
    The language's import lines are prepended (E3); python programs end with
    ``check(entry_point)``; Java's ``class Problem`` becomes ``class Main``; Go
    packages and imports are hoisted (E2).
    """
    from gavel.operators import extraction as X
    lang = language.split(".")[0]
    c = F.col(completion_col)
    if mode == "pretrain":
        code = X.keep_to_end_token(X.stop_trim(c, F.col(stop_tokens_col)), lang)
        st = df.withColumn("__code", code)
        full = F.concat(F.col(prompt_col), F.lit("\n"), F.col("__code"), F.lit("\n"), F.col(tests_col))
    elif mode == "func":
        st = X.pick(df, completion_col, lang, out="__w")
        st = st.withColumn("__code", X.cut_main(F.coalesce(F.col("__w.code"), F.lit("")), lang)).drop("__w")
        full = F.concat(F.col("__code"), F.lit("\n"), F.col(tests_col))
    elif mode == "stop_token":
        st = X.extract_freeform_df(df, completion_col, lang, out="__x", first_block_only=True)
        st = st.withColumn("__code", X.cut_main(X.stop_trim(F.col("__x.code"), F.col(stop_tokens_col)), lang)) \
            .drop("__x")
        full = F.concat(F.col("__code"), F.lit("\n"), F.col(tests_col))
    else:
        raise ValueError(mode)
    full = with_import_preamble(full, lang)
    if lang == "python" and entry_point_col:
        full = F.concat(full, F.lit("\ncheck("), F.col(entry_point_col), F.lit(")"))
    if lang == "java":
        full = F.replace(full, F.lit("class Problem"), F.lit("class Main"))
    if lang in ("go", "go_test"):
        full = go_hoist_imports(full)
    return st.withColumn(out, full).withColumnRenamed("__code", f"{out}_completion")


# ------------------------------------------------------------------ E8
# Values are JSON text.  Arguments and results print as Python prints them, nested ones included,
# in every language; only strings and booleans that stand alone are spelled as the language does.
_TRUE_FALSE = {"racket": ("#t", "#f"), "bash": ("1", "0"), "perl": ("1", "0"), "python": ("True", "False")}


def _elements(json: Column) -> Column:
    """The elements of a JSON array: struct(text, is_string), the text decoded if it is a string."""
    kinds = F.transform(F.try_variant_get(F.try_parse_json(json), "$", "array<variant>"), lambda v: F.schema_of_variant(v) == "STRING")
    return F.zip_with(F.from_json(json, "array<string>"), kinds, lambda text, is_string: F.struct(
        F.coalesce(text, F.lit("null")).alias("text"), F.coalesce(is_string, F.lit(False)).alias("is_string")))


def _arg_literal(e: Column) -> Column:
    """Argument outside python: strings in double quotes (unescaped), everything else as Python prints it."""
    return F.when(e["is_string"], F.concat(F.lit('"'), e["text"], F.lit('"'))).otherwise(py_repr_json(e["text"]))


def _expected_literal(json: Column, language: str) -> Column:
    """Expected value: a one-element list is unwrapped; a boolean is spelled as in the language."""
    whole = F.struct(
        F.when(json.startswith('"'), F.try_variant_get(F.try_parse_json(json), "$", "string")).otherwise(json).alias("text"),
        json.startswith('"').alias("is_string"))
    parts = _elements(json)
    one = F.when(json.startswith("[") & (F.size(parts) == 1), F.element_at(parts, 1)).otherwise(whole)
    yes, no = _TRUE_FALSE.get(language, ("true", "false"))
    lone = ~one["is_string"]
    return (F.when(lone & (one["text"] == "true"), F.lit(yes)).when(lone & (one["text"] == "false"), F.lit(no)).otherwise(_arg_literal(one)))


# The python header used when the function is a method of class Solution.
PY_SOLUTION_HEADER = (
    "from string import *\nfrom re import *\nfrom datetime import *\nfrom collections import *\nfrom heapq import *\n"
    "from bisect import *\nfrom copy import *\nfrom math import *\nfrom random import *\nfrom statistics import *\n"
    "from itertools import *\nfrom functools import *\nfrom operator import *\nfrom io import *\nfrom sys import *\n"
    "from json import *\nfrom builtins import *\nfrom typing import *\nimport string\nimport re\nimport datetime\n"
    "import collections\nimport heapq\nimport bisect\nimport copy\nimport math\nimport random\nimport statistics\n"
    "import itertools\nimport functools\nimport operator\nimport io\nimport sys\nimport json\n"
    "sys.setrecursionlimit(6*10**5)\n")

# Per-language assertion programs.  Placeholders: {F} function source,
# {N} function name, {A} argument list, {E} expected literal.
ASSERT_TEMPLATES = {
    "racket": "\n{F}\n(define (main)\n    (define res ({N} {A}))\n    (define expected {E})\n    (if (equal? res expected)\n"
              "        (display \"Test passed\")\n        (error \"Test failed\")))\n(main)\n",
    "D_ut": "\nimport std.stdio;\n{F}\nvoid main() {\n    auto res = {N}({A});\n    auto expected = {E};\n"
            "    if (res != expected) {\n        throw new Exception(\"Test failed\");\n    } else {\n"
            "        writeln(\"Test passed\");\n    }\n}\n",
    "lua": "\n{F}\nres = {N}({A})\nassert(res =={E}, \"Test failed: expected 8, got \" .. res)\n",
    "julia": "\n{F}\nres = {N}({A})\nif res != {E}\n    error(\"Test failed\")\nend\n",
    "nodejs": "\n{F}\nconst res = {N}({A});\nconst expected = {E};\nif (res !== expected) {\n"
              "    throw new Error(`Test failed`);\n}\n",
    "cpp": "\n#include <iostream>\n#include <cassert>\n{F}\nint main() {\n    auto res = {N}({A});\n"
           "    auto expected = {E};\n    assert(res == expected);\n    return 0;\n}\n",
    "go": "\npackage main\nimport (\n    \"fmt\"\n    \"testing\"\n)\n{F}\nfunc Test{N}(t *testing.T) {\n"
          "    res := {N}({A})\n    expected := {E}\n    if res != expected {\n"
          "        t.Errorf(\"Expected %v, got %v\", expected, res)\n    }\n}\nfunc main() {\n    res := {N}({A})\n"
          "    expected := {E}\n    if res != expected {\n"
          "        panic(fmt.Sprintf(\"Test failed: Expected %v, got %v\", expected, res))\n    } else {\n"
          "        fmt.Println(\"Test passed\")\n    }\n}\n",
    "java": "\npublic class Main {\n    {F}\n    public static void main(String[] args) {\n        var res = {N}({A});\n"
            "        var expected = {E};\n        if (res != expected) {\n"
            "            throw new RuntimeException(\"Test failed\");\n        } else {\n"
            "            System.out.println(\"Test passed\");\n        }\n    }\n}\n",
    "typescript": "\n{F}\nconst res = {N}({A});\nconst expected = {E};\nif (res !== expected) {\n"
                  "    throw new Error(`Test failed`);\n}\n",
    "csharp": "\nusing System;\n\npublic class Test{N} {\n    {F}\n    public static void Main(string[] args) {\n"
              "        var res = {N}({A});\n        var expected = {E};\n        if (res != expected) {\n"
              "            throw new Exception(\"Test failed\");\n        } else {\n"
              "            Console.WriteLine(\"Test passed\");\n        }\n    }\n}\n",
    "rust": "\n{F}\nfn main() {\n    let res = {N}({A});\n    let expected = {E};\n    if res != expected {\n"
            "        panic!(\"Test failed\");\n    } else {\n        println!(\"Test passed\");\n    }\n}\n",
    "php": "\n<?php\n{F}\n$res = {N}({A});\n$expected = {E};\nif ($res != $expected) {\n"
           "    throw new Exception(\"Test failed\");\n}\n?>\n",
    "bash": "\n{F}\nres=$({N} {A})\nexpected={E}\nif [ \"$res\" != \"$expected\" ]; then\n"
            "    echo \"Test failed, res: $res, expected: $expected\" 1>&2\n    exit 1\nfi\n",
    "ruby": "\n{F}\nres = {N}({A})\nexpected = {E}\nif res != expected\n    raise \"Test failed\"\nend\n",
    "perl": "\n{F}\n$res = {N}({A});\n$expected = {E};\nif ($res != $expected) {\n    die \"Test failed\";\n}\n",
    "scala": "\nobject Test{N} {\n    {F}\n    def main(args: Array[String]): Unit = {\n        val res = {N}({A})\n"
             "        val expected = {E}\n        if (res != expected) {\n"
             "            throw new Exception(s\"Test failed: Expected $expected, got $res\")\n        } else {\n"
             "            println(\"Test passed\")\n        }\n    }\n}\n",
    "swift": "\n{F}\n\nlet res = {N}({A})\nlet expected = {E}\nif res != expected {\n"
             "    fatalError(\"Test failed: Expected \\(expected), got \\(res)\")\n} else {\n    print(\"Test passed\")\n}\n",
}
_SPACE_SEPARATED = ("racket", "bash")


def _labelled(args: Column, function: Column, name: Column) -> Column:
    """Swift arguments with the labels of the function's signature; a single argument goes without."""
    signature = F.regexp_extract_all(function, F.concat(F.lit("func \\Q"), name, F.lit("\\E\\((.*)\\)")), F.lit(1))
    labels = F.regexp_extract_all(F.try_element_at(signature, F.lit(1)), F.lit(r"(\w+):"), 1)
    n = F.least(F.size(labels), F.size(args))
    one = F.size(args) < 2
    return F.zip_with(F.slice(labels, F.lit(1), n), F.slice(args, F.lit(1), n), lambda label, arg: F.concat(
        F.when(one, F.lit("")).otherwise(F.concat(label, F.lit(": "))), _arg_literal(arg)))


def _fill(template: str, parts: dict[str, Column]) -> Column:
    """Split the template on its placeholders and concatenate literal pieces with columns."""
    import re
    pieces = re.split(r"(\{[FNAE]\})", template)
    return F.concat(*[parts[p[1]] if re.fullmatch(r"\{[FNAE]\}", p) else F.lit(p) for p in pieces if p != ""])


def function_assertion(function, fn_name, inputs, output, language: str) -> Column:
    """``function_assertion_json`` for VARIANT values (whose maps are in order of their keys)."""
    return function_assertion_json(function, fn_name, F.to_json(_c(inputs)), F.to_json(_c(output)), language)


def function_assertion_json(function, fn_name, inputs, output, language: str) -> Column:
    """Assertion program for one function-call case.

    ``inputs`` is the JSON text of the array of arguments, ``output`` that of the expected value.
    """
    fn, name = _c(function), _c(fn_name)
    inputs, output = (F.btrim(_c(x), F.lit(" \t\n\r")) for x in (inputs, output))
    if language == "python":
        call_args = py_repr_json(inputs)
        expected = F.concat(py_repr_json(output), F.lit("[0]"))
        plain = F.concat(F.lit("\n"), fn, F.lit("\nres = "), name, F.lit("(*"), call_args,
                         F.lit(")\nassert res == "), expected, F.lit("\n"))
        method = F.concat(F.lit(PY_SOLUTION_HEADER + "\n"), fn, F.lit("\nsol = Solution()\nres = sol."), name,
                          F.lit("(*"), call_args, F.lit(")\nassert res == "), expected, F.lit("\n"))
        return F.when(F.instr(fn, "class Solution") > 0, method).otherwise(plain)
    if language not in ASSERT_TEMPLATES:
        raise ValueError(f"no assertion template for {language}")
    sep = " " if language in _SPACE_SEPARATED else ", "
    args = _elements(inputs)
    spelled = _labelled(args, fn, name) if language == "swift" else F.transform(args, _arg_literal)
    arg_str = F.array_join(spelled, sep)
    return _fill(ASSERT_TEMPLATES[language], {"F": fn, "N": name, "A": arg_str,
                                               "E": _expected_literal(output, language)})
