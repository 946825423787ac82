"""Python spelling of JSON values against Python itself."""

import json
import random

from gavel.functions.pyrepr import py_float_repr, py_repr_json, py_str_repr
from gavel.operators import assembly as A
from pyspark.sql import functions as F


def value(rng, depth=0):
    kind = rng.randrange(9 if depth < 5 else 7)
    if kind < 7:
        return [None, True, False, rng.randrange(-10**20, 10**20), round(rng.uniform(-1, 1), 6) * 10.0**rng.randrange(-8, 20), float(rng.randrange(-50, 50)),
                "".join(rng.choice("ab '\"\\\n\t\r\x00\x1b\x7f\xa0é日​\U0001f600{}[],:") for _ in range(rng.randrange(9)))][kind]
    if kind == 7:
        return [value(rng, depth + 1) for _ in range(rng.randrange(5))]
    return {f"{rng.choice('zbqé')}{k}": value(rng, depth + 1) for k in range(rng.randrange(4))}


def test_repr_of_json(spark):
    rng = random.Random(5)
    values = [value(rng) for _ in range(700)] + [[], {}, [[]], {"b": 1, "a": {"x": [-0.0, 1e16, 1e-5, 123456789.125, 1e22, 5e-7]}}, "it's", 'a"b\'c', ["x"] * 2000]
    texts = [json.dumps(v, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2])) for v in values]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(py_repr_json(F.col("t"))).collect()]
    assert got == [repr(json.loads(t)) for t in texts]


def test_float_and_string_repr(spark):
    rng = random.Random(6)
    numbers = [rng.uniform(-1, 1) * 10**rng.randrange(-20, 25) for _ in range(300)] + [0.0, -0.0, 1e15, 1e16, 9999999999999998.0, 0.0001, 0.00001, float("inf")]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in numbers], "x double").select(py_float_repr(F.col("x"))).collect()]
    # of two shortest texts of the same double the JVM may have the other one
    assert all(float(g) == x and len(g) == len(repr(x)) and g[:15] == repr(x)[:15] for g, x in zip(got, numbers))
    texts = ["", "'", '"', "'\"", "\\n", "a\nb", "\x01\x9f \U000e0001ü"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(py_str_repr(F.col("t"))).collect()]
    assert got == [repr(t) for t in texts]


def test_nested_assertions(spark):
    df = spark.createDataFrame([("def g(*a): pass", '[[true, null], {"z": false, "a": [1.50, "q"]}]', '[{"k": null}]'), ("def g(*a): pass", '["s", [2]]', "true")],
                               "fn string, i string, o string")
    out = df.select(*(A.function_assertion_json("fn", F.lit("g"), "i", "o", lang).alias(lang) for lang in ("python", "nodejs", "racket", "go"))).collect()
    assert "res = g(*[[True, None], {'z': False, 'a': [1.5, 'q']}])\nassert res == [{'k': None}][0]\n" in out[0]["python"]
    assert "const res = g([True, None], {'z': False, 'a': [1.5, 'q']});\nconst expected = {'k': None};" in out[0]["nodejs"]
    assert '(define res (g "s" [2]))\n    (define expected #t)' in out[1]["racket"]
    assert 'res := g("s", [2])\n    expected := true\n' in out[1]["go"]


def test_append_test_with_repr(spark):
    df = spark.createDataFrame([("it's\n'''", "run(#<INSERT>)"), ("x = 1\nif __name__ == 1:\n  y", "assert x")], "c string, t string")
    got = [r[0] for r in df.select(A.append_test("c", "t", as_repr=True)).collect()]
    assert got == ["run(" + repr("it's\n'''") + ")", repr("x = 1\n") + "\nassert x"]
