"""Python-compatible string helpers against Python itself on generated text."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gavel.functions import text as T

BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"
ALPHABET = BLANKS + "ab.eE+-_019xIinfNaé"

texts = st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=1, max_size=60)


def _py_float(s):
    try:
        return float(s)
    except ValueError:
        return None


def _ascii_digits_only(s):
    return all(not c.isdigit() or c in "0123456789" for c in s)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts)
def test_string_helpers_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    out = df.select("i", "s", T.py_strip("s").alias("strip"), T.splitlines("s").alias("lines"),
                    T.py_split_ws("s").alias("ws"), T.py_float("s").alias("f"),
                    T.is_py_float("s").alias("isf")).collect()
    for r in out:
        s = r["s"]
        assert r["strip"] == s.strip(), repr(s)
        assert list(r["lines"]) == s.splitlines(), repr(s)
        assert list(r["ws"]) == s.split(), repr(s)
        want = _py_float(s)
        if _ascii_digits_only(s):
            assert r["isf"] == (want is not None), repr(s)
            if want is None:
                assert r["f"] is None
            elif math.isnan(want):
                assert math.isnan(r["f"])
            else:
                assert r["f"] == want, repr(s)


def test_float_edge_spellings(spark):
    cases = ["1d", "1f", "1_000", " 1e5 ", "nan", "-Infinity", "inf", "1e400", ".5", "5.", "1__0", "_1", "0x10"]
    df = spark.createDataFrame([(c,) for c in cases], "s string").select("s", T.py_float("s").alias("f"))
    got = {r["s"]: r["f"] for r in df.collect()}
    for c in cases:
        want = _py_float(c)
        if want is None:
            assert got[c] is None, c
        elif math.isnan(want):
            assert math.isnan(got[c])
        else:
            assert got[c] == want, c


def test_truncate_middle(spark):
    s = "x" * 400 + "y" * 700
    r = spark.createDataFrame([(s,)], "s string").select(T.truncate_middle(F.col("s")).alias("t")).first()
    assert r["t"] == s[:498] + "..." + s[-498:]
