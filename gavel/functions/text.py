"""Column helpers that follow Python's string semantics with built-in Spark
expressions only (no UDF), so they stay inside whole-stage codegen.

Spark's ``trim`` only removes ASCII spaces and ``try_cast`` accepts spellings
Python rejects (``1d``); these helpers close those gaps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters for which Python's str.isspace() is true
# (the set str.strip() / str.split() remove), in code-point order.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Line boundaries of Python's str.splitlines().
_SPLITLINES_RE = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"

# Python float() grammar (ASCII digits; underscores only between digits),
# plus the case-insensitive special names.
_PY_FLOAT_RE = (
    r"^[+-]?(?:(?:\d(?:_?\d)*(?:\.(?:\d(?:_?\d)*)?)?|\.\d(?:_?\d)*)(?:[eE][+-]?\d(?:_?\d)*)?"
    r"|(?i:inf|infinity|nan))$"
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(x) -> Column:
    """Python ``str.strip()``: remove every Unicode blank at both ends."""
    return F.btrim(_c(x), F.lit(PY_WHITESPACE))


def py_rstrip(x) -> Column:
    return F.rtrim(_c(x), F.lit(PY_WHITESPACE))


def py_lstrip(x) -> Column:
    return F.ltrim(_c(x), F.lit(PY_WHITESPACE))


def py_split_ws(x) -> Column:
    """Python ``s.split()``: split on runs of Unicode blanks, no empty pieces."""
    s = py_strip(x)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, "[" + PY_WHITESPACE + "]+", -1))


def split_nl(x) -> Column:
    """Python ``s.split('\\n')`` (keeps trailing empty pieces)."""
    return F.split(_c(x), "\n", -1)


def splitlines(x) -> Column:
    """Python ``s.splitlines()``: all line boundaries, last empty piece dropped."""
    c = _c(x)
    parts = F.split(c, _SPLITLINES_RE, -1)
    return (F.when(c == "", F.array().cast("array<string>"))
            .when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1))
            .otherwise(parts))


# float() strips every blank except the four separators \x1c-\x1f.
FLOAT_BLANKS = "".join(ch for ch in PY_WHITESPACE if ch not in "\x1c\x1d\x1e\x1f")
_PY_FLOAT_PADDED_RE = "^[" + FLOAT_BLANKS + "]*(?:" + _PY_FLOAT_RE[1:-1] + ")[" + FLOAT_BLANKS + "]*$"


def is_py_float(x) -> Column:
    """True when Python's ``float(x)`` would succeed (ASCII digits)."""
    return _c(x).rlike(_PY_FLOAT_PADDED_RE)


def py_float(x) -> Column:
    """Python ``float(x)`` or null when it would raise.

    One regex check on the raw text; Spark's cast already ignores ASCII blanks,
    so the strip / underscore rewrite only runs when the direct cast fails.
    """
    c = _c(x)
    return F.when(c.rlike(_PY_FLOAT_PADDED_RE),
                  F.coalesce(c.try_cast("double"),
                             F.regexp_replace(py_strip(c), "_", "").try_cast("double")))


def py_float_equal(a: Column, b: Column, rel_tol: float = 1e-5) -> Column:
    """``abs(a - b) / max(abs(b), 1e-10) < rel_tol`` with b the expected value."""
    return (F.abs(a - b) / F.greatest(F.abs(b), F.lit(1e-10))) < F.lit(rel_tol)


def truncate_middle(x, limit: int = 1000, keep: int = 498, marker: str = "...") -> Column:
    """Keep ``keep`` chars at each end when longer than ``limit``."""
    c = _c(x)
    return F.when(F.length(c) > limit,
                  F.concat(F.substring(c, 1, keep), F.lit(marker), F.right(c, F.lit(keep)))).otherwise(c)


def cut_before(x, marker: str, strip: bool = True) -> Column:
    """Python ``s[:s.index(marker)]`` when marker occurs (optionally stripped)."""
    c = _c(x)
    pos = F.instr(c, marker)
    head = F.substring(c, F.lit(1), pos - 1)
    head = py_strip(head) if strip else head
    return F.when(pos > 0, head).otherwise(c)

