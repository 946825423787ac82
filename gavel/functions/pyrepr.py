"""Python's ``repr`` of JSON values, written token by token.

A JSON text is cut into its tokens once.  Brackets stay; a comma and a colon get
Python's blank; true, false and null, numbers and strings are spelled as Python
spells them.  So nested lists and maps need no recursion, keep their order of
keys, and take time in proportion to the text.  A repeated key is kept twice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKENS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[\[\]{},:]|[^\[\]{},:"\s]++'
# Python's words for JSON's, and its spelling of separators.
_WORDS = {"true": "True", "false": "False", "null": "None", ",": ", ", ":": ": ", "-0": "0"}
_SHOWN = {"\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t"}
_HIDDEN = r"[\p{C}\p{Z}&&[^ ]]"  # Python escapes what isn't printable


def _escaped(s: Column) -> Column:
    """Every character that isn't printable as \\x, \\u or \\U and its code point."""
    def one(c: Column) -> Column:
        digits = F.lower(F.hex(F.ascii(c).cast("long")))
        size = F.length(digits)
        code = (F.when(size <= 2, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0"))).when(size <= 4, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
                .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0"))))
        return F.when(c.rlike(_HIDDEN), code).otherwise(c)
    return F.when(s.rlike(_HIDDEN), F.array_join(F.transform(F.split(s, ""), one), "")).otherwise(s)


def py_str_repr(s: Column) -> Column:
    """``repr(str)``: double quotes only where the text has single ones and no double ones."""
    out = s
    for plain, shown in _SHOWN.items():
        out = F.replace(out, F.lit(plain), F.lit(shown))
    out = _escaped(out)
    double = (F.instr(s, "'") > 0) & (F.instr(s, '"') == 0)
    return F.when(double, F.concat(F.lit('"'), out, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(out, F.lit("'"), F.lit("\\'")), F.lit("'")))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _shorter(x: Column, d: Column) -> Column:
    """The digits, or these rounded by one or two if that is the same double: the JVM's text is not always the shortest."""
    out = x["digits"]
    for cut in (1, 2):
        rounded = F.floor((x["digits"].try_cast("decimal(20,0)") + F.lit(5 * 10**(cut - 1))) / F.lit(10**cut)).cast("string")
        same = F.concat(x["sign"], rounded, F.lit("E"), (x["power"] + cut).cast("string")).try_cast("double") == d
        out = F.when((F.length(x["digits"]) > 15) & same, F.concat(rounded, F.repeat(F.lit("0"), F.lit(cut)))).otherwise(out)
    return out


def _placed(x: Column) -> Column:
    """A number from its sign, digits and the power of ten of the point before them."""
    digits, point = x["digits"], x["point"]
    n, exponent = F.length(digits), F.abs(point - 1).cast("string")
    fixed = (F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
             .when(point >= n, F.concat(digits, F.repeat(F.lit("0"), point - n), F.lit(".0")))
             .otherwise(F.concat(F.substr(digits, F.lit(1), point), F.lit("."), F.substr(digits, point + 1))))
    scientific = F.concat(F.left(digits, F.lit(1)), F.when(n > 1, F.concat(F.lit("."), F.substr(digits, F.lit(2)))).otherwise(F.lit("")), F.lit("e"),
                          F.when(point < 1, F.lit("-")).otherwise(F.lit("+")), F.when(F.length(exponent) < 2, F.concat(F.lit("0"), exponent)).otherwise(exponent))
    return F.concat(x["sign"], F.when(n == 0, F.lit("0.0")).when((point > -4) & (point <= 16), fixed).otherwise(scientific))


def py_float_repr(d: Column) -> Column:
    """``repr(float)`` of a double: shortest digits, an exponent below 1e-4 and from 1e16.

    Where two shortest texts are the same double, the last of 17 digits is the JVM's choice.
    """
    def parts(java: Column) -> Column:
        part = lambda k: F.regexp_extract(java, r"^(-?)(\d+)\.(\d+)(?:E(-?\d+))?$", k)
        return F.struct(part(1).alias("sign"), F.ltrim(F.concat(part(2), part(3)), F.lit("0")).alias("digits"),
                        (F.coalesce(F.nullif(part(4), F.lit("")).cast("int"), F.lit(0)) - F.length(part(3))).alias("power"))

    def number(x: Column) -> Column:
        return _let(F.struct(x["sign"].alias("sign"), _shorter(x, d).alias("every"), x["power"].alias("power")), lambda y: _placed(F.struct(
            y["sign"].alias("sign"), F.rtrim(y["every"], F.lit("0")).alias("digits"), (F.length(y["every"]) + y["power"]).alias("point"))))
    java = d.cast("string")
    return F.when(java.contains("Inf"), F.when(d > 0, "inf").otherwise("-inf")).otherwise(_let(parts(java), number))


def _token(t: Column) -> Column:
    plain = F.substr(t, F.lit(2), F.length(t) - 2)
    text = F.when(F.instr(t, "\\") == 0, plain).otherwise(F.try_variant_get(F.try_parse_json(t), "$", "string"))
    out = F.when(t.startswith('"'), py_str_repr(text))
    for word, python in _WORDS.items():
        out = out.when(t == word, F.lit(python))
    return out.when(t.rlike(r"^-?[0-9].*[.eE]"), py_float_repr(t.try_cast("double"))).otherwise(t)


def py_repr_json(json: Column) -> Column:
    """``repr(json.loads(text))``."""
    return F.array_join(F.transform(F.regexp_extract_all(json, F.lit(_TOKENS), 0), _token), "")
