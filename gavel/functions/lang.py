"""Language aliases for fence tags, as a literal map column (no join needed)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fence-tag aliases per language, in the reference's order.
# Later entries win when an alias repeats: 'javascript', 'Javascript' and
# 'JavaScript' therefore map to 'javascript', while 'JS' and 'js' map to 'nodejs'.
LANGUAGE_ALIASES: list[tuple[str, list[str]]] = [
    ("python", ["python", "Python", "py", "Python3", "python3", "PY"]),
    ("cpp", ["cpp", "c++", "C++", "Cpp", "CPP"]),
    ("nodejs", ["javascript", "Javascript", "JavaScript", "JS", "js"]),
    ("go", ["go", "Go"]),
    ("java", ["java", "Java"]),
    ("php", ["php", "PHP"]),
    ("csharp", ["csharp", "c#", "C#"]),
    ("bash", ["bash", "Bash", "BASH", "sh", "shell"]),
    ("typescript", ["typescript"]),
    ("rust", ["rust", "Rust", "rs"]),
    ("sql", ["sql", "SQL", "Sql"]),
    ("D", ["D", "d"]),
    ("julia", ["julia", "Julia", "jl"]),
    ("lua", ["lua", "Lua"]),
    ("perl", ["perl", "Perl", "PERL"]),
    ("R", ["R", "r"]),
    ("ruby", ["ruby", "Ruby"]),
    ("scala", ["scala", "Scala"]),
    ("kotlin", ["kotlin", "Kotlin"]),
    ("c", ["c", "C"]),
    ("html", ["html", "Html", "HTML"]),
    ("javascript", ["javascript", "Javascript", "JavaScript"]),
    ("verilog", ["verilog", "Verilog", "VERILOG"]),
    ("racket", ["racket"]),
    ("swift", ["swift"]),
]

ALIASES_OF: dict[str, list[str]] = dict(LANGUAGE_ALIASES)

ALIAS_TO_LANGUAGE: dict[str, str] = {}
for _lang, _aliases in LANGUAGE_ALIASES:
    for _a in _aliases:
        ALIAS_TO_LANGUAGE[_a] = _lang


def _map_literal(d: dict[str, str]) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in d.items()))


def tag_language(tag: Column) -> Column:
    """Fence tag -> language; unknown tags give ''. The tag is stripped first."""
    from gavel.functions.text import py_strip
    return F.coalesce(F.element_at(_map_literal(ALIAS_TO_LANGUAGE), py_strip(tag)), F.lit(""))


def alias_sql_case(tag_sql: str) -> str:
    """The same mapping as an ANSI ``CASE`` (for oracle SQL)."""
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ALIAS_TO_LANGUAGE.items())
    return f"(CASE {tag_sql} {whens} ELSE '' END)"


def other_language_tags(language: str) -> list[str]:
    """Every alias that belongs to some language other than ``language``."""
    return sorted({a for lang, al in LANGUAGE_ALIASES if lang != language for a in al})
