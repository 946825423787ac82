"""Personal data replaced by format-preserving pseudonyms.

Values are found by pattern and validated (Luhn for cards, mod 97 for IBANs,
ranges for dates, addresses and social-security numbers).  A value is read as
a number in the mixed radix of its format, permuted by a keyed Feistel network
over that range (cycle walking skips numbers out of range or not valid), and
written back in the same format, separators and letter case included.  Equal
values get equal pseudonyms in every document, and the key holder can undo
them with ``restore``.

The permutation P is used as "P, one step on, P undone": a keyed permutation
in which no value stands for itself (unless its format has one value only).

A match that fails validation is tried again with the ends of its groups, then
as the other formats, and the scan goes on one character behind its start.

Defined cases: a null text stays null and an empty one empty; values that are
valid in no way stay as they are; rows that share a doc_id are treated each for
itself; other columns are carried through untouched.
"""

from __future__ import annotations

import calendar
import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: For tests and examples only: a real run passes a secret of its own.
EXAMPLE_KEY = b"example key, not a secret"
ROUNDS = 10
KINDS = ["secret", "email", "iban", "date", "ssn", "ip", "phone", "card"]

_SOURCE = r"""
  (?P<secret> (?<![0-9A-Za-z])(?i:api[_-]?key|access[_-]?key|token|secret|password|passwd|pwd)
              \s{0,3}[:=]\s{0,3}["']? (?P<secret_value> [0-9A-Za-z_+/.\-]{8,}) )
| (?P<email> (?<![0-9A-Za-z._%+\-@]) [0-9A-Za-z._%+\-]{1,64} @ [0-9A-Za-z\-]+ (?:\.[0-9A-Za-z\-]+)* \.[A-Za-z]{2,} )
| (?P<iban>  (?<![0-9A-Za-z]) [A-Z]{2}[0-9]{2} (?:\ ?[0-9A-Z]{4}){2,7} (?:\ ?[0-9A-Z]{1,4})? (?![0-9A-Za-z]) )
| (?P<date>  (?<![0-9A-Za-z/.\-]) (?: [0-9]{4}-[0-9]{2}-[0-9]{2} | [0-9]{2}[/.][0-9]{2}[/.][0-9]{4} ) (?=T[0-9]{2}:?[0-9]{2} | (?![0-9A-Za-z]|[/.\-][0-9])) )
| (?P<ssn>   (?<![0-9A-Za-z\-]) [0-9]{3}-[0-9]{2}-[0-9]{4} (?![0-9A-Za-z]|-[0-9]) )
| (?P<ip>    (?<![0-9A-Za-z.]) [0-9]{1,3} (?:\.[0-9]{1,3}){3} (?![0-9A-Za-z]|\.[0-9]) )
| (?P<phone> (?<![0-9A-Za-z+]) (?: \+[0-9]{1,3}[\ .\-]?)? (?: \([0-9]{3}\)\ ? | [0-9]{3}[.\-] ) [0-9]{3}[.\-\ ][0-9]{4} (?![0-9A-Za-z])
           | (?<![0-9A-Za-z+]) \+[0-9]{1,3} (?:[\ .\-]?[0-9]{2,4}){2,5} (?![0-9A-Za-z]) )
| (?P<card>  (?<![0-9A-Za-z]) (?: [0-9]{13,19} | [0-9]{4}(?P<gap>[\ \-])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{1,7}
           | [0-9]{4}[\ \-][0-9]{6}[\ \-][0-9]{5} ) (?![0-9A-Za-z]) )
"""
_FIND = re.compile(_SOURCE, re.X)
#: Each format for itself, in the same order.
_ONE = {k: re.compile(part, re.X) for k, part in zip(KINDS, re.split(r"\n\| (?=\(\?P<)", _SOURCE.strip()), strict=True)}
#: Length of an IBAN by country, as the registry has it.
_IBAN_LENGTHS = {c: int(n) for n, codes in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA "
    "23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,DZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:FR,GR,IT,MC,MR,SM,BI,DJ 28:AL,AZ,BY,CY,DO,GT,HU,LB,NI,PL,SV "
    "29:BR,EG,PS,QA,UA 30:JO,KW,MU 31:MT,SC 32:LC 33:RU").split()) for c in codes.split(",")}
#: Cheap tests that a text can hold any value at all.
_DIGIT = re.compile("[0-9@]")
_NAMED = re.compile(r"(?i:key|token|secret|password|passwd|pwd)\s{0,3}[:=]")


# ------------------------------------------------------------- permutations

class Feistel:
    """Keyed permutation of 0..size-1 and its inverse; ``tweak`` names the format."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.half = max(1, ((size - 1).bit_length() + 1) // 2)
        self.mask = (1 << self.half) - 1
        self.keys = [hashlib.blake2b(f"{tweak}|{size}|{r}".encode(), key=key[:64], digest_size=32).digest() for r in range(ROUNDS)]

    def _round(self, r: int, half: int) -> int:
        width = (self.half + 7) // 8
        digest = hashlib.blake2b(half.to_bytes(width, "little"), key=self.keys[r], digest_size=min(64, width + 8)).digest()
        while len(digest) < width + 8:
            digest += hashlib.blake2b(digest, key=self.keys[r]).digest()
        return int.from_bytes(digest, "little") & self.mask

    def _walk(self, x: int, order: range) -> int:
        while True:
            left, right = x >> self.half, x & self.mask
            if order.step > 0:
                for r in order:
                    left, right = right, left ^ self._round(r, right)
            else:
                for r in order:
                    left, right = right ^ self._round(r, left), left
            x = left << self.half | right
            if x < self.size:
                return x

    def forward(self, x: int) -> int:
        return self._walk(x, range(ROUNDS))

    def backward(self, x: int) -> int:
        return self._walk(x, range(ROUNDS - 1, -1, -1))

    def moved(self, x: int, step: int = 1) -> int:
        """The pseudonym of x (step 1), or what x is the pseudonym of (step -1)."""
        return self.backward((self.forward(x) + step) % self.size)


@lru_cache(4096)
def _network(key: bytes, tweak: str, size: int) -> Feistel:
    return Feistel(key, tweak, size)


def _permuted(key: bytes, tweak: str, size: int, x: int, step: int, valid: Callable[[int], bool] = lambda x: True) -> int:
    """Move until the number is valid again: a permutation of the valid numbers."""
    network = _network(key, tweak, size)
    while True:
        x = network.moved(x, step)
        if valid(x):
            return x


# ------------------------------------------------------------------ formats

_CLASSES = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
_OF = {c: k for k, letters in enumerate(_CLASSES) for c in letters}


def _string(value: str, key: bytes, kind: str, step: int, alphabet: str | None = None) -> str:
    """Permute a string position by position class: digit to digit, letter to letter of the same case."""
    sets = [alphabet if alphabet and c in alphabet else _CLASSES[_OF[c]] if c in _OF else None for c in value]
    size, x = 1, 0
    for c, letters in zip(value, sets):
        if letters:
            size, x = size * len(letters), x * len(letters) + letters.index(c)
    if size < 2:
        return value
    form = "".join("." if s is None else str(len(s)) + s[0] for s in sets)
    x = _permuted(key, f"{kind}|{form}", size, x, step)
    out = []
    for c, letters in zip(reversed(value), reversed(sets)):
        if letters:
            x, k = divmod(x, len(letters))
            c = letters[k]
        out.append(c)
    return "".join(reversed(out))


def _refill(value: str, digits: str) -> str:
    """``value`` with its digits replaced in order."""
    rest = iter(digits)
    return "".join(next(rest) if c in _CLASSES[0] else c for c in value)


def luhn_digit(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _card(value: str, key: bytes, step: int) -> str | None:
    digits = re.sub(r"\D", "", value)
    if int(digits[-1]) != luhn_digit(digits[:-1]) or not digits.strip("0"):
        return None
    n = len(digits) - 1
    x = _permuted(key, f"card|{n}", 10**n, int(digits[:-1]), step, lambda x: x > 0)
    body = f"{x:0{n}d}"
    return _refill(value, body + str(luhn_digit(body)))


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _iban(value: str, key: bytes, step: int) -> str | None:
    plain = value.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain) != 1:
        return None
    body = _string(plain[4:], key, "iban" + plain[:2], step)
    new = iter(f"{plain[:2]}{98 - _mod97(plain[:2] + '00' + body):02d}{body}")
    return "".join(c if c == " " else next(new) for c in value)


_FIRST, _LAST = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def _date(value: str, key: bytes, step: int) -> str | None:
    gap = value[4] if value[4] == "-" else value[2]
    a, b, c = (int(x) for x in value.split(gap) if x) if value.count(gap) == 2 else (0, 0, 0)

    def order(a: int, b: int) -> str:
        return "ymd" if gap == "-" else "mdy" if gap == "/" and a <= 12 < b else "dmy"

    form = order(a, b)
    year, month, day = {"ymd": (a, b, c), "dmy": (c, b, a), "mdy": (c, a, b)}[form]
    if not (1900 <= year <= 2099 and 1 <= month <= 12 and 1 <= day <= calendar.monthrange(year, month)[1]):
        return None

    def parts(x: int) -> tuple[int, int, int]:
        d = dt.date.fromordinal(x + _FIRST)
        return {"ymd": (d.year, d.month, d.day), "dmy": (d.day, d.month, d.year), "mdy": (d.month, d.day, d.year)}[form]

    x = _permuted(key, f"date|{form}{gap}", _LAST - _FIRST + 1, dt.date(year, month, day).toordinal() - _FIRST, step,
                  lambda x: order(*parts(x)[:2]) == form)
    return gap.join(f"{p:0{4 if p > 99 else 2}d}" for p in parts(x))


def _ssn(value: str, key: bytes, step: int) -> str | None:
    def valid(x: int) -> bool:
        area, group, serial = x // 10**6, x // 10**4 % 100, x % 10**4
        return area not in (0, 666) and area < 900 and group > 0 and serial > 0
    x = int(value.replace("-", ""))
    if not valid(x):
        return None
    return _refill(value, f"{_permuted(key, 'ssn', 10**9, x, step, valid):09d}")


def _ip(value: str, key: bytes, step: int) -> str | None:
    octets = value.split(".")
    if any(int(o) > 255 or o != str(int(o)) for o in octets):
        return None
    x = _permuted(key, "ip", 2**32, int.from_bytes(bytes(map(int, octets)), "big"), step)
    return ".".join(map(str, x.to_bytes(4, "big")))


def _phone(value: str, key: bytes, step: int) -> str | None:
    code = re.match(r"\+[0-9]{1,3}(?=[ .\-(])", value)
    kept = code.group() if code else ""
    digits = re.sub(r"\D", "", value[len(kept):])
    if not 7 <= len(digits) <= 14:
        return None
    x = _permuted(key, f"phone|{kept}|{len(digits)}", 10**len(digits), int(digits), step)
    return kept + _refill(value[len(kept):], f"{x:0{len(digits)}d}")


def _email(value: str, key: bytes, step: int) -> str | None:
    name, at, domain = value.rpartition("@")
    return _string(name, key, "email" + domain.lower(), step) + at + domain


def _secret(value: str, key: bytes, step: int) -> str | None:
    for alphabet in ("0123456789abcdef", "0123456789ABCDEF"):
        if len(value) >= 16 and set(value) <= set(alphabet):
            return _string(value, key, "hex", step, alphabet)
    return _string(value, key, "secret", step)


_FORMATS: dict[str, Callable[[str, bytes, int], str | None]] = {
    "email": _email, "iban": _iban, "date": _date, "ssn": _ssn, "ip": _ip, "phone": _phone, "card": _card}


def pseudonymise(text: str, key: bytes, step: int = 1) -> tuple[str, dict[str, int]]:
    """The text with its values replaced, and how many of each kind; ``step=-1`` undoes it."""
    counts = dict.fromkeys(KINDS, 0)
    if not _DIGIT.search(text) and not ((":" in text or "=" in text) and _NAMED.search(text)):
        return text, counts

    out, done, at = [], 0, 0
    while found := _FIND.search(text, at):
        at = found.start() + 1
        kind = next(k for k in KINDS if found[k] is not None)
        if kind == "secret":
            value = found["secret_value"]
            swapped = kind, found.end(), found.group()[:-len(value)] + _secret(value, key, step)
        else:
            swapped = _swap(text, found, kind, key, step)
        if swapped:
            kind, at, new = swapped
            counts[kind] += 1
            out += [text[done:found.start()], new]
            done = at
    return "".join([*out, text[done:]]), counts


def _ends(kind: str, value: str) -> list[int]:
    """Ends at which a match may be a value: its own, and those of its groups (an IBAN's country's length first)."""
    if kind not in ("iban", "phone"):
        return [len(value)]
    ends = [len(value), *(i for i in range(len(value) - 1, 0, -1) if value[i] in " .-")]
    if kind == "iban" and (length := _IBAN_LENGTHS.get(value[:2])):
        return sorted(ends, key=lambda e: len(value[:e].replace(" ", "")) != length)
    return ends


def _swap(text: str, found: re.Match, kind: str, key: bytes, step: int) -> tuple[str, int, str] | None:
    """Kind, end and pseudonym of the first valid value where ``found`` starts, in the order of the formats, then of their ends."""
    start = found.start()
    for k in KINDS[KINDS.index(kind):]:
        match = found if k == kind else _ONE[k].match(text, start)
        if not match:
            continue
        for end in _ends(k, match.group()):
            if end < len(match.group()) and not _ONE[k].fullmatch(text, start, start + end):
                continue
            new = _FORMATS[k](text[start:start + end], key, step)
            if new is not None:
                return k, start + end, new
    return None


def restore(text: str, key: bytes) -> str:
    return pseudonymise(text, key, -1)[0]


# -------------------------------------------------------------------- Spark

def pseudonymised(docs: DataFrame, key: bytes = EXAMPLE_KEY) -> DataFrame:
    """All columns of ``docs`` plus the struct ``pi_out``: text and the count of each kind."""
    def run(frames: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in frames:
            out = [(None, *[0] * len(KINDS)) if t is None else (lambda r: (r[0], *r[1].values()))(pseudonymise(t, key)) for t in texts]
            yield pd.DataFrame(out, columns=["text", *(f"n_{k}" for k in KINDS)])

    udf = F.pandas_udf(run, "text string, " + ", ".join(f"n_{k} long" for k in KINDS))
    return docs.withColumn("pi_out", udf("text"))


def query(docs: DataFrame) -> DataFrame:
    """doc_id, the pseudonymised text, and the number of values of each kind."""
    return pseudonymised(docs.select("doc_id", "text")).select("doc_id", "pi_out.*")
