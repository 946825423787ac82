"""Plain-Python versions of what the operators compute, and a fixture of awkward documents."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text):
    return WORD.findall(text or "")


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    rng = random.Random(seed)
    out = [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
    for k in range(12, n, 13):
        out[k] += "\n"
    return " ".join(out).replace("\n ", "\n")


def edited(text: str, seed: int, changes: int) -> str:
    rng, out = random.Random(seed), text.split(" ")
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def awkward():
    """(doc_id, text): nulls, empty and blank texts, copies, near copies, repeated rows, one id with two texts, a long text."""
    base, shared = prose(1, 300), prose(2, 120, 50)
    rows = [(1, base), (2, base), (3, edited(base, 3, 3)), (4, edited(base, 4, 80)), (5, None), (6, ""), (7, ""), (8, " \t\n "),
            (9, "One line, only"), (10, "one LINE, only  "), (11, shared + "\n" + prose(5, 60)), (12, prose(6, 70) + "\n" + shared),
            (13, "ab" * 900), (14, prose(7, 20000)), (14, prose(8, 40)), (15, prose(9, 50)), (15, prose(9, 50)), (None, base), (None, None),
            (16, "éàü " * 200 + "\nÉTÉ été ééééééééé\n\n"), (17, "été ééééééééé " * 3), (18, "\x85\x1c a\rb\x0bc\x0cd"), (19, "x" * 399), (20, "y" * 400 + "z"),
            (21, "y" * 400), (22, "a b c"), (23, "A B c")]
    return rows + [(100 + k, edited(base, 100 + k, 2)) for k in range(12)] + [(200 + k, prose(200 + k, 80) + "\nVery common line here\n") for k in range(12)]


def lines(rows):
    def key(line):
        return line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(LOWER)
    owner = {}
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 10 and i is not None:
                owner[k] = min(owner.get(k, i), i)
    out = []
    for i, text in rows:
        every = (text or "").split("\n")
        kept = [x for x in every if not (len(key(x)) >= 10 and key(x) in owner and owner[key(x)] != i)]
        out.append((i, len(every), len(every) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def shingles(text):
    w = words((text or "").translate(LOWER))
    seen, out = Counter(), set()
    for k in range(max(1, len(w) - 4) if w else 0):
        s = tuple(w[k:k + 5])
        out.add((s, seen[s]))
        seen[s] += 1
    return out


def classes(rows, threshold=0.8):
    """Index of each row -> least doc_id of its class, by all pairs; for texts whose copies keep their order."""
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    sets = [shingles(t) for _, t in rows]
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][1] is None or rows[b][1] is None:
                continue
            union = len(sets[a] | sets[b])
            if rows[a][1] == rows[b][1] or union and len(sets[a] & sets[b]) >= threshold * union:
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        least[root(k)].append(i)
    return [(i, min((x for x in least[root(k)] if x is not None), default=None), len(least[root(k)])) for k, (i, _) in enumerate(rows)]


def suffixes(rows, length=400):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[s:s + length] for _, b in data for s in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if count[b[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def statistics(text):
    w = words(text)
    windows = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
    count, hit = Counter(windows), set()
    for k, x in enumerate(windows):
        if count[x] > 1:
            hit |= set(range(k, k + 8))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        dup += bool(words(line)) and line in seen
        seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit))


def contamination(rows, items):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def cut_words(t):
        return cut.findall((t or "").translate(LOWER))
    windows = defaultdict(set)
    for item, text in items:
        w = cut_words(text)
        m = min(13, len(w))
        for k in range(len(w) - m + 1 if w else 0):
            windows[tuple(w[k:k + m])].add(item)
    sizes = {len(x) for x in windows}
    out = []
    for i, text in rows:
        w, hit, found = cut_words(text), set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                if (x := tuple(w[k:k + m])) in windows:
                    hit |= set(range(k, k + m))
                    found |= {str(j) for j in windows[x] if j is not None}
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out
