"""A table of documents with every awkward case, and plain versions of what operators return."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Columns whose names the operators use inside.
CLASHING = ["id", "key", "kept", "block", "row", "hash", "rank", "token", "before", "shard", "first", "n", "text_sha256"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def documents() -> list[tuple]:
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdefgéü") for _ in range(rnd.randint(1, 7))) for _ in range(400)]

    def prose(n: int) -> str:
        return " ".join(rnd.choice(words) for _ in range(n))

    base, passage = prose(120), prose(30)
    near = base.split()
    near[60] = "changed"
    texts: list[tuple[int | None, str | None]] = [
        (1, ""), (2, None), (3, " \t\n\x0b "), (4, base), (5, base.upper()), (6, " ".join(near)), (7, base),
        (8, prose(40) + " " + passage + " " + prose(50)), (9, passage), (10, prose(20) + "\n" + passage + "\n" + passage),
        (11, "one two three"), (12, "one two three"), (13, "ONE TWO THREE"), (14, "x"), (15, "x " * 200),
        (16, "same line here\n" * 40 + prose(60)), (17, prose(12_000)), (18, "a" * 50_000),
        (19, "# * % $ & | < > " * 30), (None, base), (None, "no identifier"), (None, None), (20, prose(60)), (20, prose(60)),
        (21, "again"), (21, "again"), (22, "tab\tand\x0bvertical\x0cfeed\r\nmore words of text  two spaces"),
        (23, "nb\u00a0space \u2028 line 😀 <|endoftext|> end "), (24, base + " tail"), (2**62, prose(70)), (-5, prose(70)),
    ]
    rows = []
    for i, (doc, text) in enumerate(texts):
        lang, source = (None, "en", "de")[i % 3], (None, "s1", "s1", "s2")[i % 4]
        rows.append((doc, text, lang, source, None, *["clash"] * len(CLASHING)))
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(documents(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df) -> list[tuple]:
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingles(text: str, n: int = 4) -> frozenset:
    words = WORD.findall(lowered(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) or frozenset([tuple(words)])


def jaccard(rows: list[tuple], percent: int = 85) -> list[tuple]:
    """(doc_id, size, component) by comparing all pairs with a common shingle."""
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(set)
    for i, (d, s) in enumerate(sets):
        for g in s if d is not None else ():
            holders[g].add(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    for a, b in pairs:
        (x, s), (y, t) = sets[a], sets[b]
        if 100 * len(s & t) >= percent * len(s | t):
            low, high = sorted((root(x), root(y)))
            parent[high] = low
    return [(d, len(s), None if d is None else root(d)) for d, s in sets]


def without_passages(rows: list[tuple], window: int = 13) -> list[tuple]:
    first: dict[tuple, int] = {}
    for d, t in rows:
        words = WORD.findall(t)
        for i in range(len(words) - window + 1 if d is not None else 0):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        words = WORD.findall(t)
        gone = set()
        for i in range(len(words) - window + 1 if d is not None else 0):
            if first[tuple(words[i : i + window])] < d:
                gone |= set(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((d, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def statistics(text: str) -> tuple[int, ...]:
    words = WORD.findall(text)
    triples = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if triples[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return [
        (kind, m.start(), m.end())
        for kind, pattern in BASE.items()
        for m in re.finditer(pattern, text)
        if _valid(kind, m.group())
    ]


def same(found, expected) -> bool:
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted(map(tuple, found), key=key) == sorted(expected, key=key)
