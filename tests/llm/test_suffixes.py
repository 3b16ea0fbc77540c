"""Repeated byte strings against a plain version."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from cases import empty, odd, rows_of, same  # noqa: F401

from stockyard.llm import suffix_dedup
from stockyard.llm.suffix_dedup import grams, least_in_windows, repeated_starts, runs_of, without_repeated_strings

SMALL = "/root/testdata/sf0.001/documents.parquet"


def plain(rows, length=400):
    texts = [(d, t.encode()) for d, t in rows]
    starts = collections.Counter(t[i : i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - length + 1):
            if starts[t[i : i + length]] > 1:
                gone[i + 1 : i + 1 + length] = True
        kept = bytes(b for b, g in zip(t, gone[1:-1]) if not g)
        spans = int((np.diff(gone.astype(int)) == 1).sum())
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_odd_documents(spark, odd):  # noqa: F811
    rows = [(d, t[:6000]) for d, t in rows_of(odd)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, key string").repartition(3)
    found = without_repeated_strings(docs)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert same(found.collect(), plain(rows))
    nulls = without_repeated_strings(odd).filter("n_bytes = 0").count()
    assert nulls == sum(not t for _, t in rows)


def test_given_documents(spark):
    docs = spark.read.parquet(SMALL)
    assert same(without_repeated_strings(docs).collect(), plain(rows_of(docs)))


def _woven(seed: int, n: int) -> list[tuple]:
    """Texts of a few passages, cut and joined at any place, of few letters, with periods."""
    rnd = random.Random(seed)
    passages = ["".join(rnd.choice("ab c\néü") for _ in range(rnd.randint(30, 300))) for _ in range(6)]
    passages += ["xyz" * 50, "q" * 130, "é" * 70]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rnd.randint(0, 7)):
            p = rnd.choice(passages)
            a = rnd.randint(0, len(p) - 1)
            text += p[a : rnd.randint(a, len(p))] if rnd.random() < 0.5 else p
            if rnd.random() < 0.3:
                text += str(rnd.randint(0, 10**6))
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("seed, most, step, together", [(1, 1000, 1 << 20, 4096), (2, 2, 700, 8), (3, 1, 5000, 1)])
def test_woven_texts(spark, monkeypatch, seed, most, step, together):
    """With every collection cut down to shorter runs and single windows, and texts in small portions, too."""
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    rows = _woven(seed, 150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = without_repeated_strings(docs, length=100, gram=16).collect()
    assert same(found, plain(rows, 100))
    texts = [t.encode() for _, t in rows]
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    monkeypatch.setattr(suffix_dedup, "STEP", step)
    windows = sum(int(w.sum()) for _, _, w, *_ in runs_of(data, bounds, 100, 16))
    assert windows == sum(max(0, len(t) - 99) for t in texts)


def test_texts_are_shuffled_once_however_many_rounds(spark, monkeypatch, folder):
    """All three rounds are needed; no plan but that of the texts' table may have a text in a shuffle."""
    monkeypatch.setattr(suffix_dedup, "MOST", 1)
    plans = []

    def seen(write):
        def wrapped(df, *args):
            plans.append(df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
            return write(df, *args)

        return wrapped

    for name in ("stored", "clustered"):
        if hasattr(suffix_dedup, name):
            monkeypatch.setattr(suffix_dedup, name, seen(getattr(suffix_dedup, name)))
    rows = _woven(5, 120)
    spark.createDataFrame(rows + [(200, rows[0][1])], "doc_id long, text string").write.parquet(f"{folder}/docs")
    docs = spark.read.parquet(f"{folder}/docs")
    found = without_repeated_strings(docs, length=100, gram=16)
    seen(lambda df: df)(found)
    shuffled = [i for plan in plans for i in re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", plan)]
    assert len(shuffled) > 10
    assert sum(bool(re.search(r"\btext#", i)) for i in shuffled) == 1
    assert same(found.collect(), plain(rows + [(200, rows[0][1])], 100))


def test_a_row_is_a_document_whatever_its_identifier(spark):
    text = "".join(random.Random(9).choice("abcdef gh") for _ in range(900))
    rows = [(1, text), (1, text[:500]), (None, text[100:]), (None, None), (2, "short"), (2, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = plain([(d, t or "") for d, t in rows])
    assert same(without_repeated_strings(docs).collect(), expected)


def test_columns_give_common_prefixes():
    rnd = random.Random(4)
    contents = ["".join(rnd.choice("ab") for _ in range(rnd.randint(12, 40))).encode() for _ in range(300)]
    offsets = np.array([rnd.randint(0, len(c) - 12) for c in contents])
    piles = np.sort(np.array([rnd.randint(0, 3) for _ in contents]))
    found, left = repeated_starts(contents, offsets, piles, 12)
    at = collections.Counter()
    for c, o, p in zip(contents, offsets, piles):
        at.update((p, i - o, c[i : i + 12]) for i in range(len(c) - 11))
    for i, (c, o, p) in enumerate(zip(contents, offsets, piles)):
        for k in range(min(o, len(c) - 12) + 1):
            assert found[left - o + k, i] == (at[p, k - o, c[k : k + 12]] > 1)


def test_hashes_and_least_values():
    data = np.frombuffer(b"abcabcabcabcabcabcabc" * 3, np.uint8)
    assert len(set(grams(data, 16).tolist())) == 3
    values = np.random.default_rng(1).integers(0, 50, 200)
    for width in (1, 7, 200):
        assert least_in_windows(values, width).tolist() == [values[i : i + width].min() for i in range(201 - width)]


def test_no_documents(empty):  # noqa: F811
    assert without_repeated_strings(empty).count() == 0
