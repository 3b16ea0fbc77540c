"""Exact duplicates, the Jaccard join and repeated passages against plain versions."""

import collections
import hashlib

import numpy as np
import pytest
from cases import empty, jaccard, lowered, odd, rows_of, same, without_passages  # noqa: F401

from stockyard.llm import group_join, substring_dedup
from stockyard.llm.components import components
from stockyard.llm.exact_dedup import exact_duplicates, without_exact_duplicates
from stockyard.llm.group_join import jaccard_components, least_common, size_classes
from stockyard.llm.substring_dedup import repeated_passages
from stockyard.llm.words import words_of

SMALL = "/root/testdata/sf0.001/documents.parquet"


def copies(rows):
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[lowered(t)].append(d)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        once = iter([True])
        out += [
            (d, keep, len(ids), d == keep and next(once, False), hashlib.sha256(text.encode()).hexdigest()) for d in ids
        ]
    return out


def test_exact_duplicates(spark, odd):  # noqa: F811
    for docs in (odd, spark.read.parquet(SMALL)):
        assert same(exact_duplicates(docs).collect(), copies(rows_of(docs)))


def test_exact_duplicates_across_partitions(spark):
    rows = [(i, "Common text") for i in range(3000)] + [(5000 + i, f"text {i % 700}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = exact_duplicates(docs)
        assert same(found.collect(), copies(rows))
        assert found.filter("kept").count() == 701
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_rows_that_stay_keep_all_columns(odd):  # noqa: F811
    kept = without_exact_duplicates(odd)
    assert kept.columns == odd.columns
    assert kept.count() == len({lowered(t) for _, t in rows_of(odd)})
    assert {r["kept"] for r in kept.select("kept").collect()} == {"clash"}


def test_jaccard_components(spark, odd):  # noqa: F811
    for docs in (odd, spark.read.parquet(SMALL)):
        assert same(jaccard_components(docs).collect(), jaccard(rows_of(docs)))


def test_jaccard_near_the_threshold(spark):
    """Chains of documents whose neighbours are just linked, or just not, and short sets of all sizes."""
    rnd = np.random.default_rng(3)
    rows, n = [], 0
    for size in (4, 5, 7, 8, 9, 10, 12, 13, 17, 25, 40, 80):
        words = [f"w{x}" for x in rnd.integers(0, 10**6, size + 40)]
        for shift in range(0, 24):
            rows.append((n, " ".join(words[shift : shift + size])))
            n += 1
        for k in range(6):
            changed = list(words[:size])
            changed[int(rnd.integers(0, size))] = f"c{k}"
            rows.append((n, " ".join(changed)))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert same(jaccard_components(docs).collect(), jaccard(rows))


def test_jaccard_of_a_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(group_join, "PORTION", 200)
    rnd = np.random.default_rng(4)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(int(rnd.integers(0, 5))):
            words[int(rnd.integers(0, 60))] = f"x{i}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    assert same(jaccard_components(docs).collect(), jaccard(rows))


def test_links_of_a_group_are_fewer_than_its_documents():
    """Of near copies in which every pair is linked, and of two sorts that are not linked with each other, in some
    documents per component that is known already."""
    base = {s: np.arange(s, s + 100, dtype=np.uint64) for s in (0, 1000)}
    own = lambda i: np.append(base[1000 * (i % 2)], np.uint64(5000 + i))
    members = list(range(60))
    group = group_join.Group(members, [i % 20 for i in members], [own(i) for i in members])
    links = []
    for i in range(60, 200):
        links += [(i, m) for m in group.linked(100 + i // 4 * 2 + i % 2, own(i), 80).tolist()]
    label = lambda i: i % 20 if i < 60 else 100 + i // 4 * 2 + i % 2
    # As many as connect the 20 labels of the members and 70 of the queries in two components.
    assert len(links) == 20 + 70 - 2
    assert {m % 2 for i, m in links if i % 2} == {1} and {m % 2 for i, m in links if not i % 2} == {0}
    at = {label(i): label(i) for i in range(200)}
    for a, b in links:
        low, high = sorted((at[label(a)], at[label(b)]))
        assert low != high
        at = {k: low if v == high else v for k, v in at.items()}
    assert len(set(at.values())) == 2


def test_size_classes_leave_room_for_every_difference():
    classes = size_classes(85, 3000)
    for (low, differences, slots), (after, _, _) in zip(classes, classes[1:]):
        for b in {low, (low + after) // 2, after - 1} - {after}:
            for a in range(max(1, -(-85 * b // 100)), b + 1):
                most = a + b - 2 * least_common(a, b, 85)
                assert most <= differences or most <= 0
        assert slots > differences or slots == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)] + [(7000, 7000)]
    found = components(spark.createDataFrame(chain, "a long, b long"))
    assert {(r[0], r[1]) for r in found.collect()} == {(i, 0) for i in range(201)} | {(i, 1000) for i in range(1000, 1300)}


@pytest.mark.parametrize("block", [20_000, 4 << 20])
def test_repeated_passages(spark, odd, monkeypatch, block):  # noqa: F811
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(substring_dedup, "EDGES_PER_PORTION", block // 10)
    for docs in (odd, spark.read.parquet(SMALL)):
        assert same(repeated_passages(docs).collect(), without_passages(rows_of(docs)))


def test_empty_tables(empty):  # noqa: F811
    assert exact_duplicates(empty).count() == 0
    assert without_exact_duplicates(empty).count() == 0
    assert jaccard_components(empty).count() == 0
    assert repeated_passages(empty).count() == 0


def test_words_of_bytes():
    texts = [b"", b" a  b\n", b"c", b"\x0b\x0c", "é ü".encode(), b"x" * (3 << 20) + b" y"]
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    words = words_of(data, bounds)
    found = [data[a:b].tobytes() for a, b in zip(words.start, words.end)]
    assert found == [w for t in texts for w in t.split()]
    assert np.diff(words.first).tolist() == [len(t.split()) for t in texts]
    assert len(set(words.hash.tolist())) == len(set(found))
