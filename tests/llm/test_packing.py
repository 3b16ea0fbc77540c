"""Packing, mixing and sharding: round trips and the laws they promise."""

import collections
import zlib

import numpy as np
import public_tokenizers
from cases import WORD, empty, odd, rows_of  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stockyard.llm.mixing import budgets, mixed, mixture
from stockyard.llm.packing import fullest, minimum_slack, packed
from stockyard.llm.sharding import exchanged, sharded
from stockyard.llm.tokens import encoder, slow_encoder

SMALL = "/root/testdata/sf0.001/documents.parquet"
PATH = public_tokenizers.path("byte_bpe_50k.json")


def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 5), max_size=6), st.integers(0, 40))
def test_fullest_combination(counts, room):
    table = np.zeros(41, np.int64)
    for length, n in counts.items():
        table[length] = n
    reachable = {0}
    for length, n in counts.items():
        reachable |= {r + length * k for r in reachable for k in range(n + 1)}
    chosen = fullest(table, room)
    assert sum(length * n for length, n in chosen) == max(r for r in reachable if r <= room)
    assert all(n <= counts[length] for length, n in chosen)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=12))
def test_every_piece_has_one_place(counts):
    filled, seen = collections.defaultdict(list), collections.Counter()
    for use in minimum_slack(counts, 64):
        assert use.first == seen[use.length]
        seen[use.length] += use.bins * use.times
        for b in range(use.bins):
            filled[use.bin + b] += [(use.offset + k * use.length, use.length) for k in range(use.times)]
    assert seen == counts
    for places in filled.values():
        end = 0
        for at, length in sorted(places):
            assert at == end
            end += length
        assert end <= 64


def test_packed_ids_round_trip(spark, odd):  # noqa: F811
    own = tokenizer()
    for docs in (odd, spark.read.parquet(SMALL)):
        rows = rows_of(docs)
        expected = []
        for d, text in rows:
            ids = np.array([*own.encode(text, add_special_tokens=False).ids, 2], "<u4")
            n = -(-len(ids) // 1024)
            bounds = [0, *range(len(ids) - (n - 1) * 1024, len(ids) + 1, 1024)]
            expected += [
                (d, k, bounds[k], bounds[k + 1] - bounds[k], zlib.crc32(ids[bounds[k] : bounds[k + 1]].tobytes()))
                for k in range(n)
            ]
        found = packed(docs, PATH).collect()
        assert collections.Counter(tuple(r)[:5] for r in found) == collections.Counter(expected)
        sequences = collections.defaultdict(list)
        for r in found:
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        for places in sequences.values():
            ends = np.cumsum([n for _, n in sorted(places)])
            assert [at for at, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 1024
        total = sum(r["length"] for r in found)
        assert len(sequences) <= -(-total // 1024) * 1.02 + 1


def test_encoder_finds_the_tokenizers_ids():
    own = tokenizer()
    texts = [
        "", " ", "  ", "a b", "a  b", "a\nb", "a \n b", "a\n\nb", "\n", " lead", "trail ", "it's 1,000 %% été", "\x00a \x00b",
        "x\u00a0y z", "<|endoftext|> a", "tab\tx", "\r\n", "a \u2028b", "word " * 300, "\x1c a", "😀 😀",
    ]
    expected = [own.encode(t, add_special_tokens=False).ids for t in texts]
    for encode in (encoder(PATH), slow_encoder(PATH)):
        assert [list(encode(t)) for t in texts] == expected
    other = public_tokenizers.path("word_bpe_49k.json")
    assert list(encoder(other)("a word")) == list(slow_encoder(other)("a word"))


def test_mixture_keeps_to_its_budgets(spark):
    docs = spark.read.parquet(SMALL)
    words = {d: len(WORD.findall(t)) for d, t in rows_of(docs)}
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    totals = collections.Counter()
    for d, n in words.items():
        totals[source[d]] += n
    drawn = mixed(docs, most_epochs=3.0, block_tokens=2000).collect()
    used, docs_of = collections.Counter(), collections.Counter()
    for r in drawn:
        used[r["source"]] += r["n_tokens"]
        docs_of[r["doc_id"]] += 1
    largest = max(totals, key=totals.get)
    assert used[largest] == totals[largest] and set(docs_of) == set(words)
    most = max(words.values())
    plan = {r["source"]: r for r in budgets(spark.createDataFrame([*totals.items()], "source string, total long"), 3.0).collect()}
    for s, total in totals.items():
        assert plan[s]["budget"] <= 3.001 * total + 1
        assert plan[s]["budget"] - most < used[s] <= plan[s]["budget"]
    assert abs(sum(r["weight"] for r in plan.values()) - 1) < 1e-9
    blocks = collections.defaultdict(list)
    for r in drawn:
        blocks[r["block"]].append(r["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in blocks.values()) and len(blocks) > 3


def test_exponent_meets_entropy_and_repetition(spark):
    totals = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10), ("d", 0), (None, 500)], "source string, total long")
    as_they_are = {r["source"]: r["weight"] for r in budgets(totals).collect()}
    assert abs(as_they_are["a"] - 1000 / 1610) < 1e-9 and as_they_are["d"] == 0
    even = [r["weight"] for r in budgets(totals, entropy=0.95).collect() if r["weight"]]
    h = -sum(w * np.log(w) for w in even) / np.log(4)
    assert 0.95 <= h < 0.9502
    limited = {r["source"]: r["budget"] for r in budgets(totals, most_epochs=2.0).collect()}
    assert limited["c"] in (19, 20) and limited["a"] == 1000
    fixed = budgets(totals, most_epochs=1.5, budget=1000).collect()
    assert abs(sum(r["budget"] for r in fixed) - 1000) <= 3 and max(r["budget"] / r["total"] for r in fixed if r["total"] > 10) < 1.51


def test_mixture_of_odd_rows(odd, empty):  # noqa: F811
    rows = mixture(odd, most_epochs=2.0)
    assert rows.columns == odd.columns
    counted = collections.Counter((r["doc_id"], r["text"], r["source"]) for r in rows.collect())
    assert {(r["doc_id"], r["text"], r["source"]) for r in odd.collect()} == set(counted)
    assert mixed(empty, most_epochs=2.0).count() == 0 and mixture(empty).count() == 0


def check_shards(rows, found, shards):
    sizes = collections.Counter(r["shard"] for r in found)
    assert sum(sizes.values()) == len(rows)
    assert max(sizes.values(), default=0) - min([sizes.get(s, 0) for s in range(shards)]) <= 1
    slots = collections.defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    expected = collections.Counter((d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in rows)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected


def test_shards(spark, odd, empty):  # noqa: F811
    for docs in (odd, spark.read.parquet(SMALL)):
        check_shards(rows_of(docs), sharded(docs).collect(), 8)
    assert sharded(empty).count() == 0


def test_copies_share_shards(spark):
    """A text with a third of all rows fills whole shards; small groups stay together."""
    rows = [(i, "hot") for i in range(400)] + [(1000 + i, f"text {i // 3}") for i in range(300)]
    rows += [(2000 + i, f"alone {i}") for i in range(500)]
    found = sharded(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    check_shards(rows, found, 8)
    shards = collections.defaultdict(set)
    for r in found:
        shards[r["text_crc32"]].add(r["shard"])
    # 400 rows need three shards of 150.
    assert len(shards[zlib.crc32(b"hot")]) <= 4
    assert sum(len(shards[zlib.crc32(f"text {i}".encode())]) > 1 for i in range(100)) <= 8


def test_copies_come_together_where_every_text_has_one(spark):
    """Without documents that leave room, groups come together by exchange between shards."""
    rows = [(i, f"pair {i // 2}") for i in range(1600)] + [(2000 + i, f"four {i // 4}") for i in range(1600)]
    found = sharded(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()
    check_shards(rows, found, 8)
    shards = collections.defaultdict(set)
    for r in found:
        shards[r["text_crc32"]].add(r["shard"])
    # Of 1,200 groups.
    assert len(shards) == 1200 and sum(len(s) > 1 for s in shards.values()) <= 24


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), min_size=4, max_size=4), min_size=4, max_size=4), st.lists(st.integers(0, 30), min_size=4, max_size=4))
def test_exchange_keeps_to_wishes_and_room(wishes, loads):
    for i in range(4):
        wishes[i][i] = 0
    room = [15] * 4
    moved = exchanged(wishes, loads, room)
    after = [loads[s] + sum(row[s] for row in moved) - sum(moved[s]) for s in range(4)]
    assert all(0 <= moved[a][b] <= wishes[a][b] for a in range(4) for b in range(4))
    assert all(x <= max(r, n) for x, r, n in zip(after, room, loads, strict=True))
    # Nothing is left that two shards could exchange or a shard has room for.
    left = [[wishes[a][b] - moved[a][b] for b in range(4)] for a in range(4)]
    assert not any(left[a][b] and (left[b][a] or after[b] < room[b]) for a in range(4) for b in range(4))
