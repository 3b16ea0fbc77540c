"""The Merkle manifest and the filter audit against plain versions."""

import collections
import hashlib
import zlib
from itertools import permutations

import pytest
from cases import WORD, empty, odd  # noqa: F401

from stockyard.llm import merkle
from stockyard.llm.filter_audit import LETTERS, audit

SMALL = "/root/testdata/sf0.001"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text) -> str:
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def way(tree, i):
    """(left, right) siblings of a leaf, level by level."""
    out = []
    for level in tree[:-1]:
        run = i // 3 * 3
        out.append((level[run:i], level[i + 1 : run + 3]))
        i //= 3
    return out


def plain_proofs(rows):
    trees = collections.defaultdict(list)
    for row in rows:
        text, doc = row["text"], row["doc_id"]
        even = doc is not None and zlib.crc32(str(doc).encode()) % 2 == 0
        found = text.replace("\n", "") if even and text is not None else text
        trees[row["source"]].append((doc is not None, doc, leaf(row, text), leaf(row, found)))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: levels([x[2] for x in sorted(trees[s])]) for s in order}
    top = levels([built[s][-1][0] for s in order])
    out = []
    for place, source in enumerate(order):
        for i, (_, doc, own, found) in enumerate(sorted(trees[source])):
            siblings, folded = "", found
            for left, right in way(built[source], i) + way(top, place):
                siblings += "".join(left) + "".join(right)
                folded = h(*left, folded, *right)
            root = top[-1][0]
            out.append((doc, own, built[source][-1][0], root, h(siblings), folded, folded == root))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_proofs(spark, odd):  # noqa: F811
    for docs in (odd, spark.read.parquet(f"{SMALL}/documents.parquet")):
        found = merkle.verified_documents(docs.repartition(5))
        assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        assert ordered(found.collect()) == ordered(plain_proofs(docs.collect()))


@pytest.mark.parametrize("height", [1, 2])
def test_proofs_over_several_rounds(spark, height, monkeypatch):
    """One source with most rows, and more sources than one builder takes."""
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rows = [(i, f"text {i}\nmore", None, "hot" if i < 60 else f"s{i % 17}", 7) for i in range(110)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    trees, forest, proofs = merkle.manifest(docs, columns, "doc_id", "source", height=height)
    assert len(trees) > 1 and len(forest) > 1
    found = proofs.selectExpr("cast(label as long)", "leaf", "subroot", "root", "proof_sha256", "folded_root = root")
    expected = [(d, own, sub, root, proof, True) for d, own, sub, root, proof, _, _ in plain_proofs(docs.collect())]
    assert ordered(found.collect()) == ordered(expected)


def test_positions_in_the_log(spark):
    """Nodes lie where the closed form says, for every number of leaves."""
    for n in range(1, 95):
        leaves = [h(str(i)) for i in range(n)]
        tree, up = levels(leaves), merkle.levels_of(n)
        assert up == len(tree) - 1
        log = merkle.append_log(leaves, up)
        assert len(log) == sum(map(len, tree))
        for level, nodes in enumerate(tree):
            assert [log[merkle.node_position(level, i, n)] for i in range(len(nodes))] == nodes
    rows = [(i, "s") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    trees, _, proofs = merkle.manifest(docs, ["doc_id", "source"], "doc_id", "source")
    log = [r.digest for r in merkle.log_rows(trees[0]).orderBy("position").collect()]
    leaves = [h(f"{len(str(i))}:{i}", "1:s") for i in range(40)]
    assert log == merkle.append_log(leaves, merkle.levels_of(40))
    assert {r.subroot for r in proofs.collect()} == {log[-1]}


def plain_audit(rows, labels):
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    least: dict = {}
    for r in rows:
        if r["doc_id"] is not None:
            least[r["text"] or ""] = min(least.get(r["text"] or "", r["doc_id"]), r["doc_id"])
    judged = collections.defaultdict(list)
    for r in rows:
        text, doc = r["text"] or "", r["doc_id"]
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), "D": any(c in "#$%&*|" for c in text),
            "E": doc is not None and doc > least[text],
        }
        judged[r["lang"] or ""].append(({x for x in fails if fails[x]}, doc in good, doc in toxic))
    out = []
    for part, docs in judged.items():
        shapley, found = collections.Counter(), []
        for order in permutations(LETTERS):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                gone = [d for d in docs if letter in d[0] and not d[0] & before]
                shapley[letter] += len(gone)
                found.append((letter, part, "".join(order), step, sum(not d[0] & (before | {letter}) for d in docs), len(gone),
                              sum(letter in d[0] and bool(d[0] & before) for d in docs), sum(d[0] == {letter} for d in docs),
                              sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out += [(*r[1:], shapley[r[0]]) for r in found]
    return out


def test_filter_audit(spark, odd, empty):  # noqa: F811
    told = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (7, 1, 1), (16, 1, 0), (20, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    small = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    for docs, labels in ((odd, told), small):
        found = audit(docs, labels.withColumn("row", labels.doc_id))
        expected = plain_audit(docs.collect(), [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
        assert ordered(found.collect()) == ordered(expected)
    assert audit(empty, told).count() == 0
    assert audit(odd, told.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0


def test_manifest_of_an_empty_table(empty):  # noqa: F811
    assert merkle.verified_documents(empty).count() == 0
