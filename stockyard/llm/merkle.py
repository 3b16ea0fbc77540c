"""A Merkle manifest of a dataset as a postorder append log, and each row's proof from it.

*Leaves* are hashes of rows, computed by SQL functions. Every tree's leaves are numbered by a range sort
and prefix sums over its partitions, so that no task ever holds a whole tree.

*Aligned builders.* The leaves of a tree are cut into aligned blocks of ARITY ** HEIGHT. A builder reads its
block's leaves in order and appends each node to its log in the moment it is complete: a leaf when it comes,
a parent behind the last of its children. The roots of the blocks are the leaves of the next round.

*Positions.* Where a node lies in a log follows from the sizes of the subtrees before it, without any index:
behind its last leaf `e` come its ancestors that end there, so that level `k` lies at
`e + e // 3 + e // 9 + ... + k`. A proof addresses siblings by that alone.

*Proofs* go from the last round to the first: the path of a block's root leads on the paths of its leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockyard.llm.common import stored

ARITY, HEIGHT = 3, 6
# The name of the tree whose leaves are the roots of all others; these are named with a + before.
FOREST = "="

SEGMENT = "tree string, block long, n long, labels array<string>, log binary, other binary, root binary"
PATH = "tree string, label string, idx long, lefts array<string>, rights array<string>, subroot string, root string"
PROOF = "tree string, label string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def node_position(level: int, index: int, leaves: int, arity: int = ARITY) -> int:
    """The place of a node in the postorder log of a tree, from 0."""
    last = min((index + 1) * arity**level, leaves) - 1
    before, size = last, arity
    while size <= last:
        before += last // size
        size *= arity
    return before + level


def levels_of(leaves: int, arity: int = ARITY) -> int:
    """Levels above the leaves of a tree."""
    level = 0
    while arity**level < leaves:
        level += 1
    return level


def joined_hash(*hexes: str) -> str:
    return hashlib.sha256("".join(hexes).encode()).hexdigest()


def append_log(leaves: list[str], levels: int, arity: int = ARITY) -> list[str]:
    """The nodes over some leaves in the order of their completion."""
    log: list[str] = []
    waiting: list[list[str]] = [[] for _ in range(levels + 1)]
    for i, leaf in enumerate(leaves):
        log.append(leaf)
        waiting[0].append(leaf)
        size = 1
        for level in range(levels):
            size *= arity
            if (i + 1) % size and i + 1 < len(leaves):
                break
            node = joined_hash(*waiting[level])
            waiting[level].clear()
            waiting[level + 1].append(node)
            log.append(node)
    return log


def log_paths(log: list[str], leaves: int, levels: int, above: tuple, arity: int = ARITY) -> list[tuple]:
    """The path of each leaf as (left siblings, right siblings, path of the parent), read from the log by position."""
    paths = [above]
    for level in reversed(range(levels)):
        count = -(-leaves // arity**level)
        found = []
        for parent, path in enumerate(paths):
            run = range(parent * arity, min(parent * arity + arity, count))
            nodes = [log[node_position(level, i, leaves, arity)] for i in run]
            found += [("".join(nodes[:i]), "".join(nodes[i + 1 :]), path) for i in range(len(nodes))]
        paths = found
    return paths


def _field(column: Column) -> Column:
    text = column.cast("string")
    told = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(column.isNull(), "-").otherwise(told)


def row_hash(columns: list[Column]) -> Column:
    """The hash of a row: of each value's length in bytes and the value, or a dash for a null."""
    return F.sha2(F.concat(*[_field(c) for c in columns]), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with `idx`, each row's place in its `tree` by `order`, and `n`, the tree's rows."""
    ranged = rows.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange("tree", *order, "salt")
    placed = ranged.sortWithinPartitions("tree", *order, "salt").drop("salt")
    at = F.monotonically_increasing_id()
    placed = stored(placed.withColumn("at", at), "ordered").withColumn("part", F.shiftright("at", 33))
    runs = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("own"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.col("first") - F.coalesce(F.sum("own").over(before), F.lit(0))
    starts = runs.select("tree", "part", shift.alias("shift"), F.sum("own").over(whole).alias("n"))
    starts = stored(starts, "starts")
    return placed.join(starts, ["tree", "part"]).select(*rows.columns, (F.col("at") - F.col("shift")).alias("idx"), "n")


def _hexes(joined: bytes) -> list[str]:
    text = joined.hex()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


def _segments(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """Of leaves ordered by (tree, block, idx): a row per block with its log."""
    now, n = None, 0
    labels, leaves, others = [], [], []

    def flush() -> pa.RecordBatch:
        levels = levels_of(n) if n <= span else levels_of(span)
        log = append_log(leaves, levels)
        row = [*now, n, labels, bytes.fromhex("".join(log)), bytes.fromhex("".join(others)), bytes.fromhex(log[-1])]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.binary(), pa.binary(), pa.binary()]
        names = ["tree", "block", "n", "labels", "log", "other", "root"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("tree", "block", "n", "label", "digest", "other")]
        for tree, block, size, label, digest, other in zip(*columns, strict=True):
            if (tree, block) != now:
                if leaves:
                    yield flush()
                now, n, labels, leaves, others = (tree, block), size, [], [], []
            labels.append(label)
            leaves.append(digest)
            others.append(other)
    if leaves:
        yield flush()


def built(leaves: DataFrame, span: int) -> list[DataFrame]:
    """The rounds' segments of all trees over `leaves` (tree, idx, n, label, digest, other)."""
    rounds = []
    most = leaves.agg(F.max("n")).first()[0] or 1
    while True:
        blocks = leaves.withColumn("block", F.floor(F.col("idx") / span)).repartition("tree", "block")
        ordered = blocks.sortWithinPartitions("tree", "block", "idx")
        rounds.append(stored(ordered.mapInArrow(partial(_segments, span=span), SEGMENT), "segments"))
        if most <= span:
            return rounds
        most = -(-most // span)
        going = rounds[-1].filter(F.col("n") > span)
        root = F.lower(F.hex("root"))
        leaves = going.select(
            "tree", F.col("block").alias("idx"), F.ceil(F.col("n") / span).alias("n"), F.lit(None).cast("string").alias("label"),
            root.alias("digest"), root.alias("other"),
        )


def _above(lefts: list[str], rights: list[str]) -> tuple:
    path: tuple = ()
    for left, right in zip(reversed(lefts), reversed(rights), strict=True):
        path = (left, right, path)
    return path


def _opened(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[tuple]:
    for batch in batches:
        for row in batch.to_pylist():
            own, log = len(row["labels"]), _hexes(row["log"])
            levels = levels_of(row["n"]) if row["n"] <= span else levels_of(span)
            paths = log_paths(log, own, levels, _above(row["lefts"], row["rights"]))
            yield row, [log[node_position(0, i, own)] for i in range(own)], paths


def _path_rows(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """The paths of a segment's leaves. In the forest a leaf is a tree's root, and its label the tree."""
    for row, leaves, paths in _opened(batches, span):
        forest = row["tree"] == FOREST
        out: dict[str, list] = {name: [] for name in ("tree", "label", "idx", "lefts", "rights", "subroot", "root")}
        for i, (leaf, path, label) in enumerate(zip(leaves, paths, row["labels"], strict=True)):
            lefts, rights = [], []
            while path:
                left, right, path = path
                lefts.append(left)
                rights.append(right)
            values = (row["tree"], label, row["block"] * span + i, lefts, rights, leaf if forest else row["subroot"], row["top"])
            for column, value in zip(out.values(), values, strict=True):
                column.append(value)
        many = pa.list_(pa.string())
        kinds = [pa.string(), pa.string(), pa.int64(), many, many, pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))


def _proof_rows(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[pa.RecordBatch]:
    """A proof's hash for each leaf of a segment, and the root that it leads to from the leaf's other hash."""
    for row, leaves, paths in _opened(batches, span):
        proofs, folds, told = [], [], {}
        for path, other in zip(paths, _hexes(row["other"]), strict=True):
            siblings, top = [], other
            while path:
                left, right, path = path
                siblings += (left, right)
                top = joined_hash(left, top, right)
            proofs.append(joined_hash(*siblings))
            folds.append(top)
        told = {
            "tree": [row["tree"]] * len(leaves), "label": row["labels"], "leaf": leaves, "subroot": [row["subroot"]] * len(leaves),
            "root": [row["top"]] * len(leaves), "proof_sha256": proofs, "folded_root": folds,
        }
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.string()) for v in told.values()], list(told))


def _led_on(segments: DataFrame, above: DataFrame) -> DataFrame:
    """Segments beside the path of their roots."""
    known = above.select("tree", F.col("idx").alias("block"), "lefts", "rights", "subroot", F.col("root").alias("top"))
    return segments.select("tree", "block", "n", "labels", "log", "other").join(known, ["tree", "block"])


def _downwards(rounds: list[DataFrame], tops: DataFrame, span: int) -> DataFrame:
    """The first round's segments, each beside its root's path. `tops`: the paths of the trees' roots."""
    above = None
    for r in reversed(range(len(rounds))):
        # A tree ends in the round in which it has one segment.
        ends = tops.join(rounds[r].filter(F.col("n") <= span).select("tree"), "tree", "left_semi")
        above = ends if above is None else ends.unionByName(above)
        beside = _led_on(rounds[r], above)
        if r:
            above = stored(beside.mapInArrow(partial(_path_rows, span=span), PATH), "paths")
    return beside


def _roots(rounds: list[DataFrame], span: int) -> DataFrame:
    ended = [r.filter(F.col("n") <= span).select("tree", F.lower(F.hex("root")).alias("digest")) for r in rounds]
    out = ended[0]
    for more in ended[1:]:
        out = out.union(more)
    return out


def manifest(
    df: DataFrame, columns: list[str], id_col: str, tree_col: str, changed: dict[str, Column] | None = None,
    height: int = HEIGHT,
) -> tuple[list[DataFrame], list[DataFrame], DataFrame]:
    """The logs of the trees, the logs of the forest over their roots, and a proof for each row.

    `columns` are hashed into a row's leaf. Rows of the same `tree_col` make a tree, in the order of `id_col`
    (null first; rows of equal identifiers by their leaf's hash). `changed` gives other values of some
    columns, as found when the manifest is verified; proofs are folded from these. A tree column of null is a
    tree of its own, before all others. An empty table has no trees and no proofs. Very long texts are
    hashed in place and never moved; columns not named are ignored, whatever their names.
    """
    span = ARITY**height
    changed = changed or {}
    tree = F.coalesce(F.concat(F.lit("+"), F.col(tree_col).cast("string")), F.lit(""))
    found = row_hash([changed.get(c, F.col(c)) for c in columns])
    rows = df.select(
        tree.alias("tree"), F.col(id_col).cast("long").alias("id"), row_hash([F.col(c) for c in columns]).alias("digest"),
        found.alias("other"),
    )
    leaves = numbered(stored(rows, "leaves"), ["id", "digest"])
    leaves = leaves.select("tree", "idx", "n", F.col("id").cast("string").alias("label"), "digest", "other")
    trees = built(leaves, span)
    roots = _roots(trees, span).select(F.lit(FOREST).alias("tree"), F.col("tree").alias("label"), "digest")
    tops = numbered(roots, ["label"]).select("tree", "idx", "n", "label", "digest", F.col("digest").alias("other"))
    forest = built(tops, span)
    none = F.array().cast("array<string>")
    root = _roots(forest, span).select(
        "tree", F.lit("").alias("label"), F.lit(0).cast("long").alias("idx"), none.alias("lefts"), none.alias("rights"),
        F.lit("").alias("subroot"), F.col("digest").alias("root"),
    )
    paths = _downwards(forest, root, span).mapInArrow(partial(_path_rows, span=span), PATH)
    paths = stored(paths, "paths").select(
        F.col("label").alias("tree"), "label", F.lit(0).cast("long").alias("idx"), "lefts", "rights", "subroot", "root"
    )
    proofs = _downwards(trees, paths, span).mapInArrow(partial(_proof_rows, span=span), PROOF)
    return trees, forest, proofs


def log_rows(segments: DataFrame, height: int = HEIGHT) -> DataFrame:
    """A round's log as rows (tree, block, position, digest), in the order of completion within each block."""
    places = F.sequence(F.lit(0), (F.octet_length("log") / 32).cast("int") - 1)
    nodes = segments.select("tree", "block", "log", F.explode(places).alias("position"))
    digest = F.lower(F.hex(F.substring("log", F.col("position") * 32 + 1, F.lit(32))))
    return nodes.select("tree", "block", "position", digest.alias("digest"))


def verified_documents(df: DataFrame) -> DataFrame:
    """One row per document: its leaf, its source's root, the root of all, and its proof's hash, beside the root
    that the proof leads to once line breaks are gone from the texts of the documents with an even checksum.

    A null in any column is hashed as a dash. Rows of equal identifiers are ordered by their leaves; a row
    without an identifier comes first and is left as it is. An empty table gives an empty result; an empty text
    is a value of no bytes. Other columns are ignored, whatever their names.
    """
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    proofs = manifest(df, columns, "doc_id", "source", {"text": text})[2]
    return proofs.select(
        F.col("label").cast("long").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
