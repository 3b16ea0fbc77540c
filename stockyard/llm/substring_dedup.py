"""Repeated passages, as paths of a de Bruijn graph of words.

An edge is a window of `WINDOW` words; consecutive windows of a document follow each other along a path.
Documents are dealt into blocks by ranges of their identifiers, so that whether an edge starts in a
smaller document is a question about blocks, apart from the block itself.

1. *Edges.* Each block sends the sorted hashes of its distinct edges, in portions by hash, and nothing
   else: however often an edge occurs, it is sent once per block.
2. *Repeats.* Per portion, an edge's first block is its source; the other blocks get to know it.
3. *Paths.* In each document, consecutive repeated edges that have the same source are compacted to one
   path. Equal paths of a block are one, with a list of the places where they start.
4. *Coordinates.* Paths join their source's documents. There an edge's first occurrence gives its
   coordinates; as long as coordinates go on from edge to edge, the words of path and source are compared.
5. The words that confirmed edges cover are removed.

The documents are shuffled once; the steps share that exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import text_bytes
from stockyard.llm.words import Words, sequences, words_of

WINDOW = 13
BLOCK_BYTES = 4 << 20
EDGES_PER_PORTION = 1 << 20
# Beyond so many blocks they grow instead; their bounds are all that the driver holds.
MOST_BLOCKS = 100_000


class Block(NamedTuple):
    """The documents of a block in the order of their identifiers."""

    ids: np.ndarray
    rank: np.ndarray
    data: np.ndarray
    bounds: np.ndarray
    words: Words
    # Each edge's hash and the word it starts at; the distinct hashes, and each edge's place among them.
    edge: np.ndarray
    at: np.ndarray
    distinct: np.ndarray
    place: np.ndarray
    # The first edge, in the order of the documents, of each distinct hash.
    first: np.ndarray


def _ordered(rows: pa.Table) -> pa.Table:
    return rows.sort_by([("id", "ascending"), ("text", "ascending")])


def read_block(rows: pa.Table, window: int) -> Block:
    rows = _ordered(rows)
    ids = rows["id"].to_numpy()
    data, bounds = text_bytes(rows["text"])
    words = words_of(data, bounds)
    every = sequences(words.hash, window)
    # Only windows within one document are edges.
    last = np.repeat(words.first[1:], np.diff(words.first))
    at = np.flatnonzero(np.arange(len(every)) + window <= last[: len(every)])
    edge = every[at]
    distinct, first, place = np.unique(edge, return_index=True, return_inverse=True)
    rank = np.concatenate([[0], np.cumsum(ids[1:] != ids[:-1])]) if len(ids) else ids
    return Block(ids, rank, data, bounds, words, edge, at, distinct, place, first)


def _document_of(block: Block, word: np.ndarray) -> np.ndarray:
    return np.searchsorted(block.words.first, word, "right") - 1


def _squeezed(ascending: np.ndarray) -> bytes:
    """Ascending numbers as the bytes of their differences, the like bytes together."""
    steps = np.diff(ascending, prepend=ascending.dtype.type(0))
    return steps.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unsqueezed(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64)
    return np.cumsum(steps.ravel(), dtype=np.uint64)


def _portions_of(distinct: np.ndarray, bits: int) -> np.ndarray:
    """Where each portion of the hashes begins and ends."""
    if not bits:
        return np.array([0, len(distinct)])
    lows = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(distinct, lows), [len(distinct)]])


EDGES = "block int, portion int, edges binary"


def _edges(key, rows: pa.Table, window: int, bits: int) -> pa.Table:
    block = read_block(rows, window)
    cuts = _portions_of(block.distinct, bits)
    filled = np.flatnonzero(np.diff(cuts))
    return pa.table(
        {
            "block": pa.array([key[0].as_py()] * len(filled), pa.int32()),
            "portion": pa.array(filled, pa.int32()),
            "edges": pa.array([_squeezed(block.distinct[cuts[p] : cuts[p + 1]]) for p in filled], pa.binary()),
        }
    )


REPEATS = "block int, portion int, places binary, sources binary"


def _repeats(rows: pa.Table) -> pa.Table:
    """For each block the places, among the edges it sent, of those with a smaller block, and that block."""
    blocks = rows["block"].to_numpy()
    order = np.argsort(blocks, kind="stable")
    sent = [_unsqueezed(rows["edges"][int(i)].as_py()) for i in order]
    counts = np.array([len(s) for s in sent])
    edges, owner = np.concatenate(sent), np.repeat(np.arange(len(sent)), counts)
    place = np.concatenate([np.arange(n) for n in counts])
    by = np.argsort(edges, kind="stable")
    edges = edges[by]
    opens = np.concatenate([[True], edges[1:] != edges[:-1]])
    head = np.maximum.accumulate(np.where(opens, np.arange(len(edges)), 0))
    later = ~opens
    who, where, source = owner[by][later], place[by][later], blocks[order][owner[by[head[later]]]]
    again = np.lexsort((where, who))
    who, where, source = who[again], where[again].astype("<u4"), source[again].astype("<i4")
    cuts = np.searchsorted(who, np.arange(len(sent) + 1))
    told = [i for i in range(len(sent)) if cuts[i] < cuts[i + 1]]
    portion = rows["portion"][0].as_py()
    return pa.table(
        {
            "block": pa.array([int(blocks[order[i]]) for i in told], pa.int32()),
            "portion": pa.array([portion] * len(told), pa.int32()),
            "places": pa.array([where[cuts[i] : cuts[i + 1]].tobytes() for i in told], pa.binary()),
            "sources": pa.array([source[cuts[i] : cuts[i + 1]].tobytes() for i in told], pa.binary()),
        }
    )


PATHS = "block int, source int, words binary, rows binary, starts binary"


def _paths(key, rows: pa.Table, repeats: pa.Table, window: int, bits: int) -> pa.Table:
    """Paths of edges that also start in a smaller document."""
    own, block = key[0].as_py(), read_block(rows, window)
    source = np.full(len(block.distinct), -1, np.int64)
    cuts = _portions_of(block.distinct, bits)
    told = zip(*[repeats[c].to_pylist() for c in ("portion", "places", "sources")], strict=True)
    for portion, places, sources in told:
        source[cuts[portion] + np.frombuffer(places, "<u4")] = np.frombuffer(sources, "<i4")
    document = _document_of(block, block.at)
    of = source[block.place]
    if len(document):
        inside = (of < 0) & (block.rank[document] > block.rank[document[block.first]][block.place])
        of = np.where(inside, own, of)
    repeated = np.flatnonzero(of >= 0)
    found: dict[tuple[int, bytes], tuple[list[int], list[int]]] = {}
    if len(repeated):
        # A path ends where edges stop following each other, or where their source changes.
        at, src, doc = block.at[repeated], of[repeated], document[repeated]
        breaks = np.flatnonzero((np.diff(at) != 1) | (np.diff(src) != 0) | (np.diff(doc) != 0)) + 1
        heads, tails = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(at)]])
        first, last = at[heads], at[tails - 1] + window
        of_doc = doc[heads]
        for f, l, s, d in zip(first.tolist(), last.tolist(), src[heads].tolist(), of_doc.tolist(), strict=True):
            places = found.setdefault((s, _text(block, f, l)), ([], []))
            places[0].append(d)
            places[1].append(f - int(block.words.first[d]))
    return pa.table(
        {
            "block": pa.array([own] * len(found), pa.int32()),
            "source": pa.array([s for s, _ in found], pa.int32()),
            "words": pa.array([w for _, w in found], pa.binary()),
            "rows": pa.array([np.array(r, "<i4").tobytes() for r, _ in found.values()], pa.binary()),
            "starts": pa.array([np.array(s, "<i4").tobytes() for _, s in found.values()], pa.binary()),
        }
    )


def _text(block: Block, first: int, last: int) -> bytes:
    """Words `first` to `last` (exclusive), one space between them, whatever there is in the text."""
    span = block.data[block.words.start[first] : block.words.end[last - 1]].tobytes()
    return b" ".join(span.split())


SPANS = "block int, rows binary, starts binary, first int, n int"


def _confirmed(key, rows: pa.Table, paths: pa.Table, window: int) -> pa.Table:
    """Of each path the runs of edges (`first`, `n`) whose words the source has."""
    out: list[tuple] = []
    if paths.num_rows:
        block = read_block(rows, window)
        data, bounds = text_bytes(paths["words"])
        words = words_of(data, bounds)
        every = sequences(words.hash, window)
        owners, at_rows, at_starts = (paths[c].to_pylist() for c in ("block", "rows", "starts"))
        for i, (low, high) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            edges = every[low : high - window + 1]
            place = np.minimum(np.searchsorted(block.distinct, edges), len(block.distinct) - 1)
            there = block.at[block.first[place]]
            known = block.distinct[place] == edges
            follows = (np.diff(there) == 1) & known[1:] & known[:-1]
            # An edge may follow another in the array and yet begin the next document.
            follows &= np.diff(_document_of(block, there)) == 0
            cuts = np.concatenate([[0], np.flatnonzero(~follows) + 1, [len(edges)]]).tolist()
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if not known[a]:
                    continue
                theirs = _text(block, int(there[a]), int(there[a]) + b - a + window - 1)
                own = data[words.start[low + a] : words.end[low + b + window - 2]].tobytes()
                if own == theirs:
                    out.append((owners[i], at_rows[i], at_starts[i], a, b - a))
                    continue
                for k in range(a, b):
                    own = data[words.start[low + k] : words.end[low + k + window - 1]].tobytes()
                    if own == _text(block, int(there[k]), int(there[k]) + window):
                        out.append((owners[i], at_rows[i], at_starts[i], k, 1))
    columns = list(zip(*out, strict=True)) if out else [()] * 5
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]
    names = ["block", "rows", "starts", "first", "n"]
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})


def _kept(key, rows: pa.Table, spans: pa.Table, window: int) -> pa.Table:
    rows = _ordered(rows)
    covered: dict[int, list[tuple[int, int]]] = {}
    for at_rows, at_starts, first, n in zip(
        *[spans[c].to_pylist() for c in ("rows", "starts", "first", "n")], strict=True
    ):
        where = zip(np.frombuffer(at_rows, "<i4").tolist(), np.frombuffer(at_starts, "<i4").tolist(), strict=True)
        for row, start in where:
            covered.setdefault(row, []).append((start + first, start + first + n + window - 1))
    n_words, n_removed, digests = [], [], []
    texts = rows["text"].cast(pa.large_binary())
    for i in range(rows.num_rows):
        words = (texts[i].as_py() or b"").split()
        n_words.append(len(words))
        if i in covered:
            change = np.zeros(len(words) + 1, np.int64)
            for low, high in covered[i]:
                change[low] += 1
                change[high] -= 1
            words = [w for w, c in zip(words, np.cumsum(change[:-1]).tolist(), strict=True) if not c]
        n_removed.append(n_words[-1] - len(words))
        digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
    return pa.table(
        {
            "doc_id": rows["id"],
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
    )


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def repeated_passages(
    df: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its words, how many of them are removed, and a digest of those kept.

    A word is removed if a window of `window` consecutive words covers it whose words also start in a
    document with a smaller identifier. Windows are judged on the texts as they are. A null text has no
    words. Rows of the same identifier are one document as far as smaller ones are concerned, with a row
    each. A row without an identifier keeps all words and is no source. Other columns are ignored.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = docs.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"), F.count("id").alias("n")
    ).first()
    blocks = int(min(MOST_BLOCKS, max(1, size["bytes"] // BLOCK_BYTES), max(1, size["n"])))
    bits = max(0, int(size["bytes"]) // 6 // EDGES_PER_PORTION).bit_length()
    parts = [i / blocks for i in range(1, blocks)]
    splits = docs.agg(F.percentile_approx("id", parts, 20 * blocks).alias("s")).first()["s"] if parts else []
    bounds = np.unique(np.array(splits or [], np.int64))

    @F.pandas_udf("int")
    def block_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(), "left").astype(np.int32))

    dealt = docs.filter("id IS NOT NULL").withColumn("block", block_of("id"))
    grouped = dealt.groupBy("block")

    edges = grouped.applyInArrow(lambda key, rows: _edges(key, rows, window, bits), EDGES)
    repeats = edges.groupBy("portion").applyInArrow(_repeats, REPEATS)
    paths = grouped.cogroup(repeats.groupBy("block")).applyInArrow(
        lambda key, rows, told: _paths(key, rows, told, window, bits), PATHS
    )
    spans = grouped.cogroup(paths.groupBy("source")).applyInArrow(
        lambda key, rows, asked: _confirmed(key, rows, asked, window), SPANS
    )
    kept = grouped.cogroup(spans.groupBy("block")).applyInArrow(
        lambda key, rows, found: _kept(key, rows, found, window), RESULT
    )
    unnamed = docs.filter("id IS NULL").mapInArrow(_whole, RESULT)
    return kept.unionByName(unnamed)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows without an identifier, with all their words."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        nothing = pa.table({"rows": [], "starts": [], "first": [], "n": []})
        yield from _kept(None, rows, nothing, WINDOW).to_batches()
