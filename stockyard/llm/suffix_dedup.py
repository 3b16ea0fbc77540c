"""Repeated byte strings of a fixed length, found by sorting suffixes column by column.

A string of `LENGTH` bytes (a window) is repeated if it starts at two places of the collection, in whichever documents.

*Anchors.* A window's anchor is the place of the least hash among its `GRAM`-byte strings (the leftmost of
equal ones). It depends on the window's bytes alone, so that equal windows have equal grams at equal
distances. Consecutive windows with one anchor are a run: a string of a few hundred bytes. Runs meet by the
hash of their anchor's gram; a run that meets none is not repeated, and runs that are equal as a whole are.
Only where different runs meet are their bytes compared.

*Columns.* The different runs of a gram are a small collection of documents, laid side by side so that their
anchors are in one column. Its suffix order is built as in the construction of a collection's
Burrows-Wheeler transform: each round inserts one symbol per document before the suffixes of the round
before, from the last column to the first. A stable sort of the new symbols, read in the present order, gives the
new order; the common prefix of new neighbours is one more than the least one between their old places.
Columns are read one after the other and only the present order and common prefixes are held. A
window is repeated where a neighbour has `LENGTH` symbols in common.

*Hot grams.* Where more than `MOST` different runs meet, each is cut into shorter ones by distance to the anchor,
which meet only if all bytes that their windows share are equal: first of `WIDTHS[0]` windows, at last of one,
where those that meet are equal and are merely counted. So no task ever gets an unbounded collection.

*Texts.* Whatever the number of rounds, texts are shuffled once: each different one is kept in a table that is dealt by the
text's name, where what is asked of a text is brought to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import clustered, stored, text_bytes
from stockyard.llm.words import mixed

LENGTH, GRAM = 400, 64
# Different runs of one gram that are sorted together, and how many windows runs are cut to beyond that.
MOST, WIDTHS = 1000, (16, 1)
# Bytes whose windows are looked at together, and runs that are sorted together.
STEP, TOGETHER = 1 << 20, 4096
# Bytes of text that a bucket of the texts' table is meant to hold, and the most buckets.
BUCKET, MOST_BUCKETS = 16 << 20, 50_000

RUNS = "doc binary, start long, windows int, offset int, key long, digest long, n long"
TEXTS = "doc binary, text string, n long"
CONTENTS = "doc binary, start long, windows int, offset int, key long, digest long, alone boolean, content binary"
SPANS = "doc binary, start long, stop long"

_CODE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x2545F4914F6CDD1D


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def grams(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of every `length` consecutive bytes; `length` is a power of two."""
    out, step, seed = _CODE[data], 1, 0x9E6C63D0876A9A35
    while step < length:
        out = out[:-step] * np.uint64(seed | 1) + out[step:]
        step, seed = 2 * step, seed * 0xD1342543DE82EF95 % 2**64
    return mixed(out)


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    n = len(values) - width + 1
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n], up[width - 1 : width - 1 + n])


def runs_of(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, start, windows, offset, key, digest) of the runs of texts whose bytes lie in `data` from `bounds` on.

    Portions of bytes are looked at one after the other, however long a text; a run ends with its portion.
    """
    long = np.flatnonzero(np.diff(bounds) >= length)
    size = STEP + length
    up, down = _powers(_BASE, size + 1), _powers(pow(_BASE, -1, 1 << 64), size + 1)
    for low in range(0, max(0, len(data) - length + 1), STEP):
        part = data[low : low + STEP + length - 1]
        n = len(part) - length + 1
        valid = np.zeros(n + 1, np.int64)
        np.add.at(valid, np.clip(bounds[long] - low, 0, n), 1)
        np.add.at(valid, np.clip(bounds[long + 1] - length + 1 - low, 0, n), -1)
        valid = np.cumsum(valid)[:n] > 0
        if not valid.any():
            continue
        hashes = grams(part, gram)
        ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        anchor = (least_in_windows(ranked, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        changes = np.flatnonzero((anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])) + 1
        first, last = np.append(0, changes), np.append(changes, n)
        first, last = first[valid[first]], last[valid[first]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_CODE[part] * up[: len(part)], out=sums[1:])
        digest = mixed((sums[last + length - 1] - sums[first]) * down[first])
        where = anchor[first]
        shape = (last - first).astype(np.uint64) * np.uint64(1 << 20) + (where - first).astype(np.uint64)
        text = np.searchsorted(bounds, first + low, "right") - 1
        yield text, first + low - bounds[text], last - first, where - first, hashes[where], mixed(digest ^ mixed(shape))


def _each_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each different text of a batch, with the number of its copies there: copies are not all sent to one task."""
    for batch in batches:
        first: dict[bytes, int] = {}
        copies = np.zeros(batch.num_rows, np.int64)
        for i, doc in enumerate(batch["doc"].to_pylist()):
            copies[first.setdefault(doc, i)] += 1
        kept = np.fromiter(first.values(), np.int64, len(first))
        rows = pa.array(kept)
        columns = [batch["doc"].take(rows), batch["text"].take(rows), pa.array(copies[kept])]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "text", "n"])


def _run_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """The runs of each text."""
    for batch in batches:
        data, bounds = text_bytes(batch["text"])
        for text, start, windows, offset, key, digest in runs_of(data, bounds, length, gram):
            rows = pa.array(text)
            columns = [
                batch["doc"].take(rows), pa.array(start), pa.array(windows.astype(np.int32)), pa.array(offset.astype(np.int32)),
                pa.array(key.view(np.int64)), pa.array(digest.view(np.int64)), batch["n"].take(rows),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "start", "windows", "offset", "key", "digest", "n"])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes]]:
    for batch in batches:
        for doc, text, asked in zip(batch["doc"], batch["text"].cast(pa.large_binary()), batch["asked"], strict=True):
            whole = text.as_py()
            for run in asked.as_py():
                yield run | {"doc": doc.as_py()}, whole


def _in_batches(rows: Iterator[dict], kinds: dict[str, pa.DataType], size: int = 2000) -> Iterator[pa.RecordBatch]:
    schema, ready = pa.schema(list(kinds.items())), []
    for row in rows:
        ready.append(row)
        if len(ready) == size:
            yield pa.RecordBatch.from_pylist(ready, schema)
            ready = []
    if ready:
        yield pa.RecordBatch.from_pylist(ready, schema)


_RUN_KINDS = {"doc": pa.binary(), "start": pa.int64(), "windows": pa.int32(), "offset": pa.int32(), "key": pa.int64(), "digest": pa.int64()}


def _contents(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[dict]:
        for run, text in _asked(batches):
            yield run | {"content": text[run["start"] : run["start"] + run["windows"] + length - 1]}

    return _in_batches(rows(), _RUN_KINDS | {"alone": pa.bool_(), "content": pa.binary()})


def _hash(told: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(told, digest_size=8).digest(), "little", signed=True)


def _shorter(batches: Iterator[pa.RecordBatch], length: int, width: int) -> Iterator[pa.RecordBatch]:
    """Runs cut into parts of `width` windows at most, by distance to the anchor; the key is what all windows at
    these distances have in common."""

    def rows() -> Iterator[dict]:
        for run, text in _asked(batches):
            far, near, anchor = run["offset"], run["offset"] - run["windows"] + 1, run["start"] + run["offset"]
            for part in range(near // width, far // width + 1):
                high, low = min(far, part * width + width - 1), max(near, part * width)
                start = anchor - high
                common = text[anchor - part * width : anchor - part * width - width + 1 + length]
                content = text[start : start + high - low + length]
                place = f"{width} {part} {high} {low} ".encode()
                yield {
                    "doc": run["doc"], "start": start, "windows": high - low + 1, "offset": high,
                    "key": _hash(f"{width} {part} ".encode() + common), "digest": _hash(place + content), "n": 1,
                }

    return _in_batches(rows(), _RUN_KINDS | {"n": pa.int64()})


def repeated_starts(contents: list[bytes], offsets: np.ndarray, piles: np.ndarray, length: int) -> tuple[np.ndarray, int]:
    """Where the windows of some documents are repeated, as (column, document), and the anchors' column.

    `piles` are ascending; only documents of one pile are compared. `offsets` are the places of their anchors.
    """
    left = int(offsets.max())
    right = max(len(c) - o for c, o in zip(contents, offsets.tolist(), strict=True))
    rows = np.zeros((len(contents), left + right), np.int64)
    for i, (content, offset) in enumerate(zip(contents, offsets.tolist(), strict=True)):
        rows[i, left - offset : left - offset + len(content)] = np.frombuffer(content, np.uint8)
        rows[i, left - offset : left - offset + len(content)] += 1
    columns = np.ascontiguousarray(rows.T.astype(np.int16))
    m = len(contents)
    pile = piles.astype(np.int64) * 257
    order, common = np.arange(m), np.zeros(m + 1, np.int32)
    repeated = np.zeros((left + 1, m), bool)
    for column in range(left + right - 1, -1, -1):
        # One symbol per document is inserted; 0 stands for none, which equals nothing.
        symbols = columns[column][order]
        keys = pile + symbols
        by = np.argsort(keys, kind="stable")
        sorted_keys = keys[by]
        equal = np.flatnonzero((sorted_keys[1:] == sorted_keys[:-1]) & (symbols[by[1:]] != 0))
        now = np.zeros(m + 1, np.int32)
        if len(equal):
            between = np.stack([by[equal] + 1, by[equal + 1] + 1], axis=1).ravel()
            now[equal + 1] = np.minimum.reduceat(common, between)[::2] + 1
        order, common = order[by], now
        if column <= left:
            enough = common >= length
            repeated[column, order[enough[:-1] | enough[1:]]] = True
    return repeated, left


def _spans(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Of contents ordered by (key, digest): the bytes that repeated windows cover, of runs that occur once."""

    def judged(held: list[dict]) -> pa.RecordBatch:
        piles = np.unique(np.array([r["key"] for r in held]), return_inverse=True)[1]
        offsets = np.array([r["offset"] for r in held])
        repeated, left = repeated_starts([r["content"] for r in held], offsets, piles, length)
        docs, starts, stops = [], [], []
        for i, run in enumerate(held):
            if run["alone"]:
                first = left - run["offset"]
                hit = np.zeros(run["windows"] + 2, np.int8)
                hit[1:-1] = repeated[first : first + run["windows"], i]
                edges = np.flatnonzero(np.diff(hit)).reshape(-1, 2)
                docs += [run["doc"]] * len(edges)
                starts += (run["start"] + edges[:, 0]).tolist()
                stops += (run["start"] + edges[:, 1] + length - 1).tolist()
        columns = [pa.array(docs, pa.binary()), pa.array(starts, pa.int64()), pa.array(stops, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["doc", "start", "stop"])

    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if len(held) >= TOGETHER and row["key"] != held[-1]["key"]:
                yield judged(held)
                held = []
            held.append(row)
    if held:
        yield judged(held)


def _spans_of(runs: DataFrame, texts: DataFrame, buckets: int, length: int, widths: tuple[int, ...]) -> DataFrame:
    """The bytes (doc, start, stop) that repeated windows of the runs cover."""
    keys = runs.groupBy("key").agg(F.sum("n").alias("met"), F.min("digest").alias("low"), F.max("digest").alias("high"))
    keys = stored(keys.filter("met > 1").select("key", (F.col("low") < F.col("high")).alias("differ")), "keys")
    # What joins here is a share of all runs or texts, so none of it is a broadcast, however few they are.
    shared = stored(runs.join(keys.hint("merge"), "key"), "shared")
    whole = [F.col("start"), (F.col("start") + F.col("windows") + (length - 1)).alias("stop")]
    spans = shared.filter("NOT differ").select("doc", *whole)
    differing = shared.filter("differ")
    if differing.isEmpty():
        return spans
    one = F.struct("doc", "start", "windows", "offset")
    groups = differing.groupBy("key", "digest").agg(F.sum("n").alias("met"), F.min(one).alias("one"))
    groups = stored(groups, "different-runs")
    spans = spans.union(differing.join(groups.filter("met > 1").select("key", "digest").hint("merge"), ["key", "digest"]).select("doc", *whole))
    piles = stored(groups.groupBy("key").agg(F.count("*").alias("members")), "piles")
    members = groups.join(piles.hint("merge"), "key")
    run = F.struct("one.start", "one.windows", "one.offset", "key", "digest", (F.col("met") == 1).alias("alone"))

    def beside_texts(chosen: DataFrame) -> DataFrame:
        # Dealt as the texts are, so that the join shuffles neither.
        asked = chosen.select(F.col("one.doc").alias("doc"), run.alias("run")).repartition(buckets, "doc")
        asked = asked.groupBy("doc").agg(F.collect_list("run").alias("asked"))
        return texts.join(asked.hint("merge"), "doc").select("doc", "text", "asked")

    contents = beside_texts(members.filter(F.col("members") <= MOST)).mapInArrow(partial(_contents, length=length), CONTENTS)
    ordered = contents.repartition("key").sortWithinPartitions("key", "digest")
    spans = spans.union(stored(ordered.mapInArrow(partial(_spans, length=length), SPANS), "spans"))
    hot = members.filter(F.col("members") > MOST)
    if not widths or hot.isEmpty():
        return spans
    finer = beside_texts(hot).mapInArrow(partial(_shorter, length=length, width=widths[0]), RUNS)
    return spans.union(_spans_of(stored(finer, "shorter"), texts, buckets, length, widths[1:]))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text without its spans."""
    for batch in batches:
        texts = batch["text"].cast(pa.large_binary())
        removed, runs, digests = [], [], []
        for text, spans in zip(texts, batch["spans"], strict=True):
            whole, at, gone, n, kept = text.as_py(), 0, 0, 0, hashlib.sha256()
            end = -1
            for start, stop in sorted((s["start"], s["stop"]) for s in spans.as_py()):
                if start > end:
                    kept.update(whole[at:start])
                    n += 1
                    gone += stop - start
                    end = stop
                elif stop > end:
                    gone += stop - end
                    end = stop
                at = end
            kept.update(whole[at:])
            removed.append(gone)
            runs.append(n)
            digests.append(kept.hexdigest())
        columns = [batch["doc"], pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc", "n_removed", "n_spans", "kept"])


def without_repeated_strings(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """One row per document: its bytes, how many of them go, in how many maximal spans, and the hash of the rest.

    A byte goes if a string of `length` bytes covers it that also starts at another place of any document, the
    same one included; strings overlap and are judged on the input. Texts are taken whole as UTF-8, however
    long; null is an empty text; shorter texts than `length` stay. Rows are documents of their own whatever
    their identifiers, which may be null or repeated; equal texts of `length` bytes go altogether. Other columns are
    ignored, whatever their names; an empty table gives an empty result. Places are compared by their
    bytes, or, of runs that are equal as a whole, by two 64-bit hashes.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    size, whole = F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole")
    docs = docs.select("doc_id", "text", size, whole).withColumn("doc", F.substring(F.unhex("whole"), 1, 16))
    long = docs.filter(F.col("n_bytes") >= length).select("doc", "text")
    buckets = min(MOST_BUCKETS, 1 + (docs.agg(F.sum("n_bytes")).first()[0] or 0) // BUCKET)
    dealt = long.mapInArrow(_each_once, TEXTS).repartition(buckets, "doc")
    texts = clustered(dealt.groupBy("doc").agg(F.first("text").alias("text"), F.sum("n").alias("n")), "doc", buckets, "texts")
    runs = texts.mapInArrow(partial(_run_rows, length=length, gram=gram), RUNS)
    spans = _spans_of(stored(runs, "runs"), texts.select("doc", "text"), buckets, length, WIDTHS)
    gone = stored(spans.groupBy("doc").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "gone")
    cut = texts.select("doc", "text").join(gone.hint("merge"), "doc")
    cut = cut.mapInArrow(_cut, "doc binary, n_removed long, n_spans long, kept string")
    n_removed, n_spans = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_removed", "n_spans")]
    kept = F.coalesce("kept", "whole").alias("kept_sha256")
    # Texts that lose nothing are no part of it; of all others only the hash of the rest comes back to the copies.
    beside = docs.select("doc_id", "n_bytes", "whole", "doc").join(cut.hint("merge"), "doc", "left")
    return beside.select("doc_id", "n_bytes", n_removed, n_spans, kept)
