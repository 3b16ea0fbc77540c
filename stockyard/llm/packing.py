"""Packing token sequences into bins by minimum bin slack.

A bin takes the longest piece left; a subset-sum over the lengths still available, as a bitset, finds
the fullest combination that fits beside it; the combination is then removed. All that this needs to
know is how many pieces there are of each length, at most `size` numbers however large the corpus.
While a combination stays available the same one would be found again, so it is removed as often as
it fits; each time uses up a length, so there are few combinations. Spark counts the lengths, numbers
the pieces of each length without bringing them together, and looks up each piece's place.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockyard.llm.common import stored
from stockyard.llm.tokens import encoder

SIZE = 1024
END_OF_TEXT = 2


def fullest(counts: np.ndarray, room: int) -> list[tuple[int, int]]:
    """Lengths, and how often each, that fill `room` best; the longest ones where several do."""
    reach, steps = 1, []
    within = (1 << (room + 1)) - 1
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        left, times = min(int(counts[length]), room // length), 1
        while left:
            times = min(times, left)
            more = (reach | reach << (length * times)) & within
            steps.append((length, times, reach))
            reach = more
            left -= times
            times *= 2
        if reach >> room:
            break
    filled, taken = reach.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> filled & 1:
            taken[length] = taken.get(length, 0) + times
            filled -= length * times
    return sorted(taken.items(), reverse=True)


class Use(NamedTuple):
    """Pieces `first` to `first + bins * times` of a length go to `bins` bins from `bin` on."""

    length: int
    first: int
    times: int
    bin: int
    bins: int
    offset: int


def minimum_slack(counts: dict[int, int], size: int = SIZE) -> list[Use]:
    """Where the pieces of each length go."""
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    used, uses, bins = np.zeros(size + 1, np.int64), [], 0
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        chosen = dict(fullest(left, size - longest))
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        repeats = min(int(left[length]) // times for length, times in chosen.items())
        offset = 0
        for length, times in sorted(chosen.items(), reverse=True):
            uses.append(Use(length, int(used[length]), times, bins, repeats, offset))
            used[length] += repeats * times
            left[length] -= repeats * times
            offset += length * times
        bins += repeats
    return uses


def _pieces(batches: Iterator[pa.RecordBatch], path: str, size: int) -> Iterator[pa.RecordBatch]:
    """The pieces of each text. `local` numbers a task's pieces of the same length."""
    part, seen, encode = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64), encoder(path)
    end = np.array([END_OF_TEXT], "<u4")
    for batch in batches:
        out: dict[str, list[int]] = {n: [] for n in ("row", "piece", "start", "length", "crc", "local")}
        for row, text in enumerate(batch["text"]):
            found = np.concatenate([encode(text.as_py() or ""), end]).astype("<u4", copy=False)
            n = -(-len(found) // size)
            bounds = [0, *range(len(found) - (n - 1) * size, len(found) + 1, size)]
            for k in range(n):
                length = bounds[k + 1] - bounds[k]
                crc = zlib.crc32(found[bounds[k] : bounds[k + 1]].tobytes())
                for name, value in zip(out, (row, k, bounds[k], length, crc, int(seen[length])), strict=True):
                    out[name].append(value)
                seen[length] += 1
        yield pa.RecordBatch.from_arrays(
            [
                batch["doc_id"].take(pa.array(out["row"], pa.int64())),
                pa.array(out["piece"], pa.int32()),
                *[pa.array(out[n], pa.int64()) for n in ("start", "length", "crc", "local")],
                pa.array([part] * len(out["row"]), pa.int64()),
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32", "local", "part"],
        )


def packed(
    df: DataFrame, tokenizer: str, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece of each document's ids (its tokens and the end mark) with its place.

    `tokenizer` is the path of the tokenizer's file, the same on every machine. Every row of `df` is
    packed, repeated ones and those without an identifier too; a null or empty text is the end mark
    alone. Only documents longer than `size` are cut; the first piece is the shorter one. Other columns
    are ignored; an empty table gives an empty result.
    """
    kind = dict(df.dtypes)[id_col]
    plain = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, local long, part long"
    pieces = stored(plain.mapInArrow(lambda batches: _pieces(batches, tokenizer, size), schema), "pieces")

    counted = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counted = stored(counted, "piece-counts")
    # At most `size` rows.
    totals = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    uses = np.array(sorted(minimum_slack(totals, size)), np.int64).reshape(-1, len(Use._fields))
    length, first, times, bin_, _, offset = uses.T
    # One ascending number for (length, place among the pieces of that length).
    most = int(max(totals.values(), default=0)) + 1
    lookup = length * most + first

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            use = np.searchsorted(lookup, own * most + rank, "right") - 1
            nth = rank - first[use]
            sequence = bin_[use] + nth // times[use]
            at = offset[use] + nth % times[use] * own
            columns = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(at)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(starts, ["length", "part"])
    ranked = ranked.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("local")).alias("rank")
    )
    out = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(place, out)
