"""Exact duplicates by sorting the contents.

Rows are range-partitioned by sampled splitters over the first bytes of the normalised text, a hash of
all of it and the identifier, so that a text with very many copies spreads over several partitions.
Spark's external sort then places equal texts side by side, and each partition is read once, comparing
every text in full with its neighbour. Runs that touch an edge of their partition may go on in
another one; there are at most a few of those per partition, and they are joined by their full text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import lower_ascii, stored

PREFIX = 32

RUN = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("part", T.LongType()),
        T.StructField("run", T.LongType()),
        T.StructField("part_keep", T.LongType()),
        T.StructField("part_size", T.LongType()),
        T.StructField("first", T.BooleanType()),
        T.StructField("edge", T.BooleanType()),
        T.StructField("edge_text", T.BinaryType()),
    ]
)


def _sorted(df: DataFrame, id_col: str, text_col: str, carried: list[str]) -> DataFrame:
    plain = df.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)],
    )
    norm = lower_ascii(F.col("text"))
    keyed = plain.withColumn("hash", F.xxhash64(norm)).withColumn("head", F.substring(norm, 1, PREFIX))
    ranged = keyed.repartitionByRange("head", "hash", "id")
    return ranged.sortWithinPartitions("head", "hash", norm, F.col("id").desc_nulls_last()).drop("head")


def _runs(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A row per document with its run; carried columns stay with the first row of a run only."""
    part, number = TaskContext.get().partitionId(), 0
    first_hash: int | None = None
    # Runs of the texts that share the present hash: [hash, text, ids, carried row of the first]
    held: list[list] = []
    ready: dict[str, list] = {name: [] for name in schema.names}

    def release(at_end: bool) -> None:
        nonlocal number
        for hashed, text, ids, carried in held:
            edge = at_end or hashed == first_hash
            digest = hashlib.sha256(text).digest()
            n = len(ids)
            ready["id"] += ids
            ready["digest"] += [digest] * n
            ready["part"] += [part] * n
            ready["run"] += [number] * n
            ready["part_keep"] += [ids[0]] * n
            ready["part_size"] += [n] * n
            ready["first"] += [True] + [False] * (n - 1)
            ready["edge"] += [edge] * n
            ready["edge_text"] += [text if edge else None] + [None] * (n - 1)
            for name, value in carried.items():
                ready[name] += [value] + [None] * (n - 1)
            number += 1
        held.clear()

    def flush() -> pa.RecordBatch:
        columns = [pa.array(ready[f.name], f.type) for f in schema]
        for values in ready.values():
            values.clear()
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for batch in batches:
        ids, hashes = batch["id"].to_pylist(), batch["hash"].to_pylist()
        texts = batch["text"].cast(pa.large_binary())
        names = [f"c{i}" for i in range(len(schema.names) - len(RUN))]
        for row, (own, hashed) in enumerate(zip(ids, hashes, strict=True)):
            first_hash = hashed if first_hash is None else first_hash
            text = texts[row].as_py().lower()
            if held and held[-1][0] == hashed and held[-1][1] == text:
                held[-1][2].append(own)
                continue
            if held and held[-1][0] != hashed:
                release(at_end=False)
            held.append([hashed, text, [own], {n: batch[n][row].as_py() for n in names}])
            if len(ready["id"]) >= 1000:
                yield flush()
        if ready["id"]:
            yield flush()
    release(at_end=True)
    if ready["id"]:
        yield flush()


def runs(df: DataFrame, id_col: str, text_col: str, carried: list[str] | None = None) -> DataFrame:
    """A row per document: its run over all partitions (`keep`, `size`), and whether it stays."""
    carried = carried or []
    types = df.select(*carried).schema.fields if carried else []
    schema = T.StructType(RUN.fields + [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(types)])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    spread = _sorted(df, id_col, text_col, carried)
    rows = stored(spread.mapInArrow(lambda batches: _runs(batches, arrow), schema), "sorted-runs")
    # At most two runs per partition (and those whose hash collides with theirs) are edges.
    edges = rows.filter("edge AND edge_text IS NOT NULL")
    whole = edges.groupBy("edge_text").agg(
        F.max("part_keep").alias("all_keep"),
        F.sum("part_size").alias("all_size"),
        F.collect_list(F.struct("part", "run")).alias("places"),
    )
    known = whole.select("all_keep", "all_size", F.explode("places").alias("p"))
    known = known.select(F.col("p.part").alias("part"), F.col("p.run").alias("run"), "all_keep", "all_size")
    joined = rows.join(F.broadcast(known), ["part", "run"], "left")
    keep = F.when(F.col("edge"), F.col("all_keep")).otherwise(F.col("part_keep"))
    size = F.when(F.col("edge"), F.col("all_size")).otherwise(F.col("part_size"))
    found = joined.withColumn("keep", keep).withColumn("size", size)
    return found.withColumn("kept", F.col("first") & F.col("id").eqNullSafe(F.col("keep")))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, dropped ones too.

    `keep_id` is the row of equal text that stays (the largest identifier), `group_size` the number of
    rows with that text. Texts are equal when identical after lower-casing A-Z only; a null text is an
    empty one. A null identifier counts as the smallest. Of rows with the same text and identifier
    exactly one is kept. Other columns are ignored; an empty table gives an empty result.
    """
    found = runs(df, id_col, text_col)
    return found.select(
        F.col("id").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all columns of `df`, whatever their names."""
    names = df.columns
    found = runs(df, id_col, text_col, names)
    return found.filter("kept").select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
