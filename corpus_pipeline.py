"""The corpus pipeline: documents judged, deduplicated, mixed and packed into training sequences.

Each stage takes the documents its predecessor kept, with all their columns, and its decisions take
effect; stages are written as Parquet and read again, upon which a stage's scratch tables are no longer
needed: the next stage deletes them first. Documents without an identifier pass the near duplicate stage,
as they are linked with nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.llm import exact_dedup, group_join, mixing, packing, quality_rules
from stockyard.llm.common import stored, table, tokenizer_path
from stockyard.session import clear_scratch, scratch_folders

# Small sources are repeated this often at most; the largest is used exactly once, so none is cut.
MOST_EPOCHS = 4.0
# Texts go to Python workers in batches of about so many bytes, however long they are: what a worker holds at
# a time is a few times that.
BATCH_BYTES = 8 << 20
# Near duplicates share this many percent of their shingles of so many words, or more.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
# Scratch tables of the stage before.
_left: list[str] = []


def _after_the_last(stage: Stage) -> Stage:
    """The stage, after deleting what the one before needed until its result was written."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        clear_scratch(spark, _left)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        before = set(scratch_folders())
        out = stage(spark, docs, sf_dir)
        _left[:] = [f for f in scratch_folders() if f not in before]
        return out

    return run_stage


@_after_the_last
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.good_documents(docs)


@_after_the_last
def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays."""
    return exact_dedup.without_exact_duplicates(docs)


@_after_the_last
def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest identifier stays. The stage's limit is wider than op2's.

    Rows are judged one by one: where identifiers repeat, each row is a document of its own, and of linked
    rows with the same identifier one stays.
    """
    again = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    key = "doc_id"
    if not again.isEmpty():
        while key in docs.columns:
            key = f"_{key}"
        number = F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())
        docs = stored(docs.withColumn(key, number), "rows")
    found = group_join.jaccard_components(docs, NEAR_SHINGLE, NEAR_PERCENT, key)
    if key == "doc_id":
        gone = found.filter("doc_id <> component_id").select("doc_id")
    else:
        ids = docs.select(F.col(key).alias("doc_id"), F.col("doc_id").alias("own"))
        first = F.min(F.struct("own", "doc_id"))["doc_id"].alias("doc_id")
        gone = found.select("doc_id").subtract(found.join(ids, "doc_id").groupBy("component_id").agg(first).select("doc_id"))
    gone = gone.withColumnRenamed("doc_id", key)
    return docs.join(gone, key, "left_anti").select(*[c for c in docs.columns if c != key or key == "doc_id"])


@_after_the_last
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are drawn towards equal weights; documents of small ones occur up to four times."""
    return mixing.mixture(docs, most_epochs=MOST_EPOCHS)


@_after_the_last
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of each document's tokens with its place in a sequence."""
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("jaccard_join", near),
    ("source_mixing", mix),
    ("best_fit_packing", pack),
]

# Token ids and robust estimates have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
