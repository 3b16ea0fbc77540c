"""What several operators share: tables, scratch tables, running totals over hot keys."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockyard.session import scratch_dir

# The white space that parts words, as a Java pattern.
WHITE = "[\\x20\\x09-\\x0D]+"


# The public tokenizer that the queries use; operators take any file's path.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written as a table in the shared scratch folder and read again: their lineage ends here."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, key: str, buckets: int, purpose: str) -> DataFrame:
    """Like `stored`, but dealt to buckets by a column, by which the rows are then joined without a shuffle of them.

    `df` comes in so many partitions by that column, each of which is one bucket's file. The table needs a name only
    while it is written and found.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name, format="parquet")
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return rows


def lower_ascii(text: Column) -> Column:
    """`text` with A-Z alone in lower case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bits_for(rows: int, per_bucket: int = 512, most: int = 20) -> int:
    """Bits of a hash that part `rows` rows into buckets of about `per_bucket`."""
    return min(most, max(0, (max(rows, 1) // per_bucket).bit_length()))


def with_running_total(
    df: DataFrame, keys: Sequence[str], by: Sequence[str], weight: Column, bits: int, name: str
) -> DataFrame:
    """`df` with `name`: the sum of `weight` over the rows of the same keys that come before.

    Rows are ordered by a hash of `by`, then by `by`. No window spans a whole key: each key's hash
    range is cut into 2^bits buckets, whose sums are added up first; a window spans one bucket.
    """
    hashed, bucket, total = f"{name}_hash", f"{name}_bucket", f"{name}_weight"
    prepared = df.withColumn(hashed, F.xxhash64(*by)).withColumn(total, weight.cast("long"))
    top = F.col(hashed).bitwiseXOR(F.lit(-(2**63)).cast("long"))
    place = F.shiftrightunsigned(top, 64 - bits) if bits else F.lit(0).cast("long")
    prepared = prepared.withColumn(bucket, place)
    sums = prepared.groupBy(*keys, bucket).agg(F.sum(total).alias("own"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("own").over(before), F.lit(0)).alias("start")
    starts = sums.select(*[F.col(k).alias(f"{name}_{i}") for i, k in enumerate(keys)], F.col(bucket).alias("b"), start)
    same = F.col(bucket) == F.col("b")
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"{name}_{i}"))
    inside = Window.partitionBy(*keys, bucket).orderBy(hashed, *by).rowsBetween(Window.unboundedPreceding, -1)
    joined = prepared.join(starts, same)
    found = F.col("start") + F.coalesce(F.sum(total).over(inside), F.lit(0))
    return joined.withColumn(name, found).select(*df.columns, name)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column, one after the other, and each text's bounds in them (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def portions(bounds: np.ndarray, size: int):
    """Row ranges of at most `size` bytes each, or of one row that is longer."""
    first = 0
    while first < len(bounds) - 1:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1)
        yield first, last
        first = last
