"""Deciding how a lookup table reaches the facts it is joined to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.session import shuffles_dropped

# A lookup side is sent to every executor only if its measured size stays below these bounds.
BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 1_000_000
# Words of a Bloom filter that is sent to every executor: at most 16 MB.
FILTER_WORDS = 1 << 20


# Sizes measured by this process, by application, plan, the files it reads and their bytes: what has grown is
# measured again.
_sizes: dict[tuple, tuple[int, int]] = {}


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes, from one aggregate over the table, measured once per state of its files."""
    files = df.inputFiles()
    if not files:
        return _measure(df)
    size = str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    state = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), size, *sorted(files))
    if state not in _sizes:
        _sizes[state] = _measure(df)
    return _sizes[state]


def _measure(df: DataFrame) -> tuple[int, int]:
    width = sum(
        (F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) + 8 for name in df.columns),
        F.lit(0),
    )
    with shuffles_dropped(df.sparkSession):
        rows, size = df.agg(F.count("*"), F.sum(width.cast("bigint"))).first()
    return rows, size or 0


def is_small(df: DataFrame, max_bytes: int | None = None, max_rows: int | None = None) -> bool:
    """Whether a table is measured to be within the bounds of a broadcast."""
    rows, size = measured_size(df)
    most_rows = BROADCAST_ROWS if max_rows is None else max_rows
    return rows <= most_rows and size <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def sized(
    lookup: DataFrame,
    measured: DataFrame | None = None,
    max_bytes: int | None = None,
    max_rows: int | None = None,
) -> DataFrame:
    """The lookup with a broadcast hint if it is measured to be small, else unchanged.

    `measured` may name a table that is no smaller but cheaper to compute, such as the rows before
    de-duplication. Static estimates multiply up over joins, so a small derived lookup would
    otherwise shuffle the whole fact table before adaptive execution could notice. Beyond the
    bounds the join shuffles and adaptive execution splits hot key partitions. The hint survives
    column selection, so one measured lookup serves several joins.
    """
    small = is_small(lookup if measured is None else measured, max_bytes, max_rows)
    return F.broadcast(lookup) if small else lookup


# Places that the rows of one key of dealt facts lie in, and what the column that tells which begins with: of whatever
# size a key is, no task gets more than its part, for which a lookup's rows come once to each place.
PLACES, PLACE = 4, "_place"


def _place(key: str) -> str:
    return f"{PLACE}_{key}"


def is_dealt(rows: DataFrame, key: str) -> bool:
    return _place(key) in rows.columns


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """Every different row once, with its place: the shuffle by which copies meet also serves a join by `key`."""
    place = F.pmod(F.xxhash64(*rows.columns), F.lit(PLACES)).cast("int")
    return rows.withColumn(_place(key), place).repartition(key, _place(key)).distinct()


def dealt_narrow(rows: DataFrame, key: str, kept: tuple[str, ...], short: dict[str, Column]) -> DataFrame:
    """As `dealt`, for readers that need few columns: those `kept`, and others in the `short` form given.

    Copies are rows that agree in what is kept and in two hashes, of 64 and 32 bits, of the whole row; other columns
    are there, but are shuffled only for a reader who asks for them. Where all readers ask for the same, they share the shuffle.
    """
    # A hash passes over NULLs, so it is told where they are.
    whole = [*rows.columns, *[F.col(f.name).isNull() for f in rows.schema if f.nullable]]
    prints = {"_print": F.xxhash64(*whole), "_print2": F.hash(*whole)}
    found = rows.withColumns(prints).withColumn(_place(key), F.pmod("_print", F.lit(PLACES)).cast("int"))
    found = found.withColumns(short).repartition(key, _place(key))
    return found.dropDuplicates([_place(key), *prints, *kept, *short]).drop(*prints)


# Parts in which rows are counted to see whether they can be dealt by a key; how far beyond its even share a part may
# be; rows that are no burden in any case.
PARTS, MOST_UNEVEN, FEW_ROWS = 1000, 4, 10_000


def dealt_evenly(rows: DataFrame, *parts: Column) -> bool:
    """Whether no part of the rows is so large that the task which gets it would hold up the others: a shuffle's
    partitions are split before a join, not before an aggregate. The rows are read once, and not shuffled."""
    with shuffles_dropped(rows.sparkSession):
        counts = rows.groupBy(*parts).agg(F.count("*").alias("n")).agg(F.max("n"), F.sum("n")).first()
    return (counts[0] or 0) <= max(MOST_UNEVEN * (counts[1] or 0) / PARTS, FEW_ROWS)


def grouped(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows dealt by some of the columns that they are about to be grouped by, so that counting different values takes
    no second shuffle; unchanged if some group is too large for that."""
    part = F.pmod(F.xxhash64(*keys), F.lit(PARTS))
    return rows.repartition(*keys) if dealt_evenly(rows, part) else rows


def looked_up(facts: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Facts joined to a lookup by its key; facts dealt by it stay where they lie."""
    if not is_dealt(facts, key):
        return facts.join(lookup, key, how)
    places = F.explode(F.sequence(F.lit(0), F.lit(PLACES - 1))).alias(_place(key))
    return facts.join(lookup.select("*", places), [key, _place(key)], how)


# Bloom filters as rows: a key's word, and four of the word's 64 bits.


def filter_word(keys: list[str], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(words)).alias("word")


def filter_mask(keys: list[str]) -> Column:
    places = F.xxhash64(*keys, F.lit(7))
    one = F.lit(1).cast("long")
    chosen = [F.shiftrightunsigned(places, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(4)]
    bits = [F.call_function("shiftleft", one, place) for place in chosen]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3]).alias("mask")


def possible_matches(df: DataFrame, wanted: DataFrame, columns: list[str], words: int = FILTER_WORDS) -> DataFrame:
    """The rows of `df` that may equal a row of `wanted` in some columns, NULLs being equal: all that do, few others.

    `wanted` becomes a Bloom filter of `words` rows at most, whatever its size, which is broadcast, so `df` is not
    shuffled; the more rows are wanted, the more others pass.
    """
    if [df.schema[c].dataType for c in columns] != [wanted.schema[c].dataType for c in columns]:
        return df
    asked = wanted.select(filter_word(columns, words), filter_mask(columns)).groupBy("word").agg(F.bit_or("mask").alias("bits"))
    own = df.select("*", filter_word(columns, words).alias("_word"), filter_mask(columns).alias("_mask"))
    asked = F.broadcast(asked.withColumnsRenamed({"word": "_word", "bits": "_bits"}))
    return own.join(asked, "_word").filter("_bits & _mask = _mask").select(*df.columns)
