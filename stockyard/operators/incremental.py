"""High-water marks, keyed upsert and insert-only merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.operators.joins import possible_matches, sized


def high_water_mark(target: DataFrame, column: str = "ingestion_date"):
    """Latest load stamp in the target as a Python value, None for an empty target."""
    return target.agg(F.max(column)).first()[0]


def newer_than(df: DataFrame, mark, column: str = "ingestion_date", upto: bool = False) -> DataFrame:
    """Rows strictly after the mark (a moment or its text); without one (first load) all rows. With `upto`,
    those up to the mark instead.

    The mark is a literal, so the comparison reaches the file scan.
    """
    if mark is None:
        return df
    moment = F.lit(mark).cast(df.schema[column].dataType)
    return df.filter(F.col(column) <= moment if upto else F.col(column) > moment)


def with_keys(df: DataFrame, keyed: DataFrame, keys: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of `df` whose keys are (or with "left_anti" are not) among those of `keyed`; NULLs are equal."""
    wanted = keyed.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return df.join(wanted, same, how)


def latest_by_key(
    df: DataFrame, keys: list[str], order: list[str], on_duplicate: str = "latest"
) -> DataFrame:
    """One row per key: the greatest by `order`, then by the remaining columns, NULLs lowest.

    An aggregate rather than a ranking window: every task first reduces its own rows, so a key that
    holds a large share of the table never has to be sorted in one place. `on_duplicate="error"`
    fails on a repeated key instead.
    """
    if on_duplicate not in ("latest", "error"):
        raise ValueError(f"on_duplicate must be 'latest' or 'error', not {on_duplicate!r}")
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = [c for c in order if c not in keys] + rest
    newest = df.groupBy(*keys).agg(
        F.max(F.struct(*ranked, F.lit(0).alias("_filler"))).alias("_row"), F.count("*").alias("_n")
    )
    if on_duplicate == "error":
        unique = F.when(F.col("_n") > 1, F.raise_error(F.lit(f"repeated key in {keys}")))
        newest = newest.filter(unique.cast("string").isNull())
    return newest.select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def _any_null(df: DataFrame, columns: list[str]) -> Column | None:
    """Condition 'some column is NULL', or None if the schema rules it out."""
    nullable = [c for c in columns if df.schema[c].nullable]
    if not nullable:
        return None
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in nullable])


def without_key(df: DataFrame, keys: list[str], unknown: dict[str, str] | None = None) -> Column | None:
    """Condition 'this row has no key': a key column is NULL, or holds what stands for an unknown id."""
    keyless = _any_null(df, keys)
    for column, value in (unknown or {}).items():
        found = F.col(column) == F.lit(value)
        keyless = found if keyless is None else keyless | found
    return keyless


def reduced(
    df: DataFrame, keys: list[str], order: list[str], keyless: Column | None = None, on_duplicate: str = "latest"
) -> DataFrame:
    """One row per key, and every different row that has no key."""
    if keyless is None:
        return latest_by_key(df, keys, order, on_duplicate)
    newest = latest_by_key(df.filter(~keyless), keys, order, on_duplicate)
    return newest.unionByName(df.filter(keyless).distinct())


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: list[str],
    order: list[str],
    on_duplicate: str = "latest",
    keyless: Column | None = None,
) -> DataFrame:
    """The target after merging the batch: a matching key replaces the row, a new key adds one.

    A row without a key (by default one with a NULL in it) equals no other key, so such batch rows are all
    added. The batch keys are broadcast if measured to be small, which leaves the target unshuffled.
    """
    keyless = _any_null(batch, keys) if keyless is None else keyless
    keyed = batch if keyless is None else batch.filter(~keyless)
    newest = latest_by_key(keyed, keys, order, on_duplicate)
    kept = target.join(sized(newest.select(*keys)), keys, "left_anti").select(*target.columns)
    merged = kept.unionByName(newest)
    return merged if keyless is None else merged.unionByName(batch.filter(keyless))


def within_batch_range(target: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """Target rows that could equal a batch row in `column`: those between the batch's extremes.

    Two literals that reach the file scan, so a merge reads only the matching part of the target.
    """
    low, high = batch.agg(F.min(column), F.max(column)).first()
    inside = F.col(column).isNull()
    if low is not None:
        kind = target.schema[column].dataType
        inside = inside | F.col(column).between(F.lit(low).cast(kind), F.lit(high).cast(kind))
    return target.filter(inside)


def new_rows(
    target: DataFrame,
    batch: DataFrame,
    null_safe: bool = True,
    file_column: str | None = None,
    prune_on: str | None = None,
) -> DataFrame:
    """Batch rows, each once, that the target does not hold yet; compared on all batch columns.

    With `null_safe` two NULLs are equal. Without it a row holding a NULL equals nothing, so it is
    always new, once per value of `file_column`. `prune_on` names a column by which to restrict
    the target to the batch's range first. A filter made from the batch keeps back the target's other rows. The
    comparison is one aggregate over both sides: copies are reduced before the shuffle, however many there are.
    """
    columns = [c for c in batch.columns if c != file_column]
    if prune_on:
        target = within_batch_range(target, batch, prune_on)
    rows, held = batch.select(*columns), target.select(*columns)
    partial = None if null_safe else _any_null(batch, columns)
    if partial is not None:
        rows, held = rows.filter(~partial), held.filter(~partial)
    # Of the target only what may be a batch row is shuffled.
    held = possible_matches(held, rows, columns)
    fresh = (
        rows.withColumn("_held", F.lit(0))
        .unionByName(held.withColumn("_held", F.lit(1)))
        .groupBy(*columns)
        .agg(F.max("_held").alias("_held"))
        .filter("_held = 0")
        .select(*columns)
    )
    if partial is None:
        return fresh
    return fresh.unionByName(batch.filter(partial).distinct().select(*columns))
