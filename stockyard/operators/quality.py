"""Data-quality checks: failing rows per check, and whole suites as one result table."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stockyard.operators.joins import sized
from stockyard.session import once


@dataclass(frozen=True)
class Check:
    """One declared check. `values` serve accepted_values, `parent` = (table, column) relationships."""

    table: str
    column: str
    kind: str
    values: tuple[str, ...] = field(default=())
    parent: tuple[str, str] | None = None


# Checks that count values over the whole table; all others judge a row by itself.
BY_VALUE = ("unique", "relationships")
# Row checks that are told by one number.
BITS = 60
# Values without a parent that are sent to every executor at most, if they are within the bytes of a broadcast.
MOST_VALUES = 2_000_000


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def failing(check: Check) -> Column:
    """The condition under which a single row fails; NULL counts as passing."""
    value = F.col(check.column)
    conditions = {
        "not_null": lambda: value.isNull(),
        "accepted_values": lambda: ~value.isin(*check.values),
        "no_whitespace": lambda: _text(check.column) != F.trim(_text(check.column)),
        "positive_value": lambda: value < 0,
        "is_date_type": lambda: value.isNotNull() & _text(check.column).try_cast("date").isNull(),
    }
    return conditions[check.kind]()


def stand_in(column: str) -> Column:
    """In place of a text, a short one (or NULL) that fails the same of not_null and no_whitespace."""
    spaced = failing(Check("", column, "no_whitespace"))
    return F.when(spaced, F.lit(" ")).when(F.col(column).isNotNull(), F.lit(""))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(failing(Check("", column, "not_null")))


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.filter(failing(Check("", column, "accepted_values", tuple(values))))


def no_whitespace(df: DataFrame, column: str) -> DataFrame:
    return df.filter(failing(Check("", column, "no_whitespace")))


def positive_value(df: DataFrame, column: str) -> DataFrame:
    """Fails below zero; zero itself passes."""
    return df.filter(failing(Check("", column, "positive_value")))


def is_date_type(df: DataFrame, column: str) -> DataFrame:
    return df.filter(failing(Check("", column, "is_date_type")))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return counts.filter("rows > 1")


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with the number of rows holding them.

    The values come first: one row each, whatever the child does to its rows, such as removing copies. Of the
    child only rows that hold a value without a parent are then looked at, and counted per value.
    """
    values = child.select(column).filter(F.col(column).isNotNull()).distinct()
    known = parent.select(F.col(parent_column).alias(column)).distinct()
    orphans = once(values.join(known, column, "left_anti"), "orphans")
    return child.join(sized(orphans, max_rows=MOST_VALUES), column, "left_semi").groupBy(column).agg(F.count("*").alias("rows"))


def shipment_date_order(shipments: DataFrame) -> DataFrame:
    """Shipments that left on or after a delivery date."""
    left = F.col("shipment_date")
    return shipments.select("shipment_date", "actual_delivery_date", "expected_delivery_date").filter(
        (left >= F.col("actual_delivery_date")) | (left >= F.col("expected_delivery_date"))
    )


def _result(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
    )


def _result_rows(counts: DataFrame, checks: list[Check]) -> DataFrame:
    """One row of failure counts f0, f1, … turned into one row per check."""
    results = F.array(*[_result(c, F.col(f"f{i}")) for i, c in enumerate(checks)])
    return counts.select(F.explode(results).alias("r")).select("r.*")


def _failures(df: DataFrame, checks: list[Check], parents: dict[str, DataFrame]) -> DataFrame:
    """All checks of a table in one pass: a row tells which values it holds for the value checks, and once which
    row checks it fails, as bits of a number, and these are counted. Parents' values are counted along, as no rows."""
    by_row = [c for c in checks if c.kind not in BY_VALUE]
    told = [(i, _text(c.column)) for i, c in enumerate(checks) if c.kind in BY_VALUE]
    for first in range(0, len(by_row), BITS):
        bits = [F.when(failing(c), F.lit(1 << k)).otherwise(F.lit(0)) for k, c in enumerate(by_row[first : first + BITS])]
        mask = reduce(lambda x, y: x.bitwiseOR(y), [bit.cast("long") for bit in bits])
        told.append((-1 - first // BITS, F.nullif(mask, F.lit(0).cast("long")).cast("string")))
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), value.alias("value")) for i, value in told])
    values = df.select(F.explode(pairs).alias("p")).select("p.*").filter("value IS NOT NULL")
    counted = values.select("i", "value", F.lit(1).cast("long").alias("n"))
    for i, c in enumerate(checks):
        if c.parent:
            known = parents[c.parent[0]].select(F.lit(i).alias("i"), _text(c.parent[1]).alias("value"))
            counted = counted.unionAll(known.withColumn("n", F.lit(0).cast("long")))
    counts = counted.groupBy("i", "value").agg(F.sum("n").alias("rows"), F.min("n").alias("least"))
    totals = []
    for i, c in enumerate(checks):
        if c.kind == "unique":
            failed = F.count_if((F.col("i") == i) & (F.col("rows") > 1))
        elif c.kind == "relationships":
            # No parent has such a value.
            failed = F.sum(F.when((F.col("i") == i) & (F.col("least") > 0), F.col("rows")))
        else:
            group, bit = divmod(by_row.index(c), BITS)
            here = F.when(F.col("i") == -1 - group, F.col("value")).try_cast("long")
            failed = F.sum(F.when(here.bitwiseAND(F.lit(1 << bit).cast("long")) != 0, F.col("rows")))
        totals.append(failed.alias(f"f{i}"))
    return counts.agg(*totals)


def run_checks(df: DataFrame, checks: list[Check], parents: dict[str, DataFrame]) -> DataFrame:
    """One row per check of one table: table_name, column_name, check_name, failures."""
    return _result_rows(_failures(df, checks, parents), checks)


def observed(df: DataFrame, checks: list[Check], seen: Observation) -> DataFrame:
    """`df` with the row checks among some checks counted while it is written, without a pass of their own."""
    counts = [F.count_if(failing(c)).alias(f"f{i}") for i, c in enumerate(checks) if c.kind not in BY_VALUE]
    return df.observe(seen, *counts) if counts else df


def observed_counts(seen: Observation) -> dict[str, int]:
    """What was observed in a write that is over; nothing where the rows turned out to be none, as the plan of
    an empty table observes nothing."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return {}


def observed_failures(checks: list[Check], seen: Observation) -> dict[Check, int]:
    """What was counted, once the rows are written."""
    by_row = {c: f"f{i}" for i, c in enumerate(checks) if c.kind not in BY_VALUE}
    counts = observed_counts(seen) if by_row else {}
    return {c: counts.get(name, 0) for c, name in by_row.items()}


def known_results(spark: SparkSession, failures: dict[Check, int]) -> DataFrame:
    """Failures that are already known, as result rows."""
    rows = [(c.table, c.column, c.kind, n) for c, n in failures.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, check_name string, failures long")


def run_suite(
    tables: dict[str, DataFrame], checks: list[Check], parents: dict[str, DataFrame] | None = None,
    apart: bool = False,
) -> DataFrame:
    """All checks of a layer as one result table. With `apart`, for large tables, these are checked now, one after
    another, so that the shuffles of one are gone before the next one's come."""
    grouped: dict[str, list[Check]] = {}
    for check in checks:
        grouped.setdefault(check.table, []).append(check)
    results = [run_checks(tables[name], found, parents or {}) for name, found in grouped.items()]
    return reduce(DataFrame.unionAll, [once(r, "checks") for r in results] if apart else results)


class ChecksFailed(Exception):
    """A layer did not pass; `failures` lists (table, column, check, count)."""

    def __init__(self, failures: list[tuple[str, str, str, int]]):
        self.failures = failures
        listing = ", ".join(f"{t}.{c} {k}: {n}" for t, c, k, n in failures)
        super().__init__(f"{len(failures)} checks failed: {listing}")


def gate(results: DataFrame) -> None:
    """Stop with ChecksFailed unless every check passed. At most one row per declared check."""
    failures = [tuple(row) for row in results.filter("failures > 0").collect()]
    if failures:
        raise ChecksFailed(sorted(failures))
