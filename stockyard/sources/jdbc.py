"""Relational sources: table discovery, partitioned scans, union of like tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FETCH_ROWS = 10_000
SALES_TABLES = "sales_%"


def _reader(spark: SparkSession, url: str, properties: dict[str, str] | None):
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", FETCH_ROWS)
    return reader.options(**(properties or {}))


def quoted(*names: str) -> str:
    """A qualified name as the database spells it, upper and lower case kept."""
    return ".".join('"' + n.replace('"', '""') + '"' for n in names)


def matching_tables(catalog: DataFrame, pattern: str, schema: str) -> DataFrame:
    """Base tables of `schema` whose name fits the pattern, upper and lower case alike."""
    return catalog.filter(
        (F.col("table_schema") == schema)
        & (F.col("table_type") == "BASE TABLE")
        & F.col("table_name").ilike(pattern)
    ).select("table_name")


def discover_tables(
    spark: SparkSession, url: str, pattern: str = SALES_TABLES, schema: str = "public",
    properties: dict[str, str] | None = None,
) -> list[str]:
    """Quoted, qualified names of the matching tables, read from the database's own catalog."""
    catalog = _reader(spark, url, properties).option("dbtable", "information_schema.tables").load()
    return sorted(quoted(schema, row.table_name) for row in matching_tables(catalog, pattern, schema).collect())


def read_table(
    spark: SparkSession, url: str, table: str, split_column: str, partitions: int,
    bounds: tuple | None = None, properties: dict[str, str] | None = None,
) -> DataFrame:
    """One table (a name as the database reads it), by `partitions` parallel queries over ranges of
    `split_column`.

    The ranges cover every row (the outer two are open, NULLs fall into the first), so no row can
    be lost or read twice, unlike with unordered paging. Without `bounds` the database is asked
    for the column's extremes.
    """
    if bounds is None:
        column = quoted(split_column)
        extremes = f"SELECT min({column}) AS low, max({column}) AS high FROM {table}"
        bounds = tuple(_reader(spark, url, properties).option("query", extremes).load().first())
    reader = _reader(spark, url, properties).option("dbtable", table)
    if bounds[0] is None:
        return reader.load()
    return (
        reader.option("partitionColumn", quoted(split_column))
        .option("lowerBound", str(bounds[0]))
        .option("upperBound", str(bounds[1]))
        .option("numPartitions", partitions)
        .load()
    )


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """Like tables under one another, matched by column name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def read_sales(
    spark: SparkSession, url: str, split_column: str, partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame | None:
    """All sales tables of the database as one DataFrame, None if there are none."""
    names = discover_tables(spark, url, properties=properties)
    tables = [
        read_table(spark, url, n, split_column, partitions, properties=properties) for n in names
    ]
    return union_tables(tables) if tables else None
