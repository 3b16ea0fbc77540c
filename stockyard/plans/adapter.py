"""The seven raw tables, derived from the given star-schema tables.

Values are soiled the way hand-kept sources are (padding, lower case, signs, gaps, files delivered
twice), so that the cleaning steps have work to do on every table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CITIES = 4


class Source:
    """The given Parquet tables of one folder and the raw tables made from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A given table, its footers read once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def raw(self, name: str) -> DataFrame:
        return RAW[name](self)


def _id(prefix: str, key: Column | str) -> Column:
    """A prefixed number of 12 digits, or of as many as it has."""
    digits = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.concat(F.lit(prefix + "-"), F.lpad(digits, F.greatest(F.lit(12), F.length(digits)), F.lit("0")))


def _lineage(source: str, extracted: Column | str, loaded: Column) -> list[Column]:
    return [
        (F.lit(extracted) if isinstance(extracted, str) else extracted).alias(f"{source}_extraction_date"),
        F.lit(f" {source} ").alias("origin"),
        loaded.cast("timestamp_ntz").alias("ingestion_date"),
    ]


def _delivered_twice(df: DataFrame, condition: Column) -> DataFrame:
    """Each row once, those meeting the condition twice."""
    copies = F.when(condition, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("copy", F.explode(copies)).drop("copy")


def _loaded() -> Column:
    """Load stamp of the dimension files."""
    return F.lit("2024-01-02 00:00:00")


def products(src: Source) -> DataFrame:
    suppliers = src.table("supplier").agg(F.count("*")).scalar()
    size = F.col("p_size")
    part = _delivered_twice(src.table("part"), size == 3)
    return part.select(
        F.when(size % 5 == 0, F.concat(F.lit("  "), F.lower(_id("PROD", "p_partkey")), F.lit(" ")))
        .otherwise(_id("PROD", "p_partkey"))
        .alias("product_id"),
        F.when(size != 1, F.concat(F.lit(" "), F.col("p_name"), F.lit("  "))).alias("product_name"),
        F.col("p_type").alias("category"),
        F.concat(F.col("p_brand"), F.lit(" ")).alias("brand"),
        F.when(size != 50, _id("sup", F.col("p_partkey") % suppliers)).alias("supplier_id"),
        (
            F.col("p_retailprice").cast("decimal(10,2)")
            * F.when(size % 2 == 0, -size).otherwise(size)
        ).alias("unit_price"),
        *_lineage("s3", "2024-01-01 08:30:00", _loaded()),
    )


def _places(src: Source) -> DataFrame:
    """Nations with their region: a fixed list of 25."""
    nation, region = src.table("nation"), src.table("region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.select("n_nationkey", "n_name", "r_name")


def suppliers(src: Source) -> DataFrame:
    supplier = src.table("supplier")
    joined = supplier.join(_places(src), supplier.s_nationkey == F.col("n_nationkey"))
    return joined.select(
        _id("SUP", "s_suppkey").alias("supplier_id"),
        F.concat(F.col("s_name"), F.lit(" ")).alias("supplier_name"),
        F.when(F.col("s_acctbal") < 0, F.lit(None))
        .when(F.col("s_suppkey") % 3 == 0, "Hardware")
        .when(F.col("s_suppkey") % 3 == 1, "Tools")
        .otherwise("Fittings")
        .alias("category"),
        F.col("n_name").alias("country"),
        *_lineage("s3", "2024-01-01 08:30:00", _loaded()),
    )


def stores(src: Source) -> DataFrame:
    customer = src.table("customer")
    joined = customer.join(_places(src), customer.c_nationkey == F.col("n_nationkey"))
    joined = _delivered_twice(joined, F.col("c_mktsegment") == "BUILDING")
    key = F.col("c_custkey")
    opened = F.date_add(F.lit("1990-01-01").cast("date"), (key % 9000).cast("int"))
    return joined.select(
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lower(_id("STORE", "c_custkey")))
        .otherwise(_id("STORE", "c_custkey"))
        .alias("store_id"),
        F.concat(F.lit("  "), F.col("c_name")).alias("store_name"),
        F.concat(F.lit("CITY_"), (key % CITIES).cast("string"), F.lit(" ")).alias("city"),
        F.col("r_name").alias("state"),
        F.col("r_name").alias("region"),
        F.when(F.col("c_acctbal") < 0, "soon")
        .when(key % 3 == 0, F.date_format(opened, "dd/MM/yyyy"))
        .when(key % 3 == 1, F.date_format(opened, "MM/dd/yyyy"))
        .otherwise(F.date_format(opened, "yyyy-MM-dd"))
        .alias("store_open_date"),
        *_lineage("sheets", "2024-01-01 09:00:00", _loaded()),
    )


def warehouses(src: Source) -> DataFrame:
    supplier = src.table("supplier")
    joined = supplier.join(_places(src), supplier.s_nationkey == F.col("n_nationkey"))
    city = F.concat(F.lit(" CITY_"), (F.col("s_suppkey") % CITIES).cast("string"))
    return joined.select(
        F.lower(_id("WH", "s_suppkey")).alias("warehouse_id"),
        city.alias("city"),
        F.col("r_name").alias("state"),
        *_lineage("s3", "2024-01-01 08:30:00", _loaded()),
    )


def _lines(src: Source) -> DataFrame:
    """Order lines with their customer; the id takes in the price to be unique."""
    line = src.table("lineitem")
    order = src.table("orders").select("o_orderkey", "o_custkey")
    cents = (F.col("l_extendedprice").cast("decimal(12,2)") * 100).cast("bigint")
    line_id = F.concat_ws(
        "-",
        *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
        cents.cast("string"),
    )
    return line.join(order, line.l_orderkey == order.o_orderkey).withColumn("line_id", line_id)


def _named() -> Column:
    """Whether the line's events have an id."""
    return ~((F.col("l_linenumber") == 3) & (F.col("l_tax") > 0.065))


def _line_quantity() -> Column:
    """Quantity as noted: sometimes negative, sometimes missing."""
    quantity = F.col("l_quantity").cast("bigint")
    counted = ~((F.col("l_linenumber") == 4) & (F.col("l_discount") > 0.085))
    return F.when(counted, F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity))


def _line_product() -> Column:
    """Product as noted on the line: sometimes in lower case, sometimes missing."""
    number = F.col("l_linenumber")
    return (
        F.when((number == 6) & (F.col("l_tax") > 0.075), F.lit(None))
        .when(number == 1, F.lower(_id("PROD", "l_partkey")))
        .otherwise(_id("PROD", "l_partkey"))
    )


def transactions(src: Source) -> DataFrame:
    lines = _delivered_twice(_lines(src), F.col("l_linenumber") == 7)
    quantity, price = F.col("l_quantity").cast("bigint"), F.col("l_extendedprice").cast("decimal(10,2)")
    unpriced = (F.col("l_linenumber") == 5) & (F.col("l_discount") < 0.005)
    return lines.select(
        F.when(_named(), F.col("line_id")).alias("transaction_id"),
        _id("STORE", "o_custkey").alias("store_id"),
        _line_product().alias("product_id"),
        _line_quantity().alias("quantity_sold"),
        F.when(~unpriced, price).alias("unit_price"),
        F.when(F.col("l_tax") > 0.005, F.col("l_discount").cast("decimal(3,2)")).alias("discount_pct"),
        (price * quantity).cast("decimal(18,2)").alias("sales_amount"),
        F.unix_micros(F.col("l_shipdate").cast("timestamp")).alias("transaction_timestamp"),
        *_lineage("rds", F.date_format("l_shipdate", "yyyy-MM-dd 10:00:00"), F.col("l_shipdate")),
    )


def shipments(src: Source) -> DataFrame:
    lines = _delivered_twice(_lines(src), F.col("l_linenumber") == 7)
    shipped = F.col("l_shipdate").cast("date")
    transit = (F.col("l_orderkey") % (F.col("l_suppkey") % 6 + 2)).cast("int")
    promised = (F.col("l_partkey") % 4 + 1).cast("int")
    carrier = F.when(F.col("l_returnflag") == "A", " Road ").when(F.col("l_returnflag") == "R", "Rail")
    return lines.select(
        F.when(_named(), F.concat(F.col("line_id"), F.lit(" "))).alias("shipment_id"),
        _id("WH", "l_suppkey").alias("warehouse_id"),
        _id("STORE", "o_custkey").alias("store_id"),
        _line_product().alias("product_id"),
        _line_quantity().alias("quantity_shipped"),
        F.date_format(shipped, "yyyy-MM-dd").alias("shipment_date"),
        F.when(F.col("l_tax") > 0.005, F.date_format(F.date_add(shipped, promised), "yyyy-MM-dd")).alias(
            "expected_delivery_date"
        ),
        F.date_format(F.date_add(shipped, transit), "yyyy-MM-dd").alias("actual_delivery_date"),
        carrier.alias("carrier"),
        *_lineage("s3", "2024-01-01 08:30:00", F.col("l_shipdate")),
    )


def inventory(src: Source) -> DataFrame:
    """Several counts of the same stock: one for each line number it was ordered under."""
    stock = src.table("lineitem").groupBy("l_suppkey", "l_partkey", "l_linenumber").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.max("l_shipdate").alias("counted"),
    )
    part = src.table("part").select("p_partkey", "p_size")
    joined = stock.join(part, stock.l_partkey == part.p_partkey)
    joined = _delivered_twice(joined, F.col("p_size") == 4)
    empty = (F.col("l_suppkey") + F.col("l_partkey")) % 17 == 0
    return joined.select(
        F.lower(_id("WH", "l_suppkey")).alias("warehouse_id"),
        _id("PROD", "l_partkey").alias("product_id"),
        F.when(empty, F.lit(0).cast("bigint")).otherwise(-F.col("quantity")).alias("quantity_available"),
        (F.col("p_size") + 10).cast("bigint").alias("reorder_threshold"),
        F.when(F.col("p_size") != 7, F.date_format("counted", "yyyy-MM-dd")).alias("snapshot_date"),
        *_lineage("s3", "2024-01-01 08:30:00", F.col("counted")),
    )


RAW: dict[str, Callable[[Source], DataFrame]] = {
    "products": products,
    "suppliers": suppliers,
    "stores": stores,
    "warehouses": warehouses,
    "transactions": transactions,
    "shipments": shipments,
    "inventory": inventory,
}
