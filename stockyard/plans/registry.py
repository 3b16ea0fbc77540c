"""The registered queries: every operator run over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.functions import cleaning
from stockyard.operators import incremental, marts, quality
from stockyard.operators.history import SNAPSHOTS, scd2
from stockyard.plans import oracle
from stockyard.plans.adapter import Source
from stockyard.plans.checks import LAYERS
from stockyard.plans.layers import Run
from stockyard.plans.models import LOOKUP_KEYS, MODELS, Views
from stockyard.session import configure, once, scratch_dir, shuffles_dropped
from stockyard.sources import files, landing
from stockyard.sources.jdbc import union_tables
from stockyard.sources.schemas import INCOMING, incoming, landed
from stockyard.streaming.loader import load_stream

AS_OF = "2024-01-01"
NOW = datetime(2024, 1, 1, 12, 30, 0)
MERGE_FROM, MERGE_TO = "1998-06-01", "1999-06-01"
RUNS = ("2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def views(spark: SparkSession, folder: str, checked: bool = False) -> Views:
    return Views(Source(configure(spark), folder).raw, AS_OF, checked)


def plain(df: DataFrame) -> DataFrame:
    """Amounts as double, whole numbers as bigint, days and moments as text: comparable anywhere."""
    forms = []
    for f in df.schema.fields:
        col = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(f.dataType, T.IntegerType):
            col = col.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        forms.append(col.alias(f.name))
    return df.select(*forms)


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            SQL[name] = sql
        return query

    return add


def _model(name: str, model: str) -> None:
    register(name, oracle.table(model))(lambda spark, folder: plain(views(spark, folder)[model]))


for _name in ("warehouses", "suppliers", "products", "stores", "inventory", "shipments", "transactions"):
    _model(f"stg_{_name}", f"stg_{_name}")
for _name, _table in (
    ("inventory_health", "int_inventory_health"),
    ("shipment_performance", "int_shipments_performance"),
    ("supplier_products", "int_supplier_products"),
    ("transactions_enriched", "int_transactions_enriched"),
    ("lane_efficiency", "int_warehouse_to_store_efficiency"),
):
    _model(_name, _table)
for _name in (
    "dim_products", "dim_stores", "dim_suppliers", "dim_warehouses",
    "fct_transactions", "fct_regional_sales", "fct_inventory", "fct_warehouse_efficiency",
):
    _model(_name, _name)


@register("top_stockouts", oracle.TOP_STOCKOUTS)
def top_stockouts(spark: SparkSession, folder: str) -> DataFrame:
    return plain(marts.top_stockouts(views(spark, folder)["int_inventory_health"]))


@register("clean_expressions", oracle.CLEAN_EXPRESSIONS)
def clean_expressions(spark: SparkSession, folder: str) -> DataFrame:
    """Every cleaning expression over all orders, with values soiled from the row itself."""
    orders = Source(configure(spark), folder).table("orders")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    day = F.col("o_orderdate").cast("date")
    text = (
        F.when(F.col("o_orderstatus") == "O", F.date_format(day, "dd/MM/yyyy"))
        .when(F.col("o_orderstatus") == "F", F.date_format(day, "MM/dd/yyyy"))
        .when(F.col("o_orderpriority") == "5-LOW", "unknown")
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    micros = F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_custkey")
    return plain(
        orders.select(
            "o_orderkey",
            cleaning.clean_id(F.concat(F.lit("  "), F.lower(F.nullif("o_orderpriority", F.lit("5-LOW")))))
            .alias("id"),
            cleaning.clean_string(F.concat(F.lit(" \t"), F.col("o_orderstatus"), F.lit("  "))).alias("text"),
            cleaning.clean_number(price - 250000).alias("number"),
            cleaning.clean_number(F.nullif("o_orderstatus", F.col("o_orderstatus")).cast("int")).alias(
                "no_number"
            ),
            cleaning.clean_decimal(F.concat(F.lit("-"), price.cast("string"), F.lit("5"))).alias("amount"),
            cleaning.date_or(F.when(F.col("o_orderstatus") != "P", day.cast("string")), AS_OF).alias("day"),
            cleaning.parse_date_any(text, as_of=AS_OF).alias("parsed"),
            cleaning.from_micros(micros).alias("moment"),
        )
    )


# Incremental


def _order_line_sales(folder_views: Views) -> DataFrame:
    """Staged sales keyed by order and line only, an id that recurs."""
    line = F.substring_index("transaction_id", "-", 2)
    return folder_views["stg_transactions"].withColumn("transaction_id", line)


@register("upsert_transactions", oracle.UPSERT_TRANSACTIONS)
def upsert_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads: the rows up to a day, then the rows newer than the first load's mark."""
    sales, order = _order_line_sales(views(spark, folder)), ["ingestion_date"]
    first = sales.filter(F.col("ingestion_date") <= F.lit(MERGE_FROM).cast("timestamp_ntz"))
    keys = ["transaction_id"]
    keyless = incremental.without_key(sales, keys, MODELS["stg_transactions"].unknown)
    target = incremental.reduced(first, keys, order, keyless)
    batch = incremental.newer_than(sales, incremental.high_water_mark(first))
    return plain(incremental.upsert(target, batch, keys, order, keyless=keyless))


def _two_loads(spark: SparkSession, folder: str, refresh: bool) -> DataFrame:
    """Sales per product after two loads into catalog tables of their own, which are dropped again."""
    source, prefix = Source(configure(spark), folder), f"run_{uuid.uuid4().hex[:12]}_"

    def raw(name: str, cut: str) -> DataFrame:
        df = source.raw(name)
        if name != "transactions":
            return df
        line = F.substring_index("transaction_id", "-", 2)
        return df.withColumn("transaction_id", line).filter(F.col("ingestion_date") <= F.lit(cut).cast("timestamp_ntz"))

    for cut in (MERGE_FROM, "2100-01-01"):
        job = Run(spark, lambda name, cut=cut: raw(name, cut), AS_OF, NOW, enforce=False, prefix=prefix)
        job.make("stg_products", "stg_transactions", "int_transactions_enriched")
    if refresh:
        job.full_refresh = True
        job.make("int_transactions_enriched")
    sales = once(job.make("fct_transactions"), "run")
    for layer in ("staging", "intermediate", "marts"):
        spark.sql(f"DROP DATABASE IF EXISTS {prefix}{layer} CASCADE")
    return plain(sales)


@register("run_increment", oracle.RUN_INCREMENT)
def run_increment(spark: SparkSession, folder: str) -> DataFrame:
    return _two_loads(spark, folder, refresh=False)


@register("run_full_refresh", oracle.RUN_FULL_REFRESH)
def run_full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    return _two_loads(spark, folder, refresh=True)


@register("latest_shipments", oracle.LATEST_SHIPMENTS)
def latest_shipments(spark: SparkSession, folder: str) -> DataFrame:
    """The latest shipment of every product and warehouse."""
    shipments = views(spark, folder)["stg_shipments"]
    return plain(
        incremental.latest_by_key(shipments, ["warehouse_id", "product_id"], ["ingestion_date", "shipment_id"])
    )


def _merge_sides(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A raw table and a later delivery that overlaps it by a year."""
    raw = Source(configure(spark), folder).raw("transactions")
    loaded, columns = F.col("ingestion_date"), landed("transactions").names
    target = raw.filter(loaded < F.lit(MERGE_TO).cast("timestamp_ntz"))
    batch = raw.filter(loaded >= F.lit(MERGE_FROM).cast("timestamp_ntz"))
    return target.select(*columns), batch.select(*columns)


@register("raw_merge_insert_only", oracle.raw_merge(null_safe=True))
def raw_merge_insert_only(spark: SparkSession, folder: str) -> DataFrame:
    target, batch = _merge_sides(spark, folder)
    return plain(incremental.new_rows(target, batch, prune_on="rds_extraction_date"))


@register("raw_merge_plain_equality", oracle.raw_merge(null_safe=False))
def raw_merge_plain_equality(spark: SparkSession, folder: str) -> DataFrame:
    target, batch = _merge_sides(spark, folder)
    return plain(incremental.new_rows(target, batch, null_safe=False))


# Type-2 history: three runs over changing states of a whole dimension.


def _states(name: str, staged: DataFrame) -> list[DataFrame]:
    snapshot = SNAPSHOTS[name]
    states = []
    for run in range(len(RUNS)):
        listed, changes = oracle.STATES[name][run]
        row = {c: F.expr(changes.get(c, c)).cast(staged.schema[c].dataType) for c in snapshot.columns}
        states.append(staged.filter(listed).select(*[v.alias(c) for c, v in row.items()]))
    return states


def _history(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        snapshot, history = SNAPSHOTS[name], None
        staged = views(spark, folder)[f"stg_{name}"]
        for now, state in zip(RUNS, _states(name, staged), strict=True):
            history = scd2(history, state, snapshot.key, list(snapshot.checked), now)
        return plain(history)

    return query


for _name in SNAPSHOTS:
    register(f"scd2_{_name}", oracle.scd2(_name, SNAPSHOTS[_name], RUNS))(_history(_name))


# Quality


def _suite(layer: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        tables = views(spark, folder, checked=layer == "intermediate")
        parents = {n: tables[f"raw_{n}"] for n in INCOMING}
        # Intermediate tables share shuffles, which are narrow.
        apart = layer != "intermediate" and not all(map(tables.small, LOOKUP_KEYS))
        return quality.run_suite(tables.layer(layer), LAYERS[layer], parents, apart)

    return query


for _name in LAYERS:
    register(f"dq_{_name}", oracle.suite(_name))(_suite(_name))


@register("dq_shipment_dates", oracle.DQ_SHIPMENT_DATES)
def dq_shipment_dates(spark: SparkSession, folder: str) -> DataFrame:
    return plain(quality.shipment_date_order(views(spark, folder)["stg_shipments"]))


@register("dq_orphan_products", oracle.DQ_ORPHAN_PRODUCTS)
def dq_orphan_products(spark: SparkSession, folder: str) -> DataFrame:
    tables = views(spark, folder)
    return quality.relationships(
        tables["stg_transactions"], "product_id", tables["raw_products"], "product_id"
    )


@register("dq_repeated_order_lines", oracle.DQ_REPEATED_ORDER_LINES)
def dq_repeated_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return quality.unique(_order_line_sales(views(spark, folder)), "transaction_id")


@register("dq_missing_discounts", oracle.DQ_MISSING_DISCOUNTS)
def dq_missing_discounts(spark: SparkSession, folder: str) -> DataFrame:
    return plain(quality.not_null(views(spark, folder)["stg_transactions"], "discount_pct"))


@register("dq_untrimmed_products", oracle.DQ_UNTRIMMED_PRODUCTS)
def dq_untrimmed_products(spark: SparkSession, folder: str) -> DataFrame:
    return plain(quality.no_whitespace(views(spark, folder)["raw_products"], "product_id"))


@register("dq_negative_quantities", oracle.DQ_NEGATIVE_QUANTITIES)
def dq_negative_quantities(spark: SparkSession, folder: str) -> DataFrame:
    return plain(quality.positive_value(views(spark, folder)["raw_transactions"], "quantity_sold"))


@register("dq_unreadable_dates", oracle.DQ_UNREADABLE_DATES)
def dq_unreadable_dates(spark: SparkSession, folder: str) -> DataFrame:
    return plain(quality.is_date_type(views(spark, folder)["raw_stores"], "store_open_date"))


@register("dq_unlisted_categories", oracle.DQ_UNLISTED_CATEGORIES)
def dq_unlisted_categories(spark: SparkSession, folder: str) -> DataFrame:
    return plain(
        quality.accepted_values(views(spark, folder)["raw_suppliers"], "category", ["Hardware", "Tools"])
    )


# Files


def _write_csv(df: DataFrame, path: str) -> None:
    writer = df.write.option("header", True).option("escape", '"').mode("append")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _write_json_arrays(df: DataFrame, path: str, per_file: int = 50_000, compression: str = "none") -> None:
    """Files that each hold one array of records, of about `per_file` records.

    Records are dealt by all their columns: by their id, those without one would all lie in a single file.
    """
    with shuffles_dropped(df.sparkSession):
        count = df.count() // per_file + 1
    record, number = F.struct(*df.columns), F.pmod(F.xxhash64(*df.columns), F.lit(count))
    arrays = df.groupBy(number.alias("file")).agg(F.to_json(F.collect_list(record)).alias("value"))
    # One unquoted cell per file: the CSV writer is the one whose file extension can be chosen.
    bare = arrays.write.option("quote", "").option("escapeQuotes", False).option("sep", "\u0001")
    with shuffles_dropped(df.sparkSession):
        bare.option("extension", "json").option("compression", compression).partitionBy("file").csv(path)


@register("csv_scan", oracle.incoming("transactions"))
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Files whose columns stand in another order, in capitals, or are left out where all are NULL."""
    raw, schema = Source(configure(spark), folder).raw("transactions"), incoming("transactions")
    path, names = scratch_dir(spark, "csv"), schema.names
    priced = F.col("unit_price").isNotNull()
    _write_csv(raw.filter(priced).select(*[F.col(c).alias(c.upper()) for c in reversed(names)]), path)
    _write_csv(raw.filter(~priced).select(*[c for c in names if c != "unit_price"]), path)
    return plain(files.read_csv(spark, path, schema))


@register("json_scan", oracle.incoming("shipments"))
def json_scan(spark: SparkSession, folder: str) -> DataFrame:
    raw, schema = Source(configure(spark), folder).raw("shipments"), incoming("shipments")
    path = scratch_dir(spark, "json")
    # Text of records takes a sixth of the disk so.
    _write_json_arrays(raw.select(*schema.names), path, compression="gzip")
    return plain(files.read_json(spark, path, schema))


@register("sheet_scan", oracle.incoming("stores"))
def sheet_scan(spark: SparkSession, folder: str) -> DataFrame:
    raw = Source(configure(spark), folder).raw("stores").select(*incoming("stores").names)
    path = scratch_dir(spark, "sheet")
    _write_csv(raw, path)
    return files.read_sheet_export(spark, path)


@register("sales_union", oracle.SALES_UNION)
def sales_union(spark: SparkSession, folder: str) -> DataFrame:
    """Two sales tables, the older one without discounts, as one."""
    raw = Source(configure(spark), folder).raw("transactions")
    newer = F.col("ingestion_date") >= F.lit(MERGE_FROM).cast("timestamp_ntz")
    columns = ["transaction_id", "quantity_sold", "discount_pct"]
    old = raw.filter(~newer).select(*columns[:2])
    return plain(union_tables([old, raw.filter(newer).select(*reversed(columns))]))


def _orders_by_priority(spark: SparkSession, folder: str, purpose: str) -> str:
    """All orders as Parquet files, one folder per priority."""
    path = scratch_dir(spark, purpose)
    orders = Source(configure(spark), folder).table("orders")
    named = orders.withColumn("folder", F.split_part("o_orderpriority", F.lit("-"), F.lit(1)))
    named.write.partitionBy("folder").parquet(path)
    return path


@register("file_inventory", oracle.FILE_INVENTORY)
def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    path = _orders_by_priority(spark, folder, "inventory")
    formats = files.folder_formats(files.file_inventory(spark, path))
    return formats.select("folder", F.array_join("extensions", ",").alias("extensions"))


@register("skip_landed", oracle.SKIP_LANDED)
def skip_landed(spark: SparkSession, folder: str) -> DataFrame:
    """One source file per order date, all of the same base name; those of finished orders' dates have landed."""
    orders = Source(configure(spark), folder).table("orders")
    name = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/part-0.csv"))
    source = orders.select(F.lit("orders").alias("folder"), name.alias("name")).distinct()
    done = orders.filter("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").select(
        F.lit("orders").alias("folder"), F.concat(name, F.lit("_20240101T123000Z")).alias("name")
    )
    return files.skip_landed(source, done)


@register("ledger_skip", oracle.LEDGER_SKIP)
def ledger_skip(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in files the ledger lacks, when the files of two priorities are recorded."""
    path = _orders_by_priority(spark, folder, "ledger")
    found = files.file_inventory(spark, path)
    ledger = f"{scratch_dir(spark, 'ledger')}/processed"
    landing.mark_processed(found.filter("folder IN ('folder=1', 'folder=4')"), ledger)
    pending = landing.unprocessed(found, spark.read.parquet(ledger)).select("path")
    rows = spark.read.parquet(path).withColumn("path", F.col("_metadata.file_path"))
    kept = rows.groupBy("path", "folder").agg(F.count("*").alias("n")).join(pending, "path", "left_semi")
    return kept.groupBy(F.col("folder").cast("string").alias("folder")).agg(F.sum("n").alias("orders"))


@register("land_and_load", oracle.LAND_AND_LOAD)
def land_and_load(spark: SparkSession, folder: str) -> DataFrame:
    """CSV and JSON files landed, loaded into a raw table, and all of it once more without effect."""
    raw, schema = Source(configure(spark), folder).raw("products"), incoming("products")
    root = scratch_dir(spark, "land")
    source, zone = f"{root}/source", f"{root}/landing"
    rows, small = raw.select(*schema.names), F.col("category").isin("SMALL", "ECONOMY")
    # Days are folders, and files of different days have the same name.
    for day in ("2024-01-01", "2024-01-02"):
        odd = F.col("category").contains("BRASS")
        _write_csv(rows.filter(small & (odd if day > "2024-01-01" else ~odd)), f"{source}/products/{day}")
    _write_json_arrays(rows.filter(~small), f"{source}/products/json")
    for _ in range(2):
        for extension in ("csv", "json", "txt"):
            landing.land_folder(spark, source, zone, "products", extension, schema, now=NOW)
        landing.load_folder(
            spark, f"{zone}/products", f"{root}/raw", f"{root}/ledger", landed("products"),
            prune_on="s3_extraction_date",
        )
    loaded = landing.read_raw(spark, f"{root}/raw", landed("products"))
    return plain(loaded.drop("ingestion_date"))


@register("load_with_bad_file", oracle.LOAD_WITH_BAD_FILE)
def load_with_bad_file(spark: SparkSession, folder: str) -> DataFrame:
    """One file among the landed ones is no Parquet file; it is tried again later, the others are not."""
    raw, schema = Source(configure(spark), folder).raw("suppliers"), landed("suppliers")
    root = scratch_dir(spark, "bad")
    raw.select(*schema.names).repartition(3, "supplier_id").write.parquet(f"{root}/landing/good")
    broken = raw.select("supplier_id").limit(1).coalesce(1).write
    broken.option("extension", "parquet").csv(f"{root}/landing/bad")
    found = [landing.load_folder(spark, f"{root}/landing", f"{root}/raw", f"{root}/ledger", schema) for _ in range(2)]
    loaded = landing.read_raw(spark, f"{root}/raw", schema).drop("ingestion_date")
    again = F.lit(found[1].files).cast("bigint"), F.lit(len(found[1].unreadable)).cast("bigint")
    return plain(loaded).withColumns({"files_again": again[0], "unreadable": again[1]})


@register("stream_load", oracle.STREAM_LOAD)
def stream_load(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs of the streaming load; the second one takes in only the files added in between."""
    raw, schema = Source(configure(spark), folder).raw("inventory"), landed("inventory")
    root = scratch_dir(spark, "stream")
    rows = raw.select(*schema.names)
    stocked = F.col("quantity_available") != 0
    for part in (rows.filter(stocked), rows.filter(~stocked)):
        part.write.mode("append").parquet(f"{root}/landing")
        load_stream(spark, f"{root}/landing", schema, f"{root}/raw", f"{root}/checkpoint")
    return plain(landing.read_raw(spark, f"{root}/raw", schema).drop("ingestion_date"))


@register("lineage_stamp", oracle.LINEAGE_STAMP)
def lineage_stamp(spark: SparkSession, folder: str) -> DataFrame:
    """Extraction stamp on every order, and its date as a load stamp in the load zone."""
    orders = Source(configure(spark), folder).table("orders")
    stamped = landing.stamp_lineage(orders.select("o_orderkey", "o_orderdate"), "s3", NOW)
    return plain(
        stamped.withColumn("ingestion_date", landing.load_stamp(F.col("o_orderdate"))).drop("o_orderdate")
    )
