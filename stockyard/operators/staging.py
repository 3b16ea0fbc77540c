"""Raw tables to typed, cleaned, de-duplicated staging tables.

Every function takes the raw DataFrame and returns a lazy one. `as_of` is the day that stands in
for missing dates (today if omitted). Full copies of a row are removed unless `distinct` is off,
which saves a shuffle where the rows are reduced by key afterwards anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.functions import rules
from stockyard.functions.cleaning import (
    MISSING_PRODUCT,
    MISSING_STORE,
    MISSING_SUPPLIER,
    MISSING_WAREHOUSE,
    clean_decimal,
    clean_id,
    clean_number,
    clean_string,
    date_or,
    from_micros,
    lineage,
    parse_date_any,
)


def _whole(raw: DataFrame, column: str) -> Column:
    return clean_number(column, kind=raw.schema[column].dataType)


def stg_warehouses(raw: DataFrame, as_of=None, distinct: bool = True) -> DataFrame:
    rows = raw.select(
        clean_id("warehouse_id", MISSING_WAREHOUSE).alias("warehouse_id"),
        clean_string("city").alias("city"),
        clean_string("state").alias("state"),
        *lineage("s3_extraction_date"),
    )
    return rows.distinct() if distinct else rows


def stg_suppliers(raw: DataFrame, as_of=None, distinct: bool = True) -> DataFrame:
    rows = raw.select(
        clean_id("supplier_id", MISSING_SUPPLIER).alias("supplier_id"),
        clean_string("supplier_name").alias("supplier_name"),
        clean_string("category").alias("category"),
        clean_string("country").alias("country"),
        *lineage("s3_extraction_date"),
    )
    return rows.distinct() if distinct else rows


def stg_products(raw: DataFrame, as_of=None, distinct: bool = True) -> DataFrame:
    rows = raw.select(
        clean_id("product_id", MISSING_PRODUCT).alias("product_id"),
        clean_string("product_name").alias("product_name"),
        clean_string("category").alias("category"),
        clean_string("brand").alias("brand"),
        clean_id("supplier_id", MISSING_SUPPLIER).alias("supplier_id"),
        clean_decimal("unit_price").alias("unit_price"),
        *lineage("s3_extraction_date"),
    )
    return rows.distinct() if distinct else rows


def stg_stores(raw: DataFrame, as_of=None, distinct: bool = True) -> DataFrame:
    rows = raw.select(
        clean_id("store_id", MISSING_STORE).alias("store_id"),
        clean_string("store_name").alias("store_name"),
        clean_string("city").alias("city"),
        clean_string("state").alias("state"),
        clean_string("region").alias("region"),
        parse_date_any("store_open_date", as_of=as_of).alias("store_open_date"),
        *lineage("sheets_extraction_date"),
    )
    return rows.distinct() if distinct else rows


def stg_inventory(raw: DataFrame, as_of=None, distinct: bool = True) -> DataFrame:
    rows = raw.select(
        clean_id("warehouse_id", MISSING_WAREHOUSE).alias("warehouse_id"),
        clean_id("product_id", MISSING_PRODUCT).alias("product_id"),
        _whole(raw, "quantity_available").alias("quantity_available"),
        _whole(raw, "reorder_threshold").alias("reorder_threshold"),
        date_or("snapshot_date", as_of).alias("snapshot_date"),
        *lineage("s3_extraction_date"),
    )
    return rows.distinct() if distinct else rows


def stg_shipments(raw: DataFrame, as_of=None, distinct: bool = True) -> DataFrame:
    rows = raw.select(
        clean_string("shipment_id").alias("shipment_id"),
        clean_id("warehouse_id", MISSING_WAREHOUSE).alias("warehouse_id"),
        clean_id("store_id", MISSING_STORE).alias("store_id"),
        clean_id("product_id", MISSING_PRODUCT).alias("product_id"),
        _whole(raw, "quantity_shipped").alias("quantity_shipped"),
        date_or("shipment_date", as_of).alias("shipment_date"),
        date_or("expected_delivery_date", as_of).alias("expected_delivery_date"),
        date_or("actual_delivery_date", as_of).alias("actual_delivery_date"),
        clean_string("carrier").alias("carrier"),
        *lineage("s3_extraction_date"),
    )
    return rows.distinct() if distinct else rows


def stg_transactions(raw: DataFrame, as_of=None, distinct: bool = True) -> DataFrame:
    quantity = _whole(raw, "quantity_sold")
    price = clean_decimal("unit_price")
    discount = F.abs(F.col("discount_pct").cast("decimal(3,2)"))
    rows = raw.select(
        clean_string("transaction_id").alias("transaction_id"),
        clean_id("store_id", MISSING_STORE).alias("store_id"),
        clean_id("product_id", MISSING_PRODUCT).alias("product_id"),
        quantity.alias("quantity_sold"),
        price.alias("unit_price"),
        discount.alias("discount_pct"),
        rules.net_revenue(quantity, price, discount).alias("net_revenue"),
        from_micros("transaction_timestamp").alias("transaction_timestamp_utc"),
        *lineage("rds_extraction_date"),
    )
    return rows.distinct() if distinct else rows
