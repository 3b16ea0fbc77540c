"""Intermediate tables: facts joined to their dimensions, with the business measures.

Pass dimensions through `joins.sized` to have small ones broadcast. A dimension with several rows
per key fans the facts out; reduce it with `incremental.latest_by_key` first where that is unwanted. Facts
that come from `joins.dealt` by the key of a dimension are not shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.functions import rules
from stockyard.functions.cleaning import MONEY
from stockyard.operators.joins import is_dealt, looked_up


def inventory_health(
    inventory: DataFrame, products: DataFrame, on_zero: str = "error"
) -> DataFrame:
    """Stock level against reorder threshold, for products in the master list."""
    ratio = rules.stock_ratio(F.col("quantity_available"), F.col("reorder_threshold"), on_zero)
    joined = looked_up(inventory, products.select("product_id", "product_name"), "product_id")
    return joined.select(
        "warehouse_id",
        "product_id",
        "product_name",
        "quantity_available",
        "reorder_threshold",
        "ingestion_date",
        ratio.alias("stock_to_threshold_ratio"),
        rules.stock_status(F.col("quantity_available"), ratio).alias("stock_status"),
    )


def shipment_performance(
    shipments: DataFrame, products: DataFrame, stores: DataFrame
) -> DataFrame:
    """Delay of each delivery against its promised date."""
    product = products.select("product_id", "product_name", "category")
    store = stores.select("store_id", "store_name", "region", "city")
    if is_dealt(shipments, "store_id"):
        joined = looked_up(shipments, store, "store_id").join(product, "product_id")
    else:
        joined = looked_up(shipments, product, "product_id").join(store, "store_id")
    expected, actual = F.col("expected_delivery_date"), F.col("actual_delivery_date")
    return joined.select(
        "shipment_id",
        "warehouse_id",
        "quantity_shipped",
        "carrier",
        "product_name",
        "category",
        "store_name",
        "region",
        "city",
        "ingestion_date",
        F.datediff(actual, expected).alias("delivery_delay_days"),
        rules.delivery_status(expected, actual).alias("delivery_status"),
    )


def supplier_products(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Every product with its supplier; both keys and attributes are NULL if there is none."""
    supplier = suppliers.select(
        F.col("supplier_id").alias("sid"),
        "supplier_name",
        F.col("category").alias("supplier_category"),
        "country",
    )
    product = products.select(
        "product_id",
        "product_name",
        "brand",
        F.col("category").alias("product_category"),
        "unit_price",
        F.col("supplier_id").alias("sid"),
    )
    matched = supplier.withColumn("supplier_id", F.col("sid"))
    return product.join(matched, "sid", "left").select(
        "supplier_id",
        "supplier_name",
        "supplier_category",
        "country",
        "product_id",
        "product_name",
        "brand",
        "product_category",
        "unit_price",
    )


def transactions_enriched(transactions: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, cost, discount, profit and margin per sale; unknown products keep the sale."""
    product = products.select(
        "product_id",
        "product_name",
        "category",
        "brand",
        "supplier_id",
        F.col("unit_price").alias("supplier_unit_price"),
    )
    quantity, price = F.col("quantity_sold"), F.col("selling_unit_price")
    money = (
        looked_up(transactions, product, "product_id", "left")
        .withColumnRenamed("unit_price", "selling_unit_price")
        .select(
            "transaction_id",
            "store_id",
            "product_id",
            "product_name",
            "category",
            "brand",
            "supplier_id",
            "quantity_sold",
            "selling_unit_price",
            "supplier_unit_price",
            "discount_pct",
            "net_revenue",
            (quantity * price).cast(MONEY).alias("gross_revenue"),
            (quantity * F.col("supplier_unit_price")).cast(MONEY).alias("total_expenses"),
            (quantity * price - F.col("net_revenue")).cast(MONEY).alias("discount_amount"),
            "ingestion_date",
        )
    )
    net, expenses, gross = F.col("net_revenue"), F.col("total_expenses"), F.col("gross_revenue")
    return money.select(
        "*",
        (net - expenses).alias("net_profit_loss"),
        rules.profit_margin(net, expenses, gross).alias("profit_margin_pct"),
        rules.financial_status(net, expenses, gross).alias("financial_status"),
    )


def lane_efficiency(
    shipments: DataFrame, stores: DataFrame, warehouses: DataFrame
) -> DataFrame:
    """Transit time and distance class of each warehouse-to-store shipment."""
    store = stores.select(
        "store_id", F.col("city").alias("store_city"), F.col("state").alias("store_state")
    )
    warehouse = warehouses.select(
        "warehouse_id",
        F.col("city").alias("warehouse_city"),
        F.col("state").alias("warehouse_state"),
    )
    joined = looked_up(shipments, store, "store_id").join(warehouse, "warehouse_id")
    lanes = joined.select(
        "shipment_id",
        "warehouse_id",
        "store_id",
        "store_city",
        "store_state",
        "warehouse_city",
        "warehouse_state",
        "ingestion_date",
        F.datediff("actual_delivery_date", "shipment_date").alias("transit_days"),
        rules.shipping_distance(
            F.col("store_city"),
            F.col("warehouse_city"),
            F.col("store_state"),
            F.col("warehouse_state"),
        ).alias("shipping_distance"),
    )
    status = rules.route_performance(F.col("shipping_distance"), F.col("transit_days"))
    return lanes.withColumn("route_performance_status", status)
