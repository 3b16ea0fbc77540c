"""Dimension and fact tables, and the stock-out report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.functions import rules


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", "product_name", "brand", "category", "supplier_id", "unit_price"
    ).distinct()


def dim_stores(stores: DataFrame) -> DataFrame:
    return stores.select("store_id", "store_name", "city", "state", "region").distinct()


def dim_suppliers(suppliers: DataFrame) -> DataFrame:
    return suppliers.select("supplier_id", "supplier_name", "category", "country").distinct()


def dim_warehouses(warehouses: DataFrame) -> DataFrame:
    return warehouses.select("warehouse_id", "city", "state").distinct()


def fct_transactions(enriched: DataFrame) -> DataFrame:
    """Sales and profit per product and store."""
    return enriched.groupBy(
        "product_id", "product_name", "category", "brand", "store_id", "supplier_id"
    ).agg(
        F.sum("quantity_sold").alias("total_quantity_sold"),
        F.sum("gross_revenue").alias("total_gross_revenue"),
        F.sum("total_expenses").alias("total_expenses"),
        F.sum("net_revenue").alias("total_net_revenue"),
        F.sum("net_profit_loss").alias("total_net_profit_loss"),
        F.avg("profit_margin_pct").alias("avg_profit_margin_pct"),
        F.countDistinct("transaction_id").alias("num_transactions"),
        F.min("ingestion_date").alias("first_transaction_date"),
        F.max("ingestion_date").alias("last_transaction_date"),
    )


def fct_regional_sales(transactions: DataFrame, stores: DataFrame) -> DataFrame:
    """Units and revenue per region.

    Sales are summed per store before the join: sums distribute over the join (also where a store
    has several rows), so only one row per store is joined and a busy store cannot overload a task.
    """
    per_store = transactions.groupBy("store_id").agg(
        F.sum("quantity_sold").alias("quantity"), F.sum("net_revenue").alias("revenue")
    )
    return (
        per_store.join(stores.select("store_id", "region"), "store_id")
        .groupBy("region")
        .agg(
            F.sum("quantity").alias("total_quantity_sold"),
            F.sum("revenue").alias("total_revenue"),
        )
    )


def fct_inventory(health: DataFrame) -> DataFrame:
    return health.select(
        "warehouse_id",
        "product_id",
        "product_name",
        "quantity_available",
        "reorder_threshold",
        "stock_status",
        "stock_to_threshold_ratio",
    )


def fct_warehouse_efficiency(lanes: DataFrame) -> DataFrame:
    """Shipments, transit time and share of internal delays per warehouse."""
    internal_delay = F.col("route_performance_status") == "Warehouse Delay"
    totals = lanes.groupBy("warehouse_id", "warehouse_city", "warehouse_state").agg(
        F.countDistinct("shipment_id").alias("total_shipments_processed"),
        F.avg("transit_days").alias("avg_transit_days"),
        F.count_if(internal_delay).alias("total_internal_delays"),
        F.max("ingestion_date").alias("last_updated_at"),
    )
    delays, shipments = F.col("total_internal_delays"), F.col("total_shipments_processed")
    return totals.select(
        "*",
        rules.error_rate_pct(delays, shipments).alias("warehouse_error_rate_pct"),
        rules.efficiency_rating(delays, shipments).alias("efficiency_rating"),
    )


def top_stockouts(health: DataFrame, k: int = 10) -> DataFrame:
    """The `k` product and warehouse pairs most often out of stock; ties ordered by key."""
    return (
        health.filter(F.col("stock_status") == "Stock-Out")
        .groupBy("product_id", "product_name", "warehouse_id")
        .agg(F.count("*").alias("stockout_events"))
        .orderBy(F.desc("stockout_events"), "product_id", "product_name", "warehouse_id")
        .limit(k)
    )
