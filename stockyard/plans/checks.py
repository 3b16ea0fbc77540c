"""The checks declared for each layer."""

from __future__ import annotations

from dataclasses import dataclass, field

from stockyard.functions import rules
from stockyard.operators.quality import Check


@dataclass(frozen=True)
class Declared:
    """The checks of one table. No column may be NULL; `text` columns may not have white space around
    them either. `unique`, `positive`, `dates` and `accepted` name the columns that have those checks
    (unique, positive_value, is_date_type, accepted_values) as well; `parents` the raw table whose column
    of the same name must hold a column's values (relationships)."""

    table: str
    text: tuple[str, ...]
    other: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    positive: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    accepted: tuple[str, ...] = ()
    parents: dict[str, str] = field(default_factory=dict)

    def checks(self) -> list[Check]:
        kinds = {
            "not_null": self.text + self.other,
            "no_whitespace": self.text,
            "unique": self.unique,
            "positive_value": self.positive,
            "is_date_type": self.dates,
        }
        found = [Check(self.table, column, kind) for kind, columns in kinds.items() for column in columns]
        found += [Check(self.table, c, "accepted_values", values=ACCEPTED[c]) for c in self.accepted]
        return found + [Check(self.table, c, "relationships", parent=(p, c)) for c, p in self.parents.items()]


# What a column may hold.
ACCEPTED = {
    "shipping_distance": rules.DISTANCES,
    "route_performance_status": rules.ROUTE_STATUSES,
    "stock_status": rules.STOCK_STATUSES,
    "delivery_status": rules.DELIVERY_STATUSES,
    "efficiency_rating": rules.EFFICIENCY_RATINGS,
}

# Which columns have which checks.
STAGING = (
    Declared(
        "stg_warehouses",
        text=("warehouse_id", "city", "state", "origin"),
        other=("s3_extraction_date", "ingestion_date"),
        unique=("warehouse_id",),
    ),
    Declared(
        "stg_suppliers",
        text=("supplier_id", "supplier_name", "category", "country", "origin"),
        other=("s3_extraction_date", "ingestion_date"),
        unique=("supplier_id",),
    ),
    Declared(
        "stg_products",
        text=("product_id", "product_name", "category", "brand", "supplier_id", "origin"),
        other=("unit_price", "s3_extraction_date", "ingestion_date"),
        unique=("product_id",),
        positive=("unit_price",),
        parents={"supplier_id": "suppliers"},
    ),
    Declared(
        "stg_stores",
        text=("store_id", "store_name", "city", "state", "region", "origin"),
        other=("store_open_date", "sheets_extraction_date", "ingestion_date"),
        unique=("store_id",),
    ),
    Declared(
        "stg_shipments",
        text=("shipment_id", "warehouse_id", "store_id", "product_id", "carrier", "origin"),
        other=(
            "quantity_shipped", "shipment_date", "expected_delivery_date", "actual_delivery_date",
            "s3_extraction_date", "ingestion_date",
        ),
        unique=("shipment_id",),
        positive=("quantity_shipped",),
        dates=("shipment_date", "expected_delivery_date", "actual_delivery_date"),
        parents={"warehouse_id": "warehouses", "store_id": "stores", "product_id": "products"},
    ),
    Declared(
        "stg_inventory",
        text=("warehouse_id", "product_id", "origin"),
        other=(
            "quantity_available", "reorder_threshold", "snapshot_date", "s3_extraction_date",
            "ingestion_date",
        ),
        positive=("quantity_available",),
        dates=("snapshot_date",),
        parents={"warehouse_id": "warehouses", "product_id": "products"},
    ),
    Declared(
        "stg_transactions",
        text=("transaction_id", "store_id", "product_id", "origin"),
        other=(
            "quantity_sold", "unit_price", "discount_pct", "net_revenue", "transaction_timestamp_utc",
            "rds_extraction_date", "ingestion_date",
        ),
        unique=("transaction_id",),
        positive=("unit_price", "discount_pct", "net_revenue"),
        parents={"store_id": "stores", "product_id": "products"},
    ),
)

INTERMEDIATE = (
    Declared(
        "int_warehouse_to_store_efficiency",
        text=(
            "warehouse_id", "store_id", "store_city", "store_state", "warehouse_city", "warehouse_state",
            "shipping_distance", "route_performance_status",
        ),
        accepted=("shipping_distance", "route_performance_status"),
    ),
    Declared(
        "int_transactions_enriched",
        text=(
            "transaction_id", "store_id", "product_id", "product_name", "category", "brand",
            "supplier_id", "financial_status",
        ),
        other=(
            "quantity_sold", "selling_unit_price", "supplier_unit_price", "discount_pct", "net_revenue",
            "gross_revenue", "total_expenses", "discount_amount", "net_profit_loss", "profit_margin_pct",
        ),
        positive=(
            "quantity_sold", "selling_unit_price", "supplier_unit_price", "discount_pct", "net_revenue",
            "gross_revenue", "total_expenses", "discount_amount",
        ),
    ),
    Declared(
        "int_inventory_health",
        text=("warehouse_id", "product_id", "product_name", "stock_status"),
        other=("quantity_available", "reorder_threshold", "stock_to_threshold_ratio"),
        positive=("quantity_available", "reorder_threshold", "stock_to_threshold_ratio"),
        accepted=("stock_status",),
    ),
    Declared(
        "int_shipments_performance",
        text=(
            "shipment_id", "warehouse_id", "carrier", "product_name", "category", "store_name", "region",
            "city", "delivery_status",
        ),
        other=("quantity_shipped", "delivery_delay_days"),
        positive=("quantity_shipped",),
        accepted=("delivery_status",),
    ),
    Declared(
        "int_supplier_products",
        text=(
            "supplier_id", "supplier_name", "supplier_category", "country", "product_id", "product_name",
            "brand", "product_category", "unit_price",
        ),
    ),
)

MARTS = (
    Declared(
        "dim_warehouses",
        text=("warehouse_id", "city", "state"),
        unique=("warehouse_id",),
    ),
    Declared(
        "dim_stores",
        text=("store_id", "store_name", "city", "state", "region"),
        unique=("store_id",),
    ),
    Declared(
        "dim_products",
        text=("product_id", "product_name", "brand", "category", "supplier_id"),
        other=("unit_price",),
        unique=("product_id",),
        positive=("unit_price",),
    ),
    Declared(
        "dim_suppliers",
        text=("supplier_id", "supplier_name", "category", "country"),
        unique=("supplier_id",),
    ),
    Declared(
        "fct_transactions",
        text=("product_id", "product_name"),
        other=(
            "total_quantity_sold", "total_gross_revenue", "total_net_revenue", "total_net_profit_loss",
            "num_transactions",
        ),
        positive=("total_quantity_sold", "total_gross_revenue", "total_net_revenue", "num_transactions"),
    ),
    Declared(
        "fct_warehouse_efficiency",
        text=("warehouse_id", "warehouse_city", "efficiency_rating"),
        other=("total_shipments_processed", "avg_transit_days", "warehouse_error_rate_pct"),
        unique=("warehouse_id",),
        positive=("total_shipments_processed", "avg_transit_days", "warehouse_error_rate_pct"),
        accepted=("efficiency_rating",),
    ),
    Declared(
        "fct_regional_sales",
        text=("region",),
        other=("total_quantity_sold", "total_revenue"),
        positive=("total_quantity_sold", "total_revenue"),
    ),
    Declared(
        "fct_inventory",
        text=("warehouse_id", "product_id", "product_name", "stock_status", "stock_to_threshold_ratio"),
        other=("quantity_available", "reorder_threshold"),
        positive=("quantity_available", "reorder_threshold", "stock_to_threshold_ratio"),
    ),
)

LAYERS = {
    "staging": [check for table in STAGING for check in table.checks()],
    "intermediate": [check for table in INTERMEDIATE for check in table.checks()],
    "marts": [check for table in MARTS for check in table.checks()],
}
