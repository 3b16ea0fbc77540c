"""Schemas of the raw tables as they arrive, and the type map of the loader."""

from __future__ import annotations

from pyspark.sql import types as T

# Incoming columns per raw table, without the lineage columns added on landing.
INCOMING = {
    "inventory": "warehouse_id string, product_id string, quantity_available bigint, "
    "reorder_threshold bigint, snapshot_date string",
    "stores": "store_id string, store_name string, city string, state string, region string, "
    "store_open_date string",
    "warehouses": "warehouse_id string, city string, state string",
    "products": "product_id string, product_name string, category string, brand string, "
    "supplier_id string, unit_price decimal(10,2)",
    "suppliers": "supplier_id string, supplier_name string, category string, country string",
    "shipments": "shipment_id string, warehouse_id string, store_id string, product_id string, "
    "quantity_shipped bigint, shipment_date string, expected_delivery_date string, "
    "actual_delivery_date string, carrier string",
    "transactions": "transaction_id string, store_id string, product_id string, "
    "quantity_sold bigint, unit_price decimal(10,2), discount_pct decimal(3,2), "
    "sales_amount decimal(18,2), transaction_timestamp bigint",
}

# Which kind of source delivers each table; it names the extraction-time column.
DELIVERED_BY = {
    "inventory": "s3",
    "stores": "sheets",
    "warehouses": "s3",
    "products": "s3",
    "suppliers": "s3",
    "shipments": "s3",
    "transactions": "rds",
}

# Column types the loader accepts and the type each is stored as.
STORED_TYPES = {
    "tinyint": "bigint",
    "smallint": "bigint",
    "int": "bigint",
    "bigint": "bigint",
    "float": "double",
    "double": "double",
    "string": "string",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp",
    "timestamp_ntz": "timestamp_ntz",
}


def incoming(table: str) -> T.StructType:
    return T.StructType.fromDDL(INCOMING[table])


def landed(table: str) -> T.StructType:
    """Schema of a landed file: incoming columns and the lineage stamp."""
    extraction = f"{DELIVERED_BY[table]}_extraction_date"
    return T.StructType.fromDDL(f"{INCOMING[table]}, {extraction} string, origin string")


def stored_type(kind: T.DataType) -> str:
    """Type a landed column gets in the raw table; an unknown type is refused."""
    name = kind.simpleString()
    if isinstance(kind, T.DecimalType):
        return name
    if name not in STORED_TYPES:
        raise TypeError(f"no raw column type for {name}")
    return STORED_TYPES[name]


def stored_schema(schema: T.StructType) -> T.StructType:
    """The raw table's schema for landed files of this schema, names in lower case."""
    return T.StructType.fromDDL(
        ", ".join(f"`{f.name.lower()}` {stored_type(f.dataType)}" for f in schema.fields)
    )
