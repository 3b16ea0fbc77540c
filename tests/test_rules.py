"""Golden rows for every branch of the business rules, and for the tables built on them."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from stockyard.functions import rules
from stockyard.operators import enrich, marts, staging

LOAD = datetime(2024, 1, 2)
S3 = "s3_extraction_date string, origin string, ingestion_date timestamp_ntz"
STAMP = ("2024-01-01 00:00:00", "s3", LOAD)


def apply(spark, column, rows, schema):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r.y for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_stock_status_edges(spark):
    ratio = rules.stock_ratio(F.col("q"), F.col("t"))
    rows = [(0, 5), (199, 200), (1, 1), (3, 1), (301, 100), (1, 2), (994, 1000)]
    schema = "q bigint, t bigint"
    assert apply(spark, ratio, rows, schema)[:5] == [D("0.00"), D("1.00"), D("1.00"), D("3.00"), D("3.01")]
    assert apply(spark, rules.stock_status(F.col("q"), ratio), rows, schema) == [
        "Stock-Out", "Healthy", "Healthy", "Healthy", "Sufficient",
        "Below Reorder Threshold", "Below Reorder Threshold",
    ]


def test_zero_threshold(spark):
    row, schema = [(5, 0)], "q bigint, t bigint"
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        apply(spark, rules.stock_ratio(F.col("q"), F.col("t")), row, schema)
    ratio = rules.stock_ratio(F.col("q"), F.col("t"), "null")
    assert apply(spark, ratio, row, schema) == [None]
    assert apply(spark, rules.stock_status(F.col("q"), ratio), row, schema) == ["Sufficient"]
    with pytest.raises(ValueError):
        rules.stock_ratio(F.col("q"), F.col("t"), "skip")


def test_delivery_status(spark):
    day = date(2024, 1, 2)
    rows = [(day, date(2024, 1, 1)), (day, day), (day, date(2024, 1, 3))]
    status = rules.delivery_status(F.col("e"), F.col("a"))
    assert apply(spark, status, rows, "e date, a date") == ["Early", "On time", "Late"]


def test_route_performance_edges(spark):
    local, regional, long_haul = rules.DISTANCES
    rows = [(long_haul, 3), (long_haul, 4), (local, 1), (local, 2), (regional, 9)]
    status = rules.route_performance(F.col("d"), F.col("t"))
    assert apply(spark, status, rows, "d string, t int") == [
        "Good Route", "High Delay Risk", "Good Route", "Warehouse Delay", "Good Route",
    ]


def test_efficiency_edges(spark):
    rows = [(1, 20), (3, 20), (4, 20), (0, 20), (1, 0)]
    rating = rules.efficiency_rating(F.col("d"), F.col("n"))
    assert apply(spark, rating, rows, "d bigint, n bigint") == [
        "Standard", "Standard", "Bottleneck Detected", "High Efficiency", "Bottleneck Detected",
    ]
    rate = rules.error_rate_pct(F.col("d"), F.col("n"))
    expected = [D("5.00"), D("15.00"), D("20.00"), D("0.00"), None]
    assert apply(spark, rate, rows, "d bigint, n bigint") == expected


def sales(spark, rows):
    schema = (
        "transaction_id string, store_id string, product_id string, quantity_sold bigint, "
        "unit_price decimal(10,2), discount_pct decimal(3,2), sales_amount decimal(18,2), "
        "transaction_timestamp bigint, rds_extraction_date string, origin string, "
        "ingestion_date timestamp_ntz"
    )
    full = [(*r, None, 0, "2024-01-01 00:00:00", "rds", LOAD) for r in rows]
    return staging.stg_transactions(spark.createDataFrame(full, schema))


def products(spark, rows):
    schema = (
        "product_id string, product_name string, category string, brand string, supplier_id string, "
        f"unit_price decimal(10,2), {S3}"
    )
    return staging.stg_products(
        spark.createDataFrame([(p, "n", "c", "b", s, D(u), *STAMP) for p, s, u in rows], schema)
    )


def test_money_columns(spark):
    tx = sales(
        spark,
        [
            ("loss", "s1", "p1", 2, D("4.00"), D("0.00")),
            ("even", "s1", "p1", 2, D("5.00"), D("0.00")),
            ("discounted", "s1", "p1", 1, D("20.00"), D("0.10")),
            ("full", "s1", "p1", -1, D("20.00"), D("0.00")),
            ("unknown", "s1", "p9", 1, D("20.00"), D("0.00")),
            ("no discount", "s1", "p1", 2, D("5.00"), None),
            ("no price", "s1", "p1", 2, None, D("0.10")),
        ],
    )
    out = enrich.transactions_enriched(tx, products(spark, [("p1", "s", "5.00")]))
    got = {
        r.transaction_id: (
            r.net_revenue, r.gross_revenue, r.total_expenses, r.discount_amount, r.net_profit_loss,
            r.profit_margin_pct, r.financial_status,
        )
        for r in out.collect()
    }

    def row(*amounts, status):
        return (*[None if a is None else D(a) for a in amounts], status)

    assert got == {
        "loss": row("8.00", "8.00", "10.00", "0.00", "-2.00", "-25.00", status="Loss"),
        "even": row("10.00", "10.00", "10.00", "0.00", "0.00", "0.00", status="Breakeven"),
        "discounted": row("18.00", "20.00", "5.00", "2.00", "13.00", "65.00", status="Profit (Discounted)"),
        "full": row("20.00", "20.00", "5.00", "0.00", "15.00", "75.00", status="Full Profit (No Discount)"),
        "unknown": row(
            "20.00", "20.00", None, "0.00", None, None, status="Full Profit (No Discount)"
        ),
        "no discount": row("0.00", "10.00", "10.00", "10.00", "-10.00", "0.00", status="Loss"),
        "no price": row("0.00", "0.00", "10.00", "0.00", "-10.00", "0.00", status="Loss"),
    }


def test_percent_style_discount_fails(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        df = spark.createDataFrame([("15",)], "d string").select(F.col("d").cast("decimal(3,2)"))
        df.collect()


def test_copies_collapse_in_staging(spark):
    row = ("t", "s", "p", 1, D("1.00"), D("0.00"))
    assert sales(spark, [row, row, (" t", "S ", "P", -1, D("-1.00"), D("0.00"))]).count() == 1


def stores(spark, rows):
    schema = (
        "store_id string, store_name string, city string, state string, region string, "
        "store_open_date string, sheets_extraction_date string, origin string, "
        "ingestion_date timestamp_ntz"
    )
    full = [(s, "n", c, st, r, "2020-01-01", e, "sheets", LOAD) for s, c, st, r, e in rows]
    return staging.stg_stores(spark.createDataFrame(full, schema))


def test_regional_sales_fan_out_with_repeated_stores(spark):
    """A store extracted twice doubles its sales, as a plain join would."""
    first, second = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
    tx = sales(spark, [("a", "s1", "p", 2, D("5.00"), D("0.00")), ("b", "s1", "p", 1, D("1.00"), D("0.50")),
                       ("c", "s2", "p", 1, D("3.00"), D("0.00")), ("d", "s3", "p", 1, D("3.00"), D("0.00"))])
    st = stores(spark, [("s1", "c", "x", "N", first), ("s1", "c", "x", "N", second), ("s2", "c", "x", "S", first)])
    got = {tuple(r) for r in marts.fct_regional_sales(tx, st).collect()}
    assert got == {("N", 6, D("21.00")), ("S", 1, D("3.00"))}


def test_warehouse_efficiency(spark):
    schema = (
        "shipment_id string, warehouse_id string, store_id string, product_id string, "
        "quantity_shipped bigint, shipment_date string, expected_delivery_date string, "
        f"actual_delivery_date string, carrier string, {S3}"
    )
    rows = [(f"{i}", "w", "s1", "p", 1, "2024-01-01", "2024-01-02", f"2024-01-0{1 + i}", None, *STAMP)
            for i in range(4)]
    shipments = staging.stg_shipments(spark.createDataFrame(rows, schema))
    house = staging.stg_warehouses(
        spark.createDataFrame([("w", "c", "x", *STAMP)], f"warehouse_id string, city string, state string, {S3}")
    )
    lanes = enrich.lane_efficiency(shipments, stores(spark, [("s1", "c", "y", "N", "2024-01-01 00:00:00")]), house)
    row = marts.fct_warehouse_efficiency(lanes).first()
    assert (row.total_shipments_processed, row.avg_transit_days, row.total_internal_delays) == (4, 1.5, 2)
    assert (row.warehouse_error_rate_pct, row.efficiency_rating) == (D("50.00"), "Bottleneck Detected")
    assert {r.carrier for r in shipments.collect()} == {"UNKNOWN"}


def test_missing_dates_take_the_given_day(spark):
    schema = "warehouse_id string, product_id string, quantity_available string, reorder_threshold string, "
    df = spark.createDataFrame([(None, None, "2.5", None, None, *STAMP)], schema + f"snapshot_date string, {S3}")
    row = staging.stg_inventory(df, date(2024, 5, 6)).first()
    assert row[:5] == ("WH-XXX", "PROD-XXXX", 3, 0, date(2024, 5, 6))


def test_top_stockouts_breaks_ties_by_key(spark):
    rows = [(f"p{i % 12:02d}", "n", "w", "Stock-Out") for i in range(24)] + [("p11", "n", "w", "Stock-Out")]
    rows += [("p00", "n", "w", "Healthy")] * 9
    df = spark.createDataFrame(rows, "product_id string, product_name string, warehouse_id string, stock_status string")
    got = [(r.product_id, r.stockout_events) for r in marts.top_stockouts(df, 3).collect()]
    assert got == [("p11", 3), ("p00", 2), ("p01", 2)]
