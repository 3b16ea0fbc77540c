"""Business rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockyard.functions.cleaning import MONEY

# The labels the rules hand out.
STOCK_STATUSES = ("Stock-Out", "Below Reorder Threshold", "Healthy", "Sufficient")
DELIVERY_STATUSES = ("Early", "On time", "Late")
FINANCIAL_STATUSES = ("Loss", "Breakeven", "Profit (Discounted)", "Full Profit (No Discount)")
DISTANCES = ("Local (Same City)", "Regional (Same State)", "Long-Haul (Inter-State)")
ROUTE_STATUSES = ("High Delay Risk", "Warehouse Delay", "Good Route")
EFFICIENCY_RATINGS = ("High Efficiency", "Standard", "Bottleneck Detected")


def net_revenue(quantity: Column, unit_price: Column, discount: Column) -> Column:
    """Discounted amount; a missing discount makes it 0.00."""
    amount = quantity * unit_price * (F.lit(1) - discount)
    return F.coalesce(amount.cast(MONEY), F.lit(0).cast(MONEY))


def stock_ratio(quantity: Column, threshold: Column, on_zero: str = "error") -> Column:
    """Stock over reorder threshold at two decimals.

    A zero threshold fails the query (`on_zero="error"`) or gives NULL (`on_zero="null"`).
    """
    if on_zero not in ("error", "null"):
        raise ValueError(f"on_zero must be 'error' or 'null', not {on_zero!r}")
    divisor = threshold.cast("decimal(18,0)")
    if on_zero == "null":
        divisor = F.nullif(divisor, F.lit(0).cast("decimal(18,0)"))
    return (quantity.cast("decimal(18,0)") / divisor).cast(MONEY)


def stock_status(quantity: Column, ratio: Column) -> Column:
    """Judged on the rounded ratio; without a ratio the stock counts as sufficient."""
    out, below, healthy, sufficient = STOCK_STATUSES
    return (
        F.when(quantity == 0, out)
        .when(ratio < 1, below)
        .when(ratio.between(1, 3), healthy)
        .otherwise(sufficient)
    )


def delivery_status(expected: Column, actual: Column) -> Column:
    early, on_time, late = DELIVERY_STATUSES
    return F.when(actual < expected, early).when(actual > expected, late).otherwise(on_time)


def profit_margin(net: Column, expenses: Column, gross: Column) -> Column:
    """Profit in percent of gross revenue; 0 where nothing was earned."""
    share = (net - expenses) / F.nullif(gross, F.lit(0).cast(MONEY))
    return F.when(net == 0, F.lit(0).cast(MONEY)).otherwise((share * 100).cast(MONEY))


def financial_status(net: Column, expenses: Column, gross: Column) -> Column:
    """A sale whose product is unknown has no expenses and falls through to full profit."""
    loss, even, discounted, full = FINANCIAL_STATUSES
    return (
        F.when(net < expenses, loss)
        .when(net == expenses, even)
        .when((net > expenses) & (net < gross), discounted)
        .otherwise(full)
    )


def shipping_distance(
    store_city: Column, warehouse_city: Column, store_state: Column, warehouse_state: Column
) -> Column:
    local, regional, long_haul = DISTANCES
    return (
        F.when(store_city == warehouse_city, local)
        .when(store_state == warehouse_state, regional)
        .otherwise(long_haul)
    )


def route_performance(distance: Column, transit_days: Column) -> Column:
    local, _, long_haul = DISTANCES
    risk, delay, good = ROUTE_STATUSES
    return (
        F.when((distance == long_haul) & (transit_days > 3), risk)
        .when((distance == local) & (transit_days > 1), delay)
        .otherwise(good)
    )


def error_rate_pct(delays: Column, shipments: Column) -> Column:
    whole = "decimal(18,0)"
    divisor = F.nullif(shipments, F.lit(0)).cast(whole)
    return (delays.cast(whole) * 100 / divisor).cast(MONEY)


def efficiency_rating(delays: Column, shipments: Column) -> Column:
    """Rated on the exact share of delays: below 5 %, 5 % to 15 % inclusive, above.

    Compared in whole numbers (share < 1/20 is 20 * delays < shipments), so the edges are exact.
    """
    high, standard, bottleneck = EFFICIENCY_RATINGS
    total = F.nullif(shipments, F.lit(0))
    scaled = delays * 20
    return (
        F.when(scaled < total, high)
        .when(scaled.between(total, total * 3), standard)
        .otherwise(bottleneck)
    )
