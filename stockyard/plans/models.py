"""The tables of each layer: what they read, how they are built and kept."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from stockyard.functions.cleaning import MISSING_TEXT
from stockyard.operators import enrich, marts, staging
from stockyard.operators.joins import dealt, dealt_narrow, is_small, sized
from stockyard.operators.quality import stand_in


@dataclass(frozen=True)
class Model:
    """A table of a layer. `build` takes the inputs and then the lookups, in order.

    `kept` says how it is materialised: view, table, or incremental (upserted by `keys` with the
    rows of the first input that are newer than the table's high-water mark). A model `by_lookup` aggregates by the
    key of its input's lookup, so that it needs no shuffle after a join by that key alone. `grouped` names columns among
    those that a model groups its input by, when it counts different values too.
    """

    name: str
    layer: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    kept: str = "view"
    keys: tuple[str, ...] = ()
    lookups: tuple[str, ...] = ()
    by_lookup: bool = False
    grouped: tuple[str, ...] = ()

    @property
    def unknown(self) -> dict[str, str]:
        """The event ids among the keys, with what stands for an unknown one: such a row has no key."""
        return {k: MISSING_TEXT for k in self.keys if k in ("transaction_id", "shipment_id")}


def _staging(name: str, kept: str = "view", keys: tuple[str, ...] = ()) -> Model:
    build = getattr(staging, f"stg_{name}")
    return Model(f"stg_{name}", "staging", (f"raw_{name}",), build, kept, keys)


INVENTORY_KEYS = (
    "warehouse_id",
    "product_id",
    "snapshot_date",
    "quantity_available",
    "ingestion_date",
    "reorder_threshold",
)

MODELS = {
    m.name: m
    for m in (
        _staging("warehouses"),
        _staging("suppliers"),
        _staging("products"),
        _staging("stores"),
        _staging("inventory", "incremental", INVENTORY_KEYS),
        _staging("shipments", "incremental", ("shipment_id",)),
        _staging("transactions", "incremental", ("transaction_id",)),
        Model(
            "int_inventory_health",
            "intermediate",
            ("stg_inventory",),
            enrich.inventory_health,
            "incremental",
            ("warehouse_id", "product_id"),
            ("stg_products",),
        ),
        Model(
            "int_shipments_performance",
            "intermediate",
            ("stg_shipments",),
            enrich.shipment_performance,
            "incremental",
            ("shipment_id", "warehouse_id"),
            ("stg_products", "stg_stores"),
        ),
        Model(
            "int_supplier_products",
            "intermediate",
            ("stg_products",),
            enrich.supplier_products,
            lookups=("stg_suppliers",),
        ),
        Model(
            "int_transactions_enriched",
            "intermediate",
            ("stg_transactions",),
            enrich.transactions_enriched,
            "incremental",
            ("transaction_id", "product_id", "store_id"),
            ("stg_products",),
        ),
        Model(
            "int_warehouse_to_store_efficiency",
            "intermediate",
            ("stg_shipments",),
            enrich.lane_efficiency,
            "incremental",
            ("warehouse_id", "store_id", "shipment_id"),
            ("stg_stores", "stg_warehouses"),
        ),
        Model("dim_products", "marts", ("stg_products",), marts.dim_products, "table"),
        Model("dim_stores", "marts", ("stg_stores",), marts.dim_stores, "table"),
        Model("dim_suppliers", "marts", ("stg_suppliers",), marts.dim_suppliers, "table"),
        Model("dim_warehouses", "marts", ("stg_warehouses",), marts.dim_warehouses, "table"),
        Model(
            "fct_transactions",
            "marts",
            ("int_transactions_enriched",),
            marts.fct_transactions,
            "table",
            by_lookup=True,
            grouped=("product_id", "store_id"),
        ),
        Model(
            "fct_regional_sales",
            "marts",
            ("stg_transactions",),
            marts.fct_regional_sales,
            "table",
            lookups=("stg_stores",),
        ),
        Model("fct_inventory", "marts", ("int_inventory_health",), marts.fct_inventory, "table"),
        Model(
            "fct_warehouse_efficiency",
            "marts",
            ("int_warehouse_to_store_efficiency",),
            marts.fct_warehouse_efficiency,
            "table",
        ),
    )
}

# The key by which facts find a lookup's rows.
LOOKUP_KEYS = {"stg_products": "product_id", "stg_stores": "store_id", "stg_warehouses": "warehouse_id"}


@dataclass(frozen=True)
class Needed:
    """What the checks of the intermediate tables need of a staged fact: the columns `kept` that its readers join or
    compute by, and those `handed_on` untouched to checks of NULLs and white space. All readers join `lookup`."""

    lookup: str
    kept: tuple[str, ...]
    handed_on: tuple[str, ...]


NEEDED = {
    "stg_shipments": Needed(
        "stg_stores",
        (
            "store_id", "product_id", "warehouse_id", "quantity_shipped", "shipment_date",
            "expected_delivery_date", "actual_delivery_date",
        ),
        ("shipment_id", "carrier"),
    ),
    "stg_transactions": Needed(
        "stg_products",
        ("product_id", "quantity_sold", "unit_price", "discount_pct", "net_revenue"),
        ("transaction_id", "store_id"),
    ),
}
# Text that a single reader hands on likewise, by the table that it comes from.
HANDED_ON = {
    "int_shipments_performance": {
        "stg_shipments": ("warehouse_id",),
        "stg_stores": ("store_name", "region", "city"),
        "stg_products": ("product_name", "category"),
    },
    "int_transactions_enriched": {"stg_products": ("product_name", "category", "brand", "supplier_id")},
}


class Views:
    """All models as lazy DataFrames over a supply of raw tables, each built once.

    With `checked` intermediate tables are for their checks only: text that checks of NULLs and white space
    alone look at is cut to what these tell apart, before rows are shuffled for lookups beyond the broadcast bound.
    """

    def __init__(self, raw: Callable[[str], DataFrame], as_of=None, checked: bool = False):
        self._raw, self._as_of, self._checked = raw, as_of, checked
        self._built: dict[str, DataFrame] = {}
        self._lookups: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._make(name)
        return self._built[name]

    def lookup(self, name: str) -> DataFrame:
        """A staging model as the lookup side of joins, its size measured once on the raw rows."""
        if name not in self._lookups:
            self._lookups[name] = sized(self[name], self[MODELS[name].inputs[0]])
        return self._lookups[name]

    def _short(self, rows: DataFrame, name: str, reader: Model) -> DataFrame:
        """A table's rows as far as a reader's checks can tell them apart."""
        told = HANDED_ON.get(reader.name, {}).get(name) if self._checked else None
        return rows.withColumns({c: stand_in(c) for c in told}) if told else rows

    def small(self, lookup: str) -> bool:
        """Whether a staging model is within the bounds of a broadcast."""
        return is_small(self[MODELS[lookup].inputs[0]])

    def _input(self, name: str, reader: Model) -> DataFrame:
        """A table as the input of a model. Where facts meet a lookup beyond the broadcast bound, copies are removed
        where the join needs the rows, so that they are shuffled once for both."""
        model = MODELS[name]
        if reader.by_lookup:
            whole = f"{name} by its lookup"
            if whole not in self._built:
                self._built[whole] = model.build(*[self[i] for i in model.inputs], *map(self.lookup, model.lookups))
            return self._built[whole]
        if reader.layer != "intermediate" or model.kept != "incremental":
            return self[name]
        need = NEEDED.get(name) if self._checked else None
        if need and not self.small(need.lookup):
            rows = f"{name} for checks"
            if rows not in self._built:
                found = model.build(self[model.inputs[0]], self._as_of, distinct=False)
                short = {c: stand_in(c) for c in need.handed_on}
                self._built[rows] = dealt_narrow(found, LOOKUP_KEYS[need.lookup], need.kept, short)
            return self._built[rows]
        if self.small(reader.lookups[0]):
            return self[name]
        rows = f"{name} for {reader.lookups[0]}"
        if rows not in self._built:
            found = model.build(self[model.inputs[0]], self._as_of, distinct=False)
            self._built[rows] = dealt(found, LOOKUP_KEYS[reader.lookups[0]])
        return self._built[rows]

    def _make(self, name: str) -> DataFrame:
        if name.startswith("raw_"):
            return self._raw(name.removeprefix("raw_"))
        model = MODELS[name]
        if model.layer == "staging":
            return model.build(*[self[i] for i in model.inputs], self._as_of)
        lookups = [self._short(self.lookup(i), i, model) for i in model.lookups]
        return model.build(*[self._short(self._input(i, model), i, model) for i in model.inputs], *lookups)

    def layer(self, layer: str) -> dict[str, DataFrame]:
        return {m.name: self[m.name] for m in MODELS.values() if m.layer == layer}
