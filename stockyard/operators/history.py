"""Type-2 history of dimension tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to")


@dataclass(frozen=True)
class Snapshot:
    """What one history table keeps: its key, the columns whose change opens a version, the rest."""

    key: str
    checked: tuple[str, ...]
    carried: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.carried, *self.checked]


# Keys and checked columns of the four histories.
SNAPSHOTS = {
    "products": Snapshot(
        "product_id", ("category", "brand", "supplier_id", "unit_price"), ("product_name",)
    ),
    "stores": Snapshot("store_id", ("store_name", "city", "state", "region", "store_open_date")),
    "suppliers": Snapshot("supplier_id", ("supplier_name", "category", "country")),
    "warehouses": Snapshot("warehouse_id", ("city", "state")),
}


def _opened(columns: list[str], key: str, stamp: Column, side: str = "") -> list[Column]:
    """Columns of a version that starts at `stamp`."""
    return [
        *[F.col(side + c).alias(c) for c in columns],
        F.md5(F.concat_ws("|", F.col(side + key), stamp.cast("string"))).alias("scd_id"),
        stamp.alias("updated_at"),
        stamp.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    ]


def scd2(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    check_cols: list[str],
    now,
    close_missing: bool = True,
) -> DataFrame:
    """The history after taking in the current state, which holds one row per key.

    A change in a checked column (NULLs compare as equal) closes the open version at `now` and
    opens another; a new or returned key opens one; a missing key closes one unless
    `close_missing` is off. Unchanged keys keep their open row as it is. Closed versions pass by
    without a shuffle; the open ones meet the new state in one full outer join.
    """
    columns = current.columns
    stamp = F.lit(now).cast("timestamp_ntz")
    if history is None:
        return current.select(*_opened(columns, key, stamp))

    fields = [*columns, *VERSION_COLUMNS]
    closed = history.filter(F.col("valid_to").isNotNull()).select(*fields)
    before = history.filter(F.col("valid_to").isNull()).select(*fields).alias("old")
    matched = before.join(
        current.alias("new"), F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer"
    )
    had, has = F.col(f"old.{key}").isNotNull(), F.col(f"new.{key}").isNotNull()
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    ends = has & ~same if not close_missing else ~has | ~same

    kept = [F.col(f"old.{c}").alias(c) for c in fields if c != "valid_to"]
    ending = F.when(ends, stamp).alias("valid_to")
    old_version = F.when(had, F.struct(*kept, ending))
    new_version = F.when(
        has & (~had | ~same), F.struct(*_opened(columns, key, stamp, side="new."))
    )
    versions = F.array_compact(F.array(old_version, new_version))
    opened = matched.select(F.explode(versions).alias("version")).select("version.*")
    return closed.unionByName(opened.select(*fields))
