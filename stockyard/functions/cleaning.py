"""Column cleaning expressions shared by the staging tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The placeholder each missing key receives.
MISSING_WAREHOUSE = "WH-XXX"
MISSING_PRODUCT = "PROD-XXXX"
MISSING_SUPPLIER = "SUP-XXX"
MISSING_STORE = "STORE-XXXX"
MISSING_TEXT = "UNKNOWN"

# Store opening dates, first matching pattern wins (03/04/2020 is 3 April).
STORE_DATE_FORMATS = ("dd/MM/yyyy", "MM/dd/yyyy", "yyyy-MM-dd")

MONEY = "decimal(10,2)"


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _day(as_of: Column | date | str | None) -> Column:
    """The day that stands in for a missing date; today unless the caller fixes it."""
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def clean_string(col: Column | str, default: str = MISSING_TEXT) -> Column:
    """Text with NULL replaced and outer spaces (not tabs) removed; empty text stays empty."""
    return F.trim(F.coalesce(_col(col).cast("string"), F.lit(default)))


def clean_id(col: Column | str, default: str = MISSING_TEXT) -> Column:
    """A cleaned string in upper case."""
    return F.upper(clean_string(col, default))


def clean_number(
    col: Column | str, default: int = 0, kind: T.DataType | None = None
) -> Column:
    """Whole number, rounded half away from zero, without its sign.

    `kind` is the column's type if known: whole numbers need no rounding and stay off decimals.
    """
    value = _col(col)
    if not isinstance(kind, T.IntegralType):
        value = value.cast("decimal(38,0)")
    return F.coalesce(F.abs(value.cast("bigint")), F.lit(default).cast("bigint"))


def clean_decimal(col: Column | str, default: str | int = 0) -> Column:
    """Amount at two decimals without its sign."""
    return F.coalesce(F.abs(_col(col).cast(MONEY)), F.lit(default).cast(MONEY))


def date_or(col: Column | str, as_of: Column | date | str | None = None) -> Column:
    return F.coalesce(_col(col).cast("date"), _day(as_of))


def parse_date_any(
    col: Column | str,
    formats: tuple[str, ...] = STORE_DATE_FORMATS,
    as_of: Column | date | str | None = None,
) -> Column:
    """First pattern that fits the text, else `as_of`."""
    attempts = [F.try_to_date(_col(col), pattern) for pattern in formats]
    return F.coalesce(*attempts, _day(as_of))


def from_micros(col: Column | str) -> Column:
    """Microseconds since the epoch to an instant."""
    return F.timestamp_micros(_col(col).cast("bigint"))


def lineage(extraction_column: str) -> list[Column]:
    """Extraction time, origin and load stamp, carried unchanged through staging."""
    return [
        F.col(extraction_column).cast("timestamp_ntz").alias(extraction_column),
        F.trim(F.col("origin").cast("string")).alias("origin"),
        F.col("ingestion_date"),
    ]
