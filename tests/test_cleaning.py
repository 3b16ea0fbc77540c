"""Golden rows for the cleaning expressions."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockyard.functions import cleaning as c


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r.y for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_ids(spark):
    rows = ["  prod-1 ", None, "", "a b"]
    assert values(spark, c.clean_id("x", "PROD-XXXX"), rows) == ["PROD-1", "PROD-XXXX", "", "A B"]
    assert values(spark, c.clean_id("x", " none "), [None]) == ["NONE"]


def test_strings_lose_spaces_but_not_tabs(spark):
    assert values(spark, c.clean_string("x"), ["\ta ", None, " b"]) == ["\ta", "UNKNOWN", "b"]


def test_numbers_round_half_away_from_zero(spark):
    assert values(spark, c.clean_number("x"), ["-3", "1.5", "2.5", "-2.5", None]) == [3, 2, 3, 3, 0]
    whole = c.clean_number("x", kind=spark.range(1).schema["id"].dataType)
    assert values(spark, whole, [-3, 4, None], "bigint") == [3, 4, 0]


def test_decimals(spark):
    rows = ["-9.995", None, "1.004"]
    assert values(spark, c.clean_decimal("x"), rows) == [Decimal("10.00"), Decimal("0.00"), Decimal("1.00")]


def test_decimal_overflow_fails(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        values(spark, c.clean_decimal("x"), ["123456789.00"])


def test_dates(spark):
    rows = ["25/12/2020", "12/25/2020", "2020-12-25", "03/04/2020", "x", None]
    christmas, day = date(2020, 12, 25), date(2024, 1, 1)
    parsed = values(spark, c.parse_date_any("x", as_of=day), rows)
    assert parsed == [christmas, christmas, christmas, date(2020, 4, 3), day, day]
    assert values(spark, c.date_or("x", "2024-01-01"), ["2020-02-03", None]) == [date(2020, 2, 3), day]
    today = spark.range(1).select(F.current_date()).first()[0]
    assert values(spark, c.date_or("x"), [None]) == [today]


def test_micros(spark):
    text = c.from_micros("x").cast("string")
    assert values(spark, text, [1704067200123456], "bigint") == ["2024-01-01 00:00:00.123456"]


def test_lineage(spark):
    df = spark.createDataFrame(
        [("2024-01-02 03:04:05", " s3 ", datetime(2024, 1, 3))],
        "s3_extraction_date string, origin string, ingestion_date timestamp_ntz",
    )
    row = df.select(*c.lineage("s3_extraction_date")).first()
    assert tuple(row) == (datetime(2024, 1, 2, 3, 4, 5), "s3", datetime(2024, 1, 3))
