"""Upsert, insert-only merge and high-water marks, against plain Python where rows are random."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockyard.operators.incremental import (
    high_water_mark,
    latest_by_key,
    new_rows,
    newer_than,
    upsert,
)
from stockyard.operators.joins import possible_matches

SCHEMA = "k string, v bigint, ingestion_date timestamp_ntz"
DAY = datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(k, v, DAY + timedelta(days=d)) for k, v, d in rows], SCHEMA)


def content(df):
    return sorted(((r.k, r.v, (r.ingestion_date - DAY).days) for r in df.collect()), key=repr)


def test_mark_and_filter(spark):
    df = frame(spark, [("a", 1, 1), ("b", 2, 3)])
    assert high_water_mark(df) == DAY + timedelta(days=3)
    assert high_water_mark(df.limit(0)) is None
    assert content(newer_than(df, DAY + timedelta(days=1))) == [("b", 2, 3)]
    assert newer_than(df, None) is df


def test_latest_by_key_is_a_total_order(spark):
    df = frame(spark, [("a", 1, 1), ("a", 5, 2), ("a", 7, 2), ("a", None, 2), ("b", None, 1)])
    assert content(latest_by_key(df, ["k"], ["ingestion_date"])) == [("a", 7, 2), ("b", None, 1)]


def test_repeated_keys_can_be_refused(spark):
    df = frame(spark, [("a", 1, 1), ("a", 5, 2)])
    with pytest.raises(Exception, match="repeated key"):
        latest_by_key(df, ["k"], ["ingestion_date"], "error").collect()
    assert latest_by_key(df.limit(1), ["k"], ["ingestion_date"], "error").count() == 1


def test_upsert_replaces_adds_and_keeps(spark):
    target = frame(spark, [("a", 1, 1), ("b", 2, 1), (None, 3, 1)])
    batch = frame(spark, [("a", 9, 2), ("a", 8, 1), ("c", 4, 2), (None, 5, 2), (None, 5, 2)])
    merged = content(upsert(target, batch, ["k"], ["ingestion_date"]))
    assert merged == sorted(
        [("a", 9, 2), ("b", 2, 1), ("c", 4, 2), (None, 3, 1), (None, 5, 2), (None, 5, 2)], key=repr
    )


rows = st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 5)), max_size=12)
few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@few
@given(rows, rows)
def test_upsert_twice_is_upsert_once(spark, first, second):
    target = latest_by_key(frame(spark, first), ["k"], ["ingestion_date"])
    batch = frame(spark, second)
    once = upsert(target, batch, ["k"], ["ingestion_date"])
    assert content(once) == content(upsert(once, batch, ["k"], ["ingestion_date"]))
    expected = {k: (k, v, d) for d, v, k in sorted((d, v, k) for k, v, d in first)}
    expected |= {k: (k, v, d) for d, v, k in sorted((d, v, k) for k, v, d in second)}
    assert content(once) == sorted(expected.values(), key=repr)


@few
@given(rows)
def test_slices_give_the_full_load(spark, given_rows):
    """Loading day by day ends where one load ends, when newer rows carry newer days."""
    source = frame(spark, given_rows)
    target = source.limit(0)
    for day in range(6):
        seen = source.filter(source.ingestion_date <= DAY + timedelta(days=day))
        target = frame(spark, content(upsert(
            target, newer_than(seen, high_water_mark(target)), ["k"], ["ingestion_date"])))
    assert content(target) == content(latest_by_key(source, ["k"], ["ingestion_date"]))


NULLABLE = "a string, b bigint"


def pairs(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_replayed_rows_with_nulls(spark):
    batch = spark.createDataFrame([("x", None), ("x", None), ("y", 1), ("y", 1)], NULLABLE)
    target = spark.createDataFrame([("x", None), ("y", 1)], NULLABLE)
    assert pairs(new_rows(target, batch)) == []
    assert pairs(new_rows(target.limit(0), batch)) == [("x", None), ("y", 1)]
    assert pairs(new_rows(target, batch, null_safe=False)) == [("x", None)]


def test_plain_equality_adds_null_rows_once_per_file(spark):
    rows = [("x", None, "f1"), ("x", None, "f1"), ("x", None, "f2"), ("y", 1, "f1"), ("y", 1, "f2")]
    batch = spark.createDataFrame(rows, NULLABLE + ", file string")
    target = batch.drop("file").limit(0)
    assert pairs(new_rows(target, batch, False, "file")) == [("x", None), ("x", None), ("y", 1)]
    assert pairs(new_rows(target, batch, True, "file")) == [("x", None), ("y", 1)]


@few
@given(
    st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from([1, 2, None])), max_size=8),
    st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.sampled_from([1, 2, None])), max_size=8),
)
def test_pruning_the_target_changes_nothing(spark, held, given_rows):
    target, batch = spark.createDataFrame(held, NULLABLE), spark.createDataFrame(given_rows, NULLABLE)
    expected = sorted(set(given_rows) - set(held), key=repr)
    assert pairs(new_rows(target, batch)) == expected
    assert pairs(new_rows(target, batch, prune_on="b")) == expected


def test_target_rows_that_cannot_match_are_not_shuffled(spark):
    """All equal rows pass the filter, NULLs too, hardly any other does, and the filter is broadcast."""
    columns = "a long, b string, c double"
    target = spark.range(20_000).selectExpr("id AS a", "IF(id % 5 = 0, NULL, concat('x', id)) AS b", "IF(id % 7 = 0, NULL, id / 2) AS c")
    batch = target.filter("a % 100 = 3 OR a % 500 = 35").unionByName(spark.createDataFrame([(None, None, None), (1, "y", 0.5)], columns))
    names = ["a", "b", "c"]
    near = possible_matches(target, batch, names)
    equal = target.intersect(batch).count()
    assert equal == 240 and near.intersect(batch).count() == equal
    assert near.count() < equal + 40
    # With few words the filter fills up: more rows pass, none is lost.
    assert possible_matches(target, batch, names, words=64).intersect(batch).count() == equal
    fresh = new_rows(target, batch)
    assert {tuple(r) for r in fresh.collect()} == {(None, None, None), (1, "y", 0.5)}
    plan = fresh._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan
    other = target.withColumn("a", F.col("a").cast("int"))
    assert possible_matches(other, batch, names).count() == 20_000
