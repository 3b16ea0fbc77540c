"""Each check on failing and passing rows, the suite and the gate."""

from collections import Counter
from datetime import date

import pytest

from stockyard.operators import quality as q
from stockyard.plans.checks import LAYERS

C = q.Check


@pytest.fixture
def table(spark):
    rows = [("a", " a", -1, "x", "2024-01-01"), ("a", "b", 0, None, "2024-02-30"), (None, None, None, "y", None)]
    return spark.createDataFrame(rows, "id string, name string, n bigint, kind string, day string")


def test_single_checks(spark, table):
    assert q.not_null(table, "id").count() == 1
    assert [tuple(r) for r in q.unique(table, "id").collect()] == [("a", 2)]
    assert [r.kind for r in q.accepted_values(table, "kind", ["x"]).collect()] == ["y"]
    assert [r.name for r in q.no_whitespace(table, "name").collect()] == [" a"]
    assert q.no_whitespace(table, "n").count() == 0
    assert [r.n for r in q.positive_value(table, "n").collect()] == [-1]
    assert [r.day for r in q.is_date_type(table, "day").collect()] == ["2024-02-30"]
    parents = spark.createDataFrame([("b",), (None,)], "key string")
    assert [tuple(r) for r in q.relationships(table, "id", parents, "key").collect()] == [("a", 2)]


def test_shipment_date_order(spark):
    day = [date(2024, 1, d) for d in range(1, 5)]
    rows = [(day[1], day[2], day[3]), (day[1], day[1], day[3]), (day[1], day[2], day[0])]
    df = spark.createDataFrame(rows, "shipment_date date, actual_delivery_date date, expected_delivery_date date")
    assert sorted(map(tuple, q.shipment_date_order(df).collect())) == sorted(rows[1:])


def test_suite_and_gate(spark, table):
    parents = {"p": spark.createDataFrame([("a",)], "key string"), "none": spark.createDataFrame([], "key string")}
    checks = [
        C("t", "id", "not_null"), C("t", "id", "unique"), C("t", "name", "no_whitespace"),
        C("t", "n", "positive_value"), C("t", "kind", "accepted_values", ("x", "y")),
        C("t", "day", "is_date_type"), C("t", "id", "relationships", parent=("p", "key")),
        C("t", "id", "relationships", parent=("none", "key")), C("t", "kind", "unique"),
    ]
    results = q.run_suite({"t": table}, checks, parents)
    got = Counter((r.column_name, r.check_name, r.failures) for r in results.collect())
    assert got == Counter(
        [
            ("id", "not_null", 1), ("id", "unique", 1), ("name", "no_whitespace", 1),
            ("n", "positive_value", 1), ("kind", "accepted_values", 0), ("day", "is_date_type", 1),
            ("id", "relationships", 0), ("id", "relationships", 2), ("kind", "unique", 0),
        ]
    )
    with pytest.raises(q.ChecksFailed) as failed:
        q.gate(results)
    assert len(failed.value.failures) == 6
    q.gate(results.filter("failures = 0"))


def test_checks_are_counted_in_compiled_code_and_without_a_join(spark, table):
    """Of whatever number: row checks are told by several numbers where one has too few bits."""
    checks = [C("t", "kind", "accepted_values", (f"v{k}",)) for k in range(2 * q.BITS)]
    checks += [C("t", "kind", "accepted_values", ("x",)), C("t", "id", "unique"), C("t", "id", "relationships", parent=("p", "id"))]
    parents = {"p": spark.createDataFrame([("b",), (None,), ("b",)], "id string")}
    results = q.run_checks(table, checks, parents)
    assert [r.failures for r in results.collect()] == [2] * 2 * q.BITS + [1, 1, 2]
    results = q.run_checks(table, [C("t", "id", "not_null"), *checks[-3:]], parents)
    plan = results._jdf.queryExecution().toString()
    assert "HashAggregate" in plan
    assert "lambda" not in plan and "Join" not in plan


def test_shuffles_of_a_suite_do_not_add_up(spark, table, shuffle_files, monkeypatch):
    """Tables are checked one after another, and each one's files are gone when it is done."""
    kept, checks, run = shuffle_files(), [C(t, "id", "unique") for t in "abc"], q.once
    left = []
    monkeypatch.setattr(q, "once", lambda df, purpose: (left.append(shuffle_files(gone=kept) - kept), run(df, purpose))[1])
    results = q.run_suite(dict.fromkeys("abc", table), checks, apart=True)
    assert [r.failures for r in results.collect()] == [1, 1, 1]
    assert left == [set()] * 3 and not shuffle_files(gone=kept) - kept
    assert q.run_suite(dict.fromkeys("abc", table), checks).collect() == results.collect() and len(left) == 3


def test_empty_table_passes(spark, table):
    checks = [C("t", "id", "unique"), C("t", "id", "relationships", parent=("p", "id")), C("t", "n", "not_null")]
    results = q.run_suite({"t": table.limit(0)}, checks, {"p": table})
    assert [r.failures for r in results.collect()] == [0, 0, 0]


def test_declared_checks():
    counted = {layer: Counter(c.kind for c in checks) for layer, checks in LAYERS.items()}
    assert {layer: sum(kinds.values()) for layer, kinds in counted.items()} == {
        "staging": 120, "intermediate": 107, "marts": 88,
    }
    assert counted["staging"]["relationships"] == 8
    assert counted["intermediate"]["accepted_values"] == 4
    assert counted["marts"]["unique"] == 5
