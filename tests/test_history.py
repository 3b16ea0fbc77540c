"""Type-2 history, against a plain Python account of open versions."""

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stockyard.operators.history import scd2

T1, T2, T3 = (datetime(2024, m, 1) for m in (1, 2, 3))
SCHEMA = "id string, name string, price bigint"


def state(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def step(spark, history, rows, now, **options):
    return scd2(history, state(spark, rows), "id", ["price"], now, **options)


def versions(df):
    return sorted(((r.id, r.name, r.price, r.valid_from, r.valid_to) for r in df.collect()), key=repr)


def test_every_kind_of_change(spark):
    first = step(spark, None, [("same", "n", 1), ("changed", "n", 1), ("filled", "n", None),
                               ("renamed", "n", 1), ("gone", "n", 1)], T1)
    assert all(v[3:] == (T1, None) for v in versions(first))
    second = step(spark, first, [("same", "n", 1), ("changed", "n", 2), ("filled", "n", 3),
                                 ("renamed", "other", 1), ("new", "n", 1)], T2)
    assert versions(second) == sorted(
        [
            ("same", "n", 1, T1, None),
            ("changed", "n", 1, T1, T2),
            ("changed", "n", 2, T2, None),
            ("filled", "n", None, T1, T2),
            ("filled", "n", 3, T2, None),
            ("renamed", "n", 1, T1, None),
            ("gone", "n", 1, T1, T2),
            ("new", "n", 1, T2, None),
        ],
        key=repr,
    )
    third = step(spark, second, [("gone", "n", 1)], T3, close_missing=False)
    assert ("gone", "n", 1, T1, T2) in versions(third)
    assert ("gone", "n", 1, T3, None) in versions(third)
    assert len(versions(third)) == len(versions(second)) + 1
    ids = [r.scd_id for r in third.collect()]
    assert len(set(ids)) == len(ids)


def test_replay_adds_nothing(spark):
    rows = [("a", "n", 1), ("b", None, None)]
    first = step(spark, None, rows, T1)
    assert versions(step(spark, first, rows, T2)) == versions(first)


states = st.dictionaries(st.sampled_from("abc"), st.sampled_from([1, 2, None]), max_size=3)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(states, states, states)
def test_against_plain_python(spark, one, two, three):
    expected, live, history = [], {}, None
    for now, given_state in ((T1, one), (T2, two), (T3, three)):
        history = step(spark, history, [(k, "n", p) for k, p in given_state.items()], now)
        for key in list(live):
            if key not in given_state or given_state[key] != live[key][0]:
                price, since = live.pop(key)
                expected.append((key, "n", price, since, now))
        for key, price in given_state.items():
            live.setdefault(key, (price, now))
    expected += [(key, "n", price, since, None) for key, (price, since) in live.items()]
    assert versions(history) == sorted(expected, key=repr)
