"""Joins against brute force over every pair."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from guestbook.operators.joins import full_outer, join_on, left_chain, lookup, spread_join
from guestbook.operators.snapshots import (
    carry_forward,
    empty_like,
    latest_snapshot,
    missing_action,
    missing_snapshots,
    of_day,
    placeholder_row,
)
from tests.conftest import rows

KEY = st.sampled_from([None, "a", "b", "c"])
LEFT = st.lists(st.tuples(KEY, KEY, st.integers(0, 9)), max_size=12)
RIGHT = st.lists(st.tuples(KEY, KEY, st.integers(0, 9)), max_size=12)
TRIES = settings(
    max_examples=4,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def frames(spark, left, right):
    return (
        spark.createDataFrame(left, "k string, m string, v int"),
        spark.createDataFrame(right, "rk string, rm string, w int"),
    )


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@TRIES
@given(LEFT, RIGHT)
def test_mixed_keys(spark, left, right):
    a, b = frames(spark, left, right)
    got = bag(join_on(a, b, equal=[("k", "rk")], null_safe=[("m", "rm")]))
    assert got == Counter((*x, y[2]) for x in left for y in right if x[0] == y[0] is not None and x[1] == y[1])


@TRIES
@given(LEFT, RIGHT)
def test_full_outer(spark, left, right):
    a, b = frames(spark, left, right)
    want = Counter()
    for x in left:
        hits = [y for y in right if y[0] == x[0] is not None]
        want.update((*x, *y) for y in hits or [(None, None, None)])
    for y in right:
        if y[0] is None or all(x[0] != y[0] for x in left):
            want.update([(None, None, None, *y)])
    assert bag(full_outer(a, b, [("k", "rk")])) == want


@TRIES
@given(LEFT, RIGHT)
def test_spread_join_is_the_plain_join(spark, left, right):
    a, b = frames(spark, left, right)
    right_keyed = b.select(F.col("rk").alias("k"), "w")
    for how in ("inner", "left"):
        spread = spread_join(a, right_keyed, ["k"], hot=F.col("k") == "a", how=how, ways=4)
        assert bag(spread) == bag(join_on(a, right_keyed, equal=["k"], how=how))


def test_spread_join_refuses_other_kinds(spark):
    a, b = frames(spark, [], [])
    with pytest.raises(ValueError):
        spread_join(a, b, [("k", "rk")], hot=F.lit(True), how="full")


@TRIES
@given(LEFT, RIGHT)
def test_lookup_never_adds_rows(spark, left, right):
    a, b = frames(spark, left, right)

    def least(x, same):
        return min((y[2] for y in right if same(x, y)), default=None)

    plain = lookup(a, b, [("k", "rk"), ("m", "rm")], "w", "found")
    assert bag(plain) == Counter(
        (*x, least(x, lambda x, y: None not in x[:2] and x[:2] == y[:2])) for x in left
    )
    safe = lookup(a, b, [("k", "rk"), ("m", "rm")], "w", "found", null_safe=True)
    assert bag(safe) == Counter((*x, least(x, lambda x, y: x[:2] == y[:2])) for x in left)


def test_condition_on_the_left_row(spark):
    a = spark.createDataFrame([(1, True), (2, False), (3, None)], "k int, go boolean")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, w string")
    assert rows(join_on(a, b, equal=["k"], how="left", when=F.col("go"))) == [(1, True, "x"), (2, False, None), (3, None, None)]


def test_left_chain_carries_misses_on(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(1, 10)], "x int, y int")
    c = spark.createDataFrame([(10, "end")], "y int, z string")
    assert rows(left_chain(a, [(b, ["x"]), (c, ["y"])])) == [(1, 10, "end"), (2, None, None)]


def test_hot_key_result_is_whole(spark):
    """A third of the rows share one key."""
    facts = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    names = spark.range(9000).select(F.col("id").alias("k"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    joined = spread_join(facts, names, ["k"], hot=F.col("k") == 0)
    assert joined.count() == 9000
    assert joined.where("name = 'n0'").count() == 3000


SNAPSHOTS = [
    ("a", "2024-01-01", 1), ("a", "2024-01-02", 2), ("a", "2024-01-02", 3), ("b", "2024-01-01", 4), (None, "2024-01-01", 5),
]


def snapshots(spark):
    df = spark.createDataFrame(SNAPSHOTS, "t string, d string, v int")
    return df.select("t", F.to_date("d").alias("snapshot_date"), "v")


def test_latest_snapshot_keeps_ties(spark):
    got = latest_snapshot(snapshots(spark), ["t"], "snapshot_date").select("t", "v")
    assert rows(got) == sorted([("a", 2), ("a", 3), ("b", 4), (None, 5)], key=repr)


def test_carry_forward(spark):
    import datetime as dt

    got = carry_forward(snapshots(spark), ["t"], dt.date(2024, 1, 2))
    assert rows(got.where("t is not null")) == [("b", dt.date(2024, 1, 2), 4)]
    assert of_day(snapshots(spark), "2024-01-02").count() == 2


def test_missing_and_action(spark):
    expected = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "c")], "system string, t string")
    present = spark.createDataFrame([("s", "a"), ("s", "a")], "system string, t string")
    runs = spark.createDataFrame([("s", "b", "FAILED"), ("s", "b", "FAILED"), ("s", "c", "SUCCEEDED")], "system string, t string, state string")
    keys = ["system", "t"]
    missing = missing_snapshots(expected, present, keys)
    chosen = missing_action(missing, runs, keys, F.col("state") == "FAILED")
    assert rows(chosen) == [("s", "b", "report"), ("s", "c", "placeholder")]


def test_placeholder_and_empty(spark):
    df = snapshots(spark)
    assert placeholder_row(df).dtypes == df.dtypes and rows(placeholder_row(df)) == [(None, None, None)]
    assert empty_like(df).dtypes == df.dtypes and empty_like(df).isEmpty()
