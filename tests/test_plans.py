"""What the physical plans must and must not hold when nothing is small enough to broadcast."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from guestbook import session
from guestbook.operators.dedupe import keep_one
from guestbook.operators.joins import full_outer, join_on, longest_prefix
from guestbook.operators.snapshots import latest_snapshot, of_day

SF_DIR = "/root/testdata/sf0.001"
THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setitem(session.SQL_SETTINGS, THRESHOLD, "-1")
    session.tune(spark)
    yield
    monkeypatch.undo()
    session.tune(spark)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [
    "identity_resolve", "fact_resolve", "address_book", "person_address", "left_chain", "full_outer_engagement",
    "person_feed", "campaigns", "consumer_actions", "quarantine_split", "whitespace_normalise", "schema_reconcile",
    "nested_items_explode", "carry_forward", "latest_snapshot", "snapshot_completeness", "computed_key_join",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_no_python_no_single_task(spark, no_broadcast, name):
    plan = plan_of(entry.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "SinglePartition", "Broadcast"):
        assert operator not in plan, f"{operator} in {name}"


def test_survivors_are_cut_before_the_shuffle(spark):
    plan = plan_of(keep_one(spark.range(9).select((F.col("id") % 3).alias("k"), "id"), ["k"]))
    final, partial = [m.start() for m in re.finditer("WindowGroupLimit", plan)]
    assert final < plan.index("Exchange") < partial


def test_identity_needs_one_shuffle_past_its_inputs(spark):
    plan = plan_of(entry.queries()["identity_resolve"](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == 1, "keys are computed, not joined on"
    assert "SortMergeJoin" not in plan


def test_full_outer_is_two_joins_spark_can_split(spark, no_broadcast):
    a, b = spark.range(9).toDF("x"), spark.range(9).toDF("y")
    plan = plan_of(full_outer(a, b, [("x", "y")]))
    assert "FullOuter" not in plan and "LeftOuter" in plan and "LeftAnti" in plan


def test_null_safe_keys_hash(spark, no_broadcast):
    a = spark.range(9).select(F.col("id").cast("string").alias("k"))
    assert "SortMergeJoin" in plan_of(join_on(a, a.withColumnRenamed("k", "r"), null_safe=[("k", "r")]))


def test_chain_on_one_key_shares_the_shuffle(spark, no_broadcast):
    root = spark.range(9).toDF("id")
    view = root
    for i in range(3):
        step = spark.range(9).toDF("_id").withColumn(f"v{i}", F.lit(i))
        when = F.col(f"v{i - 1}").isNotNull() if i else None
        view = join_on(view, step.repartition(3), equal=[("id", "_id")], how="left", when=when)
    plan = plan_of(view)
    assert plan.count("hashpartitioning(id#") == 1, "the left side is shuffled once"


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(9).select("id", F.lit("x").alias("wide"), F.to_date(F.lit("2024-01-01")).alias("snapshot_date"))
    df.write.partitionBy("snapshot_date").parquet(path)
    plan = plan_of(of_day(spark.read.parquet(path), "2024-01-01").where("id > 3").select("id"))
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert "GreaterThan(id,3)" in plan and "wide" not in plan


def test_latest_snapshot_has_no_window(spark):
    df = spark.range(9).select("id", (F.col("id") % 2).alias("k"))
    assert "Window" not in plan_of(latest_snapshot(df, ["k"], "id"))


def test_longest_prefix_shuffles_the_rows_twice(spark, no_broadcast):
    """Once for their distinct leads, of which every task sends its own, and once to meet what the leads have found."""
    prefixes = spark.createDataFrame([("1", "a"), ("123456789", "b")], "prefix string, country string")
    numbers = spark.range(9).select(F.col("id").cast("string").alias("n"), F.lit("x").alias("wide"))
    plan = plan_of(longest_prefix(numbers, "n", prefixes, "prefix", ["country"]))
    assert plan.count("Range (0, 9") == 2
    assert plan.count("Join") == 2, "one for the leads and one for the rows, whatever the lengths"


def test_conformed_views_are_joined_once(spark):
    """What the six subjects read of views that join tables is staged."""
    from guestbook.plans.datamart import conform_all
    from tests.sources import frames

    joins = [plan_of(df).count("Join") for df in vars(conform_all(frames(spark))).values()]
    lazy = [plan_of(df).count("Join") for df in vars(conform_all(frames(spark), staged=False)).values()]
    assert sum(joins) < sum(lazy) / 2


def test_source_of_a_joined_view_reads_one_table(spark, no_broadcast):
    from guestbook.plans.origins import source_rows

    left, right = spark.range(9).toDF("a"), spark.range(9).toDF("b")
    view = join_on(left, right, equal=[("a", "b")], how="left").withColumn("source_system", F.lit("x"))
    assert "Join" not in plan_of(source_rows(view))
