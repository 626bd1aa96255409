"""What the whole datamart leaves on disk while it runs, and that it is the same datamart."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from guestbook.functions.keys import natural_key
from guestbook.operators.conform import conform
from guestbook.plans import orders as sales, people as persons
from guestbook.schemas import ORDER_LINE, ORDER_PLACE
from guestbook.session import _DROP_SHUFFLES, stage_spare
from tests.conftest import rows
from workload.entities import _tally
from workload.recipes import LINES, lines
from workload.registry import Tables

DAY = dt.datetime(2001, 2, 3)
TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "R0")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N0", 0), (1, "N1", 0), (1, "N1 again", 0)]),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
        [(1, "Customer#1", 0, "A"), (2, "Customer#2", 1, "B"), (2, "Customer#2", 7, None), (None, "Customer#3", 0, "A")],
    ),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int", [(1, "S1", 0), (7, "S7", 1)]),
    "part": ("p_partkey bigint, p_name string, p_size int", [(1, "ring", 1), (1, "bolt", 2), (2, None, 3), (None, "lost", 4)]),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        [(1, 1, "F", 1.5, DAY, "5-LOW"), (2, 2, "O", 2.5, DAY, None), (2, 10, "O", 2.5, DAY, "1"), (3, 9, "P", None, None, "2"), (None, 1, "F", 3.0, DAY, "3")],
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, l_discount double",
        [(1, 1, 1.0, 2.0, 0.0), (1, 1, 1.0, 2.0, 0.0), (2, 2, 3.0, None, -0.0), (2, 5, 3.0, 4.0, 0.1), (2, None, 1.0, 1.0, 0.0), (None, 1, 9.0, 9.0, 0.0), (8, 1, 9.0, 9.0, 0.0)],
    ),
    "events": (
        "event_id bigint, user_id bigint, ts timestamp, event_type string, props string",
        [(1, 1, DAY, "signup", '{"k": 3}'), (2, 1, DAY, "click", '{"k": 3}'), (3, 4, DAY, "error", '{"k": 9}')],
    ),
}


@pytest.fixture
def folder(spark, tmp_path):
    for name, (schema, made) in TABLES.items():
        spark.createDataFrame(made, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def shuffles(spark):
    """Shuffle files on the disk."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in files.mkString("\n").split("\n") if "/shuffle_" in name}


def test_a_spare_stage_drops_its_shuffles(spark):
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    before, setting = shuffles(spark), spark.conf.get(_DROP_SHUFFLES)
    staged = stage_spare(df, "spare")
    assert not shuffles(spark) - before and spark.conf.get(_DROP_SHUFFLES) == setting
    assert rows(staged) == rows(df)


def test_the_datamart_keeps_the_shuffles_of_one_step(spark, folder):
    before = shuffles(spark)
    made = {r["table_name"]: (r["rows"], r["ids"]) for r in entry.queries()["datamart"](spark, folder).collect()}
    assert not shuffles(spark) - before
    want = {"addresses": 15, "consumers": 8, "consumer_events": 4, "orders": 3, "order_items": 8, "marketing_action_list": 3}
    assert len(made) == 13 and {n: made[n] for n in want} == {n: (k, k) for n, k in want.items()}


def test_lines_are_those_of_the_sql(spark, folder):
    t = Tables(spark, folder)
    want = t.sql(LINES)
    assert rows(lines(t)) == rows(conform(want, {c: c for c in want.columns}, ORDER_LINE))


def placed_lines(spark):
    """Orders of one person, of two, of nobody but with a known line, of nobody, and without facts."""
    given = "source_order_id string, source_system string, email string, name_first string, total double, product_name string, unit_price double, event_name string"
    made = [
        ("1", "s", "a@b", "A", 1.0, "x", 1.0, "e"), ("1", "s", "a@b", "A", 1.0, "x", 1.0, "e"), ("1", "s", "c@d", "C", 1.0, "y", -0.0, None),
        ("1", "s", "c@d", "C", 1.0, "y", 0.0, None), ("2", "s", None, "B", 2.0, "z", 3.0, "e"), ("2", "s", "b@b", "B", 2.0, "z", 4.0, None),
        ("3", "s", None, None, 1.0, "w", 1.0, None), ("4", "other", "a@b", "A", float("nan"), "v", 1.0, None), ("5", "s", "a@b", "A", float("nan"), "u", 1.0, None),
        (None, "s", "a@b", "A", 1.0, "t", 1.0, None), ("1", None, "a@b", "A", 1.0, "x", 1.0, "e"),
    ]
    names = [part.split()[0] for part in given.split(", ")]
    return conform(spark.createDataFrame(made, given), {n: n for n in names}, ORDER_LINE)


def book_and_sources(spark):
    book = spark.createDataFrame([], ", ".join(f"{c} string" for c in (*ORDER_PLACE, "id")))
    return book, spark.createDataFrame([(1, None, "s")], "id int, name string, platform string")


def test_items_of_sure_lines_need_no_lookup(spark):
    given = placed_lines(spark)
    book, sources = book_and_sources(spark)
    placed = sales.orders(given, sources, book).localCheckpoint()
    want = rows(sales.order_items(given, placed))
    assert rows(sales.order_items(given, placed, sales.surely_placed())) == want and len(want) == 6
    left = placed.limit(0)  # none of these lines is looked up
    assert {r["product_name"] for r in sales.order_items(given, left, sales.surely_placed()).collect()} == {"x", "y", "z"}


def test_orders_survive_by_their_least_person(spark):
    given = placed_lines(spark)
    book, sources = book_and_sources(spark)
    got = {r["source_order_id"]: r for r in sales.orders(given.where("source_system = 's'"), sources, book).collect()}
    ids = given.where("source_order_id = '1'").agg(F.min(persons.person_id())).first()[0]
    assert got["1"]["consumer_id"] == ids and set(got) == {"1", "2", "5"}
    key = spark.range(1).select(natural_key(F.lit("1"), F.lit("s"), F.lit(None))).first()[0]
    assert got["1"]["id"] == key


def test_order_places_take_the_least_id(spark):
    book = spark.createDataFrame(
        [("a", "b", "c", "d", "e", "2"), ("a", "b", "c", "d", "e", "1"), ("a", None, "c", "d", "e", "0")],
        ", ".join(f"{c} string" for c in (*ORDER_PLACE, "id")),
    )
    line = conform(
        spark.createDataFrame([("1", "s", "a@b", "a", "b", "c", "d", "e")], "source_order_id string, source_system string, email string, "
                              + ", ".join(f"shipping_{c} string" for c in ORDER_PLACE)),
        {n: n for n in ("source_order_id", "source_system", "email", *(f"shipping_{c}" for c in ORDER_PLACE))}, ORDER_LINE,
    )
    _, sources = book_and_sources(spark)
    for places in (book, sales.order_places(book)):
        found = sales.orders(line, sources, places).first()
        assert (found["address_shipping_id"], found["address_billing_id"]) == ("1", None)


def test_tally_counts_ids_of_any_form(spark):
    ids = ["0" * 32, "0" * 32, "A" * 32, "a" * 32, "12", None, "\0" * 16]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    assert rows(_tally("t", df)) == [("t", 7, 5)]
    assert rows(_tally("t", df.limit(0))) == []
