"""Operators for wide groups: distinct rows by fingerprint, bridges by place, number plans."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from guestbook.operators.dedupe import distinct_rows
from guestbook.operators.quality import phone_plan
from guestbook.plans.addresses import consumer_addresses, pairs_of, person_places, place_addresses, place_links
from guestbook.schemas import ADDRESS_FIELDS, PLACE
from tests.conftest import rows


@pytest.mark.parametrize("marks", [64, 1 << 24])
def test_distinct_rows(spark, marks):
    """With few marks single rows share those of repeated ones, and all is compared whole."""
    rng = random.Random(1)
    made = [(rng.randrange(40), rng.choice(["a", "b", None]), rng.choice([0.0, -0.0, float("nan"), None]), [1, None]) for _ in range(300)]
    df = spark.createDataFrame(made, "`a.b` int, s string, x double, l array<int>").withColumn("_own_word", F.lit(1))
    got, want = distinct_rows(df, marks), df.distinct()
    plain = [F.col(f"`{c}`") if c != "x" else (F.col("x") + 0.0).alias("x") for c in df.columns]  # one nought
    assert got.columns == df.columns
    assert sorted(map(repr, got.select(*plain).collect())) == sorted(map(repr, want.select(*plain).collect()))
    single = spark.range(50)
    assert distinct_rows(single).count() == 50 and distinct_rows(single.limit(0)).count() == 0


def test_single_rows_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select((F.col("id") % 990).alias("id"), F.repeat(F.lit("text"), 50).alias("text")).write.parquet(path)
    found = distinct_rows(spark.read.parquet(path))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    single = plan[: plan.index("HashAggregate")]
    assert "Exchange" not in single and "BroadcastHashJoin" in single
    moved = found._jdf.queryExecution().executedPlan()
    assert found.count() == 990 and "ENSURE_REQUIREMENTS" in moved.toString()
    # What repeats is all that a shuffle moves: ten rows and their ten copies.
    repeated = spark.read.parquet(path).groupBy("id").count().where("count > 1").count()
    assert repeated == 10


def test_places_bridge_what_pairs_would(spark):
    rng = random.Random(2)
    blank = dict.fromkeys(ADDRESS_FIELDS)

    def place():
        return rng.choice([{}, {"country": "US"}, {"country": "US", "city": "Cary"}, {"address_1": "1 Main", "country": "US"}])

    kind = ", ".join(f"{c} string" for c in ["id", *ADDRESS_FIELDS])
    people = spark.createDataFrame([{"id": f"p{i}", **blank, **place()} for i in range(40)], kind)
    book = spark.createDataFrame([{"id": f"a{i}", **blank, **place(), "latitude": str(i)} for i in range(30)], kind)
    living, lying = person_places(people), place_addresses(book)
    somewhere = [r for r in people.collect() if any(r[c] for c in PLACE)]
    assert living.count() == len(somewhere)
    want = {(p["id"], a["id"]) for p in somewhere for a in book.collect() if all(p[c] == a[c] for c in PLACE)}
    pairs = {(r["consumer_id"], r["address_id"]) for r in consumer_addresses(people, book).collect()}
    assert pairs == want
    links = place_links(living, lying).collect()
    assert sum(r["links"] for r in links) == len(want) and sum(r["people"] for r in links) == len(somewhere)
    wide = max(links, key=lambda r: r["links"])["place_id"]
    some = pairs_of(living, lying, place_links(living, lying).where(F.col("place_id") == wide))
    assert some.count() == max(r["links"] for r in links) and set(rows(some)) <= want
    none = place_links(living, lying.limit(0)).collect()
    assert {r["links"] for r in none} == {0}


def test_number_plan(spark):
    plan = [("1", 11, 11, "NA"), ("1242", 11, 11, "BS"), ("1242", 13, 14, "BS long"), ("12", 8, 9, "XX"), ("44", 12, 12, "GB")]
    rng = random.Random(3)
    numbers = ["+" + rng.choice(["1", "12", "124", "1242", "44", "9"]) + "5" * rng.randrange(0, 13) for _ in range(200)]
    numbers += ["1 242 555 5555", "+1 (242) 555-5555", "+", "", None, "+٣" + "5" * 10]

    def brute(n):
        if n is None:
            return None, None
        d = re.sub("[^0-9]", "", n) if n.startswith("+") else ""
        fit = [(len(p), c) for p, low, high, c in plan if d.startswith(p) and low <= len(d) <= high]
        return (max(fit)[1], "valid") if fit else (None, "invalid")

    df = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i int, phone string")
    table = spark.createDataFrame([(*p, "z") for p in plan], "prefix string, least int, most int, country string, zone string")
    got = {r["i"]: (r["country"], r["phone_check"]) for r in phone_plan(df, "phone", table).collect()}
    assert got == {i: brute(n) for i, n in enumerate(numbers)}
