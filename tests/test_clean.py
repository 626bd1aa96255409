from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from guestbook.operators import clean
from guestbook.operators.audit import counted, with_audit
from guestbook.operators.conform import conform, union_all
from guestbook.operators.dedupe import distinct_keyed, keep_one
from guestbook.operators.quality import (
    email_column,
    phone_columns,
    phone_zone,
    quarantined,
    split_quality,
    trusted,
)
from tests.conftest import rows


def test_null_record_fixture(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, col_a string")
    assert rows(clean.drop_null_records(df, ["id"])) == [(1, "a"), (3, "c")]


def test_audit_columns_come_last(spark):
    df = spark.createDataFrame([(1, "a")], "id long, col_a string")
    assert with_audit(df).columns == ["id", "col_a", "created_at", "updated_at"]


def test_audit_replaces_the_source_column(spark):
    df = spark.createDataFrame([(1, "old")], "id long, created_at string")
    out = with_audit(df)
    assert out.columns == ["id", "created_at", "updated_at"]
    assert dict(out.dtypes)["created_at"] == "timestamp"


def test_empty_and_sentinel(spark):
    df = spark.createDataFrame([(1, "null", ""), (None, None, None)], "n int, a string, b string")
    assert rows(clean.drop_empty_rows(df)) == [(1, "null", "")]
    assert rows(clean.sentinel_to_null(df))[0] == (1, None, "")
    assert rows(clean.empty_to_null(df))[0] == (1, "null", None)
    assert clean.to_text(df).dtypes == [("n", "string"), ("a", "string"), ("b", "string")]
    assert rows(clean.require(df, "n")) == [(1, "null", "")]


def test_duplicate_columns_keep_the_first(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, A int, a_dup int, b int")
    out = clean.drop_duplicate_columns(df)
    assert out.columns == ["a", "a_dup", "b"]
    assert rows(out) == [(1, 3, 4)]


def test_rename_dots(spark):
    assert clean.rename_dots(spark.range(1).toDF("a.b")).columns == ["a_b"]


NESTED = "id int, p struct<x: string, q: struct<amount: double>>, items array<struct<k: string>>, note string"


def test_leaf_paths(spark):
    schema = spark.createDataFrame([], NESTED).schema
    assert clean.leaf_paths(schema) == ["id", "p.x", "p.q.amount", "items.k", "note"]


def test_normalise_lifts_and_squeezes(spark):
    df = spark.createDataFrame([(1, ("  a  b ", (2.5,)), [("k  k",)], " n\t n ")], NESTED)
    mapped = ["p.x", "p.q.amount", "items.k", "note", "null", "p.gone", "new"]
    out = clean.normalise(clean.ensure_columns(df, mapped), mapped)
    assert out.columns == ["id", "items", "note", "gone", "new", "x", "amount"]
    row = out.first()
    assert (row["x"], row["amount"], row["note"], row["gone"], row["new"]) == ("a b", 2.5, "n n", None, None)
    assert row["items"][0]["k"] == "k  k"


def test_normalise_upper_case_and_text(spark):
    df = spark.createDataFrame([(1, " a ", ("x ",))], "ID int, NAME string, P struct<city: string>")
    out = clean.normalise(df, ["id", "name", "p.city"], as_text=True)
    assert out.columns == ["ID", "NAME", "CITY"]
    assert rows(out) == [("1", "a", "x")]


def test_normalise_refuses_a_clash(spark):
    df = spark.createDataFrame([("a", ("b",))], "x string, p struct<x: string>")
    with pytest.raises(ValueError):
        clean.normalise(df, ["p.x"])


def test_conform_types_and_order(spark):
    df = spark.createDataFrame([("12.7", "yes", "bad", (5,))], "a string, b string, c string, s struct<n: int>")
    schema = {"n": "int", "missing": "double", "flag": "boolean", "day": "date", "inner": "bigint", "up": "string"}
    out = conform(df, {"n": "a", "flag": "b", "day": "c", "inner": "s.n", "up": F.upper("c")}, schema)
    assert out.columns == list(schema)
    assert rows(out) == [(12, None, True, None, 5, "BAD")]
    with pytest.raises(ValueError):
        conform(df, {"other": "a"}, schema)


def test_union_is_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    assert rows(union_all([a, a.select("s", "n")])) == [(1, "x"), (1, "x")]


def test_keep_one_takes_the_least_with_nulls_last(spark):
    df = spark.createDataFrame([(1, None, "z"), (1, "b", "a"), (1, "b", None), (None, "c", "d")], "k int, a string, b string")
    assert rows(keep_one(df, ["k"])) == [(1, "b", "a"), (None, "c", "d")]
    assert rows(keep_one(df, ["k"], [F.col("a").desc_nulls_first()]))[0] == (1, None, "z")


def test_distinct_keyed_removes_equal_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "v string")
    out = distinct_keyed(df)
    assert out.count() == 2 and out.select("id").distinct().count() == 2


def test_choice_of_checked_columns():
    assert email_column(["first_name", "contact.primary_email", "email"]) == "primary_email"
    assert email_column(["cyber_txt"]) == "cyber_txt"
    assert email_column(["order_id", "delivery_email"]) == "delivery_email"
    assert email_column(["delivery_email"], exact=True) is None
    assert email_column(["name"]) is None
    assert phone_columns(["phone", "mobilephone", "homephone"]) == ("phone", "mobilephone", "homephone")
    assert phone_columns(["mobilephone"]) == ("phone", "mobilephone")
    assert phone_columns(["phone_number", "phone"]) == ("phone_number",)
    assert phone_columns(["phone_num"]) == ()


def test_split_is_whole(spark):
    df = spark.createDataFrame(
        [(1, "a@b.com", "5713331112", None), (2, "bad", "5713331112", None), (3, "a@b.com", "1", "2"),
         (4, "bad", "1", None), (5, "a@b.com", "1", "5713331112")],
        "id int, email string, phone string, mobilephone string",
    )
    judged = split_quality(df, "email", ("phone", "mobilephone"))
    assert [(r["id"], r["reject_reason"]) for r in judged.orderBy("id").collect()] == [
        (1, None), (2, "email"), (3, "phone"), (4, "email"), (5, None)
    ]
    assert rows(trusted(judged).union(quarantined(judged))) == rows(df)
    phone_only = split_quality(df, None, ("phone",))
    assert {r["reject_reason"] for r in phone_only.collect()} == {None, "phone"}
    assert {r["reject_reason"] for r in split_quality(df, None, ()).collect()} == {None}


def test_phone_zone_takes_the_longest_prefix(spark):
    prefixes = spark.createDataFrame(
        [
            ("1", "US", "America"),
            ("1571", "US-VA", "America/New_York"),
            ("44", "GB", "Europe/London"),
            ("447986123", "GB-M", "Europe/London"),
        ],
        "prefix string, country string, zone string",
    )
    df = spark.createDataFrame(
        [("+15714123819",), ("+1 212 5550000",), ("+447986123456",), ("13818827777",), ("+99912345678",), ("+1",), (None,)],
        "phone string",
    )
    got = {r["phone"]: (r["country"], r["phone_check"]) for r in phone_zone(df, "phone", prefixes).collect()}
    assert got == {
        "+15714123819": ("US-VA", "valid"),
        "+1 212 5550000": ("US", "valid"),
        "+447986123456": ("GB-M", "valid"),
        "13818827777": (None, "invalid"),
        "+99912345678": (None, "invalid"),
        "+1": (None, "invalid"),
        None: (None, None),
    }


def test_counted_needs_no_job_of_its_own(spark):
    df, seen = counted(spark.range(7), "seen")
    df.where("id > 3").collect()
    assert seen.get["rows"] == 7
