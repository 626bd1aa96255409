from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from guestbook import functions as fn

EMAILS = {
    "ken@gmail.com": "valid",
    "michell312@yahoo.com": "valid",
    "A@B.COM": "valid",
    "a.b-c@d-e.org": "valid",
    "eeeeze.com": "invalid",
    "johns_2a": "invalid",
    "GNIWE~": "invalid",
    "__exxxw12zz": "invalid",
    "tfd@club.com.invalid": "invalid",
    "a@b.co.uk": "invalid",
    "a@@b.com": "invalid",
    "www.x@b.com": "invalid",
    "http@b.com": "invalid",
    "josé@example.com": "valid",
    "用户@example.org": "valid",
    "a@exämple.com": "valid",
    "a@example.cöm": "invalid",
    "a@com": "invalid",
    "a@b.com ": "invalid",
    "": "invalid",
    None: "invalid",
}
PHONES = {
    "+15714123819": "valid",
    "13818827777": "valid",
    "(518)3917181": "valid",
    "571-333-1112": "valid",
    "581_111_3918": "valid",
    "57122183919": "valid",
    "157122183919": "valid",
    "+447986123456": "valid",
    "1234567890123": "invalid",
    "123456789": "invalid",
    "GMOMCCCEEZ": "invalid",
    None: "invalid",
}


def evaluate(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["out"] for r in df.select("i", column.alias("out")).orderBy("i").collect()]


def test_email_status(spark):
    assert evaluate(spark, EMAILS, fn.email_status("v")) == list(EMAILS.values())


def test_email_status_seven(spark):
    values = ["tfd@club.com", "tfd@club.com.invalid", "a@b.biz", "a@b.gov", None]
    got = evaluate(spark, values, fn.email_status_seven("v"))
    assert got == ["valid", "invalid", "invalid", "valid", "invalid"]


def test_phone_status(spark):
    assert evaluate(spark, PHONES, fn.phone_status("v")) == list(PHONES.values())


def test_any_phone_status(spark):
    df = spark.createDataFrame([("1", "13818827777", None), ("1", None, None)], "a string, b string, c string")
    got = [r[0] for r in df.select(fn.any_phone_status("a", "b", "c")).collect()]
    assert got == ["valid", "invalid"]


@pytest.mark.parametrize(
    ("address", "reason"),
    [
        ("ken@gmail.com", "valid email"),
        ("a@b.co.uk", "valid email"),
        ("johns_2a", "no @-sign"),
        ("a@@b.com", "more than one @-sign"),
        ("@b.com", "nothing before the @-sign"),
        ("a@", "nothing after the @-sign"),
        ("a b@c.com", "bad character before the @-sign"),
        (".a@c.com", "misplaced period before the @-sign"),
        ("a@c_d.com", "bad character after the @-sign"),
        ("a@c..com", "misplaced period after the @-sign"),
        ("a@-c.com", "misplaced hyphen after the @-sign"),
        ("a@com", "no period after the @-sign"),
        ("a@b.c1", "domain does not end in a letter"),
        ("tfd@club.com.invalid", "reserved domain"),
        ("x" * 65 + "@b.com", "too long before the @-sign"),
        ("a@" + "x" * 64 + ".com", "domain label too long"),
        (None, "missing"),
    ],
)
def test_email_reason(spark, address, reason):
    assert evaluate(spark, [address], fn.email_reason("v")) == [reason]


def test_squeeze_covers_every_blank(spark):
    value = "\t a b　\u001cc\u0085d  e \n"
    assert evaluate(spark, [value, None, "", "x"], fn.squeeze("v")) == ["a b c d e", None, "", "x"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0  abé", max_size=12), max_size=40))
def test_squeeze_is_split_and_join(spark, values):
    assert evaluate(spark, values, fn.squeeze("v")) == [" ".join(v.split()) for v in values]


def test_text_parts(spark):
    assert evaluate(spark, [" \tx \t", None], fn.trim_blank("v")) == ["x", None]
    assert evaluate(spark, ["a, b", "a", None], fn.street_line("v", 1)) == [" b", None, None]
    assert evaluate(spark, ["+1 (5)-a$"], fn.phone_text("v")) == ["15a$"]
    assert evaluate(spark, ["2023-03-07", None], fn.year_text("v")) == ["2023", None]


def test_times(spark):
    at = dt.datetime(1997, 8, 12, 0, 0, 0, 5)
    df = spark.createDataFrame([(at, at.date())], "t timestamp, d date")
    row = df.select(
        fn.epoch_micros("t").alias("us"),
        fn.from_epoch_micros(fn.epoch_micros("t")).alias("back"),
        fn.date_path("d").alias("path"),
        fn.year_text("t").alias("year"),
    ).first()
    assert row["us"] == 871344000000005
    assert row["back"] == at
    assert (row["path"], row["year"]) == ("1997/08/12", "1997")


def test_natural_key(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("", None), ("a|1:b", "c")], "x string, y string")
    keys = [r[0] for r in df.select(fn.natural_key("x", "y")).collect()]
    assert len(set(keys)) == 4
    assert keys[0] == hashlib.md5(b"1:a|N").hexdigest()
    assert df.select(fn.natural_key(F.lit(3))).first()[0] == hashlib.md5(b"1:3").hexdigest()
