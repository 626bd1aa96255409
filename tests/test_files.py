"""Sources, sinks, landing and streams on folders of their own."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from guestbook.plans import landing
from guestbook.session import clear_staged, shared_dir, stage
from guestbook.sinks.files import land, stripped_json, write_json, write_parquet, write_stripped_json
from guestbook.sinks.warehouse import FolderTarget, full_refresh, write_all
from guestbook.sources import files
from guestbook.sources.mapping import MappedTable, load_mapping, mapped_tables
from guestbook.streaming.incremental import BATCH, new_files, run_once
from guestbook.streaming.webhook import faulty_messages, land_messages, landed_messages, latest_messages, parse
from tests.conftest import rows

DAY = dt.date(2024, 3, 7)
MAPPING = """source_system,schema,source_table,source_column
shop,null,shop_people,email
shop,null,shop_people,phone
shop,null,shop_people,contact.first_name
shop,null,shop_people,email
crm,sales,accounts,null
"""


@pytest.fixture
def mapping(spark, tmp_path):
    path = tmp_path / "mapping.csv"
    path.write_text(MAPPING)
    return load_mapping(spark, str(path))


def test_mapping(mapping):
    assert mapping.count() == 5
    shop, crm = mapped_tables(mapping)
    assert shop == MappedTable("shop", "null", "shop_people", ("email", "phone", "contact.first_name"))
    assert shop.name == "shop_shop_people" and shop.folder() == "shop/shop_people"
    assert crm.folder({"crm": "prod/db"}) == "crm/prod_db_sales_accounts"
    assert [t.system for t in mapped_tables(mapping, "crm")] == ["crm"]


def test_snapshot_folders(spark, tmp_path):
    table = MappedTable("shop", "null", "t", ("a",))
    root = str(tmp_path)
    assert files.find_snapshot(spark, root, table, DAY) is None
    day = files.snapshot_path(root, table, DAY)
    assert day.endswith("shop/t/2024/03/07")
    df = spark.createDataFrame([(1,)], "a int")
    for name, value in (("2024-03-07T080000", 1), ("2024-03-07T093000", 2)):
        df.withColumn("a", F.lit(value)).write.json(f"{day}/{name}")
    found = files.find_snapshot(spark, root, table, DAY)
    assert found.endswith("T093000")
    assert files.detect_format(spark, found) == "json"
    loaded = files.load_tables(spark, [table, MappedTable("shop", "null", "gone", ())], root, DAY)
    assert list(loaded) == ["shop_t"] and loaded["shop_t"].first()["a"] == 2
    typed = files.read_snapshot(spark, found, "json", {"a": "string"})
    assert typed.first()["a"] == "2"


def test_csv_snapshot(spark, tmp_path):
    (tmp_path / "emails.csv").write_text("emails\nken@gmail.com\njohns_2a\n")
    assert files.detect_format(spark, str(tmp_path)) == "csv"
    assert rows(files.read_snapshot(spark, str(tmp_path), "csv")) == [("johns_2a",), ("ken@gmail.com",)]


def test_parquet_replaces_one_day(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = spark.createDataFrame([(1,), (2,)], "a int")
    land(df, path, DAY)
    land(df.where("a = 1"), path, DAY)
    land(df, path, dt.date(2024, 3, 8))
    got = spark.read.parquet(path)
    assert rows(got) == [(1, DAY), (1, dt.date(2024, 3, 8)), (2, dt.date(2024, 3, 8))]
    plain = str(tmp_path / "plain")
    write_parquet(df, plain, marker=False)
    write_parquet(df.where("a = 2"), plain, marker=False)
    assert rows(spark.read.parquet(plain)) == [(2,)]
    assert not (Path(plain) / "_SUCCESS").exists()
    assert any(f.name.endswith("snappy.parquet") for f in Path(plain).iterdir())


NULLS = [(1, None), (2, None), (3, "c"), (4, "null")]


def test_stripped_json_fixture(spark, tmp_path):
    df = spark.createDataFrame(NULLS, "id long, col_a string")
    path = str(tmp_path / "feed")
    write_stripped_json(df.coalesce(1), path, skip_bare=True)
    lines = [json.loads(line) for f in Path(path).glob("*.json") for line in f.read_text().splitlines()]
    assert lines == [{"id": 3, "col_a": "c"}]
    texts = [r["json"] for r in stripped_json(df).collect()]
    assert [json.loads(t) for t in texts] == [{"id": 1}, {"id": 2}, {"id": 3, "col_a": "c"}, {"id": 4}]


def test_feed_files_are_bounded(spark, tmp_path):
    path = str(tmp_path / "feed")
    write_stripped_json(spark.range(25).coalesce(1), path, per_file=10)
    sizes = sorted(len(f.read_text().splitlines()) for f in Path(path).glob("*.json"))
    assert sizes == [5, 10, 10]


def test_write_all_and_refresh(spark, tmp_path):
    full = spark.createDataFrame([(1, ""), (2, "x")], "n int, s string")
    tables = {"full": full, "empty": full.limit(0)}
    target = FolderTarget(str(tmp_path / "wh"))
    full_refresh(full, "empty", target)
    assert write_all(tables, str(tmp_path / "json"), target) == ["full"]
    assert rows(spark.read.parquet(f"{target.root}/full")) == [(1, None), (2, "x")]
    assert spark.read.parquet(f"{target.root}/empty").count() == 2, "an empty table leaves the old rows"
    assert write_all(tables, str(tmp_path / "json"), target, on_empty="write") == ["full", "empty"]
    assert spark.read.parquet(f"{target.root}/empty").count() == 0
    assert write_all(tables, warehouse=target) == ["full", "empty"], "without JSON no empty check is made"
    assert spark.read.json(str(tmp_path / "json" / "full")).count() == 2
    with pytest.raises(ValueError):
        write_all(tables, on_empty="?")
    write_json(full, str(tmp_path / "json" / "full"))


def test_json_names_that_differ_in_case(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "Id": "x", "p.q": " two  words "}\n{"id": 2, "Id": "y"}\n')
    raw = files.read_snapshot(spark, str(tmp_path), "json")
    assert spark.conf.get("spark.sql.caseSensitive") == "false"
    tidy = landing.clean_table(raw, ["id", "p_q"], dotted=True)
    assert tidy.columns == ["Id", "p_q"]
    assert rows(tidy) == [("x", "two words"), ("y", None)]


def test_format_of_first_and_last_file(spark, tmp_path):
    for name in ("a.csv", "b.json", "_skip.parquet"):
        (tmp_path / name).write_text("x")
    assert files.detect_format(spark, str(tmp_path)) == "json"
    assert files.detect_format(spark, str(tmp_path), first=True) == "csv"


def test_new_files_are_cleaned_on_the_way(spark, tmp_path):
    """Incremental intake straight into the cleaning step."""
    src, out, checkpoint = (str(tmp_path / n) for n in ("src", "out", "progress"))
    df = spark.createDataFrame([(1, " a@b.com"), (2, "bad")], "id int, email string")
    df.write.parquet(src)
    run_once(new_files(spark, src, df.schema), out, checkpoint, lambda b: landing.verdicts(b, ["id", "email"]))
    assert rows(spark.read.parquet(out).select("id", "email", "reject_reason")) == [(1, "a@b.com", None), (2, "bad", "email")]


def test_stage_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), None)], "a int, d date, s string")
    staged = stage(df, "x")
    assert staged.dtypes == df.dtypes and rows(staged) == rows(df)
    path = staged.inputFiles()[0]
    assert shared_dir(spark) in path
    assert clear_staged(spark) >= 1 and clear_staged(spark) == 0
    assert not files.exists(spark, path)


RAW = [
    (1, " a@b.com ", "571-333-1112", ("  Ken  in ",), "2024"),
    (1, " a@b.com ", "571-333-1112", ("  Ken  in ",), "2024"),
    (2, "bad", "571-333-1112", ("x",), None),
    (3, "c@d.org", "12", ("y",), None),
    (None, None, None, None, None),
]


def test_raw_to_trusted(spark, tmp_path, mapping):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    df = spark.createDataFrame(RAW, "id int, email string, phone string, contact struct<first_name: string>, note string")
    shop, crm = mapped_tables(mapping)
    df.write.parquet(files.snapshot_path(raw, shop, DAY))
    written = landing.raw_to_trusted(spark, [shop, crm], raw, out, DAY)
    assert written == {"shop_shop_people": 3, "crm_accounts": None}
    loaded = landing.load_trusted(spark, [shop, crm], out, DAY)
    assert list(loaded) == ["shop_shop_people"]
    good = loaded["shop_shop_people"]
    assert good.columns == ["id", "email", "phone", "note", "first_name"]
    assert rows(good) == [(1, "a@b.com", "571-333-1112", "2024", "Ken in")]
    bad = landing.read_zone(spark, f"{out}/{shop.folder()}", DAY, "quarantine")
    assert sorted((r["id"], r["reject_reason"]) for r in bad.collect()) == [(2, "email"), (3, "phone")]
    before = rows(good)
    df.where("id = 1").write.mode("overwrite").parquet(files.snapshot_path(raw, shop, DAY))
    landing.raw_to_trusted(spark, [shop], raw, out, DAY)
    assert rows(landing.load_trusted(spark, [shop], out, DAY)["shop_shop_people"]) == before
    assert not files.exists(spark, f"{out}/{shop.folder()}/snapshot_date=2024-03-07/zone=quarantine"), "a rerun replaces the day"


def test_land_database(spark, tmp_path):
    spark.sql("create database if not exists src")
    spark.range(3).write.mode("overwrite").saveAsTable("src.things")
    assert landing.land_database(spark, "src", str(tmp_path), "sys", DAY) == ["things"]
    assert spark.read.parquet(f"{tmp_path}/sys/things").where(F.col("snapshot_date") == F.lit(DAY)).count() == 3
    spark.sql("drop database src cascade")


def test_new_files_are_taken_once(spark, tmp_path):
    src, out, checkpoint = (str(tmp_path / n) for n in ("src", "out", "progress"))
    spark.range(3).write.parquet(src)
    schema = spark.range(1).schema

    def run():
        run_once(new_files(spark, src, schema), out, checkpoint, lambda b: b.where("id <> 1"))

    run()
    run()
    assert rows(spark.read.parquet(out).select("id")) == [(0,), (2,)]
    spark.range(10, 12).write.mode("append").parquet(src)
    run()
    assert set(rows(spark.read.parquet(out).select("id"))) == {(0,), (2,), (10,), (11,)}
    assert spark.read.parquet(out).select(BATCH).distinct().count() == 2


def test_webhook_last_copy_wins(spark, tmp_path):
    src, out, checkpoint = (str(tmp_path / n) for n in ("src", "out", "progress"))

    def body(event, message, extra):
        return json.dumps({"eventName": event, "dataFields": {"messageId": message, "x": extra}})

    at = dt.datetime(2024, 3, 7, 8)
    sent = [
        (body("click", "m1", 1), at),
        (body("click", "m1", 1), at),
        (body("click", "m1", 2), at + dt.timedelta(minutes=5)),
        (body("open", "m1", 3), at),
        (json.dumps({"eventName": "click"}), at),
        ("not json", at),
    ]
    df = spark.createDataFrame(sent, "body string, received_at timestamp")
    df.write.parquet(src)
    land_messages(parse(new_files(spark, src, df.schema)), out, checkpoint)
    landed = spark.read.parquet(out)
    assert landed.count() == 6
    faults = faulty_messages(spark, out).groupBy("fault").count()
    assert rows(faults) == [("no message id", 1), ("unreadable", 1)]
    last = latest_messages(landed_messages(spark, out)).select("event_name", "message_id", F.get_json_object("body", "$.dataFields.x"))
    assert rows(last) == [("click", "m1", "2"), ("open", "m1", "3")]
    assert (Path(out) / "batch_id=0" / "fault=none").is_dir()
