"""Published folders and what is built on them: compaction, the file ledger, dictionaries, tables published at once."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from guestbook.operators.dictionary import Dictionary, extended, numbered
from guestbook.sinks.manifest import Conflict, Published
from guestbook.sinks.warehouse import publish_all
from guestbook.streaming import compaction, ledger
from guestbook.streaming.compaction import compact, compacted
from guestbook.streaming.incremental import new_files
from guestbook.streaming.ledger import Intake
from guestbook.streaming.webhook import land_messages, parse
from tests.conftest import rows


def failing(df):
    return df.where(F.raise_error(F.lit("broken off")).isNull())


def test_readers_see_whole_publications(spark, tmp_path):
    published = Published(spark, str(tmp_path / "store"))
    assert published.state().version == 0 and published.read() is None
    state = published.state()
    one = published.write(spark.range(3), "t")
    assert published.read() is None, "what is written isn't published yet"
    state = published.publish(state, {"t": one}, {"seen": "a"})
    two = published.write(spark.range(5), "t")
    assert published.read(["t"]).count() == 3
    with pytest.raises(Conflict):
        published.publish(published._read(1).__class__(0, {}, {}), {"t": two})
    assert published.read(["t"]).count() == 3
    published.publish(state, {"t": two, "u": one})
    assert published.read(["t"]).count() == 5 and published.read().count() == 8 and published.read(["x"]) is None
    assert published.state().marks == {"seen": "a"}
    published.publish(published.state(), {"u": None})
    lost = published.write(spark.range(1), "never")
    assert published.clear(keep=1) == 2  # the first part, and what was never published
    assert published.read(["t"]).count() == 5 and not os.path.exists(published.path(lost))


def test_a_failed_table_leaves_all_of_before(spark, tmp_path):
    published = Published(spark, str(tmp_path / "store"))
    tables = {f"t{i}": spark.range(i).withColumn("s", F.lit("")) for i in range(13)}
    publish_all(tables, published)
    again = {n: df.where("id > 0") for n, df in tables.items()} | {"t7": failing(tables["t7"])}
    with pytest.raises(Exception, match="broken off"):
        publish_all(again, published)
    schema = tables["t0"].schema
    assert [published.read([n], schema).count() for n in tables] == list(range(13))
    assert published.read(["t4"], schema).where("s is null").count() == 4
    publish_all({n: df.limit(0) for n, df in tables.items()} | {"t2": spark.range(9).withColumn("s", F.lit("x"))}, published, on_empty="skip")
    assert published.read(["t2"], schema).count() == 9 and published.read(["t4"], schema).count() == 4
    publish_all({"t4": tables["t4"].limit(0)}, published)
    assert published.read(["t4"], schema).count() == 0


def message(event, number, x):
    return json.dumps({"eventName": event, "dataFields": {"messageId": number, "x": x}})


def brute(sent):
    """Last copy and number of copies by event, message and day; of equal times the least body."""
    found = {}
    for body, at in sent:
        try:
            read = json.loads(body)
            key = (read["eventName"], read["dataFields"]["messageId"], at.date())
        except (ValueError, KeyError):
            continue
        found.setdefault(key, []).append((at, body))
    return {k: (max(a for a, _ in v), min(b for a, b in v if a == max(x for x, _ in v)), len(v)) for k, v in found.items()}


def test_compaction_against_brute_force(spark, tmp_path):
    rng = random.Random(1)
    source, out, checkpoint, store = (str(tmp_path / n) for n in ("sent", "landing", "progress", "store"))
    every = []
    assert compact(spark, out, store) == [] and compacted(spark, store).count() == 0
    kept = {}
    for run, days in enumerate([(7, 8), (3, 8), (9,)]):
        start = [dt.datetime(2024, 3, d, 8) for d in days]
        sent = [
            (message(rng.choice(["click", "open/x y"]), f"m{rng.randrange(6)}", rng.randrange(3)), rng.choice(start) + dt.timedelta(seconds=rng.randrange(5)))
            for _ in range(60)
        ]
        sent += [("not json", start[0]), (json.dumps({"eventName": "click"}), start[0])]
        every += sent
        spark.createDataFrame(sent, "body string, received_at timestamp").write.mode("append").parquet(source)
        land_messages(parse(new_files(spark, source, spark.read.parquet(source).schema)), out, checkpoint)
        touched = compact(spark, out, store)
        assert touched == sorted(dt.date(2024, 3, d) for d in days)
        now = dict(Published(spark, store).state().folders)
        assert all(now[d] == f for d, f in kept.items() if dt.date.fromisoformat(d) not in touched), "other days keep their files"
        kept = now
        got = {
            (r["event_name"], r["message_id"], r["event_date"]): (r["received_at"], r["body"], r["copies"])
            for r in compacted(spark, store).collect()
        }
        assert got == brute(every), run
    assert compact(spark, out, store) == []
    only = compacted(spark, store, [dt.date(2024, 3, 9)])
    assert {r["event_date"] for r in only.collect()} == {dt.date(2024, 3, 9)}
    assert all("2024-03-09" in f for f in only.inputFiles())
    assert "Window" not in only._jdf.queryExecution().toString()


def test_a_compaction_that_fails_counts_nothing(spark, tmp_path, monkeypatch):
    source, out, checkpoint, store = (str(tmp_path / n) for n in ("sent", "landing", "progress", "store"))
    at = dt.datetime(2024, 3, 7, 8)
    df = spark.createDataFrame([(message("click", "m", 1), at)] * 3, "body string, received_at timestamp")
    df.write.parquet(source)
    land_messages(parse(new_files(spark, source, df.schema)), out, checkpoint)

    def broken(self, *_):
        raise OSError("no space")

    with monkeypatch.context() as m:
        m.setattr(compaction.Published, "publish", broken)
        with pytest.raises(OSError):
            compact(spark, out, store)
    assert compacted(spark, store).count() == 0
    compact(spark, out, store)
    assert [r["copies"] for r in compacted(spark, store).collect()] == [3]


def test_only_faulty_messages(spark, tmp_path):
    source, out, checkpoint, store = (str(tmp_path / n) for n in ("sent", "landing", "progress", "store"))
    df = spark.createDataFrame([("x", dt.datetime(2024, 3, 7)), (None, None)], "body string, received_at timestamp")
    df.write.parquet(source)
    land_messages(parse(new_files(spark, source, df.schema)), out, checkpoint)
    assert compact(spark, out, store) == [] and compacted(spark, store).count() == 0


def test_ledger_takes_every_file_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "MOST_PARTS", 3)
    source, store = tmp_path / "in", str(tmp_path / "store")
    schema = spark.range(1).schema

    def put(name, *numbers):
        spark.createDataFrame([(n,) for n in numbers], schema).coalesce(1).write.mode("overwrite").parquet(str(source / name))

    put("a", 1, 2)
    put("b/c", 3)
    intake = Intake(spark, str(source), store, schema, files_per_batch=1)
    assert intake.rows() is None
    with pytest.raises(Exception, match="broken off"):
        intake.run(failing)
    assert intake.rows() is None and intake.taken().count() == 0
    assert intake.run() == 2 and intake.run() == 0
    assert sorted(rows(intake.rows())) == [(1,), (2,), (3,)]
    put("d", 4)
    old = next((source / "d").glob("*.parquet"))
    os.utime(old, (1, 1))
    assert intake.run() == 1, "files of any date are taken"
    put("a", 5)  # replaced
    for name in "efghi":
        put(name, ord(name))
    assert intake.run(lambda df: df.where("id < 106")) == 6
    assert sorted(rows(intake.rows().distinct())) == [(1,), (2,), (3,), (4,), (5,), (101,), (102,), (103,), (104,), (105,)]
    state = intake.published.state()
    assert sum(n.startswith("ledger") for n in state.folders) <= 4 and intake.taken().count() == 9
    assert Intake(spark, str(source), store, schema).run() == 0, "the table is all that is remembered"


def test_listing_opens_no_file(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("no parquet")
    (tmp_path / "_hidden").write_text("x")
    found = ledger.listing(spark, str(tmp_path)).collect()
    assert [(r["path"].rsplit("/", 1)[-1], r["size"]) for r in found] == [("x.parquet", 10)]


def test_numbers_follow_the_order(spark):
    rng = random.Random(2)
    keys = [(f"k{n}", rng.choice(["a", None])) for n in rng.sample(range(10_000), 500)]
    df = spark.createDataFrame(keys, "k string, v string").repartition(7)
    got = {(r["k"], r["v"]): r["id"] for r in numbered(df, ["v", "k"], start=11).collect()}
    want = sorted(keys, key=lambda x: (x[1] is None, x[1] or "", x[0]))
    assert [got[k] for k in want] == list(range(11, 511))
    assert numbered(df.limit(0), ["k"]).count() == 0


def test_dictionary_never_renumbers(spark, tmp_path):
    kind = {"id": "bigint", "k": "string", "v": "string"}
    book = Dictionary(spark, str(tmp_path / "book"), kind)
    assert book.read().count() == 0
    rng, held = random.Random(3), {}
    for _ in range(4):
        keys = [(rng.choice("abcdefgh"), rng.choice(["x", "y", None])) for _ in range(9)]
        got = {(r["k"], r["v"]): r["id"] for r in book.extend(spark.createDataFrame(keys, "k string, v string")).collect()}
        assert held.items() <= got.items() and set(keys) <= set(got)
        assert sorted(got.values()) == list(range(1, len(got) + 1))
        held = got
    before = book.published.state().version
    assert book.extend(spark.createDataFrame(keys, "k string, v string")).count() == len(held)
    assert book.published.state().version == before, "a load without new keys publishes nothing"
    assert Dictionary(spark, str(tmp_path / "book"), kind).read().count() == len(held)
    assert extended(book.read(), book.read(), ["k", "v"]).count() == 0
