from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from guestbook.llm import mixing, queries
from guestbook.llm.mixing import mix, shard_quotas, taken
from tests.llm.conftest import ODD, documents
from tests.llm.words import prose


def plain_targets(sizes):
    """Shares by weight, what is above a cap reshared by weight until nothing is."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(2 * sizes[s] for s in capped)
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if target[s] > 2 * sizes[s]}
        if not above:
            return {s: 2.0 * sizes[s] if s in capped else target[s] for s in names}
        capped |= above


def corpus(seed, n=300):
    rng = random.Random(seed)
    sources = ["b", "a", "é", "c", "Z", None, "zz", "hot", "hot", "hot", "hot"]
    return [(i, prose(rng, rng.randrange(0, 60)), "en", rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("block", [4, 256])
def test_words_meet_targets(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", block)
    rows = corpus(1)
    docs = documents(spark, rows)
    got = taken(docs).collect()
    sizes, words, left_out = Counter(), Counter(), {}
    for r in got:
        assert r["size"] == len(rows[r["id"]][1].split()) and 0 <= r["taken"] <= 2 * r["size"]
        assert r["extra"] in (0, r["size"]) and r["taken"] == r["passes"] * r["size"] + r["extra"]
        if r["size"] and not r["extra"]:
            left_out[r["source"]] = min(left_out.get(r["source"], r["size"]), r["size"])
        sizes[r["source"]] += r["size"]
        words[r["source"]] += r["taken"]
    want = plain_targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    # Whole documents: no source misses by more than half of one that it left out (in its last block, with blocks of a source).
    longest = {s: max(r["size"] for r in got if r["source"] == s) for s in want}
    assert all(abs(words[s] - want[s]) <= 0.5 + (left_out.get(s, 0) if block == 256 else longest[s]) / 2 for s in want)
    key = lambda r: r["id"]
    assert sorted(got, key=key) == sorted(taken(docs.repartition(5)).collect(), key=key)


def test_mix_has_the_words_taken(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 4)
    rows = corpus(2)
    docs = documents(spark, rows)
    want = {r["id"]: r["taken"] for r in taken(docs).collect() if r["taken"]}
    got = mix(docs, shards=8)
    assert got.columns[: len(docs.columns)] == docs.columns
    words, shards = Counter(), defaultdict(set)
    for r in got.collect():
        n = len(r["text"].split())
        assert n == r["mix_words"] and rows[r["doc_id"]][1] == r["text"]
        words[r["doc_id"]] += n
        shards[r["doc_id"], r["mix_copy"]].add(r["mix_shard"])
    assert words == want
    assert all(len(s) == 1 for s in shards.values())


def test_query_deals_what_the_mix_deals(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 4)
    rows = corpus(3)
    docs = documents(spark, [*rows, rows[5], rows[5]])  # equal rows are separate documents
    monkeypatch.setattr(queries, "open_table", lambda *_: docs)
    got = queries.op10_mixing(spark, "").collect()
    assert len(got) == len(rows) + 2 and len({s for r in got for s in r["shards"].split(",")} - {""}) == mixing.SHARDS
    dealt, words = defaultdict(list), Counter()
    for r in mix(docs).orderBy("mix_copy").collect():
        dealt[r["doc_id"]].append(str(r["mix_shard"]))
        words[r["doc_id"]] += r["mix_words"]
    listed, summed = defaultdict(list), Counter()
    for r in got:
        listed[r["doc_id"]] += filter(None, r["shards"].split(","))
        summed[r["doc_id"]] += r["taken"]
    assert {i: sorted(s) for i, s in listed.items() if s} == {i: sorted(s) for i, s in dealt.items()}
    assert {i: n for i, n in summed.items() if n} == words


def test_quotas_are_used_up(spark):
    quotas = [("a", 1000), ("b", 37), ("c", 1), (None, 5), ("big", 300_000)]
    frame = spark.createDataFrame(quotas, "source string, quota long")
    rows = shard_quotas(frame, 16).collect()
    total = sum(q for _, q in quotas)
    by_shard, by_source = Counter(), defaultdict(list)
    for r in rows:
        by_shard[r["shard"]] += r["stop"] - r["start"]
        by_source[r["source"]].append((r["start"], r["stop"]))
    assert set(by_shard) == set(range(16)) and max(by_shard.values()) - min(by_shard.values()) <= 4
    assert sum(by_shard.values()) == total
    for source, quota in quotas:
        ranges = sorted(by_source[source])
        assert ranges[0][0] == 0 and max(b for _, b in ranges) == quota
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:], strict=False) if a[0] < a[1] or b[0] < b[1])
    spread = [r["stop"] - r["start"] for r in rows if r["source"] == "a"]
    assert abs(sum(spread) / 16 - 62.5) < 1e-9 and max(abs(x - 62.5) for x in spread) < 5 * math.sqrt(62.5)
    with pytest.raises(ValueError):
        shard_quotas(frame, 6)


def test_draws_follow_the_distribution(spark):
    draw = mixing._drawn("50D", "20D", "25D", "u")
    rows = spark.range(4000).selectExpr("(id + 0.5D) / 4000 as u").selectExpr(f"{draw} as d").collect()
    counts = Counter(r["d"] for r in rows)
    exact = lambda k: math.comb(20, k) * math.comb(30, 25 - k) / math.comb(50, 25)
    assert all(abs(counts[k] / 4000 - exact(k)) < 0.001 for k in range(21))


def test_odd_rows(odd, none):
    got = taken(odd).collect()
    assert len(got) == len(ODD)
    for source in {r["source"] for r in got}:
        mine = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 0.5 + max(r["size"] for r in mine) / 2
    assert taken(none).count() == 0 and mix(none).count() == 0
    assert all(r["mix_words"] == len(r["text"].split()) for r in mix(odd).collect())


def test_names_of_callers_stay(spark):
    rows = corpus(5, 60)
    docs = documents(spark, rows)
    for name in ("__row", "__id", "__key", "__source", "__size", "__place", "__extra", "__plan", "__copy", "mix_copy", "mix_words"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id")))
    got = mix(docs)
    assert got.columns == [*docs.columns, "mix_copy_", "mix_words_", "mix_shard", "mix_position"]
    for r in got.collect():
        assert all(r[c] == f"{c}{r['doc_id']}" for c in docs.columns if c.startswith(("__", "mix_")))


def test_equal_rows_of_a_last_block_and_very_long_documents(spark):
    rows = [(1, "a b c d e f g", "en", "s")] * 40 + [(2, "w " * 5000, "en", "s"), (3, "x", "en", "s"), (4, "y z", "en", "t")]
    got = taken(documents(spark, rows)).collect()
    assert len(got) == len(rows) and all(r["taken"] % r["size"] == 0 for r in got)
    for source, longest in (("s", 5000), ("t", 2)):
        mine = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 0.5 + longest / 2
