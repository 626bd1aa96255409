from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from guestbook.llm import jaccard
from guestbook.llm.components import components
from guestbook.llm.jaccard import representatives, shingles, similar
from tests.llm.conftest import ODD, documents
from tests.llm.words import edited, prose


def brute(rows):
    sets = [set(shingles(t).tolist()) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc_id))
    return sorted(out, key=repr)


def found(docs):
    return sorted(((r["id"], r["n"], r["component"]) for r in similar(docs).collect()), key=repr)


def family(seed, size, words=120):
    rng = random.Random(seed)
    base = prose(rng, words)
    return [base] + [edited(rng, base, rng.randrange(0, 9)) for _ in range(size)]


def corpus(seed):
    rng = random.Random(seed)
    passage = prose(rng, 60)
    texts = [t for i in range(6) for t in family(seed + i, rng.randrange(1, 12), rng.randrange(6, 300))]
    texts += [prose(rng, rng.randrange(1, 80)) for _ in range(20)]
    texts += [prose(rng, 20) + " " + passage + " " + prose(rng, rng.randrange(1, 40)) for _ in range(12)]
    texts += ["one two three", "one two three", "One two THREE", "one two", "a b c d e", "a b c d e f"]
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


def test_against_brute_force(spark):
    rows = corpus(1)
    assert found(documents(spark, rows)) == brute(rows)


@pytest.mark.parametrize("short", [1, 4])
def test_stars_give_the_same(spark, monkeypatch, short):
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "LONG_SHARE", 0.2)
    rows = corpus(7)
    assert found(documents(spark, rows)) == brute(rows)


def test_last_round_makes_every_set_a_centre(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SHORT", 2)
    monkeypatch.setattr(jaccard, "LONG_SHARE", 0.0)
    monkeypatch.setattr(jaccard, "ROUNDS", 1)
    rows = corpus(11)
    assert found(documents(spark, rows)) == brute(rows)


def by_rarest(spark, texts):
    lists = jaccard._shared_lists(spark.createDataFrame(list(enumerate(texts)), "sid long, text string"))
    return jaccard._by_rarest(jaccard._rarest(lists))


@pytest.mark.parametrize("words, changes", [(300, 14), (300, 60), (90, 9), (30, 2)])
def test_the_rarest_shingles_lose_no_link(spark, words, changes):
    """All linked pairs of a family whose sets mostly aren't linked, whatever they have in common."""
    rng = random.Random(words)
    base = prose(rng, words)
    texts = [edited(rng, base, rng.randrange(changes // 2, changes)) for _ in range(60)]
    texts += [edited(rng, t, rng.randrange(1, 4)) for t in texts[:20]] + [" ".join(t.split(" ")[: rng.randrange(words * 3 // 4, words)]) for t in texts[20:30]]
    sets = {i: set(shingles(t).tolist()) for i, t in enumerate(texts)}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    got = {(r["a"], r["b"]) for r in by_rarest(spark, texts).collect()}
    assert want and want <= got


def test_pairs_of_a_large_family_are_few(spark):
    """Sets that depart from their common text in what they have alone aren't paired by what they share."""
    rng = random.Random(4)
    base = prose(rng, 200).split(" ")
    texts = [" ".join(f"w{i}x{j}" if rng.random() < 0.05 else w for j, w in enumerate(base)) for i in range(300)]
    pairs = by_rarest(spark, texts).count()
    assert pairs < 300 * 299 / 2 / 20


def test_all_lists_leave_nothing_to_chance(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SAMPLE", 4)
    rows = corpus(5)
    got = similar(documents(spark, rows), sample=None).collect()
    assert sorted(((r["id"], r["n"], r["component"]) for r in got), key=repr) == brute(rows)


def steered(rng, words, more, low, high):
    """``words`` and ``more`` others, by each of which the text gains a shingle between these shares of the hash range."""
    words = list(words)
    while more:
        word = f"w{rng.randrange(10**9)}"
        (last,) = shingles(" ".join([*words[-4:], word]))
        if low <= int(last) / 2**64 < high:
            words.append(word)
            more -= 1
    return words


@pytest.mark.parametrize("size, own", [(343, 57), (86, 14), (1029, 171)])
def test_links_where_no_shingle_of_least_hash_is_shared(spark, size, own):
    """What linked sets share may all come after what they have alone."""
    rng = random.Random(size)
    base = steered(rng, "to begin with four".split(" "), size, 0.35, 1)
    rows = [(i, " ".join(steered(rng, base, own, 0, 0.05))) for i in range(3)]
    rows += [(3, " ".join(steered(rng, base, own + size // 12, 0, 0.05)))]
    want = brute(rows)
    assert [c for _, _, c in want] == [0, 0, 0, 3]
    assert found(documents(spark, rows)) == want


@pytest.mark.parametrize("short, share", [(1, 0.0), (2, 0.08), (40, 0.08)])
def test_few_lists_lose_no_link(spark, monkeypatch, short, share):
    """Families of many sizes, cut short and edited, at the threshold and about it."""
    monkeypatch.setattr(jaccard, "SHORT", short)
    monkeypatch.setattr(jaccard, "LONG_SHARE", share)
    rng = random.Random(19)
    texts = []
    for words in (8, 11, 30, 90, 400):
        base = prose(rng, words)
        texts += [base] + [" ".join(base.split(" ")[: rng.randrange(words * 7 // 10, words)]) for _ in range(8)]
        texts += [edited(rng, base, rng.randrange(1, 1 + words // 20 + 1)) for _ in range(8)]
    rows = list(enumerate(texts))
    assert found(documents(spark, rows)) == brute(rows)


def test_a_sample_is_refused(spark):
    with pytest.raises(ValueError):
        similar(documents(spark, corpus(3)[:3]), sample=80)


def test_clashing_names(spark):
    rows = corpus(3)[:12] + corpus(3)[:3]
    docs = documents(spark, rows).withColumn("__id", F.lit("mine")).withColumn("__key", F.lit(1)).withColumn("__KEY_", F.lit(2))
    kept = representatives(docs)
    assert kept.columns == docs.columns and {r["__id"] for r in kept.select("__id").collect()} == {"mine"}


def test_one_of_each_group_stays(spark):
    rows = corpus(3)
    rows += rows[:5]
    docs = documents(spark, rows)
    kept = representatives(docs)
    assert kept.columns == docs.columns
    want = sorted({i for i, n, c in brute(rows) if n == 0 or i == c})
    assert sorted(r["doc_id"] for r in kept.collect()) == want


def test_odd_rows(odd, none):
    assert found(odd) == brute(ODD)
    assert found(none) == []
    # Of the repeated row one stays, and those without words all do.
    assert representatives(odd).count() == len(ODD) - 1
    assert representatives(none).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (200, 200)], "a long, b long")
    got = {(r["node"], r["root"]) for r in components(edges).collect()}
    assert got == {(i, 0) for i in range(41)} | {(100, 100), (101, 100), (200, 200)}


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_edges(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(40 + 30 * seed)]
    edges += [(200, 200), (7, 300), (300, 7), (7, 300)] + [(k, 500) for k in range(400, 440)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == {(x, find(x)) for x in root}
    assert got.count() == len(root)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
