from __future__ import annotations

import math
import random
import re

import pytest

from guestbook.llm import search
from guestbook.llm.search import item_terms, postings, ranked, term_filter
from tests.llm.conftest import ODD, documents
from tests.llm.words import prose

ITEMS = "item_id long, text string, item int, score string"


def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(items, docs, k=10):
    read = [(d, terms(t)) for d, t in docs]
    read = [(d, t) for d, t in read if t]
    n_docs, length = len(read), sum(len(t) for _, t in read)
    out = []
    for item, text in items:
        scores = []
        asked = terms(text)
        df = {t: sum(t in held for _, held in read) for t in set(asked)}
        for d, held in read:
            m = 25 + 75 * len(held) * n_docs // length
            score = 0
            for t in asked:
                if tf := held.count(t):
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, i, d, -s) for i, (s, _, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def got(spark, items, docs, k=10):
    asked = spark.createDataFrame([(*i, 1, "z") for i in items], ITEMS)
    rows = ranked(asked, documents(spark, docs), k).collect()
    return sorted(((r["item_id"], r["rank"], r["id"], r["score"]) for r in rows), key=repr)


def corpus(rng):
    docs = [(i, prose(rng, rng.choice([1, 5, 30, 120]))) for i in range(150)]
    docs += [(300 - i, docs[i % 7][1].upper()) for i in range(40)]  # ties
    rare = ["the quillon Ünder İ", "quillon", "zwölf quillon quillon 12ab_34"]
    docs += [(400 + i, f"{rng.choice(rare)} {prose(rng, 20)}") for i in range(9)]
    items = [(i, prose(rng, rng.choice([1, 4, 25]))) for i in range(12)]
    items += [(20, "Quillon, quillon! zwölf"), (21, "ünder"), (22, None), (23, ""), (24, "none.of.these"), (20, "again quillon"), (25, docs[2][1])]
    return items, docs


@pytest.mark.parametrize("block, growth", [(1, 2), (50, 4), (10**6, 4)])
def test_against_brute_force(spark, monkeypatch, block, growth):
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "GROWTH", growth)
    items, docs = corpus(random.Random(7))
    assert got(spark, items, docs) == brute(items, docs)
    assert got(spark, items, docs, 3) == brute(items, docs, 3)


def test_accumulators_are_limited(spark, monkeypatch):
    """Documents that hold common terms alone get no accumulator once the rare ones decide."""
    monkeypatch.setattr(search, "BLOCK", 20)
    rng = random.Random(8)
    docs = [(i, f"quillon zorrel {prose(rng, 8)}") for i in range(12)] + [(100 + i, "the " + prose(rng, 30)) for i in range(300)]
    made = {}
    kept = search.scratch

    def counting(df, label):
        made.setdefault(label, []).append(kept(df, label))
        return made[label][-1]

    monkeypatch.setattr(search, "scratch", counting)
    items = [(1, "quillon zorrel the")]
    assert got(spark, items, docs) == brute(items, docs)
    assert max(x.count() for x in made["accumulators"]) == 12


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(search, "FILTER_BITS", 64)
    items, docs = corpus(random.Random(9))
    assert got(spark, items, docs) == brute(items, docs)


def test_postings_hold_whole_texts(spark):
    rng = random.Random(10)
    text = prose(rng, 60_000) + " endword"
    items = spark.createDataFrame([(1, "endword", 0, "")], ITEMS)
    found = postings(documents(spark, [(1, text)]), term_filter(item_terms(items)))
    assert [(r["tf"], r["n"]) for r in found.where("term = 'endword'").collect()] == [(1, len(terms(text)))]


def test_odd_rows(spark, odd, none):
    items = [(1, "text other words under an id"), (2, "x" * 50_000), (None, "é" * 300)]
    assert got(spark, items, [r[:2] for r in ODD]) == brute(items, [r[:2] for r in ODD])
    asked = spark.createDataFrame([(*i, 1, "z") for i in items], ITEMS)
    assert ranked(asked, none).count() == 0 and ranked(asked.limit(0), odd).count() == 0
    assert ranked(asked, odd).columns == ["item", "item_id", "rank", "id", "score"]
