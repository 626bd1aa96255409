from __future__ import annotations

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
from pyspark import cloudpickle

from guestbook.llm import suffixes
from guestbook.llm.suffixes import LENGTH, anchors, deduplicated, difference_cover
from tests.llm.conftest import ODD, documents
from tests.llm.words import edited, prose


def brute(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + LENGTH] for d in data for i in range(len(d) - LENGTH + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 2, bool)
        for i in range(len(d) - LENGTH + 1):
            if seen[d[i : i + LENGTH]] > 1:
                gone[i + 1 : i + 1 + LENGTH] = True
        rest = bytes(b for b, g in zip(d, gone[1:], strict=False) if not g)
        out.append((len(d), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(rest).hexdigest()))
    return out


def found(docs):
    rows = deduplicated(docs).collect()
    return sorted((r["n_bytes"], r["n_removed"], len(r["cuts"]) // 2, r["kept_sha256"]) for r in rows)


def texts(seed):
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(20, 200)) for _ in range(12)]
    passage = prose(rng, 45)
    out = base + [edited(rng, base[i % 6], rng.randrange(0, 6)) for i in range(20)]
    out += [prose(rng, 30) + " " + passage + " " + prose(rng, rng.randrange(0, 30)) for _ in range(8)]
    out += ["und " * 120, "und " * 90, "é" * 250, base[0], base[0], base[1][:199], base[1][:200], base[2][50:251]]
    return out


def test_against_brute_force(spark):
    some = texts(1)
    docs = documents(spark, list(enumerate(some)))
    assert found(docs) == sorted(brute(some))


def test_crowded_anchors_give_the_same(spark, monkeypatch):
    some = texts(2)
    monkeypatch.setattr(suffixes, "CROWD", 3)
    docs = documents(spark, list(enumerate(some)))
    assert found(docs) == sorted(brute(some))


def test_a_large_bucket_takes_little_memory():
    """A few kilobytes a context, as a task may hold ``CROWD`` of them."""
    rng = random.Random(8)
    shared, n = rng.randbytes(suffixes.LENGTH - 1), 4096
    before = np.array([rng.randrange(suffixes.AROUND) for _ in range(n)])
    data = [rng.randbytes(b) + shared + bytes([i % 250]) for i, b in enumerate(before.tolist())]
    tracemalloc.start()
    low, high = suffixes.repeated_strings(np.zeros(n, np.int64), before, data, np.zeros(n, bool))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (high == suffixes.AROUND - 1).all() and (low > suffixes.AROUND - 6).all()
    assert peak < 3000 * n


def test_blocks_keep_anchors_whole(spark):
    rng = random.Random(3)
    passage = prose(rng, 60)
    some = [prose(rng, 10) + passage + prose(rng, 10) for _ in range(60)]
    assert found(documents(spark, list(enumerate(some)))) == sorted(brute(some))


def test_pieces_give_the_same_anchors(monkeypatch):
    data = prose(random.Random(4), 2000).encode()
    whole = {(p, k) for p, k, _ in zip(*anchors(data), strict=True)}
    monkeypatch.setattr(suffixes, "PIECE", 512)
    places, keys, contexts = anchors(data)
    assert {(p, k) for p, k in zip(places, keys, strict=True)} == whole
    assert len(set(zip(places.tolist(), contexts.tolist(), strict=True))) == len(set(places.tolist()))


def test_pieces_against_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    passage = prose(rng, 60)
    some = [prose(rng, 300), prose(rng, 40) + passage + prose(rng, 200), prose(rng, 100) + passage, *texts(6)]
    monkeypatch.setattr(suffixes, "PIECE", 300)
    cloudpickle.register_pickle_by_value(suffixes)  # workers see the small pieces too
    try:
        assert found(documents(spark, list(enumerate(some)))) == sorted(brute(some))
    finally:
        cloudpickle.unregister_pickle_by_value(suffixes)
    places = anchors(some[0].encode())[0]
    assert len(places) == len(set(places.tolist()))


def test_long_texts_lose_nothing_unique(spark):
    text = random.Random(7).randbytes(5 << 20).hex()
    assert found(documents(spark, [(1, text)])) == [(len(text), 0, 0, hashlib.sha256(text.encode()).hexdigest())]


def test_cover():
    for v in (7, 31, 73):
        cover = difference_cover(v)
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))
        assert len(cover) < v / 2


def test_odd_rows(odd, none):
    assert found(odd) == sorted(brute([r[1] for r in ODD]))
    assert found(none) == []
