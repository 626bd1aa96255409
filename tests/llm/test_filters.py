"""Quality classifier, quality rules, line spread and decontamination."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from guestbook.llm import classifier, decontamination, linespread, outliers
from guestbook.llm.classifier import classify, isotonic
from guestbook.llm.common import prepared
from guestbook.llm.textstats import base_stats
from tests.llm.conftest import ODD, documents
from tests.llm.words import prose


def junk(rng, n):
    return " ".join(w.upper() + "!!" for w in prose(rng, n).split())


def test_classifier_on_held_out_rows(spark):
    rng = random.Random(1)
    rows = [(i, junk(rng, 60) if i % 4 == 0 else prose(rng, 60)) for i in range(600)]
    truth = {i: int(i % 4 != 0) for i, _ in rows}
    labels = spark.createDataFrame([(i, q, 0) for i, q in truth.items()], "doc_id long, quality int, toxic int")
    got = classify(documents(spark, rows), labels).collect()
    held = [r for r in got if r["held_out"]]
    assert {r["id"] for r in held} == {i for i in truth if crc32(str(i).encode()) % 5 == 0}
    assert sum((r["score"] >= 0.3) == truth[r["id"]] for r in held) > 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)
    # Labels of held-out rows change nothing.
    turned = labels.withColumn("quality", F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["id"]: r["score"] for r in classify(documents(spark, rows), turned).collect()}
    assert again == pytest.approx({r["id"]: r["score"] for r in got})


def test_classifier_without_labels(spark, odd, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in classify(odd, labels).collect()} == {0.5}
    some = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (5, None, 0), (99, 0, 0)], labels.schema)
    assert classify(odd, some).count() == len(ODD)
    assert classify(none, some).count() == 0


def test_isotonic_rises():
    rng = np.random.default_rng(0)
    bins = [(s, float(rng.binomial(20, min(1, max(0, s)))), 20) for s in np.linspace(-0.2, 1.2, 50)]
    knots, values = isotonic(bins, 0.5)
    assert (np.diff(knots) > 0).all() and (np.diff(values) >= 0).all()
    assert np.abs(np.interp([0.2, 0.5, 0.8], knots, values) - [0.2, 0.5, 0.8]).max() < 0.15


def plain_stats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = (text or "").split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)


def test_base_statistics():
    rng = random.Random(2)
    texts = [None, "", " \n \n", "a a a a", "a b c a b c\na b c\n\n\na b c", "é# |x| y\n\x0b\n"]
    texts += ["\n".join(rng.choice(["a b", "b c a", "", " ", "a"]) for _ in range(12)) for _ in range(50)]
    for text in texts:
        assert base_stats(text) == plain_stats(text)


def test_outliers_go_and_the_bulk_stays(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randrange(60, 300)), "en", f"s{i % 2}") for i in range(700)]
    rows += [(1000 + i, junk(rng, 100), "en", "s0") for i in range(30)]
    rows += [(2000, "same text " * 40, "en", "s0"), (2001, "few words", "en", "s0")]
    rows += [(3000 + i, rows[0][1], "en", "s1") for i in range(400)]  # a third are copies
    docs = documents(spark, rows)
    got = {r["id"]: r for r in outliers.verdicts(docs).collect()}
    assert all(got[i]["kept"] for i in range(700)) and all(got[3000 + i]["kept"] for i in range(400))
    assert not any(got[1000 + i]["kept"] for i in range(30))
    assert got[2000]["base_failed"] and got[2001]["base_failed"]
    kept = outliers.accepted(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}


def vectors(spark, groups):
    """Rows ``lang, source`` and statistics, from ``{(lang, source): array}``."""
    rows = [(*g, *map(float, v)) for g, x in groups.items() for v in x]
    return spark.createDataFrame(rows, ["lang", "source", *outliers.NAMES])


def estimates(spark, groups):
    got = outliers.estimated(vectors(spark, groups)).collect()
    return {r["stratum"].split("|=")[-1]: r for r in got}


def squared(estimate, v):
    cov = np.array(estimate["cov"]).reshape(6, 6)
    off = np.asarray(v) - np.array(estimate["centre"])
    return off @ np.linalg.solve(cov, off)


def test_least_determinant_against_all_subsets(spark):
    """Of all choices of the nearest rows none has a lesser determinant, and the estimate is that of the best."""
    prepared(spark)
    rng = np.random.default_rng(4)
    prior_centre, prior_cov = np.full(6, 0.1), np.diag(np.full(6, 0.04))
    for case in range(3):
        x = rng.normal(size=(13, 6)) * 0.3
        x[:3] = 4 + rng.normal(size=(3, 6)) * (0.1 + case)
        rows = spark.createDataFrame([("a", *map(float, r)) for r in x], ["stratum", *outliers.NAMES])
        prior = spark.createDataFrame(
            [("a", prior_centre.tolist(), prior_cov.ravel().tolist())], "stratum string, prior_centre array<double>, prior_cov array<double>"
        )
        got = outliers.minimum_determinant(rows, prior).first()
        best = None
        for chosen in itertools.combinations(range(13), 10):
            part = x[list(chosen)]
            centre, cov = outliers.regularised(
                10, part.mean(0), outliers.CONSISTENCY * np.cov(part.T, bias=True), prior_centre, prior_cov
            )
            found = (np.linalg.slogdet(cov)[1], centre, cov)
            best = found if best is None or found[0] < best[0] else best
        assert got["logdet"] == pytest.approx(best[0], abs=0.02)
        assert np.allclose(got["centre"], best[1], atol=1e-3)
        assert np.allclose(np.array(got["cov"]).reshape(6, 6), best[2], atol=2e-3)
    assert abs(outliers.chi2_cdf(12.592, 6) - 0.95) < 1e-4


def test_sources_of_different_covariance_judge_a_vector_differently(spark):
    """Two sources with the same spread in every statistic and opposite correlations: the estimate decides, no constant does."""
    prepared(spark)
    rng = np.random.default_rng(5)
    along, across = np.eye(6), np.eye(6)
    along[0, 1] = along[1, 0] = 0.95
    across[0, 1] = across[1, 0] = -0.95
    draw = lambda c, n: rng.multivariate_normal(np.zeros(6), 0.01 * c, n)
    got = estimates(spark, {("en", "along"): draw(along, 2500), ("en", "across"): draw(across, 2500)})
    v = [0.18, 0.18, 0, 0, 0, 0]
    assert squared(got["along"], v) < outliers.CUTOFF < squared(got["across"], v)
    v[1] = -0.18
    assert squared(got["across"], v) < outliers.CUTOFF < squared(got["along"], v)
    for name, true in (("along", along), ("across", across)):
        cov = np.array(got[name]["cov"]).reshape(6, 6)
        assert np.abs(cov / 0.01 - true).max() < 0.25


def test_outliers_do_not_move_the_estimate(spark):
    """A fifth of the rows far off, in one place, which would hide each other from a plain covariance."""
    prepared(spark)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1000, 6)) * 0.1
    x[:200] = [1, 1, 1, 1, 1, 1] + rng.normal(size=(200, 6)) * 0.01
    got = estimates(spark, {("en", "a"): x})["a"]
    d = np.array([squared(got, v) for v in x])
    assert (d[:200] > outliers.CUTOFF).all() and (d[200:] > outliers.CUTOFF).mean() < 0.005
    plain = np.cov(x.T)
    off = x - x.mean(0)
    assert (np.einsum("ij,jk,ik->i", off, np.linalg.inv(plain), off)[:200] < outliers.CUTOFF).all()


def test_small_sources_lean_on_their_language(spark):
    """From one row to many a source's estimate goes from its language's to its own, without a jump."""
    prepared(spark)
    rng = np.random.default_rng(7)
    small = rng.normal(size=(320, 6)) * 0.1 + 0.5
    groups = {("en", "big"): rng.normal(size=(3000, 6)) * 0.1}
    groups |= {("en", f"n{n}"): small[:n] for n in (1, 20, 80, 320)}
    got = estimates(spark, groups)
    assert len(got) == 5
    centres = [float(np.mean(got[f"n{n}"]["centre"])) for n in (1, 20, 80, 320)]
    assert centres == sorted(centres) and centres[0] < 0.05 and centres[-1] > 0.3
    assert squared(got["big"], small[0]) > outliers.CUTOFF > squared(got["n320"], small[0])


def test_statistics_of_texts():
    rng = random.Random(8)
    texts = ["a", "Ab a, B!", "é# É x\n\nyy 12", "😀 a 😀", "...", *(prose(rng, 80) for _ in range(5)), *(junk(rng, 60) for _ in range(5))]
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        chars = [c for w in words for c in w]
        letters = [c.lower() for c in chars if c.isalpha()]
        shares = [letters.count(c) / len(letters) for c in set(letters)]
        logs = [math.log(len(w)) for w in words]
        mean = sum(logs) / len(logs)
        want = [
            math.log(len(chars) / len(words)),
            math.sqrt(sum((x - mean) ** 2 for x in logs) / len(logs)),
            math.sqrt((sum(not c.isalnum() for c in chars) + 1) / (len(chars) + 1)),
            math.sqrt((sum(c.isupper() for c in chars) + 1) / (len(chars) + 1)),
            -sum(p * math.log2(p) for p in shares),
            math.log(len({w.lower() for w in words})) / math.log(len(words) + 1),
        ]
        assert outliers._vector(text, *base_stats(text)[:2]) == pytest.approx(want)
    assert outliers._vector("", 0, 0) == [0.0] * 6


def test_verdicts_against_a_plain_estimate(spark):
    """Every verdict of a corpus, against the same estimate made in one place with exact sorting."""
    prepared(spark)
    rng = random.Random(9)
    rows, i = [], 0
    for lang in ("en", "de", None):
        for source, n in (("a", 260), ("b", 90), (None, 15)):
            for _ in range(n):
                rows.append((i, junk(rng, 80) if rng.random() < 0.08 else prose(rng, rng.randrange(55, 200)), lang, source))
                i += 1
    rows += [(i + k, rows[3][1], rows[3][2], rows[3][3]) for k in range(300)]  # a hot text counts once
    got = {r["id"]: r for r in outliers.verdicts(documents(spark, rows)).collect()}

    x = {}
    for _, text, lang, source in rows:
        n_words, chars, _, _, repeated = base_stats(text)
        if n_words >= 50 and 100 * repeated <= 50 * n_words:
            x[lang, source, text] = outliers._vector(text, n_words, chars)

    def quartile(v):
        q = np.quantile(v, [0.25, 0.5, 0.75], axis=0)
        return q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2)

    def plain(v, centre, target):
        v = np.array(v)
        c, cov = quartile(v)
        cov = outliers.regularised(len(v), c, cov, c, target)[1]
        for _ in range(30):
            off = v - c
            d = np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off)
            near = v[np.argsort(d)[: math.ceil(0.75 * len(v))]]
            spread = np.cov(near.T, bias=True) if len(near) > 1 else np.zeros((6, 6))
            c, cov = outliers.regularised(len(near), near.mean(0), outliers.CONSISTENCY * spread, centre, target)
        return c, cov

    start = quartile(np.array(list(x.values())))
    langs = {lang: plain([v for k, v in x.items() if k[0] == lang], *start) for lang in {k[0] for k in x}}
    own = {g: plain([v for k, v in x.items() if k[:2] == g], *langs[g[0]]) for g in {k[:2] for k in x}}
    d = {k: (v - own[k[:2]][0]) @ np.linalg.solve(own[k[:2]][1], v - own[k[:2]][0]) for k, v in x.items()}
    roots = np.cbrt(list(d.values()))
    q = np.quantile(roots, [0.5, 0.75])
    cut = max(outliers.CUTOFF, (q[0] + outliers._FAR * (q[1] - q[0]) / outliers._QUARTILE) ** 3)
    seen = Counter()
    for doc_id, text, lang, source in rows:
        want = d.get((lang, source, text))
        assert got[doc_id]["base_failed"] == (want is None)
        if want is not None and not 0.8 * cut < want < 1.25 * cut:  # estimates agree closely, not to the last digit
            assert got[doc_id]["kept"] == (want <= cut)
            seen[want <= cut] += 1
    assert seen[True] > 900 and seen[False] > 40 and sum(seen.values()) > 0.98 * (len(rows) - 5)


def test_verdicts_of_odd_rows(odd, none):
    got = outliers.verdicts(odd).collect()
    assert len(got) == len(ODD) and not any(r["kept"] for r in got)
    assert outliers.verdicts(none).count() == 0 and outliers.accepted(none).count() == 0


def plain_lines(rows, sites):
    space = "\x20\t\n\x0b\x0c\r"
    where, first = defaultdict(set), {}
    for doc_id, text, _, source, *_ in rows:
        for line in (text or "").split("\n"):
            if key := line.strip(space):
                if source is not None:
                    where[key].add(source)
                if doc_id is not None:
                    first[key] = min(first.get(key, doc_id), doc_id)
    gone = {k for k, s in where.items() if len(s) >= sites}
    out = []
    for doc_id, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (x.strip(space) in gone and first.get(x.strip(space)) != doc_id)]
        out.append((doc_id, None if text is None else "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sites", [2, 5, 9])
def test_lines_against_brute_force(spark, sites):
    rng = random.Random(5)
    shared = [prose(rng, 5) for _ in range(30)]
    rows = [
        (i, "\n".join(rng.choice([prose(rng, 4), shared[int(rng.random() ** 3 * 30)], " ", shared[0] + " "]) for _ in range(8)), "en", f"s{rng.randrange(12)}")
        for i in range(150)
    ] + [(None, shared[0], "en", "s1"), (200, shared[1], "en", None)]
    docs = documents(spark, rows)
    got = linespread.without_boilerplate(docs, sites)
    assert got.drop("__lines", "__removed").columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == plain_lines(rows, sites)


def test_lines_of_odd_rows(odd, none):
    got = sorted(((r["doc_id"], r["text"]) for r in linespread.without_boilerplate(odd).collect()), key=repr)
    assert got == sorted(((r[0], r[1]) for r in ODD), key=repr)
    assert linespread.without_boilerplate(none).count() == 0


def test_line_dedup_leaves_names_of_callers(spark):
    prepared(spark)
    docs = documents(spark, [(i, f"shared by all\nown {i}", "en", f"s{i}") for i in range(6)])
    names = ("__lines", "__removed", "__id", "__key", "__places", "__kept", "id", "line", "first")
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id")))
    got = linespread.without_boilerplate(docs)
    assert got.columns == [*docs.columns, "__lines_", "__removed_"]
    for r in got.collect():
        assert all(r[c] == f"{c}{r['doc_id']}" for c in names)
        assert r["text"] == (f"own {r['doc_id']}" if r["doc_id"] else "shared by all\nown 0")


def plain_overlaps(text, items):
    def words(t):
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)

    doc, hit, names = words(text), set(), set()
    for item, body in items:
        w = words(body)
        n = min(13, len(w))
        runs = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(doc) - n + 1):
            if n and tuple(doc[i : i + n]) in runs:
                hit |= set(range(i, i + n))
                names.add("null" if item is None else str(item))
    return len(doc), len(hit), sorted(names)


def test_overlaps_against_brute_force(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, n)) for i, n in enumerate((40, 13, 14, 5, 1, 30))] + [(10, None), (None, prose(rng, 20)), (11, "..."), (0, prose(rng, 15))]
    texts = [prose(rng, 50) for _ in range(10)]
    for _, body in items:
        w = (body or "").split()
        for n in (len(w), 13, 12, 20):
            texts.append(prose(rng, 20) + " " + " ".join(w[:n]).upper() + "; " + prose(rng, rng.randrange(0, 40)))
    texts += [items[0][1] + " " + items[0][1], items[0][1] + items[5][1], None, "", "ÄÖ ÉCOLE " * 13]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(spark, rows)
    found = decontamination.contaminated(decontamination.overlaps(docs, bench)).collect()
    got = sorted((r["id"], r["n_words"], r["n_hit"], r["items"]) for r in found)
    assert got == sorted((i, *plain_overlaps(t, items)) for i, t in rows)
    for r in found:
        assert r["n_hit"] == sum(s["end"] - s["start"] for s in r["spans"])
        assert r["contaminated"] == (r["n_hit"] > 0 and 20 * r["n_hit"] >= r["n_words"])
    kept = decontamination.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["id"] for r in found if not r["contaminated"])


def test_overlaps_of_odd_rows(spark, odd, none):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.clean(odd, empty).count() == len(ODD)
    some = spark.createDataFrame([(1, "a text")], empty.schema)
    assert decontamination.clean(odd, some).count() == len(ODD) - 1
    assert decontamination.overlaps(none, some).count() == 0
