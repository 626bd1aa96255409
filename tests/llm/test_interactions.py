from __future__ import annotations

import random
import re
from itertools import permutations

from guestbook.llm.interactions import audit, interactions
from tests.llm.conftest import ODD, documents
from tests.llm.words import prose

LABELS = "doc_id long, quality int, toxic int, part string"


def brute(rows, labels):
    """The audit of ``(doc_id, text, lang)`` by its words."""
    fails = []
    for doc, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = set()
        bad |= {"A"} if len(words) < 100 else set()
        bad |= {"B"} if 100 * len(set(words)) < 80 * len(words) else set()
        bad |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else set()
        bad |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in rows):
            bad.add("E")
        known = [(q, t) for d, q, t in labels if d is not None and d == doc]
        fails.append((lang or "", bad, any(q == 1 for q, _ in known), any(t == 1 for _, t in known)))
    out = {}
    for part in {f[0] for f in fails}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = [f for f in fails if f[0] == part], []
            for step, name in enumerate(order, 1):
                here = [f for f in left if name in f[1]]
                redundant = sum(name in f[1] for f in gone)
                left, gone = [f for f in left if name not in f[1]], gone + here
                shapley[name] += len(here)
                alone = sum(f[0] == part and f[1] == {name} for f in fails)
                out[part, "".join(order), step] = [name, len(left), len(here), redundant, alone, sum(f[2] for f in here), sum(f[3] for f in here)]
        for key, row in out.items():
            if key[0] == part:
                row.append(shapley[row[0]])
    return out


def got(df):
    names = ["filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    found = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in names] for r in rows}
    assert len(found) == len(rows)
    return found


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(120):
        text = prose(rng, rng.choice([0, 3, 40, 110, 130]))
        text = rng.choice([str, str.upper, lambda t: t + " #", lambda t: t + " " + t, lambda t: " ".join(f"{w}{j}" for j, w in enumerate(t.split()))])(text)
        rows.append((i, text, rng.choice(["en", "de", "", None])))
    rows += [(200 + i, rng.choice(rows)[1], "en") for i in range(40)] + [(None, rows[3][1], "en"), (5, rows[5][1], "en"), (7, None, "de")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 240, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    docs = documents(spark, [(d, t, lang, "s") for d, t, lang in rows])
    marks = spark.createDataFrame([(*x, "p") for x in labels], LABELS)
    assert got(audit(docs, marks)) == brute(rows, labels)


def test_odd_rows(spark, odd, none):
    marks = spark.createDataFrame([], LABELS)
    assert got(audit(odd, marks)) == brute([(r[0], r[1], r[2] if len(r) > 2 else "en") for r in ODD], [])
    assert audit(none, marks).count() == 0


def test_filters_of_any_number(spark):
    rows = spark.createDataFrame([(i, "x", i % 2, 0) for i in range(10)], "id long, part string, good int, toxic int")
    fails = {f: spark.createDataFrame([(i,) for i in ids], "id long") for f, ids in {"P": range(4), "Q": range(2, 7)}.items()}
    found = got(interactions(rows, fails))
    assert found["x", "PQ", 1] == ["P", 6, 4, 0, 2, 2, 0, 6] and found["x", "PQ", 2] == ["Q", 3, 3, 2, 3, 1, 0, 8]
    assert found["x", "QP", 1] == ["Q", 5, 5, 0, 3, 2, 0, 8] and len(found) == 4
