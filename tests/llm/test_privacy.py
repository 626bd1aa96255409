from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from guestbook.llm import privacy
from guestbook.llm.privacy import disclosures, personal_data, sanitised
from tests.llm.conftest import ODD, documents
from tests.llm.words import prose

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits)))]
    return sum(doubled) % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        spans += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if valid(kind, m[0])]
    return sorted(spans)


def found(docs, column):
    return {r["id"]: [tuple(s) for s in r[column]] for r in personal_data(docs).collect()}


def test_entities_against_brute_force(spark):
    rng = random.Random(1)
    parts = ["a@b.c", "_x@d.e", ".f", "@", "a", "é", " ", "-", "+", "(", ")", "12", "255.", "256", "0001.2.3.4", "4111111111111111", "\n"]
    parts += ["4111 1111-1111 1111", "+1 (555) 234-5678", "1.2.3.4", "5500005555555559", ".", ",", "%"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(600)]
    texts += ["9" * 3000, "1 " * 3000, "a" * 5000, "1." * 3000, "+1" + "-" * 3000, "x." * 2000 + "@", "a@" + "b." * 2000 + "c"]
    rows = list(enumerate(texts))
    assert found(documents(spark, rows), "base") == {i: brute(t) for i, t in rows}


def test_addresses_with_zero_parts(spark):
    rng = random.Random(3)
    some = ["10.0.0.1", "0.0.0.0", "00.1.2.3", "192.168.0.5", "127.0.0.1", "000.00.0.010", "1.2.3.0", "0.0.0.256", "0.00300.1.1"]
    parts = ["0", "00", "1", "10", "100", "0255", "256", "0300", "."]
    texts = [f"host {x}, up" for x in some] + [".".join(rng.choice(parts) for _ in range(4)) for _ in range(300)]
    texts += ["0" * 3000 + ".0.0.1", ".".join(["0" * 3000] * 4), ".".join(["0" * 3000] * 3 + ["999"])]
    rows = list(enumerate(texts))
    docs = documents(spark, rows)
    assert found(docs, "base") == {i: brute(t) for i, t in rows}
    clean = {r["doc_id"]: r["text"] for r in sanitised(docs).collect()}
    assert all("[IP]" in clean[i] for i in range(7)) and "[IP]" not in clean[7] + clean[8]


def test_revealing_terms(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, 40)) for i in range(200)]
    rows += [(1000 + i, f"{prose(rng, 8)} quillon {prose(rng, 3)} write to one@mail.example today") for i in range(4)]
    rows += [(1100, f"seen: Quillon, {prose(rng, 5)}")] + [(1200 + i, "ordinal of solo two@mail.example") for i in range(9)]
    docs = documents(spark, rows)
    terms = {r["term"]: r["disclosure"] for r in disclosures(docs).collect()}
    assert 0.9 < terms["quillon"] < 1  # four of its five lines are of that address
    assert "solo" not in terms  # many copies of one line are one line
    spans = found(docs, "spans")
    assert [(s[2], s[0]) for s in spans[1100] if s[2] in ("general", "removed")] == [("removed", 6)]
    assert terms["today"] == 1 and privacy.REMOVE <= terms["quillon"]
    assert all(any(s[2] == "email" for s in spans[1000 + i]) for i in range(4))
    base = found(docs, "base")
    assert all(set(base[i]) <= set(spans[i]) for i in spans)
    clean = {r["doc_id"]: r["text"] for r in sanitised(docs).collect()}
    assert clean[1100].startswith("seen: , ") and "[EMAIL]" in clean[1000] and "quillon" not in clean[1000]
    assert clean[5] == rows[5][1]


def test_odd_rows(odd, none):
    assert personal_data(odd).count() == len(ODD)
    assert not any(s for spans in found(odd, "spans").values() for s in spans)
    assert sanitised(odd).columns == odd.columns
    assert sorted(map(repr, (r["text"] for r in sanitised(odd).collect()))) == sorted(repr(r[1]) for r in ODD)
    assert personal_data(none).count() == 0


def test_lines_of_many_entities_make_no_pairs_without_support(spark):
    """A line of thousands of addresses that stand nowhere else is none the longer for it."""
    crowded = " ".join(f"u{i}@h{i}.example" for i in range(3000))
    lines = [f"met qorvan{i % 3} here write to boss@corp.example now{i}" for i in range(9)] + ["other words"] * 40
    rows = [(i, x, "en", "s") for i, x in enumerate([*lines, crowded, crowded + " and more"])]
    got = {r["term"]: r["disclosure"] for r in disclosures(documents(spark, rows)).collect()}
    assert {"qorvan0", "qorvan1", "qorvan2"} <= set(got) and not any(t.startswith("now") for t in got)
    assert len(found(documents(spark, rows), "base")[len(rows) - 1]) == 3000


def test_names_of_callers_stay(spark):
    docs = documents(spark, [(1, "write to a@b.c", "en", "s"), (2, None, "en", "s")])
    for name in ("__row", "__key", "__base", "__spans", "__terms", "__found", "general", "removed", "line", "term"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id")))
    got = sanitised(docs)
    assert got.columns == docs.columns
    for r in got.collect():
        assert all(r[c] == f"{c}{r['doc_id']}" for c in docs.columns[9:])
        assert r["text"] == ("write to [EMAIL]" if r["doc_id"] == 1 else None)
