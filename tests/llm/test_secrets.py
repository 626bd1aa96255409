from __future__ import annotations

import random
import re
import string

from guestbook.llm import secrets as leaks
from guestbook.llm.grammars import Automaton, compatible, form, merged, prefix_tree
from guestbook.llm.secrets import learned, likelier, redacted, secrets, strings
from tests.llm.conftest import ODD, documents
from tests.llm.words import prose


def brute(text):
    text = text or ""
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_key", "apikey"))
    found = []
    for m in re.finditer(rf"({word})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        found += [(m.start(), 0, "assign", m.end())] if len(m[2]) >= 8 else []
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def got(df, column):
    return {r["id"]: [tuple(s) for s in r[column]] for r in df.collect()}


def test_rules_against_brute_force(spark):
    rng = random.Random(1)
    parts = ["password", "PassWd", "secret", "ToKen", "api_key", "APIKEY", "toKen", "ſecret", '"', "'", " ", "  ", ":", "=", "é", "\n"]
    parts += ["abcd", "12345678", "AKIA", "ABCD0123", "0123456789abcdef", "f", "=" * 3, "+/", "_", ".", "-"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 25))) for _ in range(1500)]
    texts += ["a" * 5000, "token" * 1000, "token" + " " * 3000 + "=", "AKIA" * 2000, "token=" * 500]
    rows = list(enumerate(texts))
    found = secrets(documents(spark, rows), automata={})
    assert got(found, "base") == {i: brute(t) for i, t in rows}
    assert got(found, "spans") == got(found, "base")


def test_forms():
    assert form("Word") == "Ulll" and form("4f9a-00-ABC_x9") == "hhhh-nn-UUU_dd" and form("AB12") == "HHHH" and form("aZ09") == "mmmm"
    assert form("AQ12") == "DDDD" and form("camelCase") == "ccccccccc" and form("+/=.") == "+/=."


def tree_of(values):
    counts = {}
    for v in values:
        for n in range(len(v) + 1):
            met, ends = counts.get(v[:n], (0, 0))
            counts[v[:n]] = (met + 1, ends + (n == len(v)))
    return prefix_tree((p, m, e) for p, (m, e) in counts.items())


def test_merging_keeps_lengths_and_finds_loops():
    fixed = merged(tree_of(["h" * 40] * 50))
    assert len(fixed.met) == 41 and fixed.bits("h" * 40) > -1 and fixed.bits("h" * 39) < -8
    rng = random.Random(2)
    loop = merged(tree_of(["a" * min(60, int(rng.expovariate(0.2))) for _ in range(2000)]))
    assert len(loop.met) < 12  # of up to 61 in the tree
    total = sum(2 ** loop.bits("a" * n) for n in range(200))
    assert 0.9 < total < 1.001  # a distribution, but for what smoothing gives to other symbols


def test_counts_are_kept():
    rng = random.Random(3)
    values = ["".join(rng.choice("ln-") for _ in range(rng.randrange(1, 12))) for _ in range(400)]
    tree = tree_of(values)
    a = merged(tree)
    assert sum(a.ends) == 400
    into = [0] * len(a.met)
    into[0] = 400
    for p, steps in enumerate(a.steps):
        assert sum(t for _, t in steps.values()) + a.ends[p] == a.met[p]
        for q, times in steps.values():
            into[q] += times
    assert into == a.met


def test_compatibility_looks_below():
    a = Automaton([{"l": [1, 50], "n": [2, 50]}, {"l": [3, 50]}, {"l": [4, 50]}, {}, {"l": [5, 50]}, {}], [0, 0, 0, 50, 0, 50], [100, 50, 50, 50, 50, 50])
    assert compatible(a, 3, 5) and not compatible(a, 1, 2)  # the one ends a step later


def key(rng, start, n, letters=string.ascii_letters + string.digits):
    return start + "".join(rng.choice(letters) for _ in range(n))


def test_held_out_credentials(spark):
    rng = random.Random(4)
    make = [lambda: key(rng, "ghp_", 36), lambda: key(rng, "", 16, "0123456789ABCDEF") + "-" + key(rng, "", 16, "0123456789ABCDEF")]
    train = [(i, f"{prose(rng, 30)} token = '{rng.choice(make)()}' {prose(rng, 30)} mail me.{i}@some.example.com or 192.168.{i % 255}.77") for i in range(400)]
    test = [rng.choice(make)() for _ in range(200)]
    clean = [(2000 + i, prose(rng, 200) + f" http.//some.example.org/a-b_c/{i} 2024-01-{i:02d}T10 +49-170-55{i} {i * 7919:016d} ABCDEFGHIJ McDonalds") for i in range(60)]
    docs = documents(spark, train + [(1000 + i, f"{prose(rng, 20)} {v} {prose(rng, 9)}") for i, v in enumerate(test)] + clean)
    automata = learned(strings(docs.where("doc_id < 1000")))
    assert set(automata) == {"assign", "plain"}
    found = got(secrets(docs, automata=automata), "spans")
    assert sum(any(s[2] == "format" for s in found[1000 + i]) for i in range(200)) >= 190
    assert not any(found[i] for i, _ in clean)
    assert likelier("anordinaryword", automata) < leaks.BITS / 2
    base = got(secrets(docs, automata=automata), "base")
    assert all(set(base[i]) <= set(found[i]) for i in found)
    shown = {r["doc_id"]: r["text"] for r in redacted(docs, automata).collect()}
    assert all("[SECRET]" in shown[i] for i, _ in train) and all(shown[i] == t for i, t in clean)
    assert sum(v in shown[1000 + i] for i, v in enumerate(test)) <= 10


def test_labelled_strings(spark, monkeypatch):
    monkeypatch.setattr(leaks, "SAMPLE", 5)
    rng = random.Random(6)
    rows = [(i, f"secret: {key(rng, '', 12)} and longerword{i} " + "0123456789abcdef" * 3) for i in range(30)]
    found = strings(documents(spark, rows + rows)).collect()
    count = {k: sum(r["label"] == k for r in found) for k in ("assign", "hex", "plain")}
    assert count == {"assign": 5, "hex": 1, "plain": 5}
    again = strings(documents(spark, rows[::-1]).repartition(7)).collect()
    assert set(found) == set(again)


def test_odd_rows(odd, none):
    found = secrets(odd)
    assert found.count() == len(ODD) and not any(got(found, "spans").values())
    assert redacted(odd).columns == odd.columns and secrets(none).count() == 0
    assert sorted(repr(r["text"]) for r in redacted(odd).collect()) == sorted(repr(r[1]) for r in ODD)
