from __future__ import annotations

import random

import duckdb
import pytest

from guestbook.llm import chat
from guestbook.llm.chat import rendered
from guestbook.llm.queries import SQL

SCHEMA = "conv_id long, turn long, role string, text string, part string, block int, n int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SCHEMA)


def brute(rows):
    whole = {}
    for conv, turn, role, text in set(rows):
        whole.setdefault(conv, []).append((-(2**63) if turn is None else turn, role is not None, role or "", text is not None, text or ""))
    whole = {c: sorted(t) for c, t in whole.items()}

    def begins(a, b):
        return len(a) < len(b) and b[: len(a)] == a

    out = {}
    for conv, turns in whole.items():
        if any(begins(turns, other) for other in whole.values()):
            continue
        same = [c for c, t in whole.items() if t == turns and c is not None]
        if conv == (min(same) if same else None):
            out[conv] = "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for _, _, r, _, t in turns)
    return out


def found(frame):
    parts = sorted(rendered(frame).collect(), key=lambda r: (repr(r["conv_id"]), r["part"]))
    out = {}
    for r in parts:
        out[r["conv_id"]] = out.get(r["conv_id"], "") + r["text"]
    return out


def logged(seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(120):
        start = conv % 8
        rows += [(conv, i, "user" if i % 2 == 0 else "assistant", f"{start} {i} {rng.random() < 0.1}") for i in range(rng.randrange(1, 9))]
    return rows


def test_against_brute_force(spark):
    rows = logged(1)
    rows += rows[:40] + [(500, None, "user", "x"), (501, 0, None, "x"), (502, 0, "", "x"), (503, 0, "user", None), (504, 0, "user", "")]
    rows += [(505, 0, "user", "x"), (505, 0, "assistant", "y"), (None, 0, "user", "no id"), (506, 0, "user", "no id"), (507, 7, "u", "gap"), (507, 9, "u", "gap")]
    assert found(conversations(spark, rows)) == brute(rows)


def test_long_and_crowded_conversations(spark):
    long = [(1, i, "user", f"t{i}") for i in range(1000)]
    rows = long + [(2, i, "user", f"t{i}") for i in range(700)] + [(3, i, "user", f"t{i}" if i < 699 else "other") for i in range(700)]
    assert found(conversations(spark, rows)) == brute(rows)
    crowded = [(9, 5, "user", f"{i:04d}") for i in range(900)]
    text = found(conversations(spark, crowded))[9]
    assert all(f"{i:04d}" in text for i in range(900)) and text.count("<|im_start|>") == 900
    assert rendered(conversations(spark, crowded)).count() > 1


def test_crowded_turns_keep_their_order(spark):
    rng = random.Random(4)
    same = "a long beginning " * 80
    rows = [(9, 5, rng.choice(["user", "assistant", None]), f"{rng.random()}") for _ in range(900)]
    rows += [(9, i % 300, "user", f"{same}{i}") for i in range(1500)] + [(None, None, "user", f"t{i}") for i in range(700)]
    rows += [(None, 0, "u", "x")] + [(8, i, "user", f"t{i}") for i in range(300)]
    rng.shuffle(rows)
    frame = conversations(spark, rows)
    assert found(frame) == brute(rows)
    got = rendered(frame.repartition(7)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, rendered(frame).collect()))
    assert max(r["n_turns"] for r in got) == chat.BLOCK and {r["part"] for r in got if r["conv_id"] == 8} == {0, 1}


def by_sql(rows):
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    return sorted(map(repr, con.execute(SQL["op7_chat"]).fetchall()))


@pytest.mark.parametrize("seed", range(3))
def test_the_sql_agrees_on_ties_nulls_and_crowds(spark, seed):
    rng = random.Random(seed)
    rows = []
    for conv in range(60):
        turns = sorted(rng.choices([None, 1, 1, 2, 3], k=rng.randrange(1, 6)), key=lambda t: (t is not None, t))
        rows += [(conv, t, rng.choice(["u", None]), rng.choice(["a", "b", None, ""])) for t in turns]
    rows += [(100, 1, "u", "a"), (101, 1, "u", "a"), (101, 1, "u", "b"), (None, 1, "u", "only here")]
    rows += [(102, 4, "u", f"{i % 700:03d}") for i in range(900)] + [(103, 4, "u", f"{i:03d}") for i in range(600)]
    got = rendered(conversations(spark, rows)).select("conv_id", "part", "first_turn", "n_turns", "text")
    found_rows = [tuple(r) for r in got.collect()]
    assert 103 not in {r[0] for r in found_rows} and 100 not in {r[0] for r in found_rows}
    assert sorted(map(repr, found_rows)) == by_sql(rows)


def test_empty(spark):
    assert rendered(conversations(spark, [])).count() == 0
