"""The pipeline's stages in turn over the smallest tables, each against the rule it follows on what it was given."""

from __future__ import annotations

import pytest

import corpus_pipeline
from corpus_pipeline import STAGES, run
from guestbook.llm import outliers
from tests.llm.conftest import documents
from tests.llm.test_filters import plain_lines, plain_overlaps
from tests.llm.test_jaccard import brute as plain_components
from tests.llm.test_mixing import plain_targets

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in STAGES:
        docs = corpus_pipeline.scratch(stage(spark, docs, SF_DIR), f"test-{name.replace(' ', '-')}")
        out.append(docs)
    return out


def rows(df):
    return [tuple(r) for r in df.select(*COLUMNS).collect()]


def test_columns(stages):
    assert all(s.columns == COLUMNS for s in stages[:-1])


def test_quality_rules(stages):
    kept = {r["id"] for r in outliers.verdicts(stages[0]).collect() if r["kept"]}
    assert sorted(rows(stages[1])) == sorted(r for r in rows(stages[0]) if r[0] in kept)
    assert all(len(r[1].split()) >= 50 for r in rows(stages[1]))


def test_line_dedup(stages):
    want = plain_lines(rows(stages[1]), 5)
    before = {r[0]: r[1] for r in rows(stages[1])}
    got = {r[0]: r[1] for r in rows(stages[2])}
    assert all(got.get(i, "") == t if t == before[i] or t.strip() else i not in got for i, t in want)
    assert all(r[4] == len(r[1]) for r in rows(stages[2]) if r[1] != before[r[0]])


def test_near_duplicates(stages):
    given = rows(stages[2])
    firsts = {c for _, _, c in plain_components(given)}
    assert sorted(rows(stages[3])) == sorted(r for r in given if r[0] in firsts)


def test_decontamination(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    want = []
    for r in rows(stages[3]):
        n_words, n_hit, _ = plain_overlaps(r[1], items)
        if not (n_hit > 0 and 20 * n_hit >= n_words):
            want.append(r)
    assert sorted(rows(stages[4])) == sorted(want)


def test_mix(stages):
    sizes, words = {}, {}
    for _, text, _, source, _ in rows(stages[4]):
        sizes[source] = sizes.get(source, 0) + len(text.split())
    for r in stages[5].collect():
        words[r["source"]] = words.get(r["source"], 0) + len(r["text"].split())
    want = plain_targets(sizes)
    texts = {(r[0], r[1]) for r in rows(stages[4])}
    assert all((r["doc_id"], r["text"]) in texts for r in stages[5].collect())  # whole
    longest = {s: max(len(r[1].split()) for r in rows(stages[4]) if r[3] == s) for s in want}
    assert all(abs(words.get(s, 0) - want[s]) <= 0.5 + longest[s] / 2 for s in want)


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(repr, run(spark, SF_DIR).collect())) == sorted(map(repr, stages[5].collect()))


def test_stages_on_an_empty_table(spark):
    docs = documents(spark, []).select(*COLUMNS)
    for _, stage in STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0
