from __future__ import annotations

import pytest

from guestbook.llm.common import prepared
from tests.conftest import spark as _spark  # noqa: F401

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, key int, n string, spans int"


def documents(spark, rows):
    """Documents from ``(doc_id, text[, lang, source])``, with further columns whose names operators use too."""
    full = [(*r, *("en", "s")[len(r) - 2 :], len(r[1] or ""), "z", 1, "n", 2) for r in rows]
    return spark.createDataFrame(full, DOCS)


ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (None, "a text without an id", "en", None),
    (3, " \n\t ", "de", "a"),
    (4, "x" * 50_000, "en", "b"),
    (4, "x" * 50_000, "en", "b"),
    (5, "é" * 300, None, "b"),
    (5, "other words under the same id", "en", "b"),
]


@pytest.fixture()
def odd(spark):
    prepared(spark)
    return documents(spark, ODD)


@pytest.fixture()
def none(spark):
    prepared(spark)
    return documents(spark, [])
