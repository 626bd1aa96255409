from __future__ import annotations

import pytest

from guestbook.session import build


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """The frame's rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
