"""Warehouse refresh and the writer that feeds several targets."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from guestbook.operators.clean import empty_to_null
from guestbook.session import stage
from guestbook.sinks.files import write_json
from guestbook.sinks.manifest import Published, State


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    schema: str
    properties: Mapping[str, str] = field(default_factory=dict)

    def write(self, df: DataFrame, table: str) -> None:
        """Truncate and append, so the table keeps its definition and grants."""
        (
            df.write.format("jdbc")
            .options(url=self.url, dbtable=f"{self.schema}.{table}", truncate=True, **self.properties)
            .mode("overwrite")
            .save()
        )


@dataclass(frozen=True)
class FolderTarget:
    """Parquet folder per table, for a warehouse that copies from or reads object storage."""

    root: str

    def write(self, df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.root}/{table}")


Target = JdbcTarget | FolderTarget


def full_refresh(df: DataFrame, table: str, target: Target) -> None:
    """Replace a warehouse table; empty text arrives as null. A failed write raises."""
    target.write(empty_to_null(df), table)


def write_all(
    tables: Mapping[str, DataFrame],
    json_root: str | None = None,
    warehouse: Target | None = None,
    on_empty: str = "skip",
) -> list[str]:
    """Write every table to the targets given; returns the names written.

    A table is evaluated once, staged, and written from there to each target.
    ``on_empty`` says what becomes of an empty table when there is a JSON target: ``skip``
    leaves both targets as they are, ``write`` empties them.
    """
    if on_empty not in ("skip", "write"):
        raise ValueError(f"on_empty: {on_empty}")
    written = []
    for name, df in tables.items():
        df = stage(df, name)
        if json_root and on_empty == "skip" and df.isEmpty():
            continue
        if json_root:
            write_json(df, f"{json_root}/{name}")
        if warehouse:
            full_refresh(df, name, warehouse)
        written.append(name)
    return written


def publish_all(tables: Mapping[str, DataFrame], published: Published, on_empty: str = "write") -> State:
    """Write every table aside and publish them together; readers see all of them or those of before.

    Whatever fails, be it the last table, leaves what was published. ``on_empty`` says what becomes of an empty
    table: ``write`` publishes it, ``skip`` leaves the one that is there. Empty text arrives as null.
    """
    if on_empty not in ("skip", "write"):
        raise ValueError(f"on_empty: {on_empty}")
    state = published.state()
    folders = {name: published.write(empty_to_null(df), name) for name, df in tables.items()}
    if on_empty == "skip":
        read = published.spark.read
        folders = {n: f for n, f in folders.items() if not read.schema(tables[n].schema).parquet(published.path(f)).isEmpty()}
    return published.publish(state, folders)
