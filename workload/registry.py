"""Queries over the driver tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from guestbook.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


_SCHEMAS: dict[str, StructType] = {}


def open_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table; its schema is read from the files once."""
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


class Tables:
    """The driver tables of one scale, each opened when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        return self.once(name, lambda: open_parquet(self.spark, f"{self.folder}/{name}.parquet"))

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A frame that several parts of one query share."""
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def sql(self, text: str) -> DataFrame:
        """SQL whose table names stand in braces."""
        named = {n: getattr(self, n) for n in TABLES if "{" + n + "}" in text}
        return self.spark.sql(text, **named)


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(text: str) -> str:
    """The same SQL with bare table names."""
    for name in TABLES:
        text = text.replace("{" + name + "}", name)
    return text


def query(sql: str | None = None, name: str | None = None):
    """Register a function of the driver tables under its name, or under the one given."""

    def register(fn: Callable[[Tables], DataFrame], name: str | None = name):
        name = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(tune(spark), sf_dir))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = plain(sql)
        return fn

    return register


def key_sql(*columns: str) -> str:
    parts = [
        f"coalesce(cast(length(cast({c} as varchar)) as varchar) || ':' || cast({c} as varchar), 'N')" for c in columns
    ]
    return f"md5(concat_ws('|', {', '.join(parts)}))"
