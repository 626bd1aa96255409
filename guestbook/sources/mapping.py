"""The source-to-target mapping table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from guestbook.operators.clean import NO_COLUMN
from guestbook.operators.conform import conform

MAPPING_SCHEMA = "source_system string, schema string, source_table string, source_column string"
TARGET_SCHEMA = MAPPING_SCHEMA + ", target_column string, target_column_type string"


def load_mapping(spark: SparkSession, path: str, with_targets: bool = False) -> DataFrame:
    """The mapping CSV, all text. The word ``null`` stays text: it means "no schema" or "no column"."""
    schema = TARGET_SCHEMA if with_targets else MAPPING_SCHEMA
    return spark.read.schema(schema).option("header", True).csv(path)


@dataclass(frozen=True)
class MappedTable:
    system: str
    schema: str
    table: str
    columns: tuple[str, ...]
    #: Source column, target column and its type, where the mapping names a target.
    targets: tuple[tuple[str, str, str], ...] = ()

    @property
    def name(self) -> str:
        """Name of the table's frame."""
        return f"{self.system}_{self.table}"

    def folder(self, databases: Mapping[str, str] | None = None) -> str:
        """Folder of the table under the zone root."""
        if self.schema == NO_COLUMN:
            return f"{self.system}/{self.table}"
        database = (databases or {}).get(self.system, self.system).replace("/", "_")
        return f"{self.system}/{database}_{self.schema}_{self.table}"


def mapped_tables(mapping: DataFrame, system: str | None = None) -> list[MappedTable]:
    """The mapping's tables with their columns in file order.

    The mapping is configuration of a few hundred rows, the one thing read on the driver.
    """
    columns: dict[tuple[str, str, str], list[str]] = {}
    targets: dict[tuple[str, str, str], list[tuple[str, str, str]]] = {}
    for row in mapping.collect():
        key = (row["source_system"], row["schema"], row["source_table"])
        if system is None or key[0] == system:
            columns.setdefault(key, []).append(row["source_column"])
            if "target_column" in row and row["target_column"] not in (None, NO_COLUMN):
                wanted = (row["source_column"], row["target_column"], row["target_column_type"])
                targets.setdefault(key, []).append(wanted)
    return [
        MappedTable(*key, tuple(dict.fromkeys(names)), tuple(dict.fromkeys(targets.get(key, []))))
        for key, names in columns.items()
    ]


def target_schema(tables: Iterable[MappedTable]) -> dict[str, str]:
    """All target columns of the mapping with their types, in file order; two types for one column are an error."""
    schema: dict[str, str] = {}
    for table in tables:
        for _, target, kind in table.targets:
            if schema.setdefault(target, kind) != kind:
                raise ValueError(f"{target} is mapped to {schema[target]} and to {kind}")
    return schema


def to_targets(df: DataFrame, table: MappedTable, schema: Mapping[str, str] | None = None) -> DataFrame:
    """A trusted table under the target columns of the mapping, or of a ``schema`` that has them.

    A nested column has been lifted to its last name by then; of two sources of a target the first counts.
    """
    sources: dict[str, str] = {}
    for source, target, _ in table.targets:
        sources.setdefault(target, source.split(".")[-1])
    return conform(df, sources, schema or target_schema([table]))
