"""Scans: dated snapshot folders, catalog tables, JDBC tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from guestbook.operators.conform import Schema, struct_of
from guestbook.sources.mapping import MappedTable

# Fixed value: formats a snapshot may come in; anything else is read as parquet.
FORMATS = ("parquet", "json", "csv")


def read_snapshot(spark: SparkSession, path: str, fmt: str = "parquet", schema: Schema | None = None) -> DataFrame:
    """Everything under one folder, sub-folders included."""
    reader = spark.read.format(fmt).option("recursiveFileLookup", True)
    if fmt == "csv":
        reader = reader.option("header", True)
    if schema:
        return reader.schema(struct_of(schema)).load(path)
    return reader.schema(infer_schema(spark, path, fmt)).load(path)


def infer_schema(spark: SparkSession, path: str, fmt: str = "parquet") -> StructType:
    """All columns of all files of a snapshot; files that type a column differently are an error.

    Columns whose names differ in case only are one. Text formats are read whole for this, so a
    caller that reads a table again keeps the schema and gives it to :func:`read_snapshot`.
    """
    # A session of its own: names that differ in case are two columns here, and only here.
    apart = spark.newSession()
    apart.conf.set("spark.sql.caseSensitive", "true")
    reader = apart.read.format(fmt).option("recursiveFileLookup", True)
    if fmt == "csv":
        reader = reader.option("header", True)
    elif fmt == "parquet":
        reader = reader.option("mergeSchema", True)
    return first_of_each(reader.load(path).schema)


def first_of_each(schema: StructType) -> StructType:
    """The schema without fields that repeat an earlier name in another case."""
    kept: dict[str, StructField] = {}
    for field in schema.fields:
        kept.setdefault(field.name.lower(), field)
    return StructType(list(kept.values()))


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _list(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """Names in a folder and whether each is a folder; empty when the folder is missing."""
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(folder))


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def latest_folder(spark: SparkSession, path: str) -> str:
    """Of a day's sub-folders the one with the greatest text after its last ``T``; else the day."""
    folders = [name for name, is_folder in _list(spark, path) if is_folder and not _hidden(name)]
    if not folders:
        return path
    return f"{path}/{max(folders, key=lambda name: name.split('T')[-1])}"


def detect_format(spark: SparkSession, path: str, first: bool = False) -> str:
    """Suffix of the last file listed; the older jobs went by the ``first``."""
    files = [name for name, is_folder in _list(spark, path) if not is_folder and not _hidden(name)]
    suffix = files[0 if first else -1].rsplit(".", 1)[-1] if files else ""
    return suffix if suffix in FORMATS else "parquet"


def snapshot_path(
    root: str, table: MappedTable, day: dt.date, databases: Mapping[str, str] | None = None
) -> str:
    return f"{root}/{table.folder(databases)}/{day:%Y/%m/%d}"


def find_snapshot(
    spark: SparkSession, root: str, table: MappedTable, day: dt.date, databases: Mapping[str, str] | None = None
) -> str | None:
    """Folder of the table's latest snapshot of the day; none when it has no files."""
    path = latest_folder(spark, snapshot_path(root, table, day, databases))
    return path if any(not _hidden(name) for name, _ in _list(spark, path)) else None


def load_tables(
    spark: SparkSession,
    tables: Sequence[MappedTable],
    root: str,
    day: dt.date,
    databases: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Lazy frames of all mapped tables that have a snapshot for the day."""
    frames = {}
    for table in tables:
        path = find_snapshot(spark, root, table, day, databases)
        if path is not None:
            frames[table.name] = read_snapshot(spark, path, detect_format(spark, path))
    return frames


def catalog_tables(spark: SparkSession, database: str) -> Iterator[tuple[str, DataFrame]]:
    for table in spark.catalog.listTables(database):
        yield table.name, spark.read.table(f"{database}.{table.name}")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    **properties: str,
) -> DataFrame:
    """A database table; with a numeric or date column to split on it is read in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if split_on and bounds:
        reader = reader.options(
            partitionColumn=split_on, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _file_system(spark, path)
    return fs.exists(folder)
