"""Source -> raw -> trusted, one mapped table at a time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from guestbook.operators import audit, clean, quality
from guestbook.operators.conform import Schema
from guestbook.operators.dedupe import distinct_rows
from guestbook.operators.snapshots import placeholder_row
from guestbook.sinks.files import day_folder, land, write_parquet
from guestbook.sources import files
from guestbook.sources.mapping import MappedTable

# Systems whose column names carry dots and may repeat.
DOTTED_SYSTEMS = ("iterable_api", "splash_that", "golf_genius")

ZONE = "zone"


def clean_table(df: DataFrame, columns: Sequence[str], dotted: bool = False) -> DataFrame:
    """Distinct, non-empty rows with every mapped column present and tidy."""
    if dotted:
        df = clean.drop_duplicate_columns(clean.rename_dots(df))
    df = clean.drop_empty_rows(distinct_rows(df))
    return clean.normalise(clean.ensure_columns(df, columns), columns)


def verdicts(df: DataFrame, columns: Sequence[str], dotted: bool = False) -> DataFrame:
    """Cleaned rows with ``reject_reason``; the checks follow from the mapped columns."""
    tidy = clean_table(df, columns, dotted)
    return quality.split_quality(tidy, quality.email_column(columns), quality.phone_columns(columns))


def write_zones(rows: DataFrame, path: str, day: dt.date) -> Observation:
    """Trusted and quarantined rows of a day, written in one pass over the input.

    Each zone is a folder of its own, so a reader of one never opens the other's files. The
    whole day is replaced, a zone that has no rows this time included. The observation counts
    the rows written.
    """
    counted, observation = audit.counted(rows, "rows")
    zone = F.when(F.col(quality.REASON).isNull(), "trusted").otherwise("quarantine")
    write_parquet(counted.withColumn(ZONE, zone), day_folder(path, day), partition_by=[ZONE], whole=True)
    return observation


def read_zone(spark: SparkSession, path: str, day: dt.date, zone: str = "trusted") -> DataFrame:
    rows = spark.read.parquet(f"{day_folder(path, day)}/{ZONE}={zone}")
    return rows.drop(quality.REASON) if zone == "trusted" else rows


def _stand_in(spark: SparkSession, table: MappedTable, path: str, day: dt.date, carry: bool) -> None:
    before = day_folder(path, day - dt.timedelta(days=1))
    if carry and files.exists(spark, before):
        write_parquet(spark.read.parquet(before), day_folder(path, day), partition_by=[ZONE], whole=True)
        return
    names = dict.fromkeys(c.split(".")[-1] for c in table.columns if c != clean.NO_COLUMN)
    blank = placeholder_row(spark.createDataFrame([], ", ".join(f"`{c}` string" for c in names)))
    write_zones(blank.withColumn(quality.REASON, F.lit(None).cast("string")), path, day)


def raw_to_trusted(
    spark: SparkSession,
    tables: Iterable[MappedTable],
    raw_root: str,
    out_root: str,
    day: dt.date,
    databases: Mapping[str, str] | None = None,
    missing: str = "report",
    schemas: Mapping[str, Schema] | None = None,
) -> dict[str, int | None]:
    """Clean, check and write every table that has a raw snapshot; rows written by table.

    A mapped table without a snapshot counts as None. ``missing`` says what stands in for it: nothing
    (``report``), an all-null row under the mapped columns (``placeholder``), or the zones of the day
    before (``carry``; a placeholder where there are none). ``schemas`` by frame name spare the pass in
    which a text format is read to infer one.
    """
    if missing not in ("report", "placeholder", "carry"):
        raise ValueError(f"missing: {missing}")
    written: dict[str, int | None] = {}
    for table in tables:
        path = files.find_snapshot(spark, raw_root, table, day, databases)
        if path is None:
            written[table.name] = None
            if missing != "report":
                _stand_in(spark, table, f"{out_root}/{table.folder(databases)}", day, missing == "carry")
            continue
        schema = (schemas or {}).get(table.name)
        raw = files.read_snapshot(spark, path, files.detect_format(spark, path), schema)
        rows = verdicts(raw, table.columns, table.system in DOTTED_SYSTEMS)
        observed = write_zones(rows, f"{out_root}/{table.folder(databases)}", day)
        written[table.name] = observed.get["rows"]
    return written


def load_trusted(
    spark: SparkSession,
    tables: Iterable[MappedTable],
    root: str,
    day: dt.date,
    databases: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Lazy frames of the trusted zone by frame name; tables never written are left out."""
    frames = {}
    for table in tables:
        path = f"{root}/{table.folder(databases)}"
        if files.exists(spark, f"{day_folder(path, day)}/{ZONE}=trusted"):
            frames[table.name] = read_zone(spark, path, day)
    return frames


def land_database(spark: SparkSession, database: str, raw_root: str, system: str, day: dt.date) -> list[str]:
    """Copy every table of a catalog database to its dated raw folder."""
    names = []
    for name, df in files.catalog_tables(spark, database):
        land(df, f"{raw_root}/{system}/{name}", day)
        names.append(name)
    return names
