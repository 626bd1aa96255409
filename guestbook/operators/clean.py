"""Cleaning of a raw frame: names, schema, white space, null rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from guestbook.functions.text import squeeze

NO_COLUMN = "null"  # the mapping's word for "no column"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def rename_dots(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns whose names differ only in case.

    Columns are marked by position, so a genuine column is never lost for its name.
    """
    positions = [f"c{i}" for i in range(len(df.columns))]
    first: dict[str, int] = {}
    for i, name in enumerate(df.columns):
        first.setdefault(name.lower(), i)
    if len(first) == len(df.columns):
        return df
    by_position = df.toDF(*positions)
    return by_position.select(*[F.col(positions[i]).alias(df.columns[i]) for i in first.values()])


def _leaves(kind: DataType) -> Iterator[tuple[str, ...]]:
    """Names on the way to each value without fields of its own; a list is what it holds."""
    match kind:
        case StructType():
            yield from ((field.name, *rest) for field in kind for rest in _leaves(field.dataType))
        case ArrayType(elementType=StructType() as held):
            yield from _leaves(held)
        case _:
            yield ()


def leaf_paths(schema: StructType) -> list[str]:
    """Lower-case dotted paths of all leaves, looking through arrays of structs."""
    return [".".join(names).lower() for names in _leaves(schema)]


def ensure_columns(df: DataFrame, paths: Iterable[str]) -> DataFrame:
    """Add a null text column for every mapped path the frame lacks, under its leaf name."""
    present = set(leaf_paths(df.schema)) | {c.lower() for c in df.columns}
    missing: dict[str, str] = {}
    for path in paths:
        leaf = path.split(".")[-1]
        if path != NO_COLUMN and path.lower() not in present and leaf.lower() not in present:
            missing.setdefault(leaf.lower(), leaf)
    if not missing:
        return df
    return df.withColumns({leaf: F.lit(None).cast("string") for leaf in missing.values()})


def _type_at(schema: StructType, path: str) -> DataType | None:
    current: DataType = schema
    for part in path.split("."):
        if not isinstance(current, StructType):
            return None
        fields = {f.name.lower(): f.dataType for f in current.fields}
        if part.lower() not in fields:
            return None
        current = fields[part.lower()]
    return current


def normalise(df: DataFrame, paths: Iterable[str], as_text: bool = False) -> DataFrame:
    """Squeeze white space in the mapped columns and lift mapped struct fields to the top.

    One projection does it all. Arrays and timestamps are left alone. A struct that gave a
    field up is dropped. ``as_text`` also turns mapped numbers and dates into text.
    """
    upper = bool(df.columns) and df.columns[0].isupper()
    tops = {c.lower(): c for c in df.columns}
    squeezed: set[str] = set()
    lifted: dict[str, str] = {}
    for path in dict.fromkeys(paths):
        top = tops.get(path.split(".")[0].lower())
        if path == NO_COLUMN or top is None:
            continue
        kind = df.schema[top].dataType.typeName()
        if kind in ("array", "timestamp", "timestamp_ntz"):
            continue
        if "." not in path:
            squeezed.add(top)
        elif _type_at(df.schema, path) is not None:
            leaf = path.split(".")[-1]
            lifted[path] = leaf.upper() if upper else leaf
    dropped = {tops[p.split(".")[0].lower()] for p in lifted}

    def clean(path: str, name: str):
        value = F.col(".".join(quoted(p) for p in path.split(".")))
        dtype = _type_at(df.schema, path)
        if isinstance(dtype, StringType):
            value = squeeze(value)
        elif as_text:
            value = value.cast("string")
        return value.alias(name)

    columns = []
    for c in df.columns:
        if c in dropped:
            continue
        columns.append(clean(c, c.upper() if upper else c) if c in squeezed else F.col(quoted(c)))
    kept = [c for c in df.columns if c not in dropped]
    clash = {n.lower() for n in lifted.values()} & {c.lower() for c in kept}
    if clash or len({n.lower() for n in lifted.values()}) < len(lifted):
        raise ValueError(f"lifted fields share a name with another column: {sorted(lifted)}")
    return df.select(*columns, *[clean(path, name) for path, name in lifted.items()])


def drop_empty_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows null in every column, or in every column of ``subset``."""
    return df.dropna(how="all", subset=list(subset) if subset else None)


def drop_null_records(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Drop rows null in everything but the key columns."""
    held = {k.lower() for k in keys}
    return drop_empty_rows(df, [c for c in df.columns if c.lower() not in held])


def require(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def sentinel_to_null(df: DataFrame, word: str = "null") -> DataFrame:
    """Turn the text ``null`` into a null in every text column."""
    return df.replace(word, None)


def empty_to_null(df: DataFrame) -> DataFrame:
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[F.nullif(F.col(quoted(c)), F.lit("")).alias(c) if c in texts else F.col(quoted(c)) for c in df.columns])


def to_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(quoted(c)).cast("string").alias(c) for c in df.columns])
