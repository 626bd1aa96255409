"""Projection of any source onto a declared schema, and unions of the results."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import StructType, _parse_datatype_string

Schema = Mapping[str, str]  # column name -> Spark type name, in output order


def struct_of(schema: Schema) -> StructType:
    """The schema as a Spark type; needs a live session."""
    return _parse_datatype_string(", ".join(f"{name} {kind}" for name, kind in schema.items()))


def _tolerant_cast(value: str, kind: str) -> str:
    """Cast that turns bad values into null; decimals in text are cut to whole numbers."""
    if kind in ("int", "bigint"):
        return f"coalesce(try_cast({value} as {kind}), try_cast(try_cast({value} as double) as {kind}))"
    return f"try_cast({value} as {kind})"


def conform(df: DataFrame, mapping: Mapping[str, str | Column], schema: Schema) -> DataFrame:
    """Emit exactly the columns of ``schema``, in order, each of its declared type.

    ``mapping`` gives the source column (dotted for a struct field) or an expression of a
    target column; a target it does not name is null.
    """
    unknown = set(mapping) - set(schema)
    if unknown:
        raise ValueError(f"not in the target schema: {sorted(unknown)}")
    given = {n: s for n, s in mapping.items() if isinstance(s, Column)}
    if given:
        df = df.select("*", *[value.alias(f"_given_{name}") for name, value in given.items()])
    columns = []
    for name, kind in schema.items():
        if name in given:
            value = _tolerant_cast(f"_given_{name}", kind)
        elif name in mapping:
            value = _tolerant_cast(".".join(f"`{part}`" for part in mapping[name].split(".")), kind)
        else:
            value = f"cast(null as {kind})"
        columns.append(f"{value} as {name}")
    return df.selectExpr(*columns)


def conform_each(df: DataFrame, mappings: Iterable[Mapping[str, str]], schema: Schema) -> DataFrame:
    """One row per mapping for every input row, in a single pass: say both addresses of an order."""
    rows = []
    for mapping in mappings:
        fields = [
            f"{_tolerant_cast(mapping[name], kind) if name in mapping else f'cast(null as {kind})'} as {name}"
            for name, kind in schema.items()
        ]
        rows.append(f"struct({', '.join(fields)})")
    return df.selectExpr(f"inline(array({', '.join(rows)}))")


def same_names(names: str | Iterable[str]) -> dict[str, str]:
    """Mapping for columns that already bear their target name."""
    return {n: n for n in (names.split() if isinstance(names, str) else names)}


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct(frames: Iterable[DataFrame]) -> DataFrame:
    return union_all(frames).distinct()
