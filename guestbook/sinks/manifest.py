"""Published folders: what readers see is what the newest manifest names.

Data is written aside, each time into a folder of its own, and then one small file says which folder stands for which name. It appears
by a rename, so readers see all of a publication or nothing of it, and a failure half-way leaves the one before. A manifest has an entry for
each name (a table, a day, a batch), never one for a file or a row.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from guestbook.sources.files import _file_system, _list

#: Hidden from Spark's readers by its first character.
MANIFESTS = "_manifests"
PARTS = "parts"


class Conflict(RuntimeError):
    """Somebody else published since the state was read."""


@dataclass(frozen=True)
class State:
    """Folders by name, relative to the root, and whatever marks the publisher keeps beside them."""

    version: int = 0
    folders: Mapping[str, str] = field(default_factory=dict)
    marks: Mapping[str, str] = field(default_factory=dict)


class Published:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self) -> list[int]:
        names = (name for name, is_folder in _list(self.spark, f"{self.root}/{MANIFESTS}") if not is_folder)
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _file(self, version: int) -> str:
        return f"{self.root}/{MANIFESTS}/{version:012d}.json"

    def _read(self, version: int) -> State:
        [(text,)] = self.spark.read.option("wholetext", True).text(self._file(version)).collect()
        return State(version, **json.loads(text))

    def state(self) -> State:
        versions = self._versions()
        return self._read(versions[-1]) if versions else State()

    def fresh(self, label: str) -> str:
        """A folder nobody has written to, relative to the root."""
        return f"{PARTS}/{label}-{uuid.uuid4().hex}"

    def path(self, folder: str) -> str:
        return f"{self.root}/{folder}"

    def write(self, df: DataFrame, label: str, partition_by: Iterable[str] = ()) -> str:
        """``df`` in a fresh folder, which no reader sees yet."""
        folder = self.fresh(label)
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(self.path(folder))
        return folder

    def publish(self, after: State, folders: Mapping[str, str | None], marks: Mapping[str, str] | None = None) -> State:
        """The state ``after`` with some names replaced, or left out where the folder is None, as the newest."""
        named = {**after.folders, **folders}
        state = State(
            after.version + 1, {n: f for n, f in sorted(named.items()) if f is not None}, {**after.marks, **(marks or {})}
        )
        text = json.dumps({"folders": state.folders, "marks": state.marks})
        system, target = _file_system(self.spark, self._file(state.version))
        draft = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{MANIFESTS}/.{uuid.uuid4().hex}")
        out = system.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if system.exists(target) or not system.rename(draft, target):
            system.delete(draft, False)
            raise Conflict(f"version {state.version} of {self.root} is there already")
        return state

    def read(
        self, names: Iterable[str] | None = None, schema: StructType | str | None = None, state: State | None = None
    ) -> DataFrame | None:
        """Rows of the names given (all by default) that are published; none if none is."""
        known = (state or self.state()).folders
        folders = [known[n] for n in (known if names is None else names) if n in known]
        if not folders:
            return None
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(*map(self.path, folders))

    def clear(self, keep: int = 2) -> int:
        """Delete manifests but the ``keep`` newest, and the parts that those don't name; how many parts went.

        Not while somebody writes: what is written but not yet published goes too.
        """
        versions = self._versions()
        for old in versions[: max(0, len(versions) - keep)]:
            system, target = _file_system(self.spark, self._file(old))
            system.delete(target, False)
        named = [f for v in self._versions() for f in self._read(v).folders.values()]
        used = {f.removeprefix(f"{PARTS}/").split("/")[0] for f in named}
        gone = [name for name, _ in _list(self.spark, f"{self.root}/{PARTS}") if name not in used]
        for name in gone:
            system, target = _file_system(self.spark, f"{self.root}/{PARTS}/{name}")
            system.delete(target, True)
        return len(gone)
