"""The manifest of a dated snapshot: what a complete one consists of.

``_manifest.json`` lies beside the files of a date (its name hides it from
Spark's readers) and is written last: rows, schema, content fingerprint, and the
name and size of every file. It is checked while a read is planned, on the
driver, by one listing of the date's folder; no job runs.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from mdmspark.operators.fingerprint import Fingerprint

MANIFEST = "_manifest.json"


class SnapshotError(RuntimeError):
    """A snapshot is not what its manifest, or the caller, says."""


@dataclass(frozen=True)
class Manifest:
    fingerprint: Fingerprint
    schema: StructType
    files: dict[str, int]
    """bytes of each file"""

    @property
    def rows(self) -> int:
        return self.fingerprint.rows

    def to_json(self) -> str:
        return json.dumps({"version": 1, "rows": self.rows, "fingerprint": dict(self.fingerprint.parts), "schema": json.loads(self.schema.json()), "files": self.files})

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        m = json.loads(text)
        return cls(Fingerprint(m["rows"], m["fingerprint"]), StructType.fromJson(m["schema"]), m["files"])


class Store:
    """The few file operations that snapshots need, on whatever store a path names."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark._jvm
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path))) if self.exists(path) else []

    def files(self, path: str) -> dict[str, int]:
        """Names and bytes of the files that a reader would see in a folder."""
        found = {s.getPath().getName(): s.getLen() for s in self._fs.listStatus(self._path(path)) if not s.isDirectory()}
        return {n: size for n, size in sorted(found.items()) if not n.startswith(("_", "."))}

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(text.encode())
        finally:
            stream.close()

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def move(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, path: str) -> bool:
        return self._fs.delete(self._path(path), True)


def read_manifest(store: Store, folder: str) -> Manifest | None:
    """The manifest in a folder; None if there is none, or only a part of one."""
    path = f"{folder}/{MANIFEST}"
    if not store.exists(path):
        return None
    try:
        return Manifest.from_json(store.read(path))
    except ValueError:
        return None


def check_files(store: Store, folder: str, manifest: Manifest) -> None:
    """Raise unless the folder holds exactly the manifest's files."""
    found = store.files(folder)
    faults = [f"missing {n}" for n in manifest.files if n not in found]
    faults += [f"unknown {n}" for n in found if n not in manifest.files]
    faults += [f"{n} has {found[n]} bytes, not {size}" for n, size in manifest.files.items() if n in found and found[n] != size]
    if faults:
        raise SnapshotError(f"{folder}: {len(faults)} files are not as committed: " + "; ".join(faults[:5]))


def check_schema(folder: str, manifest: Manifest, declared: StructType) -> None:
    """Raise unless every declared column was written, with the declared type."""
    written = {f.name: f.dataType for f in manifest.schema.fields}
    faults = [f"{f.name} is declared {f.dataType.simpleString()}, written {written[f.name].simpleString() if f.name in written else 'never'}"
              for f in declared.fields if written.get(f.name) != f.dataType]
    if faults:
        raise SnapshotError(f"{folder}: " + "; ".join(faults))
