"""Several tables published together.

Each table is first written whole into a staging folder. A manifest there then names them,
which commits the lot; only after that are the former tables moved aside and the new ones
renamed into place. A job that dies before the manifest leaves the former tables as they were; one
that dies after it is finished by the next `recover`, which `publish` begins with.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

STAGING = "_staging"
MANIFEST = "_tables.json"
FORMER = "_former"


class _Files:
    """The few operations needed on the folder's file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.system = self._path(root).getFileSystem(self.conf)

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.system.exists(self._path(path))

    def children(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(f.getPath().getName() for f in self.system.listStatus(self._path(path)))

    def move(self, source: str, target: str) -> None:
        """Rename; a target that is there already makes it fail rather than be filled."""
        if self.exists(target):
            raise FileExistsError(target)
        self.system.mkdirs(self._path(target).getParent())
        if not self.system.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def delete(self, path: str) -> None:
        self.system.delete(self._path(path), True)

    def write_text(self, path: str, text: str) -> None:
        """Written under another name first, so that the name stands for a whole file."""
        stream = self.system.create(self._path(f"{path}.part"), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.move(f"{path}.part", path)

    def read_text(self, path: str) -> str:
        stream = self.system.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def _finish(files: _Files, root: str, stage: str) -> None:
    """Put a committed stage into place; every step may have been done before."""
    for name in json.loads(files.read_text(f"{stage}/{MANIFEST}")):
        new, current, former = f"{stage}/{name}", f"{root}/{name}", f"{stage}/{FORMER}/{name}"
        if not files.exists(new):
            continue
        if files.exists(current):
            files.move(current, former)
        files.move(new, current)
    _drop(files, root, stage)


def _drop(files: _Files, root: str, stage: str) -> None:
    files.delete(stage)
    if not files.children(f"{root}/{STAGING}"):
        files.delete(f"{root}/{STAGING}")


def recover(spark: SparkSession, root: str) -> None:
    """Finish stages that were committed, drop those that were not."""
    files, root = _Files(spark, root), root.rstrip("/")
    for name in files.children(f"{root}/{STAGING}"):
        stage = f"{root}/{STAGING}/{name}"
        if files.exists(f"{stage}/{MANIFEST}"):
            _finish(files, root, stage)
        else:
            _drop(files, root, stage)


def publish(spark: SparkSession, root: str, tables: dict[str, Callable[[str], None]]) -> None:
    """Write the tables, each by its function of a path, and replace those of the same names.

    One job at a time may publish to a folder. A table may be read from the folder it
    replaces, as that stays until all are written.
    """
    recover(spark, root)
    files, root = _Files(spark, root), root.rstrip("/")
    stage = f"{root}/{STAGING}/{uuid.uuid4().hex}"
    for name, write in tables.items():
        write(f"{stage}/{name}")
    files.write_text(f"{stage}/{MANIFEST}", json.dumps(sorted(tables)))
    _finish(files, root, stage)


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Write one table and put it in the place of a former one."""
    root, _, name = path.rstrip("/").rpartition("/")
    publish(spark, root or ".", {name: write})
