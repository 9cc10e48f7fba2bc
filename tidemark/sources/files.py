"""Folders and small files on any Hadoop path: what Spark's readers and writers have no call for."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Files:
    """The file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._jvm = spark._jvm
        self._system = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        """Rename; the folder of the target is made, a target that is there is an error."""
        self._system.mkdirs(self._path(target).getParent())
        if not self._system.rename(self._path(source), self._path(target)):
            raise OSError(f"can't move {source} to {target}")

    def names(self, folder: str) -> list[str]:
        """Names in a folder, in order; none if it isn't there."""
        return sorted(f.getPath().getName() for f in self._system.listStatus(self._path(folder))) if self.exists(folder) else []

    def write_json(self, path: str, value) -> None:
        """A small file that is there as a whole or not at all."""
        beside = f"{path}.{uuid.uuid4().hex}"
        out = self._system.create(self._path(beside))
        try:
            out.write(bytearray(json.dumps(value).encode()))
        finally:
            out.close()
        self.move(beside, path)

    def read_json(self, path: str):
        source = self._system.open(self._path(path))
        try:
            return json.loads(bytes(self._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(source)))
        finally:
            source.close()


def beside(path: str, name: str) -> str:
    """A new name next to a table, for what two writers must not share."""
    return f"{path.rstrip('/')}.{name}-{uuid.uuid4().hex}"
