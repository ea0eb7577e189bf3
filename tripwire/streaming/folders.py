"""A small folder of notes in any file system that Spark writes to."""
from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._root = path

    def _of(self, name: str | None = None):
        return self._path(self._root if name is None else f"{self._root}/{name}")

    def names(self) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self._of())] if self._fs.exists(self._of()) else []

    def has(self, name: str) -> bool:
        return self._fs.exists(self._of(name))

    def touch(self, name: str) -> None:
        self._fs.create(self._of(name), True).close()

    def put(self, name: str, data: bytes) -> None:
        """A whole file at once: it is written aside and then renamed."""
        out = self._fs.create(self._of("_" + name), True)
        out.write(data)
        out.close()
        self._fs.rename(self._of("_" + name), self._of(name))

    def remove(self, name: str) -> None:
        self._fs.delete(self._of(name), True)
