"""Small files in the store that the session's own file systems reach."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    folder: bool
    modified: float


class Store:
    """A folder of any file system that Spark is configured for, its credentials included."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._io = spark._jvm.org.apache.hadoop.io

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}" if name else self.root)

    def create(self, name: str, text: str) -> bool:
        """Write a file that must not be there yet; False if it is.

        Exclusive as far as the store creates files exclusively.  A writer that dies leaves
        the name taken and the text empty or cut short.
        """
        try:
            out = self._fs.create(self._at(name), False)
        except Py4JJavaError as error:
            if "AlreadyExists" not in error.java_exception.getClass().getName() and not self.exists(name):
                raise
            return False
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True

    def read(self, name: str) -> str | None:
        """The text of a file; None if it is not there."""
        if not self.exists(name):
            return None
        source = self._fs.open(self._at(name))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def exists(self, name: str = "") -> bool:
        return bool(self._fs.exists(self._at(name)))

    def list(self, name: str = "") -> list[Entry]:
        """Entries of a folder by name; none if it is not there."""
        if not self.exists(name):
            return []
        found = [
            Entry(s.getPath().getName(), bool(s.isDirectory()), s.getModificationTime() / 1000)
            for s in self._fs.listStatus(self._at(name))
        ]
        return sorted(found, key=lambda e: e.name)

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)
