"""Small marker and commit files in the store that a folder lies in, through
the same Hadoop client that Spark writes data with (any store, no local path)."""
from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self.path = path.rstrip("/")
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}")

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def names(self, name: str = "") -> list[str]:
        """Names in a folder, in order; none where there is no such folder."""
        at = self._at(name) if name else self._path(self.path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def create(self, name: str, text: str) -> bool:
        """Write a file that isn't there yet; False where another writer was first."""
        try:
            out = self._fs.create(self._at(name), False)
        except Exception as e:  # the gateway's own error or PySpark's form of it
            if "FileAlreadyExists" in str(e) or "already exists" in str(e):
                return False
            raise
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        return True

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
