"""Small files next to a table, through the cluster's own file system API (HDFS, object store, local)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Names below ``root``; every path is resolved by the session's Hadoop configuration."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self.root = root.rstrip("/")
        conf = spark._jsc.hadoopConfiguration()
        base = self._path("")
        self._fs = base.getFileSystem(conf)
        self._context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def names(self, pattern: str) -> list[str]:
        """Last parts of the names that match a glob pattern."""
        return [s.getPath().getName() for s in self._fs.globStatus(self._path(pattern)) or []]

    def age(self, name: str, now: float) -> float:
        return now - self._fs.getFileStatus(self._path(name)).getModificationTime() / 1000

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def put(self, name: str, text: str, replace: bool = False) -> bool:
        """Write a file whole or not at all; False where it is there already and may not be replaced."""
        folder = name.rpartition("/")[0]
        draft = self._path(f"{folder}/.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE if replace else rename.NONE
        if not replace and self.exists(name):
            self._fs.delete(draft, False)
            return False
        try:
            self._context.rename(draft, self._path(name), options)
        except Exception:
            self._fs.delete(draft, False)
            if not replace and self.exists(name):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
