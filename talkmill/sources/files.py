"""Small files by Hadoop's file systems, so that any store that Spark reaches will do."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Conflict(RuntimeError):
    """Another writer has published this version."""


class Files:
    """Small files of a folder, by Hadoop's file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = jvm = spark._jvm
        self._path = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join((root, *parts)))
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("x").getFileSystem(self._conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        self._none = spark.sparkContext._gateway.new_array(rename, 1)
        self._none[0] = rename.NONE
        self._io = jvm.org.apache.commons.io.IOUtils

    def names(self, folder: str) -> list[str]:
        where = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def read(self, name: str) -> dict:
        stream = self._fs.open(self._path(name))
        try:
            return json.loads(bytes(self._io.toByteArray(stream)))
        finally:
            stream.close()

    def move(self, name: str, folder: str) -> None:
        """A file or folder to another folder, which is made."""
        to = self._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        self._fs.mkdirs(to.getParent())
        if not self._fs.rename(self._path(name), to):
            raise OSError(f"could not move {name} to {folder}")

    def create(self, name: str, document: dict) -> None:
        """The whole file or none; Conflict if it is there."""
        part = self._path(f"_part-{uuid.uuid4().hex}")
        stream = self._fs.create(part, False)
        stream.write(bytearray(json.dumps(document, ensure_ascii=False).encode()))
        stream.close()
        try:
            self._fs.mkdirs(self._path(name).getParent())
            self._context.rename(part, self._path(name), self._none)
        except Exception as e:
            self._fs.delete(part, False)
            if "FileAlreadyExistsException" in str(e):
                raise Conflict(name) from None
            raise
