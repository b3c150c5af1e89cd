"""Small text files beside tables and models, on whatever file system Spark uses."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class SmallFiles:
    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway

    def _open(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def names(self, folder: str) -> list[str]:
        fs, p = self._open(folder)
        return [s.getPath().getName() for s in fs.listStatus(p) if not s.getPath().getName().startswith(".")] if fs.exists(p) else []

    def write(self, path: str, text: str) -> None:
        """Create the file whole: written beside its place and then renamed; fails if it exists."""
        fs, p = self._open(path)
        beside = self._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
        out = fs.create(beside, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        hadoop = self._jvm.org.apache.hadoop.fs
        keep = self._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            hadoop.FileContext.getFileContext(fs.getUri(), self._conf).rename(
                fs.makeQualified(beside), fs.makeQualified(p), keep)
        except Exception:
            fs.delete(beside, False)
            raise

    def read(self, path: str) -> str:
        fs, p = self._open(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        """Remove a file, or a folder with all it holds."""
        fs, p = self._open(path)
        fs.delete(p, True)
