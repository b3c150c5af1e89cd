"""Reading and writing tables: delimited files, catalog tables, versioned folders."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabulon.sources.files import SmallFiles


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Delimited file with a header row; types are inferred only if no schema is given."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by (qualified) name, or a parquet folder when the name is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def write_table(df: DataFrame, name: str, mode: str = "overwrite") -> None:
    """Save as a catalog table.  To replace a table that ``df`` itself reads, use VersionedTable."""
    df.write.mode(mode).format("parquet").saveAsTable(name)


class VersionedTable:
    """A parquet table whose every write is a new folder, made current by one small commit file.

    Readers keep the version they planned with, so a table may be overwritten from itself, and
    a failed or retried job leaves no half-written current version.  Creating the commit file
    fails if another writer got there first.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._files = SmallFiles(spark)

    def version(self) -> int:
        """The current version; 0 before the first write."""
        return max(self.versions(), default=0)

    def info(self, version: int | None = None) -> dict:
        version = version or self.version()
        return json.loads(self._files.read(f"{self.path}/_commits/{version:08d}.json")) if version else {}

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{self.info(version)['folder']}")

    def write(self, df: DataFrame, expected: int | None = None, **info) -> int:
        """Write the rows as the next version and make it current."""
        base = self.version() if expected is None else expected
        folder = f"data/{base + 1:08d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.path}/{folder}")
        rows = self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}").count()  # from the file footers
        return self.commit(base, **info, folder=folder, rows=rows)

    def commit(self, base: int, **info) -> int:
        """Make what ``info`` describes the version after ``base``; fails if there is one already."""
        self._files.write(f"{self.path}/_commits/{base + 1:08d}.json", json.dumps(info))
        return base + 1

    def versions(self) -> list[int]:
        return sorted(int(n[:8]) for n in self._files.names(f"{self.path}/_commits") if n.endswith(".json") and n[:8].isdigit())

    def forget(self, version: int) -> None:
        """Remove a version's commit file, not its data; the current version stays."""
        if version == self.version():
            raise ValueError("the current version cannot be removed")
        self._files.delete(f"{self.path}/_commits/{version:08d}.json")

    def drop(self, folder: str) -> None:
        """Remove a data folder that no version names any more."""
        self._files.delete(f"{self.path}/{folder}")


def snapshot(df: DataFrame, cols, n: int, order_by) -> DataFrame:
    """The first n rows in key order, on the named columns (top-k, not a full sort)."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.select(*dict.fromkeys([*cols, *keys])).orderBy(*keys).limit(n).select(*cols)
