"""Feature tables: a keyed, described, versioned parquet table with upsert."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.sources.tables import VersionedTable


def key_check(df: DataFrame, keys) -> tuple[int, bool]:
    """(rows, unique): unique when every key occurs once and holds no NULL.  One combined aggregate."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    row = df.groupBy(*keys).count().agg(
        F.sum("count").alias("rows"), F.max("count").alias("most"), F.max(any_null).alias("nulls")).first()
    return row["rows"] or 0, (row["most"] or 1) == 1 and not row["nulls"]


def merge_frames(target: DataFrame, source: DataFrame, keys, newer_by: str | None = None) -> DataFrame:
    """Upsert: matched keys take the supplied columns (a NULL in the source wins), new keys are
    added, other rows and columns are kept.  Both sides must be unique by key.

    With ``newer_by``, a matched row is left alone if its value of that column is later than the
    source's, so feeds that arrive out of order end in the same state."""
    keys = list(keys)
    unknown = [c for c in source.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    t = target.withColumn("_old", F.lit(True)).alias("t")
    s = source.withColumn("_new", F.lit(True)).alias("s")
    joined = t.join(s, [F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in keys], "full_outer")
    take = F.col("_new")
    if newer_by:
        take = take & (F.col(f"t.`{newer_by}`").isNull() | (F.col(f"s.`{newer_by}`") >= F.col(f"t.`{newer_by}`")))
    take = F.coalesce(take, F.lit(False))
    out = []
    for f in target.schema.fields:
        c = f.name
        if c in keys:
            value = F.coalesce(F.col(f"t.`{c}`"), F.col(f"s.`{c}`"))
        elif c in source.columns:
            value = F.when(take, F.col(f"s.`{c}`").cast(f.dataType)).otherwise(F.col(f"t.`{c}`"))
        else:
            value = F.col(f"t.`{c}`")
        out.append(value.cast(f.dataType).alias(c))
    return joined.select(*out)


# Rows of a bucket, about, when a new table's buckets are not given.
BUCKET_ROWS = 1_000_000
_BUCKET = "_bucket"


class FeatureTable:
    """One writer at a time; every write is a new version, readers are not disturbed.

    Rows lie in a fixed number of buckets by the hash of their key, sorted inside.  A version names the folder of each
    bucket, so an upsert writes the buckets that its keys fall into and takes over the others as they are.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.table = VersionedTable(spark, path)

    @property
    def keys(self) -> list[str]:
        return self.table.info()["keys"]

    @property
    def description(self) -> str:
        return self.table.info()["description"]

    @property
    def rows(self) -> int:
        return self.table.info()["rows"]

    def read(self, version: int | None = None, near: DataFrame | None = None) -> DataFrame:
        """The rows of a version; with ``near``, a frame that has the key columns, only the buckets of its keys.

        Looking up few keys then reads few files.  ``near`` is scanned for its buckets, so hand in a stored frame.
        """
        info = self.table.info(version)
        return self._of(info, None if near is None else self._touched(near, info))

    def _of(self, info: dict, buckets: list[int] | None = None) -> DataFrame:
        spark, parts = self.table.spark, info["parts"]
        schema = T.StructType.fromJson(json.loads(info["schema"]))
        chosen = parts if buckets is None else {b: parts[str(b)] for b in buckets if str(b) in parts}
        if not chosen:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*[f"{self.table.path}/{folder}" for folder, _ in chosen.values()])

    @staticmethod
    def _bucket_of(df: DataFrame, info: dict):
        schema = T.StructType.fromJson(json.loads(info["schema"]))
        # the same hash whatever type the caller's key has
        cells = [F.col(f"`{k}`").cast(schema[k].dataType) for k in info["keys"]]
        return F.pmod(F.xxhash64(*cells), F.lit(info["buckets"])).cast("int")

    def _touched(self, df: DataFrame, info: dict) -> list[int]:
        # at most one row per bucket
        return sorted(r[0] for r in df.select(self._bucket_of(df, info)).distinct().collect())

    def _stored(self, df: DataFrame, info: dict, version: int) -> dict:
        """Writes the rows by bucket; bucket -> (folder, rows)."""
        folder = f"data/{version:08d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.table.path}/{folder}"
        (df.withColumn(_BUCKET, self._bucket_of(df, info)).repartition(_BUCKET).sortWithinPartitions(_BUCKET, *info["keys"])
         .write.partitionBy(_BUCKET).parquet(path))
        written = df.sparkSession.read.schema(T.StructType([*df.schema, T.StructField(_BUCKET, T.IntegerType())])).parquet(path)
        counts = written.groupBy(_BUCKET).count().collect()  # one row per bucket, from the file footers
        return {str(r[0]): [f"{folder}/{_BUCKET}={r[0]}", r[1]] for r in counts}

    @classmethod
    def create(cls, df: DataFrame, path: str, keys, description: str = "", buckets: int | None = None) -> "FeatureTable":
        """Write the frame as a feature table; keys must be unique and not NULL."""
        made = cls(df.sparkSession, path)
        if made.table.version():
            raise ValueError(f"feature table exists: {path}")
        if _BUCKET in df.columns:
            raise ValueError(f"a feature table keeps the name {_BUCKET} for itself")
        rows, unique = key_check(df, keys)
        if not unique:
            raise ValueError(f"rows are not unique by {list(keys)}")
        info = {"keys": list(keys), "description": description, "schema": df.schema.json(),
                "buckets": buckets or max(1, -(-rows // BUCKET_ROWS))}
        made.table.commit(0, **info, rows=rows, parts=made._stored(df, info, 1))
        return made

    def merge(self, source: DataFrame, newer_by: str | None = None, **more) -> int:
        """Upsert the rows; returns the new version.  Buckets without a source key are neither read nor written."""
        base = self.table.version()
        info = self.table.info(base)
        if not key_check(source, info["keys"])[1]:
            raise ValueError(f"source rows are not unique by {info['keys']}")
        touched = self._touched(source, info)
        merged = merge_frames(self._of(info, touched), source, info["keys"], newer_by)
        parts = {**info["parts"], **self._stored(merged, info, base + 1)}
        kept = {k: v for k, v in info.items() if k not in ("parts", "rows")}
        return self.table.commit(base, **{**kept, **more}, parts=parts, rows=sum(n for _, n in parts.values()))

    def vacuum(self, keep: int = 1) -> int:
        """Drop all but the last ``keep`` versions, and the folders that only those used; returns how many folders went.

        Readers of a dropped version fail, so run it when none is left.
        """
        last = self.table.version()
        held = {folder for v in range(max(1, last - keep + 1), last + 1) if v in self.table.versions()
                for folder, _ in self.table.info(v)["parts"].values()}
        gone = {folder for v in self.table.versions() if v <= last - keep
                for folder, _ in self.table.info(v)["parts"].values()} - held
        for v in self.table.versions():
            if v <= last - keep:
                self.table.forget(v)
        for folder in gone:
            self.table.drop(folder)
        return len(gone)
