"""Where intermediate results go, and when a side may be broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast side may have at most this many (narrow) rows.
BROADCAST_ROWS = 200_000
# Spark's setting that removes a query's shuffle files at its end; Spark before 4.1 ignores it.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may do without the setting; it then gets a temporary folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tabulon-")
    sc.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder, one parent per application."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tabulon-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write the frame out once, as a table in the shared folder, and read it from there.

    Cuts the lineage, survives the loss of executors, and later passes read only the columns
    they need.  The shuffle files of the write are removed when it ends, not when the driver next
    collects garbage.
    """
    path = scratch(df.sparkSession, label)
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard_scratch(spark: SparkSession) -> None:
    """Delete everything this application wrote with ``scratch``; call it when results are saved."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(
        f"{checkpoint_root(spark).rstrip('/')}/tabulon-{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting; above ``rows`` the join stays a shuffle join.

    ``df`` should be materialised or cheap, as it is counted here.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def settle(df: DataFrame, bounded: bool, rows: int = 10_000) -> tuple[DataFrame, list | None]:
    """Compute a small frame once.

    ``bounded`` frames (one row per column, say) come back as a local frame and its rows; others
    are written out, and turned local only after a count shows at most ``rows`` rows.
    """
    if not bounded:
        df = materialise(df)
        if df.limit(rows + 1).count() > rows:
            return df, None
    found = df.collect()
    return df.sparkSession.createDataFrame(found, df.schema), found
