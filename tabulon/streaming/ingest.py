"""Structured Streaming: incremental ingest, upsert, scoring, health windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.operators.score import score, score_with_lookup
from tabulon.operators.train import SavedModel
from tabulon.sources.feature_table import FeatureTable


_BATCH = "_batch_id"  # the folder of each micro-batch


def stream_files(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
                 files_per_batch: int | None = None) -> DataFrame:
    """A stream of the files in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append everything that is there now to a parquet folder, exactly once, and stop."""
    (stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).outputMode("append").start().awaitTermination())


def ingest_files(spark: SparkSession, folder: str, schema, out: str, checkpoint: str, fmt: str = "parquet") -> DataFrame:
    """Take the new files of the folder into ``out``; a rerun adds nothing."""
    run_available(stream_files(spark, folder, schema, fmt), out, checkpoint)
    return spark.read.parquet(out)


def latest_per_key(df: DataFrame, keys, ts: str) -> DataFrame:
    """One row per key, the one with the largest ts (ties by the other columns): a map-side
    combined aggregate, so a key with many rows costs no more than its partial results."""
    others = [c for c in df.columns if c not in (*keys, ts)]
    newest = F.max(F.struct(F.col(ts), *[F.col(c) for c in others])).alias("_n")
    return df.groupBy(*keys).agg(newest).select(*keys, "_n.*").select(*df.columns)


def merge_stream(stream: DataFrame, table: str, ts: str, checkpoint: str) -> None:
    """Upsert the latest row per key of each micro-batch into a feature table; a batch that comes
    late does not replace newer rows.

    The batch number is stored in the table's commit, so a batch that is run again after a
    failure changes nothing.
    """
    spark = stream.sparkSession

    def apply(batch: DataFrame, batch_id: int) -> None:
        target = FeatureTable(spark, table)
        done = target.table.info().get("batches", {})
        if done.get(checkpoint, -1) >= batch_id:
            return
        fresh = latest_per_key(batch, target.keys, ts)
        target.merge(fresh, newer_by=ts, batches={**done, checkpoint: batch_id})

    (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def score_stream(stream: DataFrame, model, out: str, checkpoint: str) -> DataFrame:
    """Score a stream with the batch operators, exactly once.

    A model with saved lookups scores each micro-batch with the batch lookup (hot keys are
    spread there too); a batch that is run again replaces its own output folder.  A column named like
    that folder, ``_batch_id``, is refused.
    """
    spark = stream.sparkSession
    if not (isinstance(model, SavedModel) and model.lookups):
        run_available(score(stream, model), out, checkpoint)
        return spark.read.parquet(out)
    if _BATCH in stream.columns:
        raise ValueError(f"the column {_BATCH} names the folders of the output")

    def apply(batch: DataFrame, batch_id: int) -> None:
        score_with_lookup(batch, model).write.mode("overwrite").parquet(f"{out}/{_BATCH}={batch_id}")

    (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out).drop(_BATCH)


def health_windows(df: DataFrame, ts: str, size: str, is_error, value: str, watermark: str | None = None,
                   by=()) -> DataFrame:
    """(window_start, window_end, requests, errors, error_rate, p50, p95) per tumbling window.

    The same call on a stream; ``watermark`` drops rows later than that.
    """
    rows = df.withColumn("_ts", F.col(ts).cast("timestamp"))
    if watermark:
        rows = rows.withWatermark("_ts", watermark)
    out = rows.groupBy(F.window("_ts", size).alias("_w"), *by).agg(
        F.count(F.lit(1)).alias("requests"), F.sum(is_error.cast("long")).alias("errors"),
        F.percentile_approx(value, [0.5, 0.95], 10_000).alias("_q"))
    return out.select(
        *by, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "requests", "errors",
        (F.col("errors") / F.col("requests")).alias("error_rate"),
        F.element_at("_q", 1).alias("p50"), F.element_at("_q", 2).alias("p95"))
