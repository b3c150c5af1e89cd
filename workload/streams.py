"""Structured Streaming queries: each runs to the end of what is there and returns its output."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.plans.shared import scratch
from tabulon.sources.feature_table import FeatureTable
from tabulon.operators import lookup as lk
from tabulon.operators.train import load_model, save_model
from tabulon.streaming import ingest
from workload.modelling import rule
from workload.registry import query, rounded, table


def event_stream(spark, d, folder=None):
    schema = table(spark, d, "events").schema
    # a glob, as the table may be one file or a folder of files
    return ingest.stream_files(spark, folder or f"{d}/events.parque[t]", schema)


def landed(spark, d, files=4):
    """The events as several files in a landing folder."""
    folder = scratch(spark, "landing")
    table(spark, d, "events").repartitionByRange(files, "event_id").write.parquet(folder)
    return folder


@query("ingest_files", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def ingest_files(spark, d):
    folder, out, log = landed(spark, d), scratch(spark, "ingested"), scratch(spark, "log")
    schema = table(spark, d, "events").schema
    ingest.ingest_files(spark, folder, schema, out, log)
    return ingest.ingest_files(spark, folder, schema, out, log)  # the rerun adds nothing


@query("merge_stream", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts, arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY user_id""")
def merge_stream(spark, d):
    folder, path, log = landed(spark, d), scratch(spark, "latest"), scratch(spark, "log")
    schema = table(spark, d, "events").schema
    empty = spark.createDataFrame([], schema).select("user_id", "event_id", "ts", "value")
    FeatureTable.create(empty, path, ["user_id"], "latest event per user")
    stream = ingest.stream_files(spark, folder, schema, files_per_batch=1).select("user_id", "event_id", "ts", "value")
    ingest.merge_stream(stream, path, "ts", log)
    ingest.merge_stream(stream, path, "ts", log)
    return FeatureTable(spark, path).read()


@query("score_stream", """
SELECT event_id, user_id, event_type, value, CAST(value > 20 AND event_type <> 'error' AS INTEGER) AS prediction FROM events""")
def score_stream(spark, d):
    stream = event_stream(spark, d).select("event_id", "user_id", "event_type", "value")
    return ingest.score_stream(stream, rule("value > 20 AND event_type <> 'error'"), scratch(spark, "scored"), scratch(spark, "log"))


@query("score_stream_lookup", """
SELECT event_id, user_id, value, mean_value, CAST(value > mean_value AS INTEGER) AS prediction
FROM events JOIN (SELECT user_id, round(avg(value), 8) AS mean_value FROM events GROUP BY 1) USING (user_id)""")
def score_stream_lookup(spark, d):
    means = rounded(table(spark, d, "events").groupBy("user_id").agg(F.avg("value").alias("mean_value")), 8)
    made = FeatureTable.create(means, scratch(spark, "means"), ["user_id"], "mean value")
    spec = lk.Lookup(made.table.path, ["mean_value"], ["user_id"]).spec()
    stream = event_stream(spark, d).select("event_id", "user_id", "value")
    example = table(spark, d, "events").select("user_id", "value").join(made.read(), "user_id")
    model = load_model(spark, save_model(rule("value > mean_value"), scratch(spark, "model"), example, [spec]))
    return ingest.score_stream(stream, model, scratch(spark, "scored"), scratch(spark, "log"))


HEALTH_SQL = """
SELECT CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS window_start,
  CAST(date_trunc('{unit}', ts) AS TIMESTAMP) + INTERVAL 1 {unit} AS window_end, count(*) AS requests,
  count(*) FILTER (event_type = 'error') AS errors, round(count(*) FILTER (event_type = 'error') / count(*), 6) AS error_rate
FROM events GROUP BY 1"""


def _plain_times(df):
    return rounded(df).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("health_windows", HEALTH_SQL.format(unit="hour"))
def health_windows(spark, d):
    out = ingest.health_windows(table(spark, d, "events"), "ts", "1 hour", F.col("event_type") == "error", "value")
    return _plain_times(out.drop("p50", "p95"))


@query("health_windows_quantiles", """
SELECT event_type, CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
  CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end, count(*) AS requests,
  count(*) FILTER (event_type = 'error') AS errors, CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END AS error_rate,
  quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95
FROM events GROUP BY 1, 2""")
def health_windows_quantiles(spark, d):
    out = ingest.health_windows(table(spark, d, "events"), "ts", "1 day", F.col("event_type") == "error", "value",
                                by=["event_type"])
    return _plain_times(out)


@query("health_windows_stream", f"""
SELECT * FROM ({HEALTH_SQL.format(unit='day')}) WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""")
def health_windows_stream(spark, d):
    """The same on a stream with a watermark: windows are emitted once they are closed."""
    stream = ingest.health_windows(event_stream(spark, d), "ts", "1 day", F.col("event_type") == "error", "value",
                                   watermark="2 hours").drop("p50", "p95")
    out = scratch(spark, "health")
    ingest.run_available(stream, out, scratch(spark, "log"))
    return _plain_times(spark.read.parquet(out))
