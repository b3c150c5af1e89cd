import datetime as dt

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tabulon.operators import score as sc
from tabulon.operators.train import load_model, save_model
from tabulon.operators.lookup import Lookup
from tabulon.plans.shared import scratch
from tabulon.sources.feature_table import FeatureTable
from tabulon.streaming import ingest

SCHEMA = "id long, v double"


def rule(expression):
    return PipelineModel([SQLTransformer(statement=f"SELECT *, CAST(({expression}) AS DOUBLE) AS prediction FROM __THIS__")])


def test_ingest_takes_each_file_once(spark):
    landing, out, log = scratch(spark, "in"), scratch(spark, "out"), scratch(spark, "log")
    rows = spark.range(100).select("id", F.lit(1.0).alias("v"))
    rows.write.parquet(landing)
    assert ingest.ingest_files(spark, landing, SCHEMA, out, log).count() == 100
    assert ingest.ingest_files(spark, landing, SCHEMA, out, log).count() == 100
    rows.limit(30).write.mode("append").parquet(landing)
    assert ingest.ingest_files(spark, landing, SCHEMA, out, log).count() == 130


def test_ingest_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,2.0\n")
    out = ingest.ingest_files(spark, str(tmp_path), SCHEMA, scratch(spark, "out"), scratch(spark, "log"), fmt="csv")
    assert [tuple(r) for r in out.collect()] == [(1, 2.0)]


def test_merge_stream_keeps_the_latest_whatever_the_order(spark):
    landing, log = scratch(spark, "in"), scratch(spark, "log")
    schema = "k long, t int, v string"
    ft = FeatureTable.create(spark.createDataFrame([(1, 0, "start")], schema), scratch(spark, "ft"), ["k"])

    def feed(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(landing)
        ingest.merge_stream(ingest.stream_files(spark, landing, schema), ft.table.path, "t", log)
        return {r.k: (r.t, r.v) for r in ft.read().collect()}

    assert feed([(1, 5, "five"), (1, 3, "three"), (2, 1, "b")]) == {1: (5, "five"), 2: (1, "b")}
    assert feed([(1, 4, "late"), (2, 9, "c")]) == {1: (5, "five"), 2: (9, "c")}
    version = ft.table.version()
    ingest.merge_stream(ingest.stream_files(spark, landing, schema), ft.table.path, "t", log)
    assert ft.table.version() == version  # nothing new, nothing written


def test_a_repeated_batch_changes_nothing(spark):
    ft = FeatureTable.create(spark.createDataFrame([(1, 0)], "k long, t int"), scratch(spark, "ft"), ["k"])
    ft.merge(spark.createDataFrame([(1, 1)], "k long, t int"), batches={"log": 4})
    assert ft.table.info()["batches"] == {"log": 4} and ft.keys == ["k"]


def test_streaming_scores_equal_batch_scores(spark, rows):
    landing = scratch(spark, "in")
    df = spark.range(200).select("id", (F.col("id") % 7).cast("double").alias("v"))
    df.repartition(3).write.parquet(landing)
    ft = FeatureTable.create(df.select("id", (F.col("id") % 5).cast("double").alias("w")), scratch(spark, "ft"), ["id"])
    uri = save_model(rule("v > w"), scratch(spark, "m"), df, [Lookup(ft.table.path, ["w"], ["id"]).spec()])
    streamed = ingest.score_stream(ingest.stream_files(spark, landing, SCHEMA), load_model(spark, uri),
                                   scratch(spark, "out"), scratch(spark, "log"))
    assert rows(streamed) == rows(sc.score_with_lookup(df, uri))


def test_health_windows_edges(spark):
    def at(h, m=0):
        return dt.datetime(2024, 1, 1, h, m)

    df = spark.createDataFrame([(at(0), "error", 1.0), (at(0, 59), "ok", 3.0), (at(1), "ok", 5.0)],
                               "ts timestamp_ntz, kind string, value double")
    got = sorted(tuple(r) for r in ingest.health_windows(df, "ts", "1 hour", F.col("kind") == "error", "value").collect())
    # an event on the edge belongs to the later window
    assert [(r[2], r[3], r[4]) for r in got] == [(2, 1, 0.5), (1, 0, 0.0)]
    assert [r[0] for r in got] == [at(0), at(1)]


def test_events_later_than_the_watermark_are_dropped(spark):
    landing, out, log = scratch(spark, "in"), scratch(spark, "out"), scratch(spark, "log")
    schema = "ts timestamp, kind string, value double"

    def feed(*hours):
        data = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), "ok", 1.0) for h in hours]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = ingest.health_windows(ingest.stream_files(spark, landing, schema), "ts", "1 hour",
                                       F.col("kind") == "error", "value", watermark="1 hour")
        ingest.run_available(stream, out, log)
        return {r.window_start.hour: r.requests for r in spark.read.parquet(out).collect()}

    assert feed(1, 1.5, 5) == {1: 2}
    assert feed(1.2, 9) == {1: 2, 5: 1}  # 1.2 came too late
