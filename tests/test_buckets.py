"""Feature tables by key bucket: what an upsert writes, what a lookup reads."""

import pytest
from pyspark.sql import functions as F

from tabulon.plans.shared import scratch
from tabulon.sources.feature_table import FeatureTable


@pytest.fixture()
def made(spark):
    df = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("f"), F.lit("x").alias("s"))
    return FeatureTable.create(df, scratch(spark, "buckets"), ["k"], "numbers", buckets=16)


def test_an_upsert_writes_the_buckets_of_its_keys_only(spark, made, rows):
    before = made.table.info()
    assert before["rows"] == 2000 and len(before["parts"]) == 16
    assert all(n > 60 for _, n in before["parts"].values())
    # 1 % of the keys, all of few buckets
    keys = [r.k for r in made.read(near=spark.createDataFrame([(3,), (4,)], "k long")).limit(20).collect()]
    source = spark.createDataFrame([(k, -1) for k in keys] + [(5_000_000, -2)], "k int, f int")
    made.merge(source)
    after = made.table.info()
    touched = {b for b in after["parts"] if after["parts"][b] != before["parts"].get(b)}
    assert 1 <= len(touched) <= 3 and after["rows"] == 2001
    want = {k: (k * 2, "x") for k in range(2000)} | {k: (-1, "x") for k in keys} | {5_000_000: (-2, None)}
    assert {r.k: (r.f, r.s) for r in made.read().collect()} == want
    assert {r.k: r.f for r in made.read(1).collect()} == {k: k * 2 for k in range(2000)}


def test_a_lookup_of_few_keys_reads_few_files(spark, made):
    near = made.read(near=spark.createDataFrame([(7,), (None,)], "k int"))
    assert 1 <= len(near.inputFiles()) <= 2 < len(made.read().inputFiles())
    assert near.filter("k = 7").count() == 1
    assert made.read(near=spark.createDataFrame([], "k long")).count() == 0


def test_vacuum_keeps_what_the_last_versions_use(spark, made):
    for i in range(3):
        made.merge(spark.createDataFrame([(i, i)], "k long, f long"))
    now = {r.k: r.f for r in made.read().collect()}
    assert made.table.versions() == [1, 2, 3, 4]
    gone = made.vacuum(keep=2)
    assert gone >= 1 and made.table.versions() == [3, 4]
    assert {r.k: r.f for r in made.read().collect()} == now and made.read(3).count() == 2000
    assert made.vacuum(keep=2) == 0
    made.merge(spark.createDataFrame([(1, 77)], "k long, f long"))
    assert made.table.version() == 5 and made.read().filter("f = 77").count() == 1


def test_empty_tables_and_several_keys(spark, rows):
    df = spark.createDataFrame([], "a int, b string, v double")
    table = FeatureTable.create(df, scratch(spark, "none"), ["a", "b"], buckets=4)
    assert table.read().count() == 0 and table.rows == 0
    table.merge(spark.createDataFrame([(1, "x", 0.5), (1, "y", None)], "a long, b string, v double"))
    table.merge(spark.createDataFrame([(1, "y", 2.0)], "a int, b string, v double"))
    assert rows(table.read()) == [(1, "x", 0.5), (1, "y", 2.0)] and table.rows == 2
    table.merge(df)
    assert table.rows == 2 and table.table.version() == 4
    with pytest.raises(ValueError):
        FeatureTable.create(df.withColumn("_bucket", F.lit(1)), scratch(spark, "name"), ["a"])
