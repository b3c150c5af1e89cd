"""The order, skew and sharing helpers, against plain Python on data with one very hot group."""

import glob
import random
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabulon.plans import ordered, skew
from tabulon.plans.shared import broadcast_if_small, checkpoint_root, materialise, settle


@pytest.fixture(scope="module")
def hot(spark):
    """2,000 rows; one group holds half of them, one value a third."""
    rng = random.Random(3)
    data = []
    for i in range(2000):
        g = "hot" if i % 2 else f"g{rng.randrange(40)}"
        v = 0 if rng.random() < 0.34 else rng.randrange(500)
        data.append((i, g, v, rng.randrange(10)))
    return spark.createDataFrame(data, "id long, g string, v int, w int").repartition(7)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_dense_ids_equal_row_number(spark, hot, rows, parts):
    got = ordered.dense_ids(hot.repartition(parts), ["v", "id"], "n", start=1)
    want = hot.withColumn("n", F.row_number().over(Window.orderBy("v", "id")).cast("long"))
    assert rows(got) == rows(want)


def test_dense_ids_with_fully_equal_rows(spark):
    df = spark.createDataFrame([(1,)] * 500 + [(2,)] * 3, "a int").repartition(5)
    got = ordered.dense_ids(df, ["a"], "n")
    assert sorted(r["n"] for r in got.collect()) == list(range(503))
    assert sorted(r["n"] for r in got.filter("a = 2").collect()) == [500, 501, 502]


@pytest.mark.parametrize("by", [[], ["g"]])
def test_running_sum(spark, hot, rows, by):
    got = ordered.running(hot, ["v", "id"], by=by, sums={"s": "w"})
    w = Window.partitionBy(*by).orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(got) == rows(hot.withColumn("s", F.sum("w").over(w)))


def test_running_last_crosses_slices(spark, hot, rows, monkeypatch):
    df = hot.withColumn("x", F.when(F.col("id") % 50 == 0, F.col("id")))
    got = ordered.running(df, ["id"], by=["g"], lasts={"l": "x"})
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(got) == rows(df.withColumn("l", F.last("x", ignorenulls=True).over(w)))


def test_a_hot_group_is_spread_over_slices(spark, hot):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        slices = ordered.sorted_slices(hot, ["v"], by=["g"])
        assert slices.filter("g = 'hot'").select(ordered.SLICE).distinct().count() > 1
        got = ordered.running(hot, ["v", "id"], by=["g"], sums={"s": "w"})
        w = Window.partitionBy("g").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
        want = hot.withColumn("s", F.sum("w").over(w))
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_short_groups_take_one_window(spark, hot, rows):
    got = ordered.running(hot, ["v", "id"], by=["g"], sums={"s": "w"}, longest=2000)
    assert rows(got) == rows(ordered.running(hot, ["v", "id"], by=["g"], sums={"s": "w"}))


def test_keyed_left_join_with_hot_and_null_keys(spark, rows, monkeypatch):
    monkeypatch.setattr(skew, "_SAMPLE", 1.0)
    left = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 3 == 1, F.col("id").cast("int")).alias("k"))
    right = spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("f"))
    assert len(skew.hot_hashes(left, ["k"])) >= 1
    got = skew.keyed_left_join(left, right, ["k"]).select("id", "k", "f")
    want = left.join(right, "k", "left").select("id", "k", "f")
    assert rows(got) == rows(want)
    assert got.count() == 3000


def test_broadcast_only_below_the_limit(spark):
    df = spark.range(100)
    assert "broadcast" in broadcast_if_small(df, 100)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in broadcast_if_small(df, 99)._jdf.queryExecution().logical().toString().lower()


def test_settle_keeps_large_frames_distributed(spark):
    small, found = settle(spark.range(5).toDF("id"), bounded=False, rows=10)
    assert len(found) == 5 and small.count() == 5
    large, none = settle(spark.range(50).toDF("id"), bounded=False, rows=10)
    assert none is None and large.count() == 50


def test_materialise_goes_to_the_shared_folder(spark):
    df = materialise(spark.range(10).toDF("id"))
    assert checkpoint_root(spark).rstrip("/").split("/")[-1] in df.inputFiles()[0]


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
        return {f for folder in folders for f in glob.glob(f"{folder.getPath()}/*/shuffle_*.data")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(name)
    stored = materialise(spark.range(1000).repartition(3, "id").groupBy(F.expr("id % 7").alias("k")).count())
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before
    assert stored.count() == 7 and spark.conf.get(name) == setting
