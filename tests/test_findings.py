"""Cases that once gave wrong answers."""

import json

import pytest
from pyspark.sql import functions as F

from tabulon.operators import evaluate, profile, score
from tabulon.plans import skew
from tabulon.sources.files import SmallFiles


def test_a_body_of_both_forms_is_read_by_the_valid_one(spark):
    body = json.dumps({"dataframe_split": {"columns": ["a", "a"], "data": [["1", "2"]]}, "inputs": {"a": [5], "b": [6]}})
    both = json.dumps({"dataframe_split": {"columns": ["b", "a"], "data": [["2", "1"]]}, "inputs": {"a": [5], "b": [6]}})
    got = score.parse_requests(spark.createDataFrame([(1, body), (2, both)], "id int, body string"), "body", ["a", "b"])
    assert sorted((r.id, r.a, r.b, r.error) for r in got.collect()) == [(1, 5.0, 6.0, None), (2, 1.0, 2.0, None)]


def test_confusion_loses_no_row(spark):
    df = spark.createDataFrame([(0, 1), (2, 1), (None, 0), (1, 1)], "y int, p int")
    got = {(r.actual, r.predicted): r.n for r in evaluate.confusion(df, "y", "p").collect()}
    assert got == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 1, (2, 1): 1, (None, 0): 1}


def test_columns_without_values(spark):
    df = spark.createDataFrame([("g", 1.0, None)], "by string, x double, y double")
    assert profile.joint_hist(df, "x", "y", by="by").collect() == []
    assert profile.histogram(df, ["y"], by="by").columns[0] == "by"


@pytest.mark.parametrize("far", [1e3, 1e7])
def test_a_histogram_lists_what_it_is_asked_for(spark, far):
    df = spark.range(1000).select((F.col("id") / 1000).alias("x")).union(spark.sql(f"select {far}d"))
    some = profile.histogram(df, ["x"], bins=200_000)
    assert some.filter("n = 0").count() == 0 and some.agg(F.sum("n")).first()[0] == 1001
    assert profile.histogram(df, ["x"], bins=200_000, empty=True).count() == 200_000


def test_equal_rows_of_a_hot_key_part(spark, monkeypatch):
    left = spark.range(20_000).select(F.lit(1).alias("k"), F.create_map(F.lit("m"), F.lit(1)).alias("m"))
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    monkeypatch.setattr(skew, "_SAMPLE", 1.0)
    out = skew.keyed_left_join(left, right, ["k"], right_rows=10**9)
    assert out.filter("v = 'x'").count() == 20_000
    parts = left.select(F.pmod(F.monotonically_increasing_id(), F.lit(4)).alias("s")).groupBy("s").count().collect()
    assert len(parts) == 4


def test_small_files_are_whole_and_not_replaced(spark, tmp_path):
    files = SmallFiles(spark)
    files.write(f"{tmp_path}/log/1.json", "one")
    with pytest.raises(Exception, match="exist"):
        files.write(f"{tmp_path}/log/1.json", "two")
    assert files.read(f"{tmp_path}/log/1.json") == "one"
    assert files.names(f"{tmp_path}/log") == ["1.json"]


def test_missing_values_are_in_no_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(None,)] * 7, "x double")
    assert profile.histogram(df, ["x"], bins=5).agg(F.sum("n")).first()[0] == 10


def test_kendall_spreads_cells_over_the_side_of_fewer_values(spark):
    from tabulon.operators import corr

    frame = spark.createDataFrame([(float(i % 3), float(i * 7 % 50), float(i % 3)) for i in range(50)], "a double, b double, c double")
    cells, pairs = corr._cells(frame, ["a", "b", "c"])
    values = {r.pair: (r.kx, r.ky) for r in corr._fewer_y(cells).groupBy("pair").agg(
        F.count_distinct("x").alias("kx"), F.count_distinct("y").alias("ky")).collect()}
    assert {pairs[p]: v for p, v in values.items()} == {("a", "b"): (50, 3), ("a", "c"): (3, 3), ("b", "c"): (50, 3)}
    got = {(r.x, r.y): r.r for r in corr.corr_matrix(frame, ["a", "b", "c"], "kendall").collect()}
    assert got["a", "b"] == got["b", "a"] == got["b", "c"] and got["a", "c"] == 1.0


def test_explanations_are_of_the_whole_ensemble(spark, monkeypatch, tmp_path):
    """The fit is replaced by a small one that notes what was asked for."""
    from tabulon.operators import boost, tune
    from workload import modelling

    spark.createDataFrame([(i, 1, float(i % 7), 9.0 * i, i % 3 / 10, i % 4 / 10, "R" if i % 5 > 2 else "N") for i in range(120)], (
        "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string")).write.parquet(f"{tmp_path}/lineitem.parquet")
    asked, fit = [], boost.fit_boosted_many

    def small(rows, plan, label, trials):
        asked.extend(trials)
        return fit(rows, plan, label, [{**t, "n_estimators": 1, "num_leaves": 3} for t in trials])

    monkeypatch.setattr(boost, "fit_boosted_many", small)
    assert modelling.gbt_explain(spark, str(tmp_path)).count() == 120
    fixed = {k: v for k, v in tune.SEARCH_SPACE.items() if not isinstance(v, tuple)}
    assert len(asked) == 1 and fixed.items() <= asked[0].items() and asked[0]["n_estimators"] == 181


def test_the_score_check_of_many_rows_of_few_cells_runs_no_job_for_each_step(spark, monkeypatch, tmp_path):
    from tabulon.operators import boost
    from workload import modelling

    spark.createDataFrame([(float(i % 5), 100.0 * (i % 7), i % 3 / 10, i % 2 / 10, "R" if i % 35 > 20 or i % 11 == 3 else "N")
                           for i in range(3000)], (
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string")).write.parquet(
        f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(boost, "TASK_ROWS", 400)
    monkeypatch.setattr(boost, "ALONE_BYTES", 210 * 25)
    monkeypatch.setattr(boost, "_grown_by_passes", None)
    got = modelling.gbt_score_check(spark, str(tmp_path)).groupBy("consistent").count().collect()
    assert [tuple(r) for r in got] == [(True, 3000)]
