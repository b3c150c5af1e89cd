import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabulon.operators import lookup as lk
from tabulon.operators import prep, split
from tabulon.plans.shared import scratch
from tabulon.sources.feature_table import FeatureTable


@pytest.fixture()
def features(spark):
    df = spark.createDataFrame([(1, 10.0, "a"), (2, None, "b"), (3, 30.0, "c")], "k long, f double, s string")
    return FeatureTable.create(df, scratch(spark, "ft"), ["k"], "test features")


def test_feature_table_properties(features):
    assert (features.keys, features.description, features.rows) == (["k"], "test features", 3)


@pytest.mark.parametrize("data", [[(1, 1.0), (1, 2.0)], [(None, 1.0), (2, 2.0)]])
def test_create_rejects_duplicate_or_null_keys(spark, data):
    with pytest.raises(ValueError):
        FeatureTable.create(spark.createDataFrame(data, "k long, f double"), scratch(spark, "ft"), ["k"])


def test_create_refuses_an_existing_table(spark, features):
    with pytest.raises(ValueError):
        FeatureTable.create(features.read(), features.table.path, ["k"])


def test_merge(spark, features, rows):
    source = spark.createDataFrame([(2, 22.0), (3, None), (4, 44.0)], "k long, f double")
    features.merge(source)
    want = [(1, 10.0, "a"), (2, 22.0, "b"), (3, None, "c"), (4, 44.0, None)]
    assert rows(features.read()) == sorted(want, key=repr)
    features.merge(source)
    assert rows(features.read()) == sorted(want, key=repr)
    assert features.table.version() == 3 and features.rows == 4
    with pytest.raises(ValueError):
        features.merge(spark.createDataFrame([(1, 1.0), (1, 2.0)], "k long, f double"))
    with pytest.raises(ValueError):
        features.merge(spark.createDataFrame([(1, 1.0)], "k long, other double"))


def test_merge_keeps_newer_rows(spark, rows):
    ft = FeatureTable.create(spark.createDataFrame([(1, 5, "x")], "k long, t int, v string"), scratch(spark, "ft"), ["k"])
    ft.merge(spark.createDataFrame([(1, 4, "old"), (2, 1, "new")], "k long, t int, v string"), newer_by="t")
    assert rows(ft.read()) == [(1, 5, "x"), (2, 1, "new")]
    ft.merge(spark.createDataFrame([(1, 6, None)], "k long, t int, v string"), newer_by="t")
    assert rows(ft.read()) == [(1, 6, None), (2, 1, "new")]


def test_lookup_keeps_every_row_once(spark, features, rows):
    left = spark.createDataFrame([(1,), (1,), (9,), (None,)], "key long")
    got = lk.lookup(left, [lk.Lookup(features.table.path, ["f", "s"], {"k": "key"})])
    assert rows(got) == sorted([(1, 10.0, "a"), (1, 10.0, "a"), (9, None, None), (None, None, None)], key=repr)


def test_lookup_errors(spark, features):
    left = spark.createDataFrame([(1, 0.0)], "k long, f double")
    with pytest.raises(ValueError, match="already present"):
        lk.lookup(left, [lk.Lookup(features.table.path, ["f"], ["k"])])
    twice = features.read().unionByName(features.read())
    with pytest.raises(ValueError, match="not unique"):
        lk.lookup_frame(left.select("k"), twice, ["k"], ["s"])


def test_training_set(spark, features):
    labels = spark.createDataFrame([(1, 0, 5), (3, 1, 6)], "k long, y int, extra int")
    frame, specs = lk.training_set(labels, [lk.Lookup(features.table.path, ["f"], ["k"])], label="y", exclude=["k"])
    assert frame.columns == ["extra", "f", "y"]
    assert lk.lookups_from_specs(specs)[0].features == ["f"]


@pytest.mark.parametrize("parts", [1, 4])
def test_lookup_asof(spark, parts):
    def at(h):
        return dt.datetime(2024, 1, 1, h)

    events = spark.createDataFrame([(1, "a", at(5)), (2, "a", at(6)), (3, "a", at(1)), (4, "b", at(9)), (5, None, at(9))],
                                   "e int, k string, ts timestamp").repartition(parts)
    feats = spark.createDataFrame([("a", at(4), 1.0), ("a", at(6), None), ("a", at(8), 3.0), (None, at(1), 9.0)],
                                  "k string, ts timestamp, v double").repartition(parts)
    got = {r.e: r.v for r in lk.lookup_asof(events, feats, ["k"], "ts", ["v"]).collect()}
    # a NULL feature value at 6 is taken, not looked behind; nothing before 1; other keys see nothing
    assert got == {1: 1.0, 2: None, 3: None, 4: None, 5: None}


def _classes(spark, neg, pos):
    return spark.range(neg + pos).select(F.col("id").alias("k"), (F.col("id") >= neg).cast("int").alias("y"))


def test_split_sizes_of_the_768_row_case(spark):
    out = split.stratified_split(_classes(spark, 500, 268), "k", "y", 0.2, seed=1)
    got = {(r["split"], r["y"]): r["count"] for r in out.groupBy("split", "y").count().collect()}
    assert got == {("train", 0): 400, ("train", 1): 214, ("test", 0): 100, ("test", 1): 54}


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_split_does_not_depend_on_the_layout(spark, parts, rows):
    df = _classes(spark, 300, 90)
    one, other = (split.stratified_split(d, "k", "y", seed=4) for d in (df, df.repartition(parts)))
    assert rows(one) == rows(other)
    assert rows(one) != rows(split.stratified_split(df, "k", "y", seed=5))


def test_split_with_a_class_of_one_and_a_single_class(spark):
    tiny = spark.createDataFrame([(i, "a") for i in range(9)] + [(9, "b")], "k long, y string")
    out = split.stratified_split(tiny, "k", "y", 0.2)
    assert out.filter("split = 'test'").count() == 2 and out.count() == 10
    single = split.stratified_split(_classes(spark, 10, 0), "k", "y", 0.25)
    assert single.filter("split = 'test'").count() == 3


def test_split_and_folds_of_twenty_thousand_classes(spark):
    many = spark.range(0, 40_000, 1, 4).select(F.col("id").alias("k"), F.expr(
        "case when id < 10000 then 0 when id < 20000 then null else id % 20000 + 1 end").alias("y"))
    out = split.stratified_split(many, "k", "y", 0.2, seed=3)
    sizes = out.groupBy("y").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t"))
    got = {r.y: (r.n, r.t) for r in sizes.filter("y is null or y = 0").collect()}
    assert got == {0: (10_000, 2_000), None: (10_000, 2_000)}
    # 4,000 rows are left for 20,000 classes of one row with equal remainders
    assert sizes.agg(F.sum("t")).first()[0] == 8_000 and sizes.filter("y > 0 and n <> 1").isEmpty()
    folds = split.stratified_folds(many, "k", "y", 4, seed=3).groupBy("y", "fold").count().persist()
    assert sorted(r["count"] for r in folds.filter("y = 0").collect()) == [2_500] * 4
    assert folds.filter("y > 0 and (fold <> 0 or count <> 1)").isEmpty() and folds.filter("y > 0").count() == 20_000


def test_folds_are_even_and_cover_everything(spark):
    out = split.stratified_folds(_classes(spark, 23, 12), "k", "y", 5, seed=2)
    counts = {(r["y"], r["fold"]): r["count"] for r in out.groupBy("y", "fold").count().collect()}
    assert sorted(v for (y, _), v in counts.items() if y == 0) == [4, 4, 5, 5, 5]
    assert sorted(v for (y, _), v in counts.items() if y == 1) == [2, 2, 2, 3, 3]


def test_folds_of_a_class_smaller_than_k(spark):
    out = split.stratified_folds(_classes(spark, 10, 2), "k", "y", 5)
    assert out.count() == 12
    assert sorted(r.fold for r in out.filter("y = 1").collect()) == [0, 1]


def test_imputers(spark):
    train = spark.createDataFrame([(0, 0.0), (2, 4.0), (4, 6.0), (None, 11.0)], "a int, b double")
    mean = prep.fit_imputer(train, ["a", "b"]).transform(train)
    assert [r.a_imputed for r in mean.collect()] == [3.0, 2.0, 4.0, 3.0]
    assert [r.b_imputed for r in mean.collect()] == [7.0, 4.0, 6.0, 11.0]
    median = prep.fit_imputer(train, ["b"], strategy="median").transform(train)
    assert [r.b_imputed for r in median.collect()] == [6.0, 4.0, 6.0, 11.0]


def test_scaler_uses_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, c double")
    out = prep.fit_scaler(df, ["a", "c"]).transform(df).collect()
    assert [r.a_scaled for r in out] == [-1.0, 1.0]
    assert [r.c_scaled for r in out] == [0.0, 0.0]


@pytest.mark.parametrize("strategy", ["mean", "median"])
def test_scaling_after_imputing_is_that_of_the_filled_column(spark, strategy):
    df = spark.createDataFrame([(float(v),) for v in (0, 0, 1, 2, 6, 7)], "a double")
    model = prep.Prep(["a"], ["a"], strategy=strategy).fit(df)
    out = [r.a_prep for r in model.transform(df).collect()]
    assert sum(out) == pytest.approx(0) and sum(v * v for v in out) / 6 == pytest.approx(1)


def test_prep_hands_on_imputed_columns_only_unless_told_to_pass(spark):
    df = spark.createDataFrame([("1", 2.0, 0.0), ("3", 4.0, 5.0), ("x", 9.0, 6.0)], "t string, u double, v double")
    drop = prep.Prep(["u", "v"], ["v"])
    assert drop.used() == ["v"]
    assert drop.fit(df).transform(df).first().features.size == 1
    keep = prep.Prep(["u", "v"], ["v"], remainder="pass")
    assert keep.fit(df).transform(df).first().features.size == 2
    coerced = prep.Prep(["t"], ["t"], scale=False).fit(df).transform(df)
    assert [r.t_prep for r in coerced.collect()] == [1.0, 3.0, 2.0]
