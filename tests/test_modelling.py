import json
import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tabulon.operators import boost
from tabulon.operators import evaluate as ev
from tabulon.operators import lookup as lk
from tabulon.operators import score as sc
from tabulon.operators import train, tune
from tabulon.operators.prep import Prep
from tabulon.plans.shared import scratch
from tabulon.sources.feature_table import FeatureTable
from workload.registry import QUERIES

import __spark_entry__ as entry  # noqa: F401  (fills the registry)


def rule(expression):
    return PipelineModel([SQLTransformer(statement=f"SELECT *, CAST(({expression}) AS DOUBLE) AS prediction FROM __THIS__")])


def frame(spark, y, s, p=None):
    p = p or [int(v >= 0.5) for v in s]
    return spark.createDataFrame([(int(a), float(b), int(c)) for a, b, c in zip(y, s, p)], "y int, s double, p int")


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    y = [int(rng.random() < 0.3) for _ in range(400)]
    s = [round(min(1, max(0, rng.gauss(0.4 + 0.2 * a, 0.2))), 2) for a in y]  # many ties
    return y, s, frame(spark, y, s).repartition(4)


def brute_auc(y, s):
    pairs = [(a > b) + 0.5 * (a == b) for a, i in zip(s, y) if i for b, j in zip(s, y) if not j]
    return sum(pairs) / len(pairs)


def test_auc_with_ties_and_its_mirror(scored):
    y, s, df = scored
    assert ev.roc_auc(df, "y", "s").first()[0] == pytest.approx(brute_auc(y, s))
    mirror = ev.roc_auc(df.withColumn("s", -F.col("s")), "y", "s").first()[0]
    assert mirror == pytest.approx(1 - brute_auc(y, s))


def test_auc_edge_cases(spark):
    assert ev.roc_auc(frame(spark, [0, 0, 1, 1], [.1, .2, .8, .9]), "y", "s").first()[0] == 1.0
    assert ev.roc_auc(frame(spark, [1, 1, 0, 0], [.1, .2, .8, .9]), "y", "s").first()[0] == 0.0
    assert ev.roc_auc(frame(spark, [1, 1], [.1, .2]), "y", "s").first()[0] is None


def test_curves(scored):
    y, s, df = scored
    roc = sorted(((r.fpr, r.tpr) for r in ev.roc_curve(df, "y", "s").collect()))
    assert roc[0] == (0.0, 0.0) and roc[-1] == (1.0, 1.0) and len(roc) == len(set(s)) + 1
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(roc, roc[1:]))
    assert area == pytest.approx(brute_auc(y, s))
    assert len(ev.roc_curve(df, "y", "s", max_points=10).collect()) <= 11
    pr = sorted(((-r.threshold, r.precision, r.recall) for r in ev.pr_curve(df, "y", "s").collect()))
    last, ap = 0.0, 0.0
    for _, precision, recall in pr:
        ap, last = ap + (recall - last) * precision, recall
    assert ev.average_precision(df, "y", "s").first()[0] == pytest.approx(ap)


def test_metrics_when_undefined(spark):
    m = ev.binary_metrics(frame(spark, [1, 1, 0], [0, 0, 0], [0, 0, 0]), "y", "p").first()
    assert (m.precision, m.recall, m.f1) == (0.0, 0.0, 0.0) and m.accuracy == pytest.approx(1 / 3)
    assert ev.roc_score_hard(frame(spark, [1, 0], [0, 0], [0, 0]), "y", "p").first()[0] is None


def test_hard_roc_score(spark):
    df = frame(spark, [1, 1, 0, 0, 0], [0] * 5, [1, 0, 1, 0, 0])
    assert ev.roc_score_hard(df, "y", "p").first()[0] == pytest.approx(7 / 12)


def test_confusion_keeps_zero_cells(spark):
    got = {(r.actual, r.predicted): r.n for r in ev.confusion(frame(spark, [1, 1], [0, 0], [1, 1]), "y", "p").collect()}
    assert got == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}


def test_report(scored):
    y, s, df = scored
    got = {r.metric: r.value for r in ev.evaluate(df, "y", "p", "s").collect()}
    loss = -np.mean([math.log(max(v, 1e-15)) if a else math.log(1 - min(v, 1 - 1e-15)) for a, v in zip(y, s)])
    assert got["log_loss"] == pytest.approx(loss) and got["roc_auc"] == pytest.approx(brute_auc(y, s))
    assert got["example_count"] == 400 and got["tp"] + got["fn"] == sum(y)


def test_lift_and_calibration(scored):
    y, s, df = scored
    lift = sorted(ev.lift_table(df, "y", "s", 5).collect(), key=lambda r: r.bin)
    assert sum(r.n for r in lift) == 400 and lift[-1].cum_gain == pytest.approx(1.0)
    assert lift[0].lift > 1 > lift[-1].lift
    cal = ev.calibration_table(df, "y", "s", 4).collect()
    assert sum(r.n for r in cal) == 400


@pytest.fixture(scope="module")
def learnable(spark):
    rng = random.Random(9)
    data = []
    for i in range(600):
        a, b = rng.random(), rng.random()
        data.append((i, 0.0 if rng.random() < 0.1 else a, b, int(a + 0.2 * rng.random() > 0.6)))
    return spark.createDataFrame(data, "k long, a double, b double, y int").repartition(3)


PREP = Prep(["a", "b"], ["a"], remainder="pass")


def test_gbt_learns_saves_and_loads(spark, learnable):
    model = train.fit_gbt(learnable, PREP, "y", maxIter=5, maxDepth=3, seed=1)
    scored = sc.score(learnable, model, probability="p")
    assert scored.columns == ["k", "a", "b", "y", "p", "prediction"]
    assert scored.schema["prediction"].dataType.simpleString() == "int"
    assert ev.roc_auc(scored, "y", "p").first()[0] > 0.8
    name = scratch(spark, "model")
    first = train.save_model(model, name, learnable.select("a", "b"))
    second = train.save_model(model, name, learnable.select("a", "b"))
    assert first != second and train.load_model(spark, name).version == 2
    again = sc.score(learnable, train.load_model(spark, first), probability="p")
    assert again.exceptAll(scored).isEmpty()
    top = ev.importance(model, PREP.used()).orderBy(F.desc("importance")).first()
    assert top.feature == "a"


def test_an_ensemble_outside_its_pipeline_predicts_the_same(spark, learnable):
    model = boost.fit_boosted(learnable, PREP, "y", n_estimators=8, num_leaves=6)
    prepared = PipelineModel(model.stages[:-1]).transform(learnable).select("k", "a_prep", "b_prep")
    batches = sc.score_batches(prepared, sc.ensemble_predictor(model.stages[-1]), ["a_prep", "b_prep"])
    own = sc.score(learnable, model).select("k", F.col("prediction").alias("own"))
    assert batches.join(own, "k").filter("prediction <> own").count() == 0


def test_score_refuses_to_replace_a_prediction(learnable):
    with pytest.raises(ValueError):
        sc.score(learnable.withColumn("prediction", F.lit(1)), rule("a > 0.5"))


def test_score_with_lookup(spark, learnable, rows):
    ft = FeatureTable.create(learnable.select("k", "b"), scratch(spark, "ft"), ["k"])
    uri = train.save_model(rule("a > b"), scratch(spark, "m"), learnable.select("a", "b"),
                           [lk.Lookup(ft.table.path, ["b"], ["k"]).spec()])
    out = sc.score_with_lookup(learnable.select("k", "a"), uri)
    assert out.columns == ["k", "a", "b", "prediction"]
    assert out.filter("prediction <> cast(a > b as int)").count() == 0 and out.count() == 600
    with pytest.raises(ValueError):
        sc.score_with_lookup(learnable.select("k", "a", "b"), uri)


COLS = ["Age", "BloodPressure", "Insulin", "BMI", "SkinThickness", "DiabetesPedigreeFunction", "Pregnancies", "Glucose"]
ROWS = [[31, 66, 2, 24.5, 29, 0.35, 0, 85], [41, 76, 3, 25.5, 30, 0.45, 1, 95], [51, 86, 4, 26.5, 31, 0.55, 2, 105]]


def test_score_requests(spark):
    order = [7, 0, 3, 1, 2, 4, 5, 6]
    shuffled = sc.request_body([COLS[i] for i in order], [[r[i] for i in order] for r in ROWS])
    inputs = json.dumps({"inputs": {c: [r[i] for r in ROWS] for i, c in enumerate(COLS)}})
    lacking = sc.request_body(COLS[:-1], [r[:-1] for r in ROWS])
    ragged = json.dumps({"dataframe_split": {"columns": COLS, "data": [ROWS[0][:3]]}})
    twice = json.dumps({"dataframe_split": {"columns": ["Age", "Age"], "data": [[1, 2]]}})
    bodies = {"plain": sc.request_body(COLS, ROWS), "shuffled": shuffled, "inputs": inputs, "broken": '{"dataframe_split": {',
              "lacking": lacking, "ragged": ragged, "twice": twice, "other": "{}", "null": None}
    df = spark.createDataFrame(list(bodies.items()), "name string, body string")
    out = {}
    for r in sc.score_requests(df, "body", rule("Age > 35 AND Glucose > 90"), COLS).collect():
        out.setdefault(r["name"], []).append(r)
    for good in ("plain", "shuffled", "inputs"):
        got = sorted(out[good], key=lambda r: r["row"])
        assert [r["prediction"] for r in got] == [0, 1, 1]
        assert [[r[c] for c in COLS] for r in got] == [[float(v) for v in r] for r in ROWS]
    for bad in ("broken", "ragged", "twice", "other", "null"):
        assert [(r["prediction"], r["error"]) for r in out[bad]] == [(None, "malformed body")]
    assert out["lacking"][0]["error"] == "missing column: Glucose"


def test_search_space(spark, rows):
    trials = tune.sample_space(spark, 200, seed=1)
    assert rows(trials) == rows(tune.sample_space(spark, 200, seed=1))
    lim = trials.agg(F.min("max_depth"), F.max("max_depth"), F.min("max_bin"), F.max("max_bin"), F.max("lambda_l1"),
                     F.avg(F.log("learning_rate")), F.stddev(F.log("learning_rate"))).first()
    assert lim[0] >= 10 and lim[1] <= 19 and lim[2] >= 50 and lim[3] <= 254 and lim[4] <= 0.5
    assert abs(lim[5]) < 0.25 and 0.8 < lim[6] < 1.2
    assert train.gbt_params({"learning_rate": 1.5, "max_depth": 12, "num_leaves": 90})["stepSize"] == 1.0


def test_trials_best_run_and_cross_validation(spark, learnable):
    trials = tune.sample_space(spark, 3, seed=2, space={"cut": ("uniform", 0.0, 1.0), "note": 7})
    runs = tune.run_trials(learnable, learnable, trials, lambda _, p: rule(f"a > {p['cut']}D"), "y")
    assert runs.columns == ["run_id", "cut", "note", "f1score", "roc_score", "loss"] and runs.count() == 3
    best = tune.best_run(runs).first()
    assert best.f1score == max(r.f1score for r in runs.collect()) and best.loss == -best.f1score
    cv = tune.cross_val(learnable, "k", "y", lambda part: train.fit_logistic(part, PREP, "y", maxIter=5), k=3)
    assert sorted(r.fold for r in cv.collect()) == [0, 1, 2] and all(r.f1 > 0.5 for r in cv.collect())


def test_baselines_and_permutation(spark, learnable):
    sweep = train.baseline_sweep(learnable, learnable, PREP, "y", ["logistic", "gaussian_bayes"]).collect()
    assert len(sweep) == 2 and sweep[0].f1 >= sweep[1].f1
    moved = ev.permute_column(learnable, "k", "a", seed=1)
    assert moved.count() == 600 and sorted(r.a for r in moved.collect()) == sorted(r.a for r in learnable.collect())
    drop = {r.feature: r.f1_drop for r in ev.perm_importance(
        learnable, lambda f: sc.score(f, rule("a > 0.5")), ["a", "b"], "k", "y").collect()}
    assert drop["a"] > 0.1 and drop["b"] == 0.0


@pytest.mark.parametrize("name", ["gbt_score", "gbt_score_check", "gbt_importance", "tune_gbt"])
def test_tree_queries_take_the_rounds_and_depths_of_the_search_space(spark, sf, monkeypatch, name):
    """The fit is replaced by a small one that notes what was asked for."""
    asked, fit = [], boost.fit_boosted_many

    def small(rows, plan, label, trials):
        asked.extend(trials)
        return fit(rows, plan, label, [{**t, "n_estimators": 1, "num_leaves": 3} for t in trials])

    monkeypatch.setattr(boost, "fit_boosted_many", small)
    monkeypatch.setattr(tune, "fit_boosted_many", small)
    QUERIES[name](spark, sf).collect()
    assert len(asked) == (5 if name == "tune_gbt" else 1)
    first, stop = tune.SEARCH_SPACE["max_depth"][1:]
    for params in asked:
        for key, fixed in tune.SEARCH_SPACE.items():
            assert isinstance(fixed, tuple) or params[key] == fixed
        assert first <= params["max_depth"] < stop


def test_logistic_query_runs_to_its_end(spark, sf, monkeypatch):
    asked, fit = [], train.fit_logistic
    monkeypatch.setattr(train, "fit_logistic", lambda *a, **params: asked.append(params) or fit(*a, **params))
    QUERIES["logistic_score"](spark, sf).collect()
    assert asked == [{}]


@pytest.mark.parametrize("by", [None, "l_returnflag"])
def test_densities_of_a_continuous_column(spark, sf, by):
    got = QUERIES["kde_continuous_by_class" if by else "kde_continuous"](spark, sf).collect()
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_extendedprice", "l_returnflag").toPandas()
    lo, hi = lines.l_extendedprice.min(), lines.l_extendedprice.max()
    groups = {None: lines} if by is None else dict(list(lines.groupby(by)))
    assert len(got) == 200 * len(groups)
    for r in got:
        v = groups[r[by] if by else None].l_extendedprice.astype(float).to_numpy()
        h = v.std(ddof=1) * len(v) ** -0.2
        assert r["density"] == pytest.approx(
            np.exp(-0.5 * ((r["x"] - v) / h) ** 2).sum() / (len(v) * h * math.sqrt(2 * math.pi)), rel=1e-5)
        assert lo - 1e-6 <= r["x"] <= hi + 1e-6
