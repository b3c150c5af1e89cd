import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulon.operators import corr, profile, quantiles
from tabulon.plans import ordered
from workload.registry import QUERIES
from workload.star import MEASURES

import __spark_entry__ as entry  # noqa: F401  (fills the registry)


@pytest.fixture(scope="module")
def pdf():
    rng = random.Random(1)
    n = 700
    x = [0.0 if rng.random() < 0.35 else round(rng.gauss(10, 4), 2) for _ in range(n)]
    y = [round(a * 0.5 + rng.gauss(0, 2), 1) for a in x]
    z = [None if rng.random() < 0.2 else rng.randrange(12) for _ in range(n)]
    g = ["a" if rng.random() < 0.7 else "b" for _ in range(n)]
    return pd.DataFrame({"id": range(n), "x": x, "y": y, "z": pd.array(z, dtype="Int64"), "g": g})


@pytest.fixture(scope="module")
def df(spark, pdf):
    data = [(int(r.id), r.x, r.y, None if r.z is pd.NA else int(r.z), r.g) for r in pdf.itertuples()]
    return spark.createDataFrame(data, "id long, x double, y double, z int, g string").repartition(5)


PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


@pytest.mark.parametrize("window_rows", [0, 1_000_000])
@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_exact_quantiles(df, pdf, monkeypatch, window_rows, accuracy):
    """Also with brackets so coarse that most rows are folded away, and without the window shortcut."""
    monkeypatch.setattr(ordered, "WINDOW_ROWS", window_rows)
    got = {r["column"]: r for r in quantiles.exact_quantiles(df, ["x", "y", "z"], PROBS, accuracy=accuracy).collect()}
    for c in ("x", "y", "z"):
        values = pdf[c].dropna().astype(float)
        assert got[c]["n"] == len(values)
        for j, p in enumerate(PROBS):
            assert got[c][f"q{j}"] == pytest.approx(values.quantile(p), abs=1e-9)


def test_exact_quantiles_by_group_and_empty(spark, df, pdf):
    got = {(r["g"], r["column"]): r["q0"] for r in quantiles.exact_quantiles(df, ["x", "y"], [0.5], by=["g"]).collect()}
    for (g, c), v in got.items():
        assert v == pytest.approx(pdf[pdf.g == g][c].median())
    none = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    found = {r["column"]: (r["n"], r["q0"]) for r in quantiles.exact_quantiles(none, ["a", "b"], [0.5]).collect()}
    assert found == {"a": (0, None), "b": (2, 2.0)}


def test_quantiles_fall_back_when_a_bracket_misses(df, pdf, monkeypatch):
    real = quantiles._brackets

    def wrong(*args):
        return real(*args).withColumn("lo0", F.lit(1e9)).withColumn("hi0", F.lit(1e9))

    monkeypatch.setattr(quantiles, "_brackets", wrong)
    got = quantiles.exact_quantiles(df, ["x"], [0.5]).first()
    assert got["q0"] == pytest.approx(pdf.x.median())


def test_describe(df, pdf):
    got = {(r["column"], r["stat"]): r["value"] for r in profile.describe(df, ["x", "y"]).collect()}
    want = pdf[["x", "y"]].describe()
    for c in ("x", "y"):
        for stat in want.index:
            assert got[c, stat] == pytest.approx(want.loc[stat, c])


def test_profile_columns(df, pdf):
    got = {r["column"]: r for r in profile.profile_columns(df, ["x", "z"], key="id").collect()}
    for c in ("x", "z"):
        v = pdf[c].dropna().astype(float)
        r = got[c]
        assert (r["count"], r["missing"], r["zeros"], r["distinct"]) == (len(v), len(pdf) - len(v), (v == 0).sum(), v.nunique())
        assert r["skewness"] == pytest.approx(v.skew()) and r["kurtosis"] == pytest.approx(v.kurt())
        assert r["std"] == pytest.approx(v.std()) and r["iqr"] == pytest.approx(v.quantile(.75) - v.quantile(.25))
        assert r["mad"] == pytest.approx((v - v.median()).abs().median())
        assert not r["increasing"]


def test_profile_of_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None), (1.0, None)], "c double, e double")
    got = {r["column"]: r for r in profile.profile_columns(df, ["c", "e"]).collect()}
    assert got["c"]["skewness"] is None and got["c"]["distinct"] == 1 and got["c"]["std"] == 0
    assert got["e"]["count"] == 0 and got["e"]["mean"] is None and got["e"]["distinct"] == 0


@pytest.mark.parametrize("parts", [1, 6])
def test_monotone(spark, parts):
    df = spark.range(200).select("id", (F.col("id") * 2).alias("up"), (-F.col("id")).alias("down"),
                                 F.lit(1).alias("flat"), (F.col("id") % 5).alias("saw")).repartition(parts)
    got = {r["column"]: (r.increasing, r.decreasing) for r in
           profile.monotone(df, ["up", "down", "flat", "saw"], "id").collect()}
    assert got == {"up": (True, False), "down": (False, True), "flat": (True, True), "saw": (False, False)}


def test_histogram_matches_numpy_auto(df, pdf):
    got = profile.histogram(df, ["x", "y"], empty=True).collect()
    for c in ("x", "y"):
        counts, edges = np.histogram(pdf[c], bins="auto")
        mine = sorted((r["bin"], r["n"], r["left"]) for r in got if r["column"] == c)
        assert len(mine) == len(counts)
        assert sum(m[1] for m in mine) == len(pdf)
        assert [m[2] for m in mine] == pytest.approx(list(edges[:-1]))


def test_box_stats(df, pdf):
    for r in profile.box_stats(df, ["y"], by="g").collect():
        v = pdf[pdf.g == r["g"]].y
        q1, q3 = v.quantile(0.25), v.quantile(0.75)
        inside = v[(v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))]
        assert (r["whisker_low"], r["whisker_high"], r["outliers"]) == (inside.min(), inside.max(), len(v) - len(inside))


def test_outliers(df, pdf):
    flagged = profile.flag_outliers(df, ["y"], rule="std", k=2)
    want = ((pdf.y - pdf.y.mean()).abs() > 2 * pdf.y.std()).sum()
    assert flagged.filter("y_outlier").count() == want
    assert profile.flag_outliers(df, ["y"], rule="std", k=2, keep="inliers").count() == len(pdf) - want


def test_kde(df, pdf):
    got = sorted((r["x"], r["density"]) for r in profile.kde(df, "y", grid=20).collect())
    h = pdf.y.std() * len(pdf) ** -0.2
    for x, density in got:
        want = np.exp(-0.5 * ((x - pdf.y) / h) ** 2).sum() / (len(pdf) * h * math.sqrt(2 * math.pi))
        assert density == pytest.approx(want)


@pytest.mark.parametrize("big", [True, False])
@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_correlations(df, pdf, method, big, monkeypatch):
    if big:
        monkeypatch.setattr(ordered, "WINDOW_ROWS", 0)
        monkeypatch.setattr(corr, "_WIDE_PAIRS", 0)
    want = pdf[["x", "y", "z"]].astype(float).corr() if method == "pearson" else None
    got = {(r["x"], r["y"]): r["r"] for r in corr.corr_matrix(df, ["x", "y", "z"], method).collect()}
    assert len(got) == 9
    for (a, b), v in got.items():
        both = pdf[[a, b]].dropna().astype(float) if a != b else None
        if a == b:
            assert v == 1.0
        elif method == "pearson":
            assert v == pytest.approx(want.loc[a, b])
        else:
            assert v == pytest.approx(both[a].rank().corr(both[b].rank()))


@pytest.mark.parametrize("cells_looked_up", [0, 40, 10 ** 6])
def test_spearman_of_few_and_many_values(spark, cells_looked_up, monkeypatch):
    met = []
    value_pairs = corr._value_pairs
    monkeypatch.setattr(corr, "_value_pairs", lambda nums, pairs: met.extend(pairs) or value_pairs(nums, pairs))
    monkeypatch.setattr(corr, "BROADCAST_ROWS", cells_looked_up)
    rows = [(i % 7 if i % 5 else None, i * i % 97, i * 31 % 89 if i % 11 else None, i % 3, None) for i in range(300)]
    data = spark.createDataFrame(rows, "few int, many int, more int, least int, none int")
    got = {(r["x"], r["y"]): r["r"] for r in corr.corr_matrix(data, data.columns, "spearman", lower=True).collect()}
    pdf = pd.DataFrame(rows, columns=data.columns, dtype=float)
    for (a, b), v in got.items():
        both = pdf[[a, b]].dropna()
        assert len(got) == 10 and (v is None if "none" in (a, b) else v == pytest.approx(both[a].rank().corr(both[b].rank())))
    # a column of few values does not meet others in value pairs
    few = {0: {"none"}, 40: {"few", "least", "none"}, 10 ** 6: set(data.columns)}[cells_looked_up]
    assert not any(few.intersection(pair) for pair in met) and (met or cells_looked_up == 10 ** 6)


def _tau_b(x, y):
    dx, dy = np.sign(x[:, None] - x), np.sign(y[:, None] - y)
    return (dx * dy).sum() / math.sqrt((dx != 0).sum() * (dy != 0).sum())


@pytest.mark.parametrize("window_rows", [0, 1_000_000])
def test_kendall_against_all_pairs(df, pdf, monkeypatch, window_rows):
    monkeypatch.setattr(ordered, "WINDOW_ROWS", window_rows)
    got = {(r["x"], r["y"]): r["r"] for r in corr.corr_matrix(df, ["x", "y", "z"], "kendall", lower=True).collect()}
    assert set(got) == {("y", "x"), ("z", "x"), ("z", "y")}
    for (a, b), v in got.items():
        both = pdf[[a, b]].dropna().astype(float)
        assert v == pytest.approx(_tau_b(both[a].to_numpy(), both[b].to_numpy()))


def _tau_b_blocks(x, y, block=500):
    """tau-b of all pairs of rows, some rows against all at a time."""
    s = a = b = 0
    for i in range(0, len(x), block):
        dx, dy = np.sign(x[i:i + block, None] - x), np.sign(y[i:i + block, None] - y)
        s, a, b = s + (dx * dy).sum(), a + (dx != 0).sum(), b + (dy != 0).sum()
    return s / math.sqrt(float(a) * float(b))


@pytest.mark.parametrize("window_rows", [0, 1_000_000])
def test_kendall_with_a_continuous_column(spark, monkeypatch, window_rows):
    monkeypatch.setattr(ordered, "WINDOW_ROWS", window_rows)
    g = np.random.default_rng(3)
    q = g.integers(1, 51, 1500).astype(float)
    data = {"q": q, "price": q * g.uniform(900, 2100, 1500), "t": g.integers(0, 9, 1500).astype(float)}
    df = spark.createDataFrame(list(zip(*(v.tolist() for v in data.values()))), "q double, price double, t double")
    got = {(r["x"], r["y"]): r["r"] for r in corr.corr_matrix(df, list(data), "kendall").collect()}
    assert len(got) == 9
    for (a, b), v in got.items():
        assert v == pytest.approx(_tau_b_blocks(data[a], data[b]))


def test_kendall_query_takes_all_measures(spark, sf):
    name, few = "corr_kendall_measures", "corr_kendall"
    got = {(r["x"], r["y"]): r["r"] for r in QUERIES[name](spark, sf).collect()}
    assert set(got) == {(a, b) for a in MEASURES for b in MEASURES}
    assert {(r["x"], r["y"]): r["r"] for r in QUERIES[few](spark, sf).collect()}.items() <= got.items()
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select(*MEASURES).toPandas().astype(float)
    lines[["l_discount", "l_tax"]] = lines[["l_discount", "l_tax"]].replace(0.0, np.nan)
    for a, b in [("l_quantity", "l_extendedprice"), ("l_extendedprice", "l_discount"), ("l_extendedprice", "l_tax")]:
        both = lines[[a, b]].dropna().to_numpy()
        assert got[a, b] == got[b, a] == pytest.approx(_tau_b_blocks(both[:, 0], both[:, 1]), abs=1e-6)


def test_correlation_with_a_constant(spark):
    df = spark.createDataFrame([(float(i), 1.0, -float(i)) for i in range(20)], "a double, c double, b double")
    for method in ("pearson", "spearman", "kendall"):
        got = {(r["x"], r["y"]): r["r"] for r in corr.corr_matrix(df, ["a", "c", "b"], method).collect()}
        assert got["a", "c"] is None and got["c", "c"] is None
        assert got["a", "b"] == pytest.approx(-1.0)


def test_cramers_v(df, pdf):
    got = corr.contingency_tests(df, ["x", "y"], 4).first()
    table = pd.crosstab(*[np.minimum(np.floor((pdf[c] - pdf[c].min()) / ((pdf[c].max() - pdf[c].min()) / 4)), 3) for c in ("x", "y")])
    o = table.to_numpy().astype(float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    chi2 = ((o - e) ** 2 / e).sum()
    assert got["chi2"] == pytest.approx(chi2)
    assert got["cramers_v"] == pytest.approx(math.sqrt(chi2 / (o.sum() * (min(o.shape) - 1))))


def test_overview_and_missing(df, pdf, spark):
    twice = df.drop("id").unionByName(df.drop("id").limit(0))
    row = profile.profile_overview(twice).first()
    plain = pdf.drop(columns="id")
    assert row["n_rows"] == 700 and row["missing_cells"] == plain.z.isna().sum()
    assert row["duplicate_rows"] == plain.astype(str).duplicated().sum()
    got = {r["column"]: r["missing"] for r in profile.missing_report(df, ["x", "z"]).collect()}
    assert got == {"x": 0, "z": pdf.z.isna().sum()}


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_results_do_not_depend_on_the_layout(df, rows, parts):
    again = df.repartition(parts)
    for make in (lambda d: profile.box_stats(d, ["x", "y"]), lambda d: profile.histogram(d, ["x"]),
                 lambda d: quantiles.exact_quantiles(d, ["x", "z"], [0.1, 0.9])):
        assert rows(make(again)) == rows(make(df))


def test_alerts(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("u"), F.lit(1.0).alias("c"),
                                 F.when(F.col("id") < 60, 0).otherwise(F.col("id")).alias("z"))
    p = profile.profile_columns(df, ["u", "c", "z"])
    got = {(r["column"], r["alert"]) for r in profile.alerts(p, corr.corr_matrix(df, ["u", "c", "z"]), high=0.8).collect()}
    assert {("u", "unique"), ("c", "constant"), ("z", "zeros"), ("u", "high_correlation")} <= got


@pytest.mark.parametrize("by", [None, "g"])
def test_a_density_on_a_lattice_keeps_its_tolerance(spark, by):
    rnd = random.Random(6)
    data = [(rnd.choice("uv"), rnd.gauss(0, 1) if rnd.random() < 0.8 else rnd.expovariate(0.2)) for _ in range(1500)]
    df = spark.createDataFrame([*data, ("u", None)], "g string, y double")

    def curve(tolerance):
        return {(r["g"] if by else None, round(r["x"], 9)): r["density"]
                for r in profile.kde(df, "y", grid=60, by=by, tolerance=tolerance).collect()}

    exact = curve(None)
    for tolerance in (1e-3, 1e-6):
        got = curve(tolerance)
        assert got.keys() == exact.keys()
        peak = max(exact.values()) * 20  # a kernel's own peak is above that of the curve
        assert max(abs(got[k] - exact[k]) for k in exact) <= tolerance * peak
    assert max(abs(curve(1e-6)[k] - exact[k]) for k in exact) < 1e-6
