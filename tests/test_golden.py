"""Known values of the 768-row, 9-column classification table.

Set GOLDEN_CSV to the path of that table to run these; they are skipped otherwise.
"""

import os

import pytest

from tabulon.operators import corr, prep, profile, shape, split
from tabulon.operators.quantiles import exact_quantiles
from tabulon.sources.tables import read_csv

PATH = os.environ.get("GOLDEN_CSV", "")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="GOLDEN_CSV is not set")

# column: zeros, distinct, min, p25, median, p75, max, mean, std, skewness, kurtosis, whiskers, outliers
GOLDEN = {
    "Pregnancies": (111, 17, 0, 1, 3, 6, 17, 3.845052, 3.369578, 0.901674, 0.159220, 0, 13, 4),
    "Glucose": (5, 136, 0, 99, 117, 140.25, 199, 120.894531, 31.972618, 0.173754, 0.640780, 44, 199, 5),
    "BloodPressure": (35, 47, 0, 62, 72, 80, 122, 69.105469, 19.355807, -1.843608, 5.180157, 38, 106, 45),
    "SkinThickness": (227, 51, 0, 0, 23, 32, 99, 20.536458, 15.952218, 0.109372, -0.520072, 0, 63, 1),
    "Insulin": (374, 186, 0, 0, 30.5, 127.25, 846, 79.799479, 115.244002, 2.272251, 7.214260, 0, 318, 34),
    "BMI": (11, 248, 0, 27.3, 32, 36.6, 67.1, 31.992578, 7.884160, -0.428982, 3.290443, 18.2, 50, 19),
    "DiabetesPedigreeFunction": (0, 517, 0.078, 0.24375, 0.3725, 0.62625, 2.42, 0.471876, 0.331329, 1.919911, 5.594954,
                                 0.078, 1.191, 29),
    "Age": (0, 52, 21, 24, 29, 41, 81, 33.240885, 11.760232, 1.129597, 0.643159, 21, 66, 9),
}
ZERO_IS_MISSING = ["BloodPressure", "SkinThickness", "BMI"]


@pytest.fixture(scope="module")
def df(spark):
    return read_csv(spark, PATH).cache()


def test_profile(df):
    p = {r["column"]: r for r in profile.profile_columns(df, list(GOLDEN)).collect()}
    b = {r["column"]: r for r in profile.box_stats(df, list(GOLDEN)).collect()}
    for c, want in GOLDEN.items():
        got = (p[c].zeros, p[c].distinct, p[c].min, p[c].p25, p[c]["median"], p[c].p75, p[c].max, p[c]["mean"], p[c]["std"],
               p[c].skewness, p[c].kurtosis, b[c].whisker_low, b[c].whisker_high, b[c].outliers)
        assert got == pytest.approx(want, abs=1e-6), c


def test_zero_as_missing_and_imputing(df):
    clean = shape.zero_to_null(df, ZERO_IS_MISSING)
    assert set(profile.zero_counts(clean, ZERO_IS_MISSING).first()) == {0}
    q = {r["column"]: (r.n, r.q0, r.q1, r.q2) for r in exact_quantiles(clean, ZERO_IS_MISSING, [0.25, 0.5, 0.75]).collect()}
    assert q["BloodPressure"] == (733, 64, 72, 80) and q["SkinThickness"] == (541, 22, 29, 36)
    assert q["BMI"] == pytest.approx((757, 27.5, 32.3, 36.6))
    fits = prep.fit_columns(df, ZERO_IS_MISSING, impute=ZERO_IS_MISSING)
    assert [fits[c].fill for c in ZERO_IS_MISSING] == pytest.approx([72.405184, 29.153420, 32.457464], abs=1e-6)
    assert [fits[c].std for c in ZERO_IS_MISSING] == pytest.approx([12.088468, 8.785217, 6.870674], abs=1e-6)


def test_correlations(df):
    raw = {(r.x, r.y): r.r for r in corr.corr_matrix(df, list(GOLDEN)).collect()}
    assert raw["Glucose", "Insulin"] == pytest.approx(0.331357, abs=1e-6)
    assert raw["Age", "Pregnancies"] == pytest.approx(0.544341, abs=1e-6)
    clean = {(r.x, r.y): r.r for r in corr.corr_matrix(shape.zero_to_null(df, ZERO_IS_MISSING), ZERO_IS_MISSING).collect()}
    assert clean["BMI", "SkinThickness"] == pytest.approx(0.648214, abs=1e-6)
    assert clean["BMI", "BloodPressure"] == pytest.approx(0.289230, abs=1e-6)


def test_by_class_and_split(df):
    med = {(r.Outcome, r["column"]): r.q0 for r in exact_quantiles(df, ["Glucose", "Insulin", "BMI"], [0.5], ["Outcome"]).collect()}
    assert med == {(0, "Glucose"): 107, (0, "Insulin"): 39, (0, "BMI"): pytest.approx(30.05),
                   (1, "Glucose"): 140, (1, "Insulin"): 0, (1, "BMI"): pytest.approx(34.25)}
    keyed = shape.add_key(df, "Id", order_by=df.columns)
    parts = split.stratified_split(keyed, "Id", "Outcome")
    got = {(r.split, r.Outcome): r["count"] for r in parts.groupBy("split", "Outcome").count().collect()}
    assert got == {("train", 0): 400, ("train", 1): 214, ("test", 0): 100, ("test", 1): 54}
