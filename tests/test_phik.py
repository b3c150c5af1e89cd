import math
import random

import numpy as np
import pytest

from tabulon.operators import phik


def rotated(spark, rho, n=40_000, seed=1):
    rng = np.random.default_rng(seed)
    a, b = rng.normal(size=n), rng.normal(size=n)
    return spark.createDataFrame(list(zip(a.tolist(), (rho * a + math.sqrt(1 - rho * rho) * b).tolist())), "a double, b double")


def test_cells_of_a_bivariate_normal_by_drawing():
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=2_000_000), rng.normal(size=2_000_000)
    b = 0.6 * a + 0.8 * b
    x, y = np.array([0.2, 0.3, 0.5]), np.array([0.6, 0.4])
    cells = phik.bivariate_cells(x, y, 0.6)
    drawn, *_ = np.histogram2d(a, b, bins=[[-9, -0.8416212, 0.0, 9], [-9, 0.2533471, 9]])
    assert cells == pytest.approx(drawn / len(a), abs=2e-3)
    assert cells.sum(axis=1) == pytest.approx(x) and cells.sum(axis=0) == pytest.approx(y)
    assert phik.normal_chi2(x, y, 0.0) == pytest.approx(0.0, abs=1e-12)


@pytest.mark.parametrize("rho", [0.3, 0.6, 0.9])
def test_a_grid_of_normal_shares_gives_its_correlation(rho):
    """Without the floor of noise and at the scale of the grid, the correlation comes back."""
    share = np.full(10, 0.1)
    counts = phik.bivariate_cells(share, share, rho) * 10**9
    found = phik.phik_of(counts)
    most, full = 9.0, phik._chi2_at_one(share, share)
    # the scale is the largest chi-square over that of the grid at 1
    scale = most / full
    low = [r for r in np.linspace(0.01, 0.99, 99) if scale * phik.normal_chi2(share, share, r) < phik.normal_chi2(share, share, rho)]
    assert found == pytest.approx(max(low), abs=0.011) and found == pytest.approx(rho, abs=0.06)


@pytest.mark.parametrize("rho", [-0.7, 0.0, 0.5, 0.95])
def test_rotated_normals(spark, rho):
    got = phik.phik_matrix(rotated(spark, rho), ["a", "b"]).first()
    assert got["phik"] == pytest.approx(abs(rho), abs=0.06)


def test_dependence_that_no_line_shows(spark):
    rnd = random.Random(2)
    data = [(x, x * x + rnd.gauss(0, 0.02), rnd.choice("uvw"), "same", "even" if round(x * 10) % 2 else "odd")
            for x in (rnd.uniform(-1, 1) for _ in range(20_000))]
    df = spark.createDataFrame(data + [(None, 1.0, "u", "same", None)] * 50, "x double, y double, c string, one string, o string")
    got = {(r["x"], r["y"]): r for r in phik.phik_matrix(df, ["x", "y", "c", "one", "o"]).collect()}
    assert got["x", "y"]["phik"] > 0.8 and got["x", "y"]["n"] == 20_000
    assert got["x", "c"]["phik"] < 0.05 and got["x", "one"]["phik"] is None
    assert got["y", "c"]["n"] == 20_050
    with pytest.raises(ValueError, match="levels"):
        phik.cells_of_pairs(df.selectExpr("cast(x as string) x", "c"), ["x", "c"])


def test_chi_square_by_hand(spark):
    df = spark.createDataFrame([("a", "p")] * 30 + [("a", "q")] * 10 + [("b", "p")] * 10 + [("b", "q")] * 50, "u string, v string")
    got = phik.phik_matrix(df, ["u", "v"]).first()
    table = np.array([[30.0, 10], [10, 50]])
    share = np.outer(table.sum(axis=1), table.sum(axis=0)) / 100
    assert got["chi2"] == pytest.approx(((table - share) ** 2 / share).sum()) and 0.5 < got["phik"] < 1
    assert phik.phik_matrix(df.limit(0), ["u", "v"]).count() == 0
