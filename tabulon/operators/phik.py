"""phi_k: a correlation of any two columns from their contingency table.

The coefficient is the correlation of the bivariate normal whose chi-square on the same grid, raised by the noise of
independent columns, equals the table's.  Spark counts the cells; each small table is solved in one group.
"""

from __future__ import annotations

from itertools import combinations
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.columns import number
from tabulon.operators.quantiles import exact_quantiles

_POINTS, _WEIGHTS = np.polynomial.legendre.leggauss(60)


def bivariate_cells(x_shares, y_shares, rho: float) -> np.ndarray:
    """Cell shares of a bivariate normal on the grid whose margins have these shares.

    Beside the product of the margins, the chance below two bounds is an integral over the correlation's angle.
    """
    normal = NormalDist()

    def bounds(shares):
        upto = np.clip(np.cumsum(shares)[:-1], 1e-15, 1 - 1e-15)
        return np.array([normal.inv_cdf(float(u)) for u in upto])

    h, k = bounds(x_shares)[:, None, None], bounds(y_shares)[None, :, None]
    top = np.arcsin(rho)
    angle = top * (_POINTS + 1) / 2
    inside = np.exp(-(h * h + k * k - 2 * h * k * np.sin(angle)) / (2 * np.cos(angle) ** 2))
    extra = np.zeros((len(x_shares) + 1, len(y_shares) + 1))
    extra[1:-1, 1:-1] = (inside * _WEIGHTS).sum(axis=2) * top / (4 * np.pi)
    product = np.outer(x_shares, y_shares)
    return product + extra[1:, 1:] - extra[:-1, 1:] - extra[1:, :-1] + extra[:-1, :-1]


def normal_chi2(x_shares, y_shares, rho: float) -> float:
    """Chi-square over rows of the bivariate normal's cells against independence."""
    product = np.outer(x_shares, y_shares)
    return float(((bivariate_cells(x_shares, y_shares, rho) - product) ** 2 / product).sum())


def _chi2_at_one(x_shares, y_shares) -> float:
    """``normal_chi2`` of correlation 1, where a cell's share is the overlap of its two intervals."""
    x, y = np.cumsum(x_shares), np.cumsum(y_shares)
    upper, lower = np.minimum.outer(x, y), np.maximum.outer(x - x_shares, y - y_shares)
    product = np.outer(x_shares, y_shares)
    return float(((np.maximum(upper - lower, 0.0) - product) ** 2 / product).sum())


def phik_of(counts: np.ndarray, noise: float = 0.0) -> float | None:
    """phi_k of one contingency table; None where a side has one level only.

    Independent columns have a chi-square of about the degrees of freedom, so that much, and ``noise`` standard
    deviations of it, is no correlation.  The scale makes a table at its largest chi-square correspond to 1.
    """
    counts = counts[counts.sum(axis=1) > 0][:, counts.sum(axis=0) > 0].astype(float)
    rows, cols = counts.shape
    if min(rows, cols) < 2:
        return None
    n = counts.sum()
    x, y = counts.sum(axis=1) / n, counts.sum(axis=0) / n
    product = np.outer(x, y)
    chi2 = n * float(((counts / n - product) ** 2 / product).sum())
    # degrees of freedom that rows can fill
    free = (rows - 1) * (cols - 1)
    floor = free + noise * np.sqrt(2 * free)
    most = n * (min(rows, cols) - 1)
    if chi2 <= floor:
        return 0.0
    if chi2 >= most * (1 - 1e-12):
        return 1.0
    full = n * _chi2_at_one(x, y)
    scale = max(0.0, most - floor) / full
    low, high = 0.0, 1 - 1e-6
    if floor + scale * full <= chi2:
        return 1.0
    while high - low > 1e-9:
        mid = (low + high) / 2
        low, high = (mid, high) if floor + scale * n * normal_chi2(x, y, mid) < chi2 else (low, mid)
    return (low + high) / 2


def _levels(df: DataFrame, cols, bins: int) -> DataFrame:
    """The columns as levels: numbers by their exact quantiles, others as text."""
    numeric = [f.name for f in df.schema if f.name in cols and (
        f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double") or f.dataType.typeName().startswith("decimal"))]
    cuts = {}
    if numeric:
        found = exact_quantiles(df, numeric, [i / bins for i in range(1, bins)])
        cuts = {r["column"]: sorted({r[f"q{i}"] for i in range(bins - 1)}) for r in found.collect() if r["n"]}  # one row per column

    def level(c):
        if c not in cuts:
            return F.col(f"`{c}`").cast("string")
        # how many cuts a value is above
        return sum(((number(c) > F.lit(q)).cast("int") for q in cuts[c]), F.lit(0)).cast("string")

    return df.select(*[level(c).alias(c) for c in cols])


def cells_of_pairs(df: DataFrame, cols, bins: int = 10, categories: int = 1000) -> DataFrame:
    """(x, y, a, b, m): the contingency tables of all pairs of columns, numbers in ``bins`` quantile bins; one scan more than those.

    Bins of equal width would leave tails with few rows, whose cells rule the chi-square and move phi_k.

    Rows that miss one of two values do not count for that pair.  More than ``categories`` levels of a text column are
    an error, as its tables would be large.
    """
    cols = list(cols)
    levels = _levels(df, cols, bins)
    wide = levels.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(cols)]).first()
    over = [c for i, c in enumerate(cols) if wide[f"d{i}"] > 1.1 * categories]
    if over:
        raise ValueError(f"too many levels for a contingency table: {over}")
    pairs = [F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"`{a}`").alias("a"), F.col(f"`{b}`").alias("b"))
             for a, b in combinations(cols, 2)]
    return levels.select(F.inline(F.array(*pairs))).filter("a is not null and b is not null").groupBy(
        "x", "y", "a", "b").agg(F.count(F.lit(1)).alias("m"))


def phik_matrix(df: DataFrame, cols, bins: int = 10, noise: float = 0.0, categories: int = 1000) -> DataFrame:
    """(x, y, n, chi2, phik) of every pair of columns, numeric or not.

    Each pair's cells, levels squared at most, are solved in one group.
    """
    schema = "x string, y string, n long, chi2 double, phik double"

    def solve(part):
        table = part.pivot(index="a", columns="b", values="m").fillna(0).to_numpy()
        n, share = table.sum(), np.outer(table.sum(axis=1), table.sum(axis=0)) / table.sum()
        found = part.iloc[:1][["x", "y"]].copy()
        found["n"], found["chi2"] = int(n), float(((table - share) ** 2 / share).sum())
        value = phik_of(table, noise)
        found["phik"] = np.nan if value is None else value
        return found

    found = cells_of_pairs(df, cols, bins, categories).groupBy("x", "y").applyInPandas(solve, schema)
    return found.withColumn("phik", F.when(~F.isnan("phik"), F.col("phik")))
