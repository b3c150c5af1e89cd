"""Profiles from state that merges: one small row per file and column, so that new files alone are read.

A state holds counts, sums, central moments and extremes, which merge exactly, a HyperLogLog sketch of the distinct
values and a KLL sketch of their distribution.  The rank error of KLL is about 2.3 / k ** 0.9 with a chance of 99 %, also
after merging: 0.07 % for the k used here.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.functions.columns import number
from tabulon.operators.profile import bin_index
from tabulon.operators.quantiles import cells_of, exact_quantiles
from tabulon.plans.shared import settle

KLL_K = 8_000
RANK_ERROR = 2.3 / KLL_K ** 0.9
HLL_BITS = 12
_PROBS = {"p05": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}


def _state_of(v) -> dict:
    """Aggregates of one column's cells: the state, and what central moments are made from."""
    x = F.col(v)
    return {"rows": F.count(F.lit(1)), "n": F.count(x), "zeros": F.count_if(x == 0), "negatives": F.count_if(x < 0),
            "sum": F.sum(x), "mean": F.avg(x), "min": F.min(x), "max": F.max(x), "_var": F.var_pop(x),
            "_skew": F.skewness(x), "_kurt": F.kurtosis(x), "distinct": F.hll_sketch_agg(F.when(x.isNotNull(), F.xxhash64(x + F.lit(0.0))), HLL_BITS),
            "quantiles": F.kll_sketch_agg_double(x, KLL_K)}


def profile_states(df: DataFrame, cols, by=()) -> DataFrame:
    """(by..., column, state...): one state per column, and per group of ``by``; one scan."""
    cells = cells_of(df, cols, by).groupBy(*by, "column").agg(*[e.alias(n) for n, e in _state_of("value").items()])
    m2 = F.coalesce(F.col("n") * F.col("_var"), F.lit(0.0))
    return cells.withColumns({
        "m2": m2, "m3": F.coalesce(F.col("_skew") * F.pow(m2, F.lit(1.5)) / F.sqrt("n"), F.lit(0.0)),
        "m4": F.coalesce((F.col("_kurt") + 3) * m2 * m2 / F.col("n"), F.lit(0.0))}).drop("_var", "_skew", "_kurt")


def merge_states(states: DataFrame, by=()) -> DataFrame:
    """States of parts to states of wholes, by column (and ``by``); merging again gives the same.

    Moments are moved to the common mean, so they stay exact up to rounding.
    """
    keys = [*by, "column"]
    whole = states.groupBy(*keys).agg(F.try_divide(F.sum("sum"), F.sum("n")).alias("_m"))
    same = None
    for k in keys:
        one = F.col(f"s.{k}").eqNullSafe(F.col(f"w.{k}"))
        same = one if same is None else same & one
    moved = states.alias("s").join(whole.alias("w"), same).select("s.*", F.coalesce(F.col("s.mean") - F.col("w._m"), F.lit(0.0)).alias("d"))
    n, d, m2, m3 = (F.col(c) for c in ("n", "d", "m2", "m3"))
    return moved.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("rows", "n", "zeros", "negatives")], F.sum("sum").alias("sum"),
        F.try_divide(F.sum("sum"), F.sum("n")).alias("mean"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double(F.when(n > 0, F.col("quantiles")), KLL_K).alias("quantiles"),
        F.sum(m2 + n * d * d).alias("m2"), F.sum(m3 + 3 * d * m2 + n * d * d * d).alias("m3"),
        F.sum(F.col("m4") + 4 * d * m3 + 6 * d * d * m2 + n * d * d * d * d).alias("m4"))


def _quantile(p: float):
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(min(1.0, max(0.0, p)))))


def statistics(states: DataFrame, by=()) -> DataFrame:
    """(by..., column, rows, count, missing, ..., p05 to p95, distinct): the profile that a state holds.

    Counts, sums, moments and extremes are exact; quantiles and distinct counts have the error of their sketches.
    """
    n, m2 = F.col("n").cast("double"), F.col("m2")
    std, spread = F.when(n > 1, F.sqrt(m2 / (n - 1))), m2 > 0
    g1, g2 = F.sqrt(n) * F.col("m3") / F.pow(m2, F.lit(1.5)), n * F.col("m4") / (m2 * m2) - 3
    return states.select(
        *by, "column", "rows", F.col("n").alias("count"), (F.col("rows") - F.col("n")).alias("missing"), "zeros", "negatives",
        "mean", "sum", "min", "max", (F.col("max") - F.col("min")).alias("range"), std.alias("std"),
        F.when(n > 1, m2 / (n - 1)).alias("variance"), F.try_divide(std, F.col("mean")).alias("cv"),
        F.when(spread & (n > 2), g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias("skewness"),
        F.when(spread & (n > 3), (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).alias("kurtosis"),
        *[_quantile(p).alias(name) for name, p in _PROBS.items()],
        F.when(n > 0, F.hll_sketch_estimate("distinct")).otherwise(0).alias("distinct"))


def brackets(states: DataFrame, probs) -> DataFrame:
    """(column, n, lo0, hi0, ...): where each quantile must lie by the sketch, three times its error to either side."""
    probs = sorted(probs)
    ends = []
    for j, p in enumerate(probs):
        low, high = p - 3 * RANK_ERROR, p + 3 * RANK_ERROR
        ends += [(F.col("min") if low <= 0 else _quantile(low)).alias(f"lo{j}"),
                 (F.col("max") if high >= 1 else _quantile(high)).alias(f"hi{j}")]
    return states.select("column", "n", *ends)


class ProfileStore:
    """States of files below a folder; adding files reads those files alone.

    One writer at a time.  A file is known by its name: a changed file needs a new one.
    """

    def __init__(self, spark: SparkSession, path: str, cols):
        self.spark, self.path, self.cols = spark, path.rstrip("/"), list(cols)

    def states(self) -> DataFrame | None:
        """(source, column, state...) of all files so far, or None."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return None
        return self.spark.read.parquet(self.path)

    def add(self, files: DataFrame) -> None:
        """Adds the states of the files that ``files`` (a frame read from them) has and the store has not.

        Files already known are left out before they are read: their names are taken from the frame's file list.
        """
        have, names = self.states(), files.inputFiles()
        known = set() if have is None else {r[0] for r in have.select("source").distinct().collect()}
        new = [f for f in names if f not in known]
        if not new:
            return
        # a condition on the file's name is no partition filter, so the reader is asked for the new files only
        rows = self.spark.read.schema(files.schema).parquet(*new).select(
            F.input_file_name().alias("source"), *[F.col(f"`{c}`") for c in self.cols])
        found = profile_states(rows, self.cols, ["source"])
        empty = self.spark.createDataFrame([(f,) for f in new], "source string").join(
            found.select(F.col("source")).distinct(), "source", "left_anti")
        found.unionByName(empty, allowMissingColumns=True).write.mode("append").parquet(self.path)

    def merged(self) -> DataFrame:
        """One state per column over all files."""
        return merge_states(self.states().filter("column is not null"))


@dataclass
class FullProfile:
    """The frames of one profile of numeric columns."""

    statistics: DataFrame
    histogram: DataFrame
    box: DataFrame
    correlation: DataFrame


def full_profile(df: DataFrame, cols, bins: int | str = "auto", states: DataFrame | None = None) -> FullProfile:
    """Statistics with exact quantiles, histograms, box statistics and Pearson correlations in three scans.

    The first makes the states (``states`` of the same rows, from a ``ProfileStore`` say, save it), whose sketches bracket
    the quantiles; the second counts the values inside the brackets; the third, with quartiles and edges known,
    bins the values, finds the whiskers and adds up the products of all pairs.
    """
    cols = list(cols)
    state, held = settle((states if states is not None else profile_states(df, cols)).filter(
        F.col("column").isin(cols)), bounded=True)  # one row per column
    probs = list(_PROBS.values())
    quantiles, found = settle(exact_quantiles(df, cols, probs, brackets=brackets(state, probs)), bounded=True)
    q = {r["column"]: r for r in found}
    stats = statistics(state).drop(*_PROBS).join(quantiles.select("column", *[
        F.col(f"q{i}").alias(name) for i, name in enumerate(_PROBS)]), "column")
    stats = stats.withColumn("iqr", F.col("p75") - F.col("p25"))
    edges = {}
    for r in held:
        low, high, n = r["min"], r["max"], r["n"]
        if not n:
            continue
        if high == low:
            edges[r["column"]] = (low - 0.5, high + 0.5, 1 if bins == "auto" else bins)
            continue
        count = bins
        if bins == "auto":
            width, fd = (high - low) / (math.log2(n) + 1), 2.0 * (q[r["column"]]["q3"] - q[r["column"]]["q1"]) / n ** (1 / 3)
            count = max(1, math.ceil((high - low) / (min(width, fd) if fd > 0 else width)))
        edges[r["column"]] = (low, high, count)
    return FullProfile(stats, *_third_scan(df, [c for c in cols if c in edges], edges, q))


def _third_scan(df, cols, edges, q):
    """Histogram, box statistics and correlations: one aggregate by (column, bin), whose rows add up to the others.

    Products of pairs go with the cells of their first column, moved by that column's middle, which keeps them small.
    """
    spark = df.sparkSession
    if not cols:
        none = spark.createDataFrame([], "column string, bin long, left double, right double, n long")
        return (none, spark.createDataFrame([], "column string, q1 double, median double, q3 double, whisker_low double, "
                                                "whisker_high double, outliers long"),
                spark.createDataFrame([], "column string, other string, corr double"))
    value = {c: number(c) for c in cols}
    fence = {c: (q[c]["q1"] - 1.5 * (q[c]["q3"] - q[c]["q1"]), q[c]["q3"] + 1.5 * (q[c]["q3"] - q[c]["q1"])) for c in cols}
    pairs = list(combinations(range(len(cols)), 2))
    cells = [F.struct(
        F.lit(c).alias("column"), bin_index(value[c], *edges[c]).alias("bin"), value[c].alias("v"),
        value[c].between(*[F.lit(f) for f in fence[c]]).alias("inside"), F.lit(i).alias("i"),
        F.array(*[F.when(value[c].isNotNull(), value[o] - F.lit(q[o]["q2"])) for o in cols[i + 1:]],
                *[F.lit(None).cast("double")] * (i + 1)).alias("after"),
        (value[c] - F.lit(q[c]["q2"])).alias("own")) for i, c in enumerate(cols)]
    rows = df.select(F.inline(F.array(*cells))).filter("v is not null")
    sums = []
    for k in range(len(cols) - 1):
        y = F.get("after", F.lit(k))
        both = y.isNotNull()
        x = F.when(both, F.col("own"))
        sums.append(F.struct(F.count(y).alias("n"), F.sum(x).alias("x"), F.sum(y).alias("y"), F.sum(x * x).alias("xx"),
                             F.sum(y * y).alias("yy"), F.sum(x * y).alias("xy")).alias(f"p{k}"))
    found, _ = settle(rows.groupBy("column", "i", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("inside"), F.col("v"))).alias("lo"),
        F.max(F.when(F.col("inside"), F.col("v"))).alias("hi"), F.count_if(~F.col("inside")).alias("outliers"), *sums), bounded=False)
    side = spark.createDataFrame([(c, edges[c][0], (edges[c][1] - edges[c][0]) / edges[c][2], q[c]["q1"], q[c]["q2"], q[c]["q3"])
                                  for c in cols], "column string, low double, width double, q1 double, median double, q3 double")
    joined = found.join(F.broadcast(side), "column")
    histogram = joined.select("column", "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("left"),
                              (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("right"), "n")
    box = joined.groupBy("column", "q1", "median", "q3").agg(
        F.min("lo").alias("whisker_low"), F.max("hi").alias("whisker_high"), F.sum("outliers").alias("outliers"))
    if not pairs:
        return histogram, box, spark.createDataFrame([], "column string, other string, corr double")
    whole = found.groupBy("column", "i").agg(*[F.sum(f"p{k}.{part}").alias(f"{part}{k}") for k in range(len(cols) - 1)
                                               for part in ("n", "x", "y", "xx", "yy", "xy")])
    named = F.array(*[F.lit(c) for c in cols])
    told = whole.select("column", "i", F.inline(F.array(*[F.struct(
        F.lit(k).alias("k"), *[F.col(f"{part}{k}").cast("double").alias(part) for part in ("n", "x", "y", "xx", "yy", "xy")])
        for k in range(len(cols) - 1)]))).filter(f"i + k + 1 < {len(cols)}")
    across = F.col("n") * F.col("xy") - F.col("x") * F.col("y")
    own = (F.col("n") * F.col("xx") - F.col("x") * F.col("x")) * (F.col("n") * F.col("yy") - F.col("y") * F.col("y"))
    return histogram, box, told.select("column", F.get(named, F.col("i") + F.col("k") + 1).alias("other"), F.when(
        own > 0, across / F.sqrt(own)).alias("corr"))
