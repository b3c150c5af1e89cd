"""Profiling: counts, statistics, histograms, box statistics, missingness."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.columns import hash_int, hash_text, number, ratio
from tabulon.operators.quantiles import cells_of, exact_quantiles, join_same, long_form
from tabulon.plans.ordered import ROW, SLICE, sorted_slices
from tabulon.plans.shared import broadcast_if_small, materialise, settle


def zero_counts(df: DataFrame, cols) -> DataFrame:
    """One row: number of zeros per column, named <column>_count0."""
    return df.agg(*[F.coalesce(F.sum((F.col(c) == 0).cast("int")), F.lit(0)).cast("long").alias(f"{c}_count0")
                    for c in cols])


def _per_column(cells, by, stats):
    """One row of statistics per column (and group)."""
    return cells.groupBy(*by, "column").agg(*[e.alias(n) for n, e in stats("value").items()])


def describe(df: DataFrame, cols, by=()) -> DataFrame:
    """Long form (by..., column, stat, value): count, mean, std, min, 25%, 50%, 75%, max."""
    by = list(by)
    found = exact_quantiles(df, cols, [0.25, 0.5, 0.75], by, also=lambda c: {
        "count": F.count(c).cast("double"), "mean": F.avg(c), "std": F.stddev_samp(c), "min": F.min(c), "max": F.max(c)})
    return found.withColumnsRenamed({"q0": "25%", "q1": "50%", "q2": "75%"}).unpivot(
        [*by, "column"], ["count", "mean", "std", "min", "25%", "50%", "75%", "max"], "stat", "value")


def quick_summary(df: DataFrame, cols, bins: int = 10) -> DataFrame:
    """One pass: counts, moments, approximate median and distinct count, small histogram."""
    return _per_column(cells_of(df, cols), [], lambda c: {
        "count": F.count(c), "missing": F.sum(F.col(c).isNull().cast("long")),
        "zeros": F.sum((F.col(c) == 0).cast("long")), "mean": F.avg(c), "std": F.stddev_samp(c),
        "min": F.min(c), "median": F.percentile_approx(c, 0.5), "max": F.max(c),
        "approx_distinct": F.approx_count_distinct(c), "histogram": F.histogram_numeric(c, F.lit(bins))})


def profile_overview(df: DataFrame) -> DataFrame:
    """One row: rows, columns, missing cells, duplicate rows, column-type counts."""
    fields = df.schema.fields
    numeric = sum(f.dataType.typeName() in
                  ("byte", "short", "integer", "long", "float", "double") or
                  f.dataType.typeName().startswith("decimal") for f in fields)
    text = sum(f.dataType.typeName() == "string" for f in fields)
    # Equal rows are counted together first, so every later sum runs over distinct rows.
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    nulls = sum((F.col(f"`{f.name}`").isNull().cast("long") for f in fields), F.lit(0))
    totals = groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(nulls * F.col("_copies")), F.lit(0)).alias("missing_cells"),
        F.coalesce(F.sum((F.col("_copies") > 1).cast("long")), F.lit(0)).alias("duplicated_groups"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"))
    n_cols = len(fields)
    return totals.select(
        "n_rows", F.lit(n_cols).cast("long").alias("n_columns"), "missing_cells",
        ratio(F.col("missing_cells") * 100, F.col("n_rows") * n_cols).alias("missing_pct"),
        "duplicated_groups", "duplicate_rows",
        ratio(F.col("duplicate_rows") * 100, F.col("n_rows")).alias("duplicate_pct"),
        F.lit(numeric).cast("long").alias("numeric_columns"), F.lit(text).cast("long").alias("text_columns"),
        F.lit(n_cols - numeric - text).cast("long").alias("other_columns"))


def _counts(c):
    x = F.col(c)
    return {
        "rows": F.count(F.lit(1)), "count": F.count(c),
        "missing": F.sum(x.isNull().cast("long")), "zeros": F.coalesce(F.sum((x == 0).cast("long")), F.lit(0)),
        "negatives": F.coalesce(F.sum((x < 0).cast("long")), F.lit(0)),
        "mean": F.avg(c), "sum": F.sum(c), "min": F.min(c), "max": F.max(c)}


def _central(d):
    """Sums of powers of the distance from the mean: stable, and cheap beside one moment aggregate each."""
    return {"m2": F.sum(d * d), "m3": F.sum(d * d * d), "m4": F.sum(d * d * d * d)}


def profile_columns(df: DataFrame, cols, key: str | None = None, exact: bool = True) -> DataFrame:
    """One row per column.  ``key`` adds monotone flags in key order; ``exact=False`` takes quantiles
    and distinct counts from sketches, in two scans altogether."""
    cols = list(cols)
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    if exact:
        first = exact_quantiles(df, cols, probs, also=_counts)
    else:
        first = _per_column(cells_of(df, cols), [], lambda c: {
            **_counts(c), "q": F.percentile_approx(c, probs, 10_000), "distinct": F.approx_count_distinct(c)})
        first = first.select("*", *[F.element_at("q", j + 1).alias(f"q{j}") for j in range(5)]).drop("q")
    base, rows = settle(first, bounded=True)  # one row per column
    mean = {r["column"]: r["mean"] for r in rows}
    median = {r["column"]: r["q2"] for r in rows}

    def off(centre):
        return df.select(*[(number(c) - F.lit(centre[c]).cast("double")).alias(c) for c in cols])

    if exact:
        spread = _per_column(cells_of(off(mean), cols), [], lambda c: _central(F.col(c)))
        distance = off(median).select(*[F.abs(c).alias(c) for c in cols])
        mad = exact_quantiles(distance, cols, [0.5]).select("column", F.col("q0").alias("mad"))
        distinct = long_form(df, cols).groupBy("column").agg(F.count_distinct("value").alias("distinct"))
        second = spread.join(mad, "column").join(distinct, "column", "left")
        second = second.withColumn("distinct", F.coalesce("distinct", F.lit(0)))
    else:
        both = df.select(*[F.struct((number(c) - F.lit(mean[c]).cast("double")).alias("d"),
                                    F.abs(number(c) - F.lit(median[c]).cast("double")).alias("a")).alias(c) for c in cols])
        second = _per_column(both.unpivot([], cols, "column", "value"), [], lambda c: {
            **_central(F.col(f"{c}.d")), "mad": F.percentile_approx(F.col(f"{c}.a"), 0.5, 10_000)})
    out = base.join(second, "column")
    n, m2 = F.col("count").cast("double"), F.col("m2")
    spread_out = m2 > 0
    g1 = F.sqrt(n) * F.col("m3") / F.pow(m2, F.lit(1.5))
    g2 = n * F.col("m4") / (m2 * m2) - 3
    std = F.when(n > 1, F.sqrt(m2 / (n - 1)))
    out = out.select(
        "column", "rows", "count", "missing", "zeros", "negatives", "mean", "sum", "min", "max",
        (F.col("max") - F.col("min")).alias("range"), std.alias("std"),
        F.when(n > 1, m2 / (n - 1)).alias("variance"), F.try_divide(std, F.col("mean")).alias("cv"),
        # sample-corrected
        F.when(spread_out & (n > 2), g1 * F.sqrt(n * (n - 1)) / (n - 2)).alias("skewness"),
        F.when(spread_out & (n > 3), (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)).alias("kurtosis"),
        F.col("q0").alias("p05"), F.col("q1").alias("p25"), F.col("q2").alias("median"), F.col("q3").alias("p75"),
        F.col("q4").alias("p95"), "distinct", "mad", (F.col("q3") - F.col("q1")).alias("iqr"))
    return out.join(monotone(df, cols, key), "column", "left") if key else out


def monotone(df: DataFrame, cols, key: str) -> DataFrame:
    """(column, increasing, decreasing): whether values never fall / never rise in key order."""
    cols = list(cols)
    slices = sorted_slices(df.select(F.col(key).alias("_k"), *[number(c).alias(f"v_{c}") for c in cols]), ["_k"])
    w = Window.partitionBy(SLICE).orderBy(ROW)
    steps = slices.select(SLICE, ROW, *[
        F.struct(F.col(f"v_{c}").alias("v"), (F.col(f"v_{c}") - F.lag(f"v_{c}").over(w)).alias("step")).alias(f"s{i}")
        for i, c in enumerate(cols)])
    parts = steps.groupBy(SLICE).agg(*[
        F.struct(F.min(f"s{i}.step").alias("low"), F.max(f"s{i}.step").alias("high"),
                 F.min_by(f"s{i}.v", ROW).alias("first"), F.max_by(f"s{i}.v", ROW).alias("last"),
                 F.sum(F.col(f"s{i}.v").isNull().cast("int")).alias("nulls")).alias(f"c{i}")
        for i in range(len(cols))])
    rows = parts.select(SLICE, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("c")) for i, c in enumerate(cols)])))
    edge = Window.partitionBy("column").orderBy(SLICE)  # one row per slice
    rows = rows.select("column", "c.*", (F.col("c.first") - F.lag("c.last").over(edge)).alias("jump"))
    return rows.groupBy("column").agg(
        (F.min(F.least("low", "jump")).isNull() | (F.min(F.least("low", "jump")) >= 0)).alias("_up"),
        (F.max(F.greatest("high", "jump")).isNull() | (F.max(F.greatest("high", "jump")) <= 0)).alias("_down"),
        F.sum("nulls").alias("_nulls"),
    ).select("column", (F.col("_up") & (F.col("_nulls") == 0)).alias("increasing"),
             (F.col("_down") & (F.col("_nulls") == 0)).alias("decreasing"))


def top_values(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The k most frequent values; ties by value."""
    return (df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc_nulls_last("value")).limit(k))


def extremes(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The k smallest and k largest distinct values with their counts."""
    counted = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    low = counted.orderBy("value").limit(k).select(F.lit("smallest").alias("side"), "value", "n")
    high = counted.orderBy(F.desc("value")).limit(k).select(F.lit("largest").alias("side"), "value", "n")
    return low.unionByName(high)


def bin_edges(df: DataFrame, cols, bins="auto", quartiles: DataFrame | None = None) -> dict[str, tuple[float, float, int]]:
    """(low, high, bin count) per column: one small row on the driver per column.

    "auto" takes the larger of Sturges' and Freedman-Diaconis' counts.
    """
    cols = list(cols)
    limits = _per_column(cells_of(df, cols), [], lambda c: {
        "n": F.count(c), "lo": F.min(c), "hi": F.max(c)})
    stats = {r["column"]: r for r in limits.collect()}
    iqr = {}
    if bins == "auto":
        iqr = {r["column"]: (r["q1"] or 0.0) - (r["q0"] or 0.0)
               for r in (quartiles or exact_quantiles(df, cols, [0.25, 0.75])).collect()}
    edges = {}
    for c in cols:
        n, lo, hi = stats[c]["n"], stats[c]["lo"], stats[c]["hi"]
        if not n:
            continue
        if hi == lo:
            lo, hi = lo - 0.5, hi + 0.5
            count = 1 if bins == "auto" else bins
        elif bins == "auto":
            width = (hi - lo) / (math.log2(n) + 1)
            fd = 2.0 * iqr[c] / n ** (1.0 / 3.0)
            width = min(width, fd) if fd > 0 else width
            count = max(1, math.ceil((hi - lo) / width))
        else:
            count = bins
        edges[c] = (lo, hi, count)
    return edges


def bin_index(col, lo: float, hi: float, count: int):
    """0-based equal-width bin; the last bin is closed; a missing value has none."""
    width = (hi - lo) / count
    return F.when(col.isNotNull(), F.least(F.floor((col - F.lit(lo)) / F.lit(width)), F.lit(count - 1)).cast("long"))


def histogram(df: DataFrame, cols, bins="auto", by=None, quartiles: DataFrame | None = None,
              empty: bool = False) -> DataFrame:
    """(by, column, bin, left, right, n) with shared edges for all groups.

    Bins that hold rows; with ``empty``, which takes no ``by``, all bins, n = 0 where there are none (a far
    outlier can make "auto" ask for very many)."""
    if empty and by:
        raise ValueError("empty bins are listed for whole columns only")
    cols = list(cols)
    edges = bin_edges(df, cols, bins, quartiles)
    have = [c for c in cols if c in edges]
    spark = df.sparkSession
    by_cols = [by] if by else []
    if not have:
        none = spark.createDataFrame([], "column string, bin long, left double, right double, n long")
        return df.select(*by_cols).limit(0).crossJoin(none) if by else none
    binned = df.select(*by_cols, *[bin_index(number(c), *edges[c]).alias(c) for c in have])
    counts = (binned.unpivot(by_cols, have, "column", "bin").filter(F.col("bin").isNotNull())
              .groupBy(*by_cols, "column", "bin").agg(F.count(F.lit(1)).alias("n")))
    lo = F.coalesce(*[F.when(F.col("column") == c, F.lit(edges[c][0])) for c in have])
    width = F.coalesce(*[F.when(F.col("column") == c, F.lit((edges[c][1] - edges[c][0]) / edges[c][2])) for c in have])
    for c in have if empty else ():
        counts = counts.unionByName(spark.range(edges[c][2]).select(
            F.lit(c).alias("column"), F.col("id").alias("bin"), F.lit(0).cast("long").alias("n")))
    if empty:
        counts = counts.groupBy("column", "bin").agg(F.sum("n").alias("n"))
    return counts.select(*by_cols, "column", "bin", (lo + F.col("bin") * width).alias("left"),
                         (lo + (F.col("bin") + 1) * width).alias("right"),
                         F.coalesce("n", F.lit(0)).cast("long").alias("n"))


# Bandwidths beyond which a kernel counts for nothing: less than 1e-9 of its peak.
_REACH = 6.5


def kde(df: DataFrame, col: str, grid: int = 200, by: str | None = None, fine: int | None = None,
        tolerance: float | None = None) -> DataFrame:
    """Gaussian kernel density on an even grid, Scott's bandwidth.

    Values are counted before kernels are summed, so the kernel work is distinct values x grid.  ``tolerance`` shares each
    value out to the two nearest points of a fine lattice instead, and kernels reach 6.5 bandwidths: the work is rows +
    lattice x the grid points in reach, whatever the number of values.  Linear shares over a step d move a kernel of
    bandwidth h by at most d * d / (8 h * h) of its peak, so the step follows from the tolerance, a share of the peak.
    ``fine`` folds the values into that many equal bins (an approximation, by choice).
    """
    by_cols = [by] if by else []
    spark = df.sparkSession
    x = df.select(*by_cols, number(col).alias("v")).filter(F.col("v").isNotNull())
    lim = x.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    lo, hi = lim["lo"], lim["hi"]
    if lo is None:
        return spark.createDataFrame([], "x double, density double")
    stats = x.groupBy(*by_cols).agg(F.count("v").alias("n"), F.stddev_samp("v").alias("sd"))
    stats = stats.withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).filter("h > 0")
    if by:
        stats = materialise(stats)
        least = stats.agg(F.min("h").alias("h")).first()["h"]
    else:
        one = stats.first()
        least = None if one is None else one["h"]
    if least is None:
        return x.select(*by_cols).limit(0).crossJoin(spark.createDataFrame([], "x double, density double"))
    if fine and hi > lo:
        width = (hi - lo) / fine
        x = x.withColumn("v", F.lit(lo) + (bin_index(F.col("v"), lo, hi, fine) + 0.5) * width)
    if tolerance:
        d = least * math.sqrt(8 * tolerance)
        place = (F.col("v") - F.lit(lo)) / F.lit(d)
        low = F.floor(place)
        shares = F.array(F.struct(low.alias("_i"), (1 - (place - low)).alias("w")), F.struct((low + 1).alias("_i"), (place - low).alias("w")))
        counted = x.select(*by_cols, F.inline(shares)).groupBy(*by_cols, "_i").agg(F.sum("w").alias("m"))
        counted = counted.select(*by_cols, (F.lit(lo) + F.col("_i") * F.lit(d)).alias("v"), "m")
    else:
        counted = x.groupBy(*by_cols, "v").agg(F.count(F.lit(1)).alias("m"))
    step = (hi - lo) / (grid - 1)
    if by:
        joined = join_same(counted, broadcast_if_small(stats), by_cols, "inner")
    else:
        joined = counted.withColumns({"n": F.lit(one["n"]), "h": F.lit(one["h"])})
    first, last = F.lit(0), F.lit(grid - 1)
    if tolerance:
        first = F.greatest(first, F.ceil((F.col("v") - F.lit(lo) - _REACH * F.col("h")) / F.lit(step)).cast("int"))
        last = F.least(last, F.floor((F.col("v") - F.lit(lo) + _REACH * F.col("h")) / F.lit(step)).cast("int"))
        joined = joined.withColumns({"_a": first, "_z": last}).filter("_a <= _z")
        first, last = F.col("_a"), F.col("_z")
    # a grid point keeps its number until the kernels are added up, so that all sums of a point meet
    z = (F.lit(lo) + F.col("_grid") * F.lit(step) - F.col("v")) / F.col("h")
    dense = (joined.withColumn("_grid", F.explode(F.sequence(first, last))).groupBy(*by_cols, "_grid")
             .agg((F.sum(F.col("m") * F.exp(-0.5 * z * z) / (F.col("n") * F.col("h"))) / F.lit(math.sqrt(2 * math.pi))).alias("density")))
    if tolerance:
        groups = stats.select(*by_cols) if by else spark.range(1).select()
        every = groups.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("_grid"))
        dense = join_same(every, dense, [*by_cols, "_grid"]).fillna(0.0, ["density"])
    return dense.select(*by_cols, (F.lit(lo) + F.col("_grid") * F.lit(step)).alias("x"), "density")


def _fences(df, cols, by):
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], by)
    iqr = F.col("q2") - F.col("q0")
    return q.select(*by, "column", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"),
                    (F.col("q0") - 1.5 * iqr).alias("lower_fence"), (F.col("q2") + 1.5 * iqr).alias("upper_fence"))


def box_stats(df: DataFrame, cols, by=None) -> DataFrame:
    """Median, quartiles, whiskers (furthest value within 1.5 IQR), outlier count; per group if ``by``."""
    by_cols = [by] if by else []
    fences = broadcast_if_small(_fences(df, cols, by_cols))
    v = F.col("value")
    inside = (v >= F.col("lower_fence")) & (v <= F.col("upper_fence"))
    joined = join_same(long_form(df, cols, by_cols), fences, [*by_cols, "column"], "inner")
    return joined.groupBy(*by_cols, "column", "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.sum((~inside).cast("long")).alias("outliers"))


def flag_outliers(df: DataFrame, cols, rule: str = "iqr", by=None, k: float | None = None, keep: str = "flag") -> DataFrame:
    """Mark (``keep="flag"``: <column>_outlier) or remove (``keep="inliers"``) rows outside the
    IQR fences or beyond k standard deviations of the mean."""
    cols, by_cols = list(cols), [by] if by else []
    if rule == "iqr":
        k = 1.5 if k is None else k
        q = exact_quantiles(df, cols, [0.25, 0.75], by_cols)
        limits = q.select(*by_cols, "column", (F.col("q0") - k * (F.col("q1") - F.col("q0"))).alias("lo"),
                          (F.col("q1") + k * (F.col("q1") - F.col("q0"))).alias("hi"))
    else:
        k = 3.0 if k is None else k
        limits = _per_column(cells_of(df, cols, by_cols), by_cols, lambda c: {
            "lo": F.avg(c) - k * F.stddev_samp(c), "hi": F.avg(c) + k * F.stddev_samp(c)})
    if by:
        wide = limits.groupBy(*by_cols).agg(*[
            F.max(F.when(F.col("column") == c, F.struct("lo", "hi"))).alias(f"_lim{i}")
            for i, c in enumerate(cols)])
        joined = join_same(df, broadcast_if_small(materialise(wide)), by_cols)
    else:
        found = {r["column"]: (r["lo"], r["hi"]) for r in limits.collect()}  # one row per column
        joined = df.withColumns({
            f"_lim{i}": F.struct(*[F.lit(v).cast("double").alias(n) for n, v in zip(("lo", "hi"), found[c])])
            for i, c in enumerate(cols)})
    flags = [F.coalesce((number(c) < F.col(f"_lim{i}.lo")) | (number(c) > F.col(f"_lim{i}.hi")), F.lit(False))
             for i, c in enumerate(cols)]
    if keep == "inliers":
        any_flag = F.lit(False)
        for f in flags:
            any_flag = any_flag | f
        return joined.filter(~any_flag).select(*df.columns)
    return joined.select(*df.columns, *[f.alias(f"{c}_outlier") for c, f in zip(cols, flags)])


def missing_report(df: DataFrame, cols) -> DataFrame:
    """(column, missing, missing_pct)."""
    gone = df.select(*[F.col(c).isNull().cast("long").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    return _per_column(gone, [], lambda c: {
        "missing": F.sum(c), "missing_pct": ratio(F.sum(c) * 100, F.count(F.lit(1)))})


def joint_hist(df: DataFrame, x: str, y: str, bins: int = 10, by: str | None = None) -> DataFrame:
    """(by, bin_x, bin_y, n): two-dimensional bins, in place of raw scatter points."""
    edges = bin_edges(df, [x, y], bins)
    by_cols = [by] if by else []
    if x not in edges or y not in edges:  # a column without a value has no bins
        return df.select(*by_cols, F.lit(0).cast("long").alias("bin_x"), F.lit(0).cast("long").alias("bin_y"),
                         F.lit(0).cast("long").alias("n")).limit(0)
    pairs = df.select(*by_cols, bin_index(number(x), *edges[x]).alias("bin_x"),
                      bin_index(number(y), *edges[y]).alias("bin_y"))
    return pairs.dropna(subset=["bin_x", "bin_y"]).groupBy(*by_cols, "bin_x", "bin_y").agg(
        F.count(F.lit(1)).alias("n"))


def sample_points(df: DataFrame, key: str, cols, share: float, seed: int = 0) -> DataFrame:
    """A repeatable sample of points for drawing, chosen by a hash of the key."""
    return df.filter(hash_int(hash_text(key, F.lit(str(seed)))) < int(share * (1 << 32))).select(key, *cols)


def group_profile(df: DataFrame, by, cols) -> DataFrame:
    """Row count and mean of each column per group."""
    by_cols = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by_cols).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"{c}_mean") for c in cols])


def suggest_imputation(profile: DataFrame, threshold: float = 1.0) -> DataFrame:
    """Median for skewed columns, mean for near-normal ones; the threshold is our choice."""
    return profile.select("column", "skewness", F.when(F.abs("skewness") > threshold, F.lit("median"))
                          .otherwise(F.lit("mean")).alias("strategy"))


def compare_profiles(a: DataFrame, b: DataFrame, stats) -> DataFrame:
    """Two profiles side by side: <stat>_a, <stat>_b, <stat>_diff per column."""
    left = a.select("column", *[F.col(s).alias(f"{s}_a") for s in stats])
    right = b.select("column", *[F.col(s).alias(f"{s}_b") for s in stats])
    joined = left.join(right, "column", "full_outer")
    return joined.select("column", *[e for s in stats for e in (
        F.col(f"{s}_a"), F.col(f"{s}_b"), (F.col(f"{s}_b") - F.col(f"{s}_a")).alias(f"{s}_diff"))])


def alerts(profile: DataFrame, corr: DataFrame | None = None, zeros: float = 0.1, missing: float = 0.05,
           skew: float = 20.0, high: float = 0.5) -> DataFrame:
    """(column, alert, value): many zeros, missing, skew, constant, unique, high correlation."""
    p = profile
    rules = [
        ("zeros", ratio(p["zeros"], p["rows"]), zeros), ("missing", ratio(p["missing"], p["rows"]), missing),
        ("skewed", F.abs(p["skewness"]), skew)]
    out = None
    parts = [p.filter(v > limit).select("column", F.lit(name).alias("alert"), v.cast("double").alias("value"))
             for name, v, limit in rules]
    parts.append(p.filter("distinct = 1").select("column", F.lit("constant").alias("alert"), F.lit(1.0).alias("value")))
    parts.append(p.filter("distinct = count and count > 1").select(
        "column", F.lit("unique").alias("alert"), F.col("distinct").cast("double").alias("value")))
    if corr is not None:
        parts.append(corr.filter((F.abs("r") > high) & (F.col("x") != F.col("y"))).select(
            F.col("x").alias("column"), F.lit("high_correlation").alias("alert"), F.abs("r").alias("value")))
    for part in parts:
        out = part if out is None else out.unionByName(part)
    return out
