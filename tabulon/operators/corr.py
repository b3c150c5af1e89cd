"""Correlation matrices in long form (x, y, r), pairwise complete."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.functions.columns import number
from tabulon.operators.profile import bin_edges, bin_index
from tabulon.operators.quantiles import cells_of
from tabulon.plans.ordered import running
from tabulon.plans.shared import BROADCAST_ROWS, materialise
from tabulon.plans.skew import keyed_left_join


def corr_matrix(df: DataFrame, cols, method: str = "pearson", lower: bool = False, bins: int | None = None) -> DataFrame:
    """pearson, spearman, kendall or cramers_v for every column pair.

    ``lower`` keeps the strict lower triangle.  ``bins`` folds the columns into equal-width bins
    first: always done for cramers_v (10 by default), and an explicit approximation for the
    rank methods, which are exact without it.
    """
    cols = list(cols)
    index = {c: i for i, c in enumerate(cols)}
    methods = {"pearson": _pearson, "spearman": _spearman, "kendall": _kendall, "cramers_v": _cramers_v}
    half = methods[method](df, cols, bins)
    later = F.coalesce(*[F.when(F.col("y") == c, F.lit(i)) for c, i in index.items()]) > F.coalesce(
        *[F.when(F.col("x") == c, F.lit(i)) for c, i in index.items()])
    if lower:
        return half.select(F.when(later, F.col("y")).otherwise(F.col("x")).alias("x"),
                           F.when(later, F.col("x")).otherwise(F.col("y")).alias("y"), "r")
    diagonal = cells_of(df, cols).groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).select(
        F.col("column").alias("x"), F.col("column").alias("y"), F.when(F.col("lo") < F.col("hi"), F.lit(1.0)).alias("r"))
    both = F.array(F.struct("x", "y", "r"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"), "r"))
    return half.select(F.inline(both)).unionByName(diagonal)


def _value_pairs(nums, pairs):
    """(pair, x, y): one row per column pair and row with both values; pair is the pair's number."""
    packed = nums.select(*[F.struct(F.col(a).alias("x"), F.col(b).alias("y")).alias(str(i))
                           for i, (a, b) in enumerate(pairs)])
    long = packed.unpivot([], [str(i) for i in range(len(pairs))], "pair", "v")
    return long.select(F.col("pair").cast("int").alias("pair"), "v.x", "v.y").filter(
        F.col("x").isNotNull() & F.col("y").isNotNull())


_WIDE_PAIRS = 64


def _pearson(df, cols, bins):
    """One scan either way: few pairs as one wide aggregate, many grouped by pair number, so the
    generated code does not grow with the square of the columns."""
    pairs = list(combinations(cols, 2))
    nums = df.select(*[number(c).alias(c) for c in cols])

    def parts(x, y):
        return F.regr_sxy(x, y), F.regr_sxx(x, y), F.regr_syy(x, y)

    def r(xy, xx, yy):
        # not corr(): on a constant column it divides by zero, an error under ANSI
        return F.try_divide(xy, F.sqrt(xx) * F.sqrt(yy))

    if len(pairs) <= _WIDE_PAIRS:
        return nums.agg(F.array(*[
            F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), r(*parts(a, b)).alias("r"))
            for a, b in pairs]).alias("all")).select(F.inline("all"))
    sums = _value_pairs(nums, pairs).groupBy("pair").agg(*[e.alias(n) for n, e in zip(("xy", "xx", "yy"), parts("x", "y"))])
    return _named(sums.select("pair", r(F.col("xy"), F.col("xx"), F.col("yy")).alias("r")), pairs)


def _numbers(df, cols, bins=None):
    """The columns as doubles, or as their bins, and their names; columns without a value have no bins and are left out."""
    if not bins:
        return df.select(*[number(c).alias(c) for c in cols]), cols
    edges = bin_edges(df, cols, bins)
    cols = [c for c in cols if c in edges]
    return df.select(*[bin_index(number(c), *edges[c]).cast("double").alias(c) for c in cols]), cols


def _cells(df, cols, bins=None):
    """(pair, x, y, m): value pairs with their counts, for every column pair."""
    nums, cols = _numbers(df, cols, bins)
    pairs = list(combinations(cols, 2))
    cells = _value_pairs(nums, pairs).groupBy("pair", "x", "y").agg(F.count(F.lit(1)).alias("m"))
    return materialise(cells), pairs


def _longest(cells):
    return cells.groupBy("pair").count().agg(F.max("count")).first()[0] or 0


def _named(result: DataFrame, pairs) -> DataFrame:
    """pair numbers back to column names; pairs without a value get NULL."""
    spark = result.sparkSession
    names = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pair int, x string, y string")
    return names.join(F.broadcast(result), "pair", "left").select("x", "y", "r")


def _mid_ranks(nums, cols):
    """(column, v, n0.., r0..) and the number of values of each column.

    ``column`` is a column's number and v a value of it; n_i counts its rows that have the i-th column too, and r_i is
    the centred mid-rank of v among such rows.
    """
    each = [nums.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("v")).agg(
        *[F.count(other).alias(f"n{i}") for i, other in enumerate(cols)]).withColumn("column", F.lit(at))
        for at, c in enumerate(cols)]
    counts = materialise(reduce(DataFrame.unionByName, each), "values")
    sizes = counts.groupBy("column").agg(F.count(F.lit(1)).alias("values"), *[
        F.sum(f"n{i}").alias(f"all{i}") for i in range(len(cols))])  # one row per column
    values = {r["column"]: r["values"] for r in sizes.collect()}
    upto = running(counts, ["v"], by=["column"], sums={f"u{i}": f"n{i}" for i in range(len(cols))},
                   longest=max(values.values(), default=0)).join(F.broadcast(sizes), "column")
    ranks = [(F.col(f"u{i}") - (F.col(f"n{i}") - 1) / 2.0 - (F.col(f"all{i}") + 1) / 2.0).alias(f"r{i}")
             for i in range(len(cols))]
    return materialise(upto.select("column", "v", *[f"n{i}" for i in range(len(cols))], *ranks), "ranks"), values


def _spearman(df, cols, bins):
    """Pearson on mid-ranks.

    Each column's values are counted and ranked once, for all its partners.  The ranks of a column of few values are
    looked up for every row; a column of many values adds up its partners' ranks by its own values, so a pair has
    no value pairs.  Only two columns of many values meet in their value pairs.
    """
    nums, cols = _numbers(df, cols, bins)
    nums, pairs = materialise(nums, "numbers"), list(combinations(cols, 2))
    ranks, values = _mid_ranks(nums, cols)
    few = {i for i in range(len(cols)) if values.get(i, 0) * len(cols) <= BROADCAST_ROWS}

    def ranks_of(at, v, named):
        return ranks.filter(F.col("column") == at).select(F.col("v").alias(v), *[
            F.col(f"r{i}").alias(name) for i, name in named.items()])

    rows = nums.select(*[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    for i in sorted(few):
        others = {j: f"r{i}_{j}" for j in range(len(cols)) if j != i}
        rows = rows.join(F.broadcast(ranks_of(i, f"v{i}", others)), f"v{i}", "left")  # few, as counted
    number_of = {(cols.index(a), cols.index(b)): n for n, (a, b) in enumerate(pairs)}
    found = []
    both = [ij for ij in number_of if few.issuperset(ij)]
    if both:
        products = F.array(*[F.struct(F.lit(number_of[i, j]).alias("pair"), (
            F.col(f"r{i}_{j}") * F.col(f"r{j}_{i}")).alias("ab")) for i, j in both])
        found.append(rows.select(F.inline(products)).groupBy("pair").agg(F.sum("ab").alias("ab")))
    for i in sorted(set(range(len(cols))) - few):
        partners = sorted(few)
        if partners:
            sums = rows.filter(F.col(f"v{i}").isNotNull()).groupBy(f"v{i}").agg(*[
                F.sum(f"r{j}_{i}").alias(f"s{j}") for j in partners])
            own = sums.join(ranks_of(i, f"v{i}", {j: f"r{j}" for j in partners}), f"v{i}")
            products = F.array(*[F.struct(F.lit(number_of[min(i, j), max(i, j)]).alias("pair"), (
                F.col(f"s{j}") * F.col(f"r{j}")).alias("ab")) for j in partners])
            found.append(own.select(F.inline(products)).groupBy("pair").agg(F.sum("ab").alias("ab")))
    many = [ij for ij in number_of if not few.intersection(ij)]
    if many:
        cells = materialise(_value_pairs(nums, [(cols[i], cols[j]) for i, j in many]).groupBy("pair", "x", "y").agg(
            F.count(F.lit(1)).alias("m")))
        x, y = (reduce(DataFrame.unionByName, [
            ranks_of(ij[side], name, {ij[1 - side]: f"r{name}"}).withColumn("pair", F.lit(at))
            for at, ij in enumerate(many)]) for side, name in enumerate("xy"))
        per_y = keyed_left_join(cells, x, ["pair", "x"]).groupBy("pair", "y").agg(
            F.sum(F.col("m") * F.col("rx")).alias("s"))
        own = F.element_at(F.array(*[F.lit(number_of[ij]) for ij in many]), F.col("pair") + 1)
        found.append(per_y.join(y, ["pair", "y"]).groupBy(own.alias("pair")).agg(
            F.sum(F.col("s") * F.col("ry")).alias("ab")))
    if not found:
        return _named(nums.sparkSession.createDataFrame([], "pair int, r double"), pairs)
    squares = {r["column"]: r for r in ranks.groupBy("column").agg(*[
        F.sum(F.col(f"n{i}") * F.col(f"r{i}") * F.col(f"r{i}")).alias(f"q{i}")
        for i in range(len(cols))]).collect()}  # one row per column
    norms = nums.sparkSession.createDataFrame(
        [(n, squares[i][f"q{j}"], squares[j][f"q{i}"]) for (i, j), n in number_of.items() if i in squares and j in squares],
        "pair int, aa double, bb double")
    r = F.try_divide(F.col("ab"), F.sqrt("aa") * F.sqrt("bb"))
    return _named(reduce(DataFrame.unionByName, found).join(F.broadcast(norms), "pair").select("pair", r.alias("r")), pairs)


def _pairs_of(n):
    return n.cast("double") * (n - 1).cast("double") / 2.0


def _fewer_y(cells):
    """The cells, x and y changed about in the pairs where y has more values than x."""
    x, y = ({r["pair"]: r["count"] for r in cells.select("pair", side).distinct().groupBy("pair").count().collect()}
            for side in ("x", "y"))  # one row per column pair
    turned = F.col("pair").isin([pair for pair, n in x.items() if n < y[pair]])
    return cells.select("pair", F.when(turned, F.col("y")).otherwise(F.col("x")).alias("x"),
                        F.when(turned, F.col("x")).otherwise(F.col("y")).alias("y"), "m")


def _kendall(df, cols, bins):
    """tau-b by counting concordant pairs bit by bit.

    Two rows with different y-ranks differ first at exactly one bit of the rank.  For each bit
    level, rows that agree above it form a group; inside it every row with the bit set is
    concordant with the rows without it that have a smaller x: a running count, so the work
    is cells x log2(distinct y), not pairs of cells.  y is the side of fewer values; tau is the same either way.
    """
    cells, pairs = _cells(df, cols, bins)
    cells, longest = _fewer_y(cells), _longest(cells)
    tx = cells.groupBy("pair", "x").agg(F.sum("m").alias("t"))
    ty = cells.groupBy("pair", "y").agg(F.sum("m").alias("t"), F.lit(1).alias("one"))
    ranks = running(ty, ["y"], by=["pair"], sums={"r": "one"}, longest=longest).select(
        "pair", "y", (F.col("r") - 1).alias("r"))
    ranked = materialise(keyed_left_join(cells, ranks, ["pair", "y"]))
    # each pair has the levels of its own ranks: above them every bit is 0 and nothing is concordant
    levels = F.broadcast(ranked.groupBy("pair").agg(F.greatest(F.length(F.bin(F.max("r"))), F.lit(1)).alias("levels")))
    spread = (ranked.join(levels, "pair")
              .withColumn("level", F.explode(F.sequence(F.lit(0), F.col("levels") - 1)))
              .select("pair", "level", F.expr("shiftright(r, level + 1)").alias("prefix"), "x", "m",
                      F.expr("shiftright(r, level) & 1").alias("bit")))
    grouped = spread.groupBy("pair", "level", "prefix", "x").agg(
        F.sum(F.when(F.col("bit") == 0, F.col("m")).otherwise(F.lit(0))).alias("n0"),
        F.sum(F.when(F.col("bit") == 1, F.col("m")).otherwise(F.lit(0))).alias("n1"))
    counted = running(grouped, ["x"], by=["pair", "level", "prefix"], sums={"u": "n0"}, longest=longest)
    conc = counted.groupBy("pair").agg(
        F.sum(F.col("n1").cast("double") * (F.col("u") - F.col("n0")).cast("double")).alias("conc"))
    n0 = cells.groupBy("pair").agg(F.sum("m").alias("n"), F.sum(_pairs_of(F.col("m"))).alias("tied_both"))
    n1 = tx.groupBy("pair").agg(F.sum(_pairs_of(F.col("t"))).alias("tied_x"))
    n2 = ty.groupBy("pair").agg(F.sum(_pairs_of(F.col("t"))).alias("tied_y"))
    all_ = n0.join(n1, "pair").join(n2, "pair").join(conc, "pair").withColumn("n0", _pairs_of(F.col("n")))
    diff = 2 * F.col("conc") - (F.col("n0") - F.col("tied_x") - F.col("tied_y") + F.col("tied_both"))
    r = F.try_divide(diff, F.sqrt(F.col("n0") - F.col("tied_x")) * F.sqrt(F.col("n0") - F.col("tied_y")))
    return _named(all_.select("pair", r.alias("r")), pairs)


def _cramers_v(df, cols, bins):
    return contingency_tests(df, cols, bins or 10).select("x", "y", F.col("cramers_v").alias("r"))


def contingency_tests(df: DataFrame, cols, bins: int = 10) -> DataFrame:
    """(x, y, n, chi2, cramers_v) of the binned columns.

    Over the full grid, empty cells included, the sum of (o-e)^2/e equals the sum of o^2/e - n.
    """
    cells, pairs = _cells(df, cols, bins)  # at most bins^2 rows per pair
    rx = cells.groupBy("pair", "x").agg(F.sum("m").alias("tx"))
    ry = cells.groupBy("pair", "y").agg(F.sum("m").alias("ty"))
    size = cells.groupBy("pair").agg(F.sum("m").alias("n"), F.count_distinct("x").alias("kx"),
                                     F.count_distinct("y").alias("ky"))
    chi = (cells.join(rx, ["pair", "x"]).join(ry, ["pair", "y"]).groupBy("pair")
           .agg(F.sum(F.col("m").cast("double") * F.col("m") / (F.col("tx").cast("double") * F.col("ty"))).alias("s"))
           .join(size, "pair").withColumn("chi2", F.col("n") * (F.col("s") - 1)))
    v = F.sqrt(F.try_divide(F.greatest(F.col("chi2"), F.lit(0.0)),
                            (F.col("n") * (F.least("kx", "ky") - 1)).cast("double")))
    names = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)],
                                            "pair int, x string, y string")
    return names.join(F.broadcast(chi.withColumn("cramers_v", v)), "pair", "left").select("x", "y", "n", "chi2", "cramers_v")


def nullity_corr(df: DataFrame, cols) -> DataFrame:
    """Correlation of the missing-indicators of every column pair (NULL if one never varies)."""
    return corr_matrix(df.select(*[F.col(c).isNull().cast("double").alias(c) for c in cols]), cols)
