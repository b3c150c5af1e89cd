"""Exact interpolated quantiles without gathering a column's values in one task.

Pass 1 takes a mergeable sketch per column (and group) and turns each wanted probability
into a value bracket that must contain it.  Pass 2 counts values: inside a bracket by exact
value, outside only as "somewhere between two brackets", so the shuffled counts are a small
share of the data.  Running counts over them give exact ranks.  Should a bracket ever miss,
the counts are taken again with nothing folded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.columns import number
from tabulon.plans.ordered import running
from tabulon.plans.shared import materialise, settle

ACCURACY = 10_000
# Counted values of one column (and group) that are ranked in one window at most, three numbers each.
RANKED_TOGETHER = 200_000


def cells_of(df: DataFrame, cols, by=()) -> DataFrame:
    """(by..., column, value): one row per cell, missing ones included.

    Statistics of many columns are grouped by ``column`` over this form: the generated code stays
    the same size however wide the table is, and map-side combining leaves one row per column.
    """
    return df.select(*by, *[number(c).alias(c) for c in cols]).unpivot(list(by), list(cols), "column", "value")


def long_form(df: DataFrame, cols, by=()) -> DataFrame:
    """``cells_of`` without the missing cells."""
    return cells_of(df, cols, by).filter(F.col("value").isNotNull())


def _brackets(df, cols, probs, by, accuracy, also):
    margin = 3.0 / accuracy
    ends = [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]
    k = len(probs)
    sketch = cells_of(df, cols, by).groupBy(*by, "column").agg(
        F.count("value").alias("n"), F.min("value").alias("_lo"), F.max("value").alias("_hi"),
        F.percentile_approx("value", ends, accuracy).alias("_b"), *[e.alias(n) for n, e in also("value").items()])
    return sketch.select(
        *by, "column", "n",
        *[(F.col("_lo") if ends[j] <= 0 else F.element_at("_b", j + 1)).alias(f"lo{j}") for j in range(k)],
        *[(F.col("_hi") if ends[k + j] >= 1 else F.element_at("_b", k + j + 1)).alias(f"hi{j}") for j in range(k)],
        *also("value"))


def exact_quantiles(df: DataFrame, cols, probs, by=(), accuracy: int = ACCURACY, also=lambda c: {},
                    brackets: DataFrame | None = None) -> DataFrame:
    """(by..., column, n, q0, q1, ..., also...): linearly interpolated quantiles of the non-missing values.

    ``brackets`` (column, n, lo0, hi0, ...), from a stored sketch say, save the sketch pass; they need not be right.

    ``also`` maps a column to further aggregates of it, {name: expression}, taken in the sketch pass.
    The frame is read twice: hand in a stored table, or ``materialise`` a costly one first.
    """
    cols, by, probs = list(cols), list(by), sorted(probs)
    if brackets is None:
        brackets = _brackets(df, cols, probs, by, accuracy, also)
    brackets, rows = settle(brackets, bounded=not by)
    if rows is None:
        longest = brackets.agg(F.max("n")).first()[0] or 0
        brackets_side = brackets
    else:
        longest = max((r["n"] for r in rows), default=0)
        brackets_side = F.broadcast(brackets)  # settled: at most 10,000 rows
    for fold in (True, False):
        result, found = settle(_select(df, cols, probs, by, brackets_side, longest, fold), bounded=rows is not None)
        if found is not None:
            if all(r["n"] == 0 or None not in r[-len(probs):] for r in found):
                break
        else:
            missed = F.array_contains(F.transform(F.array(*[f"q{j}" for j in range(len(probs))]), F.isnull), True)
            if result.filter(missed & (F.col("n") > 0)).isEmpty():
                break
    more = list(also("value"))
    if not more:
        return result
    return join_same(result, brackets_side.select(*by, "column", *more), [*by, "column"])


def join_same(left: DataFrame, right: DataFrame, names, how: str = "left") -> DataFrame:
    """Null-safe join on the named columns; the left names are kept."""
    renamed = right.select(*[
        F.col(f"`{c}`").alias(f"_r_{c}") if c in names else F.col(f"`{c}`") for c in right.columns])
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(f"`{n}`").eqNullSafe(F.col(f"`_r_{n}`"))
    return left.join(renamed, cond, how).drop(*[f"_r_{n}" for n in names])


def _ranked(counts, by, longest):
    """Running counts of the counted values; how many there are is known only once they are stored."""
    if longest > RANKED_TOGETHER:
        counts = materialise(counts, "values")
        longest = counts.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    if longest > RANKED_TOGETHER:
        return running(counts, ["v", "at"], by=by, sums={"upto": "m"})
    upto = Window.partitionBy(*by).orderBy("v", "at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("upto", F.sum("m").over(upto))


def _select(df, cols, probs, by, brackets, longest, fold):
    k = len(probs)
    keyed = brackets.select(*[F.col(b).alias(f"_b_{b}") for b in by], F.col("column").alias("_b_column"),
                            F.col("n").alias("_n"), *[c for j in range(k) for c in (f"lo{j}", f"hi{j}")])

    def on(frame):
        cond = F.col("column") == F.col("_b_column")
        for b in by:
            cond = cond & F.col(b).eqNullSafe(F.col(f"_b_{b}"))
        return frame.join(keyed, cond)

    v = F.col("value")
    if fold:
        place = None
        for j in range(k):
            below = v < F.col(f"lo{j}")
            folded = F.struct(F.col(f"lo{j}").alias("v"), F.lit(0).alias("at"))
            kept = F.struct(v.alias("v"), F.lit(1).alias("at"))
            place = F.when(below, folded) if place is None else place.when(below, folded)
            place = place.when(v <= F.col(f"hi{j}"), kept)
        place = place.otherwise(F.struct(F.col(f"hi{k - 1}").alias("v"), F.lit(2).alias("at")))
    else:
        place = F.struct(v.alias("v"), F.lit(1).alias("at"))
    marked = on(long_form(df, cols, by)).select(*by, "column", place.alias("p"))
    counts = marked.groupBy(*by, "column", F.col("p.v").alias("v"), F.col("p.at").alias("at")).agg(
        F.count(F.lit(1)).alias("m"))
    ranked = _ranked(counts, [*by, "column"], longest)
    with_n = on(ranked)
    aggs = []
    for j, p in enumerate(probs):
        pos = F.lit(p) * (F.col("_n") - 1)
        for end, idx in (("f", F.floor(pos)), ("c", F.ceil(pos))):
            hit = (F.col("upto") > idx) & (F.col("upto") - F.col("m") <= idx) & (F.col("at") == 1)
            aggs.append(F.max(F.when(hit, F.col("v"))).alias(f"{end}{j}"))
    picked = with_n.groupBy(*by, "column", F.col("_n").alias("n")).agg(*aggs)
    out = []
    for j, p in enumerate(probs):
        pos = F.lit(p) * (F.col("n") - 1)
        w = pos - F.floor(pos)
        out.append((F.col(f"f{j}") + w * (F.col(f"c{j}") - F.col(f"f{j}"))).alias(f"q{j}"))
    exact = picked.select(*by, "column", "n", *out)
    # groups without any value keep a row
    empty = brackets.filter(F.col("n") == 0).select(
        *by, "column", "n", *[F.lit(None).cast("double").alias(f"q{j}") for j in range(k)])
    return exact.unionByName(empty)
