"""Evaluation of binary classifiers; every result is a Spark aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.columns import hash_text, number, ratio
from tabulon.operators.quantiles import exact_quantiles
from tabulon.plans.ordered import dense_ids, running
from tabulon.plans.shared import materialise


def confusion(df: DataFrame, label: str, pred: str, classes=(0, 1)) -> DataFrame:
    """(actual, predicted, n) for every pair of classes, zero cells included, and for any other pair that occurs."""
    counts = df.groupBy(F.col(label).cast("int").alias("actual"), F.col(pred).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.createDataFrame([(a, p) for a in classes for p in classes], "actual int, predicted int")
    return counts.unionByName(grid.withColumn("n", F.lit(0).cast("long"))).groupBy("actual", "predicted").agg(
        F.sum("n").alias("n"))


def _cells(label: str, pred: str):
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")

    def count(actual, predicted):
        return F.coalesce(F.sum(((y == actual) & (p == predicted)).cast("long")), F.lit(0))

    return {"tp": count(1, 1), "fp": count(0, 1), "fn": count(1, 0), "tn": count(0, 0)}


def binary_metrics(df: DataFrame, label: str, pred: str, by=()) -> DataFrame:
    """tp, fp, fn, tn, precision, recall, f1, accuracy for positive class 1; 0 when undefined."""
    counts = df.groupBy(*by).agg(*[e.alias(n) for n, e in _cells(label, pred).items()])
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def safe(top, bottom):
        return F.coalesce(ratio(top, bottom), F.lit(0.0))

    return counts.select(
        *by, "tp", "fp", "fn", "tn", safe(tp, tp + fp).alias("precision"), safe(tp, tp + fn).alias("recall"),
        safe(2 * tp, 2 * tp + fp + fn).alias("f1"), safe(tp + tn, tp + fp + fn + tn).alias("accuracy"))


def roc_score_hard(df: DataFrame, label: str, pred: str, by=()) -> DataFrame:
    """(precision + negative predictive value) / 2 of hard labels.

    It is what an AUC call yields with labels and predictions exchanged, and is not an AUC;
    NULL if only one class is predicted.
    """
    counts = df.groupBy(*by).agg(*[e.alias(n) for n, e in _cells(label, pred).items()])
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(*by, ((ratio(tp, tp + fp) + ratio(tn, tn + fn)) / 2).alias("roc_score"))


def score_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(score, pos, neg, cum_pos, cum_neg): one row per distinct score, cumulated from the top.

    Written out, so the totals and every figure drawn from it do not score the frame again."""
    y = F.col(label).cast("int")
    groups = (df.select(number(score).alias("score"), y.alias("y")).filter("score is not null and y is not null")
              .groupBy("score").agg(F.sum((F.col("y") == 1).cast("long")).alias("pos"),
                                    F.sum((F.col("y") == 0).cast("long")).alias("neg")))
    return materialise(running(groups, [F.desc("score")], sums={"cum_pos": "pos", "cum_neg": "neg"}), "curve")


def _totals(curve: DataFrame) -> tuple[int, int]:
    row = curve.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    return row["p"] or 0, row["n"] or 0


def _auc(p: int, n: int):
    area = F.sum(F.col("pos").cast("double") * (F.lit(n) - F.col("cum_neg") + F.col("neg") / 2.0))
    return F.when(F.lit(bool(p and n)), area / F.lit(float(p or 1)) / F.lit(float(n or 1)))


def _ap(p: int):
    step = F.col("pos") * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    return F.when(F.lit(bool(p)), F.sum(step) / F.lit(float(p or 1)))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL with one class only."""
    curve = score_curve(df, label, score)
    p, n = _totals(curve)
    return curve.agg(_auc(p, n).alias("roc_auc"))


def _thin(curve: DataFrame, p: int, n: int, max_points: int | None) -> DataFrame:
    """For drawing only: keep the row at which each of max_points equal steps of rows is passed."""
    if not max_points or not p + n:
        return curve
    upto = F.col("cum_pos") + F.col("cum_neg")
    here = F.col("pos") + F.col("neg")

    def step(v):
        return F.floor(v * F.lit(float(max_points)) / F.lit(float(p + n)))

    return curve.filter(step(upto) > step(upto - here))


def roc_curve(df: DataFrame, label: str, score: str, max_points: int | None = None) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, starting at (0, 0) with no threshold."""
    curve = score_curve(df, label, score)
    p, n = _totals(curve)
    points = _thin(curve, p, n, max_points).select(
        F.col("score").alias("threshold"), ratio(F.col("cum_neg"), F.lit(n)).alias("fpr"),
        ratio(F.col("cum_pos"), F.lit(p)).alias("tpr"))
    start = df.sparkSession.createDataFrame([(None, 0.0, 0.0)], points.schema)
    return start.unionByName(points)


def pr_curve(df: DataFrame, label: str, score: str, max_points: int | None = None) -> DataFrame:
    """(threshold, precision, recall) per distinct score."""
    curve = score_curve(df, label, score)
    p, n = _totals(curve)
    return _thin(curve, p, n, max_points).select(
        F.col("score").alias("threshold"),
        ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
        ratio(F.col("cum_pos"), F.lit(p)).alias("recall"))


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Sum of recall steps times precision."""
    curve = score_curve(df, label, score)
    p, _ = _totals(curve)
    return curve.agg(_ap(p).alias("average_precision"))


def evaluate(df: DataFrame, label: str, pred: str, score: str, eps: float = 1e-15) -> DataFrame:
    """(metric, value): counts, threshold metrics, log loss, AUC and average precision."""
    y, s = F.col(label).cast("int"), number(score)
    clipped = F.least(F.greatest(s, F.lit(eps)), F.lit(1 - eps))
    loss = -F.when(y == 1, F.log(clipped)).otherwise(F.log(1 - clipped))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    row = df.agg(*[e.alias(n) for n, e in _cells(label, pred).items()],
                 F.count(F.lit(1)).alias("example_count"), F.avg(loss).alias("log_loss"))

    def safe(top, bottom):
        return F.coalesce(ratio(top, bottom), F.lit(0.0))

    hard = row.select(
        *[F.col(c).cast("double").alias(c) for c in ("example_count", "tp", "fp", "fn", "tn")],
        safe(tp, tp + fp).alias("precision"), safe(tp, tp + fn).alias("recall"),
        safe(2 * tp, 2 * tp + fp + fn).alias("f1"), safe(tp + tn, tp + fp + fn + tn).alias("accuracy"), "log_loss")
    curve = score_curve(df, label, score)
    p, n = _totals(curve)
    soft = curve.agg(_auc(p, n).alias("roc_auc"), _ap(p).alias("average_precision"))

    def long(frame):
        return frame.unpivot([], frame.columns, "metric", "value")

    return long(hard).unionByName(long(soft))


def lift_table(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """(bin, n, positives, rate, lift, cum_gain): bins by score quantiles, best scores first."""
    edges = exact_quantiles(df, [score], [i / bins for i in range(1, bins)]).first()
    cut = [] if edges is None or edges["n"] == 0 else [edges[f"q{i}"] for i in range(bins - 1)]
    s = number(score)
    below = sum(((s <= F.lit(c)).cast("int") for c in cut), F.lit(0))
    counts = df.filter(s.isNotNull()).groupBy((below + 1).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col(label).cast("int") == 1).cast("long")).alias("positives"))
    every = Window.partitionBy(F.lit(0))  # at most `bins` rows from here on
    upto = every.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.sum("positives").over(every) / F.sum("n").over(every)
    return counts.select(
        F.col("bin").cast("int").alias("bin"), "n", "positives", ratio(F.col("positives"), F.col("n")).alias("rate"),
        ratio(ratio(F.col("positives"), F.col("n")), base).alias("lift"),
        ratio(F.sum("positives").over(upto), F.sum("positives").over(every)).alias("cum_gain"))


def calibration_table(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """(bin, n, mean_score, positive_rate) in equal steps of the score over [0, 1]."""
    s = number(score)
    where = F.least(F.floor(s * bins), F.lit(bins - 1)).cast("int")
    return df.filter(s.isNotNull()).groupBy(where.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(s).alias("mean_score"),
        F.avg(F.col(label).cast("double")).alias("positive_rate"))


def importance(model, features) -> DataFrame:
    """(feature, importance) of a fitted tree model, or absolute coefficients of a linear one."""
    from pyspark.sql import SparkSession

    last = model.stages[-1] if hasattr(model, "stages") else model
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    else:
        values = abs(last.coefficients.toArray())
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double")


def permute_column(df: DataFrame, key: str, col: str, seed: int = 0) -> DataFrame:
    """The frame with one column handed round: row i in one hashed order gets the value of row i
    in another.  Both orders are dense numberings, so the join is one to one."""
    left = dense_ids(df.drop(col), [hash_text(key, F.lit(f"to{seed}")), F.col(key)], "_place")
    right = dense_ids(df.select(key, col), [hash_text(key, F.lit(f"from{seed}")), F.col(key)], "_place")
    return left.join(right.select("_place", col), "_place").select(*df.columns)


def perm_importance(df: DataFrame, predict, cols, key: str, label: str, seed: int = 0) -> DataFrame:
    """(feature, f1_drop): loss of F1 when a column is permuted.  ``predict`` maps a frame to a
    frame with a ``prediction`` column."""
    base = binary_metrics(predict(df), label, "prediction").first()["f1"]
    rows = []
    for c in cols:
        f1 = binary_metrics(predict(permute_column(df, key, c, seed)), label, "prediction").first()["f1"]
        rows.append((c, base - f1))
    return df.sparkSession.createDataFrame(rows, "feature string, f1_drop double")
