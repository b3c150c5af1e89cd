"""Random and Parzen search over a parameter space, the run table, cross-validation."""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool
from statistics import NormalDist

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabulon.functions.columns import hash_uniform
from tabulon.operators.boost import fit_boosted_many
from tabulon.operators.evaluate import binary_metrics
from tabulon.operators.split import stratified_folds

# The search space of the boosted-tree classifier.
SEARCH_SPACE = {
    "colsample_bytree": ("uniform", 0.0, 1.0),
    "lambda_l1": ("uniform", 0.0, 0.5),
    "lambda_l2": ("uniform", 0.0, 0.5),
    "learning_rate": ("lognormal", 0.0, 1.0),
    "max_bin": ("integer", 50, 255),
    "max_depth": ("integer", 10, 20),
    "min_child_samples": 35,
    "n_estimators": 181,
    "num_leaves": 90,
    "path_smooth": 82.58514740065912,
    "subsample": 0.7664087623951591,
    "random_state": 50122439,
}


def draw_params(df: DataFrame, key: str, space: dict, seed: int = 0) -> DataFrame:
    """Add one drawn value per parameter to every row, from a hash of key, name and seed.

    ("uniform", low, high), ("lognormal", mean, std), ("integer", start, stop) or a constant.
    """
    def u(name, part=""):
        return hash_uniform(key, F.lit(f"{name}{part}"), F.lit(str(seed)))

    out = {}
    for name, spec in space.items():
        if not isinstance(spec, tuple):
            out[name] = F.lit(spec)
        elif spec[0] == "uniform":
            out[name] = F.lit(spec[1]) + u(name) * F.lit(spec[2] - spec[1])
        elif spec[0] == "integer":
            out[name] = (F.lit(spec[1]) + F.floor(u(name) * F.lit(spec[2] - spec[1]))).cast("int")
        elif spec[0] == "lognormal":
            normal = F.sqrt(-2.0 * F.log(1.0 - u(name, "_r"))) * F.cos(F.lit(2 * math.pi) * u(name, "_a"))
            out[name] = F.exp(F.lit(spec[1]) + F.lit(spec[2]) * normal)
        else:
            raise ValueError(f"unknown draw: {spec[0]}")
    return df.withColumns(out)


def sample_space(spark: SparkSession, n: int, seed: int = 0, space: dict | None = None) -> DataFrame:
    """n trials: (run_id, parameters...)."""
    return draw_params(spark.range(n).withColumnRenamed("id", "run_id"), "run_id", space or SEARCH_SPACE, seed)


def _threads(spark: SparkSession, parallelism: int, work, items):
    pool = ThreadPool(processes=max(1, min(parallelism, len(items))))
    try:
        return pool.map(inheritable_thread_target(spark)(work), items)
    finally:
        pool.close()


def _measured(predicted: DataFrame, label: str) -> tuple:
    """f1score, roc_score and loss of a frame with its label and prediction."""
    m = binary_metrics(predicted, label, "prediction").select(
        "f1", ((F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
                + F.try_divide(F.col("tn").cast("double"), (F.col("tn") + F.col("fn")).cast("double"))) / 2
               ).alias("roc")).first()
    return m["f1"], m["roc"], -m["f1"]


def run_trials(train: DataFrame, valid: DataFrame, trials: DataFrame, fit, label: str, parallelism: int = 2) -> DataFrame:
    """Fit every trial on the whole train frame and measure it on ``valid``.

    ``fit(train, params)`` returns a fitted pipeline; each fit is itself a distributed job, and
    a few of them overlap.  Returns the trial columns plus f1score, roc_score and loss = -f1score.
    """
    rows = [r.asDict() for r in trials.collect()]  # one row per trial
    train, valid = train.persist(), valid.persist()

    def one(params):
        predicted = fit(train, params).transform(valid).select(label, "prediction")
        return tuple(params.values()) + _measured(predicted, label)

    try:
        found = _threads(train.sparkSession, parallelism, one, rows)
    finally:
        train.unpersist()
        valid.unpersist()
    return _runs(trials, found)


def _runs(trials: DataFrame, found: list[tuple]) -> DataFrame:
    schema = StructType(list(trials.schema))
    for name in ("f1score", "roc_score", "loss"):
        schema = schema.add(name, "double")
    return trials.sparkSession.createDataFrame(found, schema)


def run_boosted(train: DataFrame, valid: DataFrame, trials: DataFrame, prep, label: str) -> DataFrame:
    """``run_trials`` for leaf-wise boosted trees: all trials grow in the same passes over ``train``."""
    rows = [r.asDict() for r in trials.collect()]  # one row per trial
    models = fit_boosted_many(train, prep, label, rows)
    valid = valid.persist()
    try:
        return _runs(trials, [tuple(p.values()) + _measured(m.transform(valid).select(label, "prediction"), label)
                              for p, m in zip(rows, models)])
    finally:
        valid.unpersist()


# --- Parzen search ---------------------------------------------------------------------------


def _inward(spec, x):
    """A parameter on the scale its density lives on: logarithms for log-normal draws."""
    return np.log(x) if spec[0] == "lognormal" else np.asarray(x, float)


def _range(spec) -> tuple[float, float, float, float]:
    """Least and largest value, and centre and width of the prior; an integer stands for the unit around it."""
    if spec[0] == "lognormal":
        return -math.inf, math.inf, spec[1], spec[2]
    low, high = (spec[1] - 0.5, spec[2] - 0.5) if spec[0] == "integer" else spec[1:]
    return low, high, (low + high) / 2, high - low


def parzen(spec, seen) -> list[tuple[float, float]]:
    """(centre, width) of a mixture of normals: one for each seen value, as wide as its farther neighbour is away, and
    the prior.  Widths stay between a hundredth of the prior's and its own."""
    _, _, centre, wide = _range(spec)
    points = sorted([*_inward(spec, np.array(sorted(seen), float)).tolist(), centre])
    gaps = [max(b - a, c - b) for a, b, c in zip([points[0], *points], points, [*points[1:], points[-1]])]
    place = points.index(centre)
    return [(p, wide if i == place else min(wide, max(g, wide / min(100.0, 1.0 + len(points)))))
            for i, (p, g) in enumerate(zip(points, gaps))]


def log_density(spec, mixture, x) -> np.ndarray:
    """Logarithm of the mixture's density at x, cut to the parameter's range."""
    low, high, *_ = _range(spec)
    x, total = _inward(spec, x), 0.0
    for centre, wide in mixture:
        one = NormalDist(centre, wide)
        mass = (one.cdf(high) if high < math.inf else 1.0) - (one.cdf(low) if low > -math.inf else 0.0)
        total = total + np.exp(-0.5 * ((x - centre) / wide) ** 2) / (wide * math.sqrt(2 * math.pi) * mass)
    return np.log(total / len(mixture))


def _drawn(spec, mixture, n: int, rng) -> np.ndarray:
    low, high, *_ = _range(spec)
    out = np.empty(n)
    for i, k in enumerate(rng.integers(len(mixture), size=n)):
        one = NormalDist(*mixture[k])
        a = one.cdf(low) if low > -math.inf else 0.0
        b = one.cdf(high) if high < math.inf else 1.0
        out[i] = one.inv_cdf(min(1 - 1e-12, max(1e-12, a + (b - a) * rng.random())))
    if spec[0] == "lognormal":
        return np.exp(out)
    return np.clip(np.rint(out), spec[1], spec[2] - 1) if spec[0] == "integer" else np.clip(out, low, high)


def proposals(measured: list[dict], n: int, space: dict, seed: int, metric: str, good: float, candidates: int) -> dict:
    """Parameter -> n proposed values, from measured trials: the part of ``suggest`` that only sees the run table."""
    measured = sorted(measured, key=lambda r: (-r[metric], r["run_id"]))
    cut = max(1, math.ceil(good * len(measured)))
    made = {}
    for at, (name, spec) in enumerate(space.items()):
        if not isinstance(spec, tuple):
            made[name] = [spec] * n
            continue
        above, others = parzen(spec, [r[name] for r in measured[:cut]]), [r[name] for r in measured[cut:]]
        rng, chosen = np.random.default_rng([seed, len(measured), at]), []
        for _ in range(n):
            drawn, below = _drawn(spec, above, candidates, rng), parzen(spec, others + chosen)
            best = float(drawn[np.argmax(log_density(spec, above, drawn) - log_density(spec, below, drawn))])
            chosen.append(int(best) if spec[0] == "integer" else best)
        made[name] = chosen
    return made


def suggest(runs: DataFrame, n: int, space: dict | None = None, seed: int = 0, metric: str = "f1score",
            good: float = 0.15, candidates: int = 8, startup: int = 10) -> DataFrame:
    """n further trials (run_id, parameters...) by tree-structured Parzen search over the run table.

    The best share ``good`` of the runs and the others give two densities per parameter; of ``candidates`` draws from
    the first, the one with the largest ratio of the two is proposed, for each trial and parameter on its own.  Trials
    already proposed in the batch count among the others, so that a batch spreads.  With fewer than ``startup``
    measured runs the trials are random draws.  Run ids go on from the largest; runs without the metric do not count.
    The run table has one row per trial, so it is read on the driver.
    """
    space = space or SEARCH_SPACE
    spark = runs.sparkSession
    seen = [r.asDict() for r in runs.collect()]
    first = max((r["run_id"] for r in seen), default=-1) + 1
    trials = draw_params(spark.range(first, first + n).withColumnRenamed("id", "run_id"), "run_id", space, seed)
    measured = [r for r in seen if r[metric] is not None and not math.isnan(r[metric])]
    if len(measured) < startup:
        return trials
    made = proposals(measured, n, space, seed, metric, good, candidates)
    return spark.createDataFrame(list(zip(range(first, first + n), *made.values())), trials.schema)


def best_run(runs: DataFrame, metric: str = "f1score", run_id: str = "run_id") -> DataFrame:
    """The run with the largest metric; ties by run id."""
    return runs.orderBy(F.desc_nulls_last(metric), run_id).limit(1)


def cross_val(df: DataFrame, key: str, label: str, fit, k: int = 5, seed: int = 0, parallelism: int = 2) -> DataFrame:
    """(fold, f1): fit on the other folds, measure on the fold; folds keep the class shares."""
    folded = stratified_folds(df, key, label, k, seed, name="_fold").persist()

    def one(i):
        model = fit(folded.filter(F.col("_fold") != i))
        scored = model.transform(folded.filter(F.col("_fold") == i))
        return i, binary_metrics(scored, label, "prediction").first()["f1"]

    try:
        return df.sparkSession.createDataFrame(_threads(df.sparkSession, parallelism, one, list(range(k))), "fold int, f1 double")
    finally:
        folded.unpersist()
