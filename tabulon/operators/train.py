"""Training boosted trees and simple baselines; saving models with their contract and lookups."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.operators.evaluate import binary_metrics
from tabulon.operators.prep import Prep
from tabulon.operators.shape import infer_contract
from tabulon.plans.shared import checkpoint_root
from tabulon.sources.files import SmallFiles


def gbt_params(trial: dict) -> dict:
    """Boosting parameters under their usual names, as GBTClassifier takes them.

    Parameters without a counterpart (leaf count, path smoothing, L1/L2, row subsampling that
    is off by default) are left out; a step size over 1 is not allowed and is cut to 1.
    """
    out = {}
    if "n_estimators" in trial:
        out["maxIter"] = int(trial["n_estimators"])
    if "learning_rate" in trial:
        out["stepSize"] = min(1.0, max(1e-6, float(trial["learning_rate"])))
    if "max_depth" in trial:
        out["maxDepth"] = min(30, int(trial["max_depth"]))
    if "max_bin" in trial:
        out["maxBins"] = max(2, int(trial["max_bin"]))
    if "min_child_samples" in trial:
        out["minInstancesPerNode"] = int(trial["min_child_samples"])
    if "colsample_bytree" in trial:
        share = min(1.0, max(1e-6, float(trial["colsample_bytree"])))
        out["featureSubsetStrategy"] = "all" if share == 1.0 else f"{share:.6f}"
    if "random_state" in trial:
        out["seed"] = int(trial["random_state"])
    return out


def fit_classifier(df: DataFrame, prep: Prep, classifier, label: str) -> PipelineModel:
    """Any of Spark's classifiers behind the same preparation."""
    prepared = prep.fit(df)
    rows = prepared.transform(df).select(prep.output, F.col(label).cast("double").alias("_label"))
    classifier = classifier.setFeaturesCol(prep.output).setLabelCol("_label")
    rows = spread_out(rows)  # read many times by the fit; spills to disk
    try:
        return PipelineModel([*prepared.stages, classifier.fit(rows)])
    finally:
        rows.unpersist()


def spread_out(rows: DataFrame) -> DataFrame:
    """Keep the rows, on every core, for an iterative fit: only fewer partitions than cores are shuffled.

    They are kept before their partitions are counted, as counting runs the shuffles of the plan.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    rows = rows.persist()
    return rows.repartition(cores).persist() if rows.rdd.getNumPartitions() < cores else rows


def fit_gbt(df: DataFrame, prep: Prep, label: str, **params) -> PipelineModel:
    """Binary gradient-boosted trees on the prepared columns."""
    checkpoint_root(df.sparkSession)  # boosting cuts its own lineage there
    return fit_classifier(df, prep, GBTClassifier(**params), label)


def fit_logistic(df: DataFrame, prep: Prep, label: str, **params) -> PipelineModel:
    return fit_classifier(df, prep, LogisticRegression(**params), label)


BASELINES = {
    "logistic": lambda: LogisticRegression(maxIter=20),
    "decision_tree": lambda: DecisionTreeClassifier(maxDepth=5, seed=1),
    "random_forest": lambda: RandomForestClassifier(numTrees=20, maxDepth=5, seed=1),
    "boosted_trees": lambda: GBTClassifier(maxIter=10, maxDepth=4, seed=1),
    "gaussian_bayes": lambda: NaiveBayes(modelType="gaussian"),
}


def baseline_sweep(train: DataFrame, valid: DataFrame, prep: Prep, label: str, names=None) -> DataFrame:
    """(model, f1, precision, recall, accuracy) of simple models with the same preparation, best first."""
    checkpoint_root(train.sparkSession)
    prepared = prep.fit(train)
    rows = spread_out(prepared.transform(train).select(prep.output, F.col(label).cast("double").alias("_label")))
    held = prepared.transform(valid).select(prep.output, F.col(label).cast("int").alias("_y")).persist()
    results = []
    try:
        for name in names or BASELINES:
            model = BASELINES[name]().setFeaturesCol(prep.output).setLabelCol("_label").fit(rows)
            m = binary_metrics(model.transform(held), "_y", "prediction").first()
            results.append((name, m["f1"], m["precision"], m["recall"], m["accuracy"]))
    finally:
        rows.unpersist()
        held.unpersist()
    schema = "model string, f1 double, precision double, recall double, accuracy double"
    return train.sparkSession.createDataFrame(results, schema).orderBy(F.desc("f1"), "model")


@dataclass
class SavedModel:
    """A fitted pipeline, the columns it expects, and how to fetch stored features."""

    model: PipelineModel
    contract: str
    lookups: list[dict] = field(default_factory=list)
    version: int = 0


def save_model(model: PipelineModel, path: str, example: DataFrame, lookups=()) -> str:
    """Save as the next version below ``path``; returns the uri ``path/<version>``."""
    spark = example.sparkSession
    files = SmallFiles(spark)
    version = max((int(n) for n in files.names(path) if n.isdigit()), default=0) + 1
    uri = f"{path.rstrip('/')}/{version:08d}"
    model.write().overwrite().save(f"{uri}/model")
    files.write(f"{uri}/contract.json", json.dumps({"contract": infer_contract(example), "lookups": list(lookups)}))
    return uri


def load_model(spark: SparkSession, uri: str) -> SavedModel:
    """By version uri, or by name: then the latest complete version."""
    files = SmallFiles(spark)
    uri = uri.rstrip("/")
    if "contract.json" not in files.names(uri):
        versions = sorted((n for n in files.names(uri) if n.isdigit()), reverse=True)
        uri = next(f"{uri}/{v}" for v in versions if "contract.json" in files.names(f"{uri}/{v}"))
    saved = json.loads(files.read(f"{uri}/contract.json"))
    return SavedModel(PipelineModel.load(f"{uri}/model"), saved["contract"], saved["lookups"],
                      int(uri.rsplit("/", 1)[-1]))
