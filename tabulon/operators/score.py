"""Batch scoring: pipelines, Arrow batches, stored-feature lookup, logged JSON requests."""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.operators.boost import walk
from tabulon.operators.lookup import lookup, lookups_from_specs
from tabulon.operators.train import SavedModel, load_model


def score(df: DataFrame, model: PipelineModel | SavedModel, probability: str | None = None) -> DataFrame:
    """Add ``prediction`` (int) last; other columns are kept.  ``probability`` names an optional
    column for the score of class 1.  Works on batch and streaming frames alike."""
    pipeline = model.model if isinstance(model, SavedModel) else model
    if "prediction" in df.columns:
        raise ValueError("column already present: prediction")
    out = pipeline.transform(df)
    extra = []
    if probability:
        from pyspark.ml.functions import vector_to_array

        extra = [vector_to_array("probability")[1].alias(probability)]
    return out.select(*df.columns, *extra, F.col("prediction").cast("int").alias("prediction"))


def score_batches(df: DataFrame, load_fn, cols, schema=None) -> DataFrame:
    """Score in Arrow batches with a model that is not Spark's.

    ``load_fn()`` runs once per partition and returns predict(matrix) -> array.
    """
    cols = list(cols)
    names = df.columns
    schema = schema or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", prediction int"

    def run(batches):
        predict = load_fn()
        for pdf in batches:
            values = predict(pdf[cols].to_numpy(dtype=float))
            yield pdf[names].assign(prediction=np.asarray(values).astype("int32"))

    return df.mapInPandas(run, schema)


def linear_predictor(coefficients, intercept: float, threshold: float = 0.0):
    """load_fn for a linear rule: 1 where coefficients . x + intercept > threshold."""
    w = np.asarray(coefficients, dtype=float)

    def load():
        return lambda x: (x @ w + intercept > threshold).astype("int32")

    return load


def ensemble_predictor(ensemble):
    """load_fn for a fitted ensemble of ``boost``, outside its pipeline: 1 where the margin is positive."""
    start, _, trees = ensemble.parts()

    def load():
        walked = [(t.arrays(), np.array(t.value)) for t in trees]

        def predict(x):
            columns = np.ascontiguousarray(x.T)
            return (start + sum(value[walk(columns, tree)] for tree, value in walked) > 0).astype("int32")

        return predict

    return load


def score_with_lookup(df: DataFrame, uri: str | SavedModel) -> DataFrame:
    """Fetch the stored features by the lookups saved with the model, then score.

    A stored feature that the caller also supplies is an error, never silently replaced."""
    saved = uri if isinstance(uri, SavedModel) else load_model(df.sparkSession, uri)
    return score(lookup(df, lookups_from_specs(saved.lookups)), saved)


def parse_requests(df: DataFrame, json_col: str, features) -> DataFrame:
    """Request bodies to rows: the frame's columns, ``row`` (position), one double per feature,
    ``error``.  Bodies are {"dataframe_split": {"columns", "data"}} or {"inputs": {name: [..]}}.

    A body that cannot be read gives one row with NULL features and the reason in ``error``.
    """
    features = list(features)
    body = F.from_json(json_col, "dataframe_split struct<columns: array<string>, data: array<array<string>>>,"
                                 "inputs map<string, array<string>>")
    b = df.withColumn("_b", body)
    # columns are placed by name, whatever their order in the body; looked up once per body
    b = b.withColumn("_at", F.array(*[F.array_position("_b.dataframe_split.columns", f).cast("int") for f in features]))
    cols, data, inputs = F.col("_b.dataframe_split.columns"), F.col("_b.dataframe_split.data"), F.col("_b.inputs")
    split_ok = (cols.isNotNull() & data.isNotNull() & (F.size(F.array_distinct(cols)) == F.size(cols))
                & F.forall(data, lambda r: F.coalesce(F.size(r) == F.size(cols), F.lit(False))))
    lengths = F.transform(F.map_values(inputs), lambda v: F.coalesce(F.size(v), F.lit(-1)))
    inputs_ok = inputs.isNotNull() & (F.size(inputs) > 0) & (F.array_min(lengths) == F.array_max(lengths)) & (
        F.array_min(lengths) >= 0)
    names = F.when(split_ok, cols).when(inputs_ok, F.map_keys(inputs))
    lacking = F.array_except(F.array(*[F.lit(f) for f in features]), names)
    error = (F.when(~F.coalesce(split_ok, F.lit(False)) & ~F.coalesce(inputs_ok, F.lit(False)), F.lit("malformed body"))
             .when(F.size(lacking) > 0, F.concat(F.lit("missing column: "), F.array_join(lacking, ", "))))

    split_rows = F.transform(data, lambda r: F.struct(*[
        F.try_element_at(r, F.col("_at")[i]).alias(f) for i, f in enumerate(features)]))
    n = F.array_max(lengths)
    input_rows = F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: F.struct(*[
        F.try_element_at(F.try_element_at(inputs, F.lit(f)), i).alias(f) for f in features]))
    rows = F.when(F.col("error").isNull(), F.when(split_ok, split_rows).otherwise(input_rows))
    flat = b.withColumn("error", error).select(
        *df.columns, "error", F.posexplode_outer(rows).alias("row", "_r"))
    values = [F.col(f"_r.`{f}`").try_cast("double").alias(f) for f in features]
    bad = F.lit(False)
    for f in features:
        bad = bad | F.col(f"_r.`{f}`").try_cast("double").isNull()
    reason = F.coalesce(F.col("error"), F.when(F.col("_r").isNotNull() & bad, F.lit("value is not a number")))
    return flat.select(*df.columns, "row", *values, reason.alias("error"))


def score_requests(df: DataFrame, json_col: str, model: PipelineModel | SavedModel, features) -> DataFrame:
    """Predictions for logged requests: row and error columns as in ``parse_requests``; rows with
    an error get a NULL prediction."""
    features = list(features)
    parsed = parse_requests(df, json_col, features)
    filled = parsed.select(*[c for c in parsed.columns if c not in features],
                           *[F.coalesce(F.col(f), F.lit(0.0)).alias(f) for f in features])
    scored = score(filled, model)
    good = F.col("error").isNull()
    return scored.select(*df.columns, "row", *[F.when(good, F.col(f)).alias(f) for f in features],
                         F.when(good, F.col("prediction")).alias("prediction"), "error")


def request_body(cols, rows) -> str:
    """A dataframe_split body for the given rows."""
    return json.dumps({"dataframe_split": {"index": list(range(len(rows))), "columns": list(cols),
                                           "data": [list(r) for r in rows]}})
