"""Imputing, scaling and column-wise preparation, fitted in one or two aggregates.

Fitted steps are SQLTransformers holding plain numbers: they run inside the JVM, work on
streams, and are saved and loaded with the pipeline they belong to.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.operators.quantiles import exact_quantiles


def _lit(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def _coerced(c: str) -> str:
    return f"try_cast(`{c}` AS DOUBLE)"


def _add(columns: dict[str, str]) -> SQLTransformer:
    items = ", ".join(f"{e} AS `{n}`" for n, e in columns.items())
    return SQLTransformer(statement=f"SELECT *, {items} FROM __THIS__")


@dataclass
class ColumnFit:
    """What one column was fitted to: the fill value (None: not imputed), mean and population std."""

    fill: float | None
    mean: float
    std: float


def _valid(c: str, missing):
    x = F.col(c).try_cast("double")
    x = F.when(~F.isnan(x), x)
    return x if missing is None else F.when(x != F.lit(float(missing)), x)


def fit_columns(df: DataFrame, cols, impute=(), missing: float = 0.0, strategy: str = "mean") -> dict[str, ColumnFit]:
    """Fill value of the ``impute`` columns, then mean and population std of every column as it
    is after filling.  The latter follow from the valid values alone, so no second scan is needed."""
    cols, impute = list(cols), set(impute)
    valid = df.select(*[_valid(c, missing if c in impute else None).alias(c) for c in cols])
    row = valid.agg(F.count(F.lit(1)).alias("rows"), *[
        F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), F.var_pop(c).alias("var")).alias(f"s{i}")
        for i, c in enumerate(cols)]).first()
    medians = {}
    if strategy == "median" and impute:
        medians = {r["column"]: r["q0"] for r in
                   exact_quantiles(valid, [c for c in cols if c in impute], [0.5]).collect()}
    fits = {}
    for i, c in enumerate(cols):
        n, mean, var = row[f"s{i}"]["n"], row[f"s{i}"]["mean"], row[f"s{i}"]["var"]
        if n == 0:
            raise ValueError(f"column {c} has no valid value")
        fill = None
        if c in impute:
            fill = medians[c] if strategy == "median" else mean
            filled = row["rows"] - n
            whole = (n * mean + filled * fill) / row["rows"]
            var = (n * (var + (mean - whole) ** 2) + filled * (fill - whole) ** 2) / row["rows"]
            mean = whole
        fits[c] = ColumnFit(fill, mean, var ** 0.5)
    return fits


def _filled(c: str, fit: ColumnFit, missing: float) -> str:
    if fit.fill is None:
        return _coerced(c)
    x = _coerced(c)
    return f"CASE WHEN {x} IS NULL OR isnan({x}) OR {x} = {_lit(missing)} THEN {_lit(fit.fill)} ELSE {x} END"


def fit_imputer(df: DataFrame, cols, missing: float = 0.0, strategy: str = "mean", suffix: str = "_imputed"):
    """Transformer that adds <column><suffix>: ``missing`` (and NULL) replaced by the mean or median."""
    fits = fit_columns(df, cols, impute=cols, missing=missing, strategy=strategy)
    return _add({f"{c}{suffix}": _filled(c, f, missing) for c, f in fits.items()})


def _scaled(x: str, fit: ColumnFit) -> str:
    # A constant column is only centred.
    return f"({x} - {_lit(fit.mean)}) / {_lit(fit.std if fit.std > 0 else 1.0)}"


def fit_scaler(df: DataFrame, cols, suffix: str = "_scaled"):
    """Transformer that adds <column><suffix> = (x - mean) / population std."""
    return _add({f"{c}{suffix}": _scaled(_coerced(c), f) for c, f in fit_columns(df, cols).items()})


@dataclass
class Prep:
    """Coerce, impute zeros, scale, and assemble a feature vector.

    ``remainder="drop"`` hands on only the imputed columns; "pass" hands on all numeric ones.
    """

    numeric: list[str]
    impute_zero: list[str] = field(default_factory=list)
    remainder: str = "drop"
    strategy: str = "mean"
    scale: bool = True
    output: str = "features"

    def used(self) -> list[str]:
        if self.remainder == "pass":
            return list(self.numeric)
        return [c for c in self.numeric if c in set(self.impute_zero)]

    def fit(self, df: DataFrame) -> PipelineModel:
        cols = self.used()
        fits = fit_columns(df, cols, impute=self.impute_zero, strategy=self.strategy)
        exprs = {}
        for c in cols:
            x = _filled(c, fits[c], 0.0)
            exprs[f"{c}_prep"] = _scaled(x, fits[c]) if self.scale else x
        assembler = VectorAssembler(inputCols=list(exprs), outputCol=self.output)
        return PipelineModel([_add(exprs), assembler])


def passthrough(cols, output: str = "features") -> PipelineModel:
    """Feature vector from the columns as they are."""
    return PipelineModel([VectorAssembler(inputCols=list(cols), outputCol=output)])
