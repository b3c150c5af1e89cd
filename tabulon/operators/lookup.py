"""Key joins, feature lookups and point-in-time lookups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.plans.ordered import running
from tabulon.plans.skew import keyed_left_join
from tabulon.sources.feature_table import FeatureTable, key_check


@dataclass(frozen=True)
class Lookup:
    """Which features to fetch, from which feature table, by which columns of the frame.

    ``table`` is the path of a feature table; ``keys`` maps its key columns to columns of the
    frame (a plain list when the names agree).
    """

    table: str
    features: list[str]
    keys: list[str] | dict[str, str]

    def key_map(self) -> dict[str, str]:
        return dict(self.keys) if isinstance(self.keys, dict) else {k: k for k in self.keys}

    def spec(self) -> dict:
        return {"table": self.table, "features": list(self.features), "keys": self.key_map()}


def assemble(base: DataFrame, others, on, cols) -> DataFrame:
    """Inner join of entity tables on the shared key, then a projection."""
    keys = [on] if isinstance(on, str) else list(on)
    for other in others:
        base = base.join(other, keys)
    return base.select(*cols)


def lookup_frame(df: DataFrame, features: DataFrame, keys, names, rows: int | None = None,
                 sample_from: DataFrame | None = None) -> DataFrame:
    """Left join of the named features; every row of ``df`` stays, once.

    ``keys`` maps key columns of ``features`` to columns of ``df``.  ``rows`` is the row count of
    ``features`` when they are known to be unique by key; otherwise both are checked here.
    """
    keys = dict(keys) if isinstance(keys, dict) else {k: k for k in keys}
    clash = sorted(set(names) & set(df.columns))
    if clash:
        raise ValueError(f"columns already present: {clash}")
    if rows is None:
        rows, unique = key_check(features.dropna(subset=list(keys)), list(keys))
        if not unique:
            raise ValueError(f"feature rows are not unique by {list(keys)}")
    right = features.select(*[F.col(k).alias(v) for k, v in keys.items()], *names)
    joined = keyed_left_join(df, right, list(keys.values()), sample_from=sample_from, right_rows=rows)
    return joined.select(*df.columns, *names)


def lookup(df: DataFrame, lookups: list[Lookup]) -> DataFrame:
    """Several feature tables, each by its own key, applied one after the other."""
    start = df
    for one in lookups:
        table = FeatureTable(df.sparkSession, one.table)
        by = one.key_map()
        known_unique = set(table.keys) <= set(by)
        # hot keys are looked for before any join, where the key is already there
        early = start if set(by.values()) <= set(start.columns) else None
        df = lookup_frame(df, table.read(), by, one.features, table.rows if known_unique else None, early)
    return df


def training_set(df: DataFrame, lookups: list[Lookup], label: str, exclude=()) -> tuple[DataFrame, list[dict]]:
    """Features by lookup, the label kept and last, excluded columns gone; plus the specs."""
    full = lookup(df, lookups)
    keep = [c for c in full.columns if c not in set(exclude) and c != label]
    return full.select(*keep, label), [one.spec() for one in lookups]


def lookups_from_specs(specs: list[dict]) -> list[Lookup]:
    return [Lookup(s["table"], list(s["features"]), dict(s["keys"])) for s in specs]


def lookup_asof(df: DataFrame, features: DataFrame, keys, ts: str, names) -> DataFrame:
    """The latest feature row with feature time <= row time, per key.

    One sorted union instead of a range join; the running value crosses slices, so a key
    with a large share of the rows is not gathered in one task.  The features travel as one
    struct: a NULL feature value is a value, not something to look behind.
    """
    keys = list(keys)
    payload = F.struct(*[F.col(n) for n in names])
    left_cols = [c for c in df.columns if c not in (*keys, ts)]
    left = df.select(*keys, F.col(ts).alias("_ts"), F.lit(1).alias("_side"),
                     F.struct(F.lit(1).alias("_one"), *left_cols).alias("_row_data"),
                     F.lit(None).cast(features.select(payload.alias("p")).schema["p"].dataType).alias("_feature"))
    right = features.select(*keys, F.col(ts).alias("_ts"), F.lit(0).alias("_side"),
                            F.lit(None).cast(left.schema["_row_data"].dataType).alias("_row_data"),
                            payload.alias("_feature"))
    right = right.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    both = running(left.unionByName(right), ["_ts", "_side", "_feature"], by=keys, lasts={"_last": "_feature"})
    rows = both.filter(F.col("_side") == 1)
    out = {**{k: F.col(k) for k in keys}, ts: F.col("_ts"), **{c: F.col(f"_row_data.`{c}`") for c in left_cols}}
    return rows.select(*[out[c].alias(c) for c in df.columns], *[F.col(f"_last.`{n}`").alias(n) for n in names])
