"""Joins that stay balanced when one key holds a large share of the left rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.plans.shared import BROADCAST_ROWS

_SAMPLE, _SHARE, _LEAST = 0.01, 0.01, 50


def hot_hashes(df: DataFrame, keys) -> list[int]:
    """Hashes of at most 100 keys, among them every key with over 1 % of a sample's rows.

    The sample only decides how rows are spread, never which rows are in the result.
    """
    sample = df.select(F.xxhash64(*keys).alias("h")).sample(fraction=_SAMPLE, seed=11)
    top = sample.groupBy("h").count().orderBy(F.desc("count")).limit(int(1 / _SHARE)).collect()
    shown = sum(r["count"] for r in top)  # not more than the sample holds
    return [r["h"] for r in top if r["count"] >= _LEAST and r["count"] > _SHARE * shown]


def keyed_left_join(left: DataFrame, right: DataFrame, keys, how: str = "left", sample_from: DataFrame | None = None,
                    right_rows: int | None = None) -> DataFrame:
    """Equi-join with a right side that is unique per key.

    A right side known to be small is broadcast.  Otherwise rows with a hot key, and rows whose
    key is NULL, are spread over as many parts as the shuffle has, the right rows of hot keys copied to each.
    Left rows are spread by their place, so equal rows part too; hand over a stored frame, whose rows keep
    their places when a task runs again.
    ``sample_from`` is a cheaper frame with the same key distribution to look for hot keys in.
    """
    keys = list(keys)
    if right_rows is not None and right_rows <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), keys, how)
    hot = hot_hashes(left if sample_from is None else sample_from, keys)
    # the same hash on both sides needs the same types
    hashed = F.xxhash64(*[F.col(k).cast(left.schema[k].dataType) for k in keys])
    no_match = F.lit(False)
    for k in keys:
        no_match = no_match | F.col(k).isNull()
    salts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    needs_salt = no_match | hashed.isin(hot) if hot else no_match
    salted_left = left.withColumn("_salt", F.when(needs_salt, spread).otherwise(F.lit(0)))
    copies = F.when(hashed.isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = right.withColumn("_salt", F.explode(copies) if hot else F.lit(0))
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")
