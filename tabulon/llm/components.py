"""Connected components of a link table by alternating stars, all in shuffles of the links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.plans.shared import materialise


def _pairs(df: DataFrame) -> DataFrame:
    return df.select("a", "b").filter("a <> b").distinct()


def _mark(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> one row (id, component) per linked id; component is the smallest id reachable.

    Large and small stars take turns until the links no longer change; every pass is written to the shared
    folder, so a lost executor repeats one pass only.  Links to itself and repeated links do not matter; an
    empty table gives an empty result.
    """
    now = materialise(_pairs(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), "links")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(_pairs(large), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))))
        now = materialise(_pairs(small), "links")
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
