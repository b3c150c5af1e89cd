"""Exact stratified splits and folds: one hashed order per class, cut at exact ranks.

The cut values are found by counting hash prefixes per class (a map-side combined count),
then ranking only the rows that share the prefix in which a cut falls.  Assigning a row is
then a comparison with its class's cut values: no sort, no window over a class.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulon.functions.columns import hash_text
from tabulon.plans.ordered import dense_ids
from tabulon.plans.shared import broadcast_if_small, materialise
from tabulon.plans.skew import keyed_left_join

_DIGITS = 5  # 16^5 prefixes per class


def _class(label):
    """A text that is equal for equal classes and not NULL, so that joins on it are plain ones."""
    return F.coalesce(F.concat(F.lit("v"), F.col(label).cast("string")), F.lit("n"))


def _hashed(df, key, label, seed):
    return df.select(_class(label).alias("_class"), F.col(key).alias("_key"),
                     hash_text(key, F.lit(str(seed))).alias("_h"))


def _prefix():
    return F.substring("_h", 1, _DIGITS)


def _prefix_counts(df, key, label, seed):
    """(class, hash prefix, rows): at most 16^5 rows per class, written out once."""
    counts = _hashed(df, key, label, seed).groupBy("_class", _prefix().alias("_p")).agg(F.count(F.lit(1)).alias("_m"))
    return materialise(counts, "prefixes")


def _classes(prefixes):
    """(class, rows), stored; there may be as many classes as rows."""
    return materialise(prefixes.groupBy("_class").agg(F.sum("_m").alias("_n")), "classes")


def _cuts(df, prefixes, key, label, seed, ranks):
    """The (hash, key) of the row at each wanted 1-based rank, as rows (class, cut, hash, key).

    ``ranks`` has rows (class, cut number, rank).
    """
    w = Window.partitionBy("_class").orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = prefixes.withColumn("_upto", F.sum("_m").over(w))  # at most 16^5 rows per class
    hit = upto.join(broadcast_if_small(materialise(ranks, "ranks")), "_class").filter(
        (F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_m") < F.col("_rank")))
    hit = materialise(hit.select("_class", "_cut", F.col("_p").alias("_hp"),
                                 (F.col("_rank") - F.col("_upto") + F.col("_m")).alias("_within")), "hit")
    # Only the rows of the hit prefixes are ranked: about n / 16^5 per cut.
    near = _hashed(df, key, label, seed).withColumn("_hp", _prefix()).join(broadcast_if_small(hit), ["_class", "_hp"])
    order = Window.partitionBy("_class", "_cut").orderBy("_h", "_key")
    return (near.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") == F.col("_within"))
            .select("_class", "_cut", F.col("_h").alias("_cut_h"), F.col("_key").alias("_cut_key")))


def _with_cut_number(df, prefixes, key, label, seed, ranks, name):
    """Add how many cuts of its class lie strictly before the row; NULL for a class without cuts."""
    cuts = _cuts(df, prefixes, key, label, seed, ranks).groupBy("_class").agg(
        F.collect_list(F.struct(F.col("_cut_h").alias("h"), F.col("_cut_key").alias("k"))).alias("_at"))
    # stored, so that reading train and test later does not look for the cuts again
    cuts = materialise(cuts, "cuts")
    row = F.struct(hash_text(key, F.lit(str(seed))).alias("h"), F.col(key).alias("k"))
    joined = keyed_left_join(df.withColumn("_class", _class(label)), cuts, ["_class"], right_rows=cuts.count())
    passed = F.when(F.col("_at").isNotNull(), F.size(F.filter("_at", lambda c: c < row)))
    return joined.withColumn(name, passed).select(*df.columns, name)


def _test_ranks(classes, test: float) -> DataFrame:
    """Rows of each class in the test part, none left out: ceil(test * n) shared out by largest remainder."""
    total = classes.agg(F.sum("_n")).first()[0] or 1
    wanted = math.ceil(test * total)
    share = F.lit(wanted).cast("decimal(18,0)") * F.col("_n").cast("decimal(18,0)")
    sized = classes.withColumn("_share", share).select(
        "_class", F.expr(f"_share div {total}").alias("_base"), (F.col("_share") % F.lit(total)).alias("_left"))
    rest = wanted - (sized.agg(F.sum("_base")).first()[0] or 0)
    placed = dense_ids(sized, [F.desc("_left"), "_class"], "_place")
    ranks = placed.select("_class", F.lit(0).alias("_cut"),
                          (F.col("_base") + (F.col("_place") < rest).cast("long")).alias("_rank"))
    return ranks.filter("_rank > 0")


def stratified_split(df: DataFrame, key: str, label: str, test: float = 0.2, seed: int = 0) -> DataFrame:
    """Add ``split`` ('train' / 'test') with exact class counts; ``key`` must be unique.

    The test rows of a class are its first ones in hash order, so the result does not depend
    on the layout of the frame.  There may be any number of classes.
    """
    prefixes = _prefix_counts(df, key, label, seed)
    ranks = _test_ranks(_classes(prefixes), test)
    cut = _with_cut_number(df, prefixes, key, label, seed, ranks, "_passed")
    part = F.when(F.col("_passed") == 0, F.lit("test")).otherwise(F.lit("train"))
    return cut.withColumn("split", part).drop("_passed")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 0, name: str = "fold") -> DataFrame:
    """Add a 0-based fold number; each class is cut into k runs of its hash order whose sizes
    differ by at most one (longer ones first)."""
    if k < 2:
        return df.withColumn(name, F.lit(0))
    prefixes = _prefix_counts(df, key, label, seed)
    upto = F.expr(f"(_cut + 1) * (_n div {k}) + least(_cut + 1, _n % {k})")
    ranks = _classes(prefixes).withColumn("_cut", F.explode(F.sequence(F.lit(0), F.lit(k - 2)))).select(
        "_class", "_cut", upto.alias("_rank")).filter("_rank > 0")
    folded = _with_cut_number(df, prefixes, key, label, seed, ranks, name)
    return folded.withColumn(name, F.coalesce(name, F.lit(0)).cast("int"))
