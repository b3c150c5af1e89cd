"""Lookups, feature tables, splits and preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.operators import lookup as lk
from tabulon.operators import prep, split
from tabulon.plans.shared import scratch
from tabulon.sources.feature_table import FeatureTable
from workload.registry import query, rounded, table


def text_features(spark, d):
    """Per-document features of the whole text."""
    text = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id", F.col("n_chars").alias("chars"),
        F.size(F.split(text, " ")).cast("long").alias("words"),
        F.size(F.split(text, "\n")).cast("long").alias("lines"),
        (F.length(text) - F.length(F.translate(text, "0123456789", ""))).cast("long").alias("digits"))


TEXT_SQL = """
SELECT doc_id, n_chars AS chars, CAST(len(string_split(text, ' ')) AS BIGINT) AS words,
  CAST(len(string_split(text, chr(10))) AS BIGINT) AS lines,
  CAST(length(text) - length(translate(text, '0123456789', '')) AS BIGINT) AS digits FROM documents"""


def text_table(spark, d):
    return FeatureTable.create(text_features(spark, d), scratch(spark, "text-features"), ["doc_id"], "document features")


@query("feature_table", TEXT_SQL)
def feature_table(spark, d):
    return text_table(spark, d).read()


@query("lookup", f"SELECT l.doc_id, quality, words, digits FROM labels l LEFT JOIN ({TEXT_SQL}) f ON l.doc_id = f.doc_id")
def lookup(spark, d):
    made = text_table(spark, d)
    spec = lk.Lookup(made.table.path, ["words", "digits"], ["doc_id"])
    return lk.lookup(table(spark, d, "labels").select("doc_id", "quality"), [spec])


@query("lookup_no_match", """
SELECT o_orderkey, c_acctbal FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def lookup_no_match(spark, d):
    rich = table(spark, d, "customer").filter("c_acctbal > 0")
    return lk.lookup_frame(table(spark, d, "orders").select("o_orderkey", "o_custkey"), rich,
                           {"c_custkey": "o_custkey"}, ["c_acctbal"]).drop("o_custkey")


@query("training_set", f"SELECT toxic, words, lines, chars, quality FROM labels l LEFT JOIN ({TEXT_SQL}) f ON l.doc_id = f.doc_id")
def training_set(spark, d):
    made = text_table(spark, d)
    frame, _ = lk.training_set(table(spark, d, "labels"),
                               [lk.Lookup(made.table.path, ["words", "lines", "chars"], ["doc_id"])],
                               label="quality", exclude=["doc_id"])
    return frame


@query("multi_lookup", """
SELECT l_orderkey, l_linenumber, l_extendedprice, p_retailprice, p_size, s_acctbal, n_name
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation ON s_nationkey = n_nationkey""")
def multi_lookup(spark, d):
    def made(name, key):
        return FeatureTable.create(table(spark, d, name), scratch(spark, name), [key], name).table.path

    frame = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return lk.lookup(frame, [
        lk.Lookup(made("part", "p_partkey"), ["p_retailprice", "p_size"], {"p_partkey": "l_partkey"}),
        lk.Lookup(made("supplier", "s_suppkey"), ["s_acctbal", "s_nationkey"], {"s_suppkey": "l_suppkey"}),
        lk.Lookup(made("nation", "n_nationkey"), ["n_name"], {"n_nationkey": "s_nationkey"}),
    ]).drop("l_partkey", "l_suppkey", "s_nationkey")


@query("asof_lookup", """
SELECT p.event_id, p.user_id, p.ts, v.value, v.event_id AS feature_event
FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN
     (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def asof_lookup(spark, d):
    events = table(spark, d, "events")
    left = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = events.filter("event_type = 'view'").select("user_id", "ts", "value", F.col("event_id").alias("feature_event"))
    return lk.lookup_asof(left, right, ["user_id"], "ts", ["value", "feature_event"])


@query("merge_feature_table", """
SELECT coalesce(t.c_custkey, s.k) AS c_custkey, CASE WHEN s.k IS NOT NULL THEN s.bal ELSE t.c_acctbal END AS c_acctbal,
  t.c_mktsegment
FROM customer t FULL OUTER JOIN (
  SELECT CASE WHEN c_custkey % 3 = 0 THEN c_custkey + 100000000 ELSE c_custkey END AS k,
    CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal + 1 END AS bal FROM customer WHERE c_nationkey < 10) s
ON t.c_custkey = s.k""")
def merge_feature_table(spark, d):
    customer = table(spark, d, "customer")
    made = FeatureTable.create(customer.select("c_custkey", "c_acctbal", "c_mktsegment"),
                               scratch(spark, "customers"), ["c_custkey"], "balances")
    source = customer.filter("c_nationkey < 10").select(
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_custkey") + 100000000).otherwise(F.col("c_custkey")).alias("c_custkey"),
        F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal") + 1).alias("c_acctbal"))
    made.merge(source)
    made.merge(source)  # a second time: no change
    return made.read()


def split_sql(label="o_orderstatus"):
    return f"""
WITH c AS (SELECT {label} AS y, count(*) AS n FROM orders GROUP BY 1),
t AS (SELECT y, n, ceil(0.2 * sum(n) OVER ()) * n / sum(n) OVER () AS ideal, ceil(0.2 * sum(n) OVER ()) AS want FROM c),
f AS (SELECT y, floor(ideal) AS base, want - sum(floor(ideal)) OVER () AS extra,
  row_number() OVER (ORDER BY ideal - floor(ideal) DESC, y) AS pos FROM t),
k AS (SELECT y, base + CASE WHEN pos <= extra THEN 1 ELSE 0 END AS n_test FROM f)
SELECT o_orderkey, {label}, CASE WHEN row_number() OVER (PARTITION BY {label}
  ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|5')) <= n_test THEN 'test' ELSE 'train' END AS split
FROM orders JOIN k ON {label} = y"""


@query("stratified_split", split_sql())
def stratified_split(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_split(orders, "o_orderkey", "o_orderstatus", seed=5)


@query("stratified_folds", """
SELECT o_orderkey, o_orderstatus, CAST(ntile(5) OVER (PARTITION BY o_orderstatus
  ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|5')) - 1 AS INTEGER) AS fold FROM orders""")
def stratified_folds(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return split.stratified_folds(orders, "o_orderkey", "o_orderstatus", 5, seed=5)


def _impute_sql(agg):
    return f"""
SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount = 0 THEN a ELSE l_discount END, 6) AS l_discount_imputed,
  round(CASE WHEN l_tax = 0 THEN b ELSE l_tax END, 6) AS l_tax_imputed
FROM lineitem, (SELECT {agg.format('nullif(l_discount, 0)')} a, {agg.format('nullif(l_tax, 0)')} b FROM lineitem)"""


def _imputed(spark, d, strategy):
    frame = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    model = prep.fit_imputer(frame, ["l_discount", "l_tax"], strategy=strategy)
    return rounded(model.transform(frame).drop("l_discount", "l_tax"))


@query("impute_mean", _impute_sql("avg({})"))
def impute_mean(spark, d):
    return _imputed(spark, d, "mean")


@query("impute_median", _impute_sql("quantile_cont({}, 0.5)"))
def impute_median(spark, d):
    return _imputed(spark, d, "median")


@query("standardize", """
SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS o_totalprice_scaled
FROM orders, (SELECT avg(o_totalprice) m, stddev_pop(o_totalprice) s FROM orders)""")
def standardize(spark, d):
    frame = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return rounded(prep.fit_scaler(frame, ["o_totalprice"]).transform(frame).drop("o_totalprice"))


def _prep_sql(imputed, passed=()):
    filled = ", ".join([f"CASE WHEN {c} = 0 THEN (SELECT avg(nullif({c}, 0)) FROM lineitem) ELSE {c} END AS {c}"
                        for c in imputed] + list(passed))
    cols = [c for c in (*passed, *imputed)]
    out = ", ".join(f"round(({c} - (SELECT avg({c}) FROM f)) / (SELECT stddev_pop({c}) FROM f), 5) AS {c}_prep" for c in cols)
    return f"WITH f AS (SELECT l_orderkey, l_linenumber, {filled} FROM lineitem) SELECT l_orderkey, l_linenumber, {out} FROM f"


def _prepared(spark, d, remainder):
    frame = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    plan = prep.Prep(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], ["l_discount", "l_tax"], remainder=remainder)
    out = plan.fit(frame).transform(frame)
    return rounded(out.select("l_orderkey", "l_linenumber", *[c for c in out.columns if c.endswith("_prep")]), 5)


@query("prep_pipeline", _prep_sql(["l_discount", "l_tax"]))
def prep_pipeline(spark, d):
    return _prepared(spark, d, "drop")


@query("prep_pipeline_pass", _prep_sql(["l_discount", "l_tax"], ["l_quantity", "l_extendedprice"]))
def prep_pipeline_pass(spark, d):
    return _prepared(spark, d, "pass")
