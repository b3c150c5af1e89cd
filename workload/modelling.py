"""Evaluation, training, tuning and scoring.

Where an exact SQL check is wanted the model is a fixed rule (a saved pipeline like any
other), so the plumbing around it is what is checked.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from tabulon.operators import evaluate as ev
from tabulon.operators import lookup as lk
from tabulon.operators import score as sc
from tabulon.operators import boost, train, tune
from tabulon.operators.prep import Prep
from tabulon.operators.split import stratified_split
from tabulon.plans.shared import scratch
from workload.features import TEXT_SQL, text_table
from workload.registry import query, rounded, table
from workload.star import SCORED_SQL, scored_lines


def rule(expression: str) -> PipelineModel:
    """A pipeline whose prediction is the given SQL condition."""
    return PipelineModel([SQLTransformer(
        statement=f"SELECT *, CAST(({expression}) AS DOUBLE) AS prediction FROM __THIS__")])


# --- evaluation -------------------------------------------------------------------------

@query("confusion", f"""
SELECT CAST(a AS INTEGER) AS actual, CAST(b AS INTEGER) AS predicted, count(y) AS n
FROM (SELECT unnest([0, 0, 1, 1]) AS a, unnest([0, 1, 0, 1]) AS b) LEFT JOIN ({SCORED_SQL}) ON a = y AND b = p GROUP BY 1, 2""")
def confusion(spark, d):
    return ev.confusion(scored_lines(spark, d), "y", "p")


CELLS_SQL = f"""SELECT count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 1) AS fp,
  count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 0 AND p = 0) AS tn FROM ({SCORED_SQL})"""


@query("binary_metrics", f"""
SELECT tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
  round(2 * tp / (2 * tp + fp + fn), 6) AS f1, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM ({CELLS_SQL})""")
def binary_metrics(spark, d):
    return rounded(ev.binary_metrics(scored_lines(spark, d), "y", "p"))


@query("roc_score_hard", f"SELECT round((tp / (tp + fp) + tn / (tn + fn)) / 2, 6) AS roc_score FROM ({CELLS_SQL})")
def roc_score_hard(spark, d):
    return rounded(ev.roc_score_hard(scored_lines(spark, d), "y", "p"))


CURVE_SQL = f"""SELECT s, pos, neg, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, sum(pos) OVER () AS tp, sum(neg) OVER () AS tn
FROM (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM ({SCORED_SQL}) GROUP BY s)
WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)"""
AUC_SQL = f"SELECT sum(pos * (tn - cn + neg / 2.0)) / (max(tp) * max(tn)) AS v FROM ({CURVE_SQL})"
AP_SQL = f"SELECT sum(pos * (cp / (cp + cn))) / max(tp) AS v FROM ({CURVE_SQL})"


@query("roc_auc", f"SELECT round(CAST(v AS DOUBLE), 6) AS roc_auc FROM ({AUC_SQL})")
def roc_auc(spark, d):
    return rounded(ev.roc_auc(scored_lines(spark, d), "y", "s"))


@query("roc_curve", f"""
SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT s, round(cn / tn, 6), round(cp / tp, 6) FROM ({CURVE_SQL})""")
def roc_curve(spark, d):
    return rounded(ev.roc_curve(scored_lines(spark, d), "y", "s"))


@query("pr_curve", f"""
SELECT s AS threshold, round(cp / (cp + cn), 6) AS precision, round(cp / tp, 6) AS recall FROM ({CURVE_SQL})""")
def pr_curve(spark, d):
    return rounded(ev.pr_curve(scored_lines(spark, d), "y", "s"))


@query("average_precision", f"SELECT round(CAST(v AS DOUBLE), 6) AS average_precision FROM ({AP_SQL})")
def average_precision(spark, d):
    return rounded(ev.average_precision(scored_lines(spark, d), "y", "s"))


@query("classifier_report", f"""
WITH c AS ({CELLS_SQL}), l AS (SELECT count(*) AS n, avg(-CASE WHEN y = 1 THEN ln(q) ELSE ln(1 - q) END) AS loss
  FROM (SELECT y, least(greatest(s, 1e-15), 1 - 1e-15) AS q FROM ({SCORED_SQL})))
SELECT unnest(['example_count', 'tp', 'fp', 'fn', 'tn', 'precision', 'recall', 'f1', 'accuracy', 'log_loss', 'roc_auc',
  'average_precision']) AS metric,
  unnest([n, tp, fp, fn, tn, round(tp / (tp + fp), 6), round(tp / (tp + fn), 6), round(2 * tp / (2 * tp + fp + fn), 6),
  round((tp + tn) / (tp + fp + fn + tn), 6), round(loss, 6), round((SELECT CAST(v AS DOUBLE) FROM ({AUC_SQL})), 6),
  round((SELECT CAST(v AS DOUBLE) FROM ({AP_SQL})), 6)]::DOUBLE[]) AS value FROM c, l""")
def classifier_report(spark, d):
    return rounded(ev.evaluate(scored_lines(spark, d), "y", "p", "s"))


@query("lift_table", f"""
WITH x AS ({SCORED_SQL}), e AS (SELECT quantile_cont(s, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS q FROM x),
b AS (SELECT CAST(len(list_filter(q, lambda c: s <= c)) + 1 AS INTEGER) AS bin, y FROM x, e),
g AS (SELECT bin, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives FROM b GROUP BY bin)
SELECT bin, n, positives, round(positives / n, 6) AS rate,
  round(positives / n / (sum(positives) OVER () / sum(n) OVER ()), 6) AS lift,
  round(sum(positives) OVER (ORDER BY bin) / sum(positives) OVER (), 6) AS cum_gain FROM g""")
def lift_table(spark, d):
    return rounded(ev.lift_table(scored_lines(spark, d), "y", "s"))


@query("calibration_table", f"""
SELECT CAST(least(floor(s * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(s), 6) AS mean_score,
  round(avg(y), 6) AS positive_rate FROM ({SCORED_SQL}) GROUP BY 1""")
def calibration_table(spark, d):
    return rounded(ev.calibration_table(scored_lines(spark, d), "y", "s"))


@query("perm_importance", """
WITH o AS (SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, o_totalprice AS a, o_custkey AS b,
  row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|to1'), o_orderkey) AS i,
  row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|from1'), o_orderkey) AS j FROM orders),
p AS (SELECT t.y, t.a, t.b, f.a AS a2, f.b AS b2 FROM o t JOIN o f ON t.i = f.j),
h AS (SELECT y, CASE WHEN a > 200000 AND b % 2 = 0 THEN 1 ELSE 0 END AS p0, CASE WHEN a2 > 200000 AND b % 2 = 0 THEN 1 ELSE 0 END AS p1,
  CASE WHEN a > 200000 AND b2 % 2 = 0 THEN 1 ELSE 0 END AS p2 FROM p),
s AS (SELECT 2 * sum(y * p0) / (sum(y) + sum(p0)) AS f0, 2 * sum(y * p1) / (sum(y) + sum(p1)) AS f1,
  2 * sum(y * p2) / (sum(y) + sum(p2)) AS f2 FROM h)
SELECT 'a' AS feature, round(f0 - f1, 6) AS f1_drop FROM s UNION ALL SELECT 'b', round(f0 - f2, 6) FROM s""")
def perm_importance(spark, d):
    frame = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("k"), (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        F.col("o_totalprice").alias("a"), F.col("o_custkey").alias("b"))
    model = rule("a > 200000 AND b % 2 = 0")
    return rounded(ev.perm_importance(frame, lambda f: sc.score(f, model), ["a", "b"], "k", "y", seed=1))


# --- training and tuning -----------------------------------------------------------------

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PREP = Prep(FEATURES, ["l_discount", "l_tax"], remainder="pass")
# the fixed values of the search space, 181 rounds among them, at its least depth, 10
GBT = {**{k: v for k, v in tune.SEARCH_SPACE.items() if not isinstance(v, tuple)},
       "max_depth": tune.SEARCH_SPACE["max_depth"][1]}


def labelled_lines(spark, d):
    return table(spark, d, "lineitem").select(*FEATURES, (F.col("l_returnflag") == "R").cast("int").alias("y"))


@query("gbt_score")
def gbt_score(spark, d):
    rows = labelled_lines(spark, d)
    model = boost.fit_boosted(rows, PREP, "y", **GBT)
    uri = train.save_model(model, scratch(spark, "gbt"), rows.select(*FEATURES))
    return rounded(sc.score(rows, train.load_model(spark, uri), probability="p"))


@query("gbt_score_check", """
SELECT l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_returnflag = 'R' AS INTEGER) AS y, true AS consistent FROM lineitem""")
def gbt_score_check(spark, d):
    """Every row is kept as it was, and the class is the one its probability says.

    That is all its SQL can say of a whole fit; ``boost_one_split`` has SQL for the values of a first tree.
    """
    rows = labelled_lines(spark, d)
    scored = sc.score(rows, boost.fit_boosted(rows, PREP, "y", **GBT), probability="p")
    return scored.select(*FEATURES, "y", (F.col("p").between(0, 1) & (
        F.col("prediction") == (F.col("p") > 0.5).cast("int"))).alias("consistent"))


FEW = ["l_quantity", "l_discount", "l_tax"]
ONE_SPLIT = {"n_estimators": 1, "num_leaves": 2, "learning_rate": 0.5, "lambda_l1": 0.5, "lambda_l2": 2.0,
             "path_smooth": 50.0, "min_child_samples": 35}
_HIT = "sign({g}) * greatest(abs({g}) - 0.5, 0)"
_OUT = f"-{_HIT} / ({{h}} + 2) * ({{n}} / 50.0) / ({{n}} / 50.0 + 1)"


@query("boost_one_split", f"""
WITH x AS (SELECT l_orderkey, l_linenumber, l_quantity::DOUBLE AS q, l_discount::DOUBLE AS d, l_tax::DOUBLE AS t,
  (l_returnflag = 'R')::INTEGER AS y FROM lineitem),
b AS (SELECT avg(y) AS p, count(*) AS n, sum(y) AS s FROM x),
u AS (SELECT 0 AS c, q AS v, y FROM x UNION ALL SELECT 1, d, y FROM x UNION ALL SELECT 2, t, y FROM x),
v AS (SELECT c, v, count(*) AS n, sum(y) AS s FROM u GROUP BY c, v),
l AS (SELECT c, v, sum(n) OVER o AS nl, sum(s) OVER o AS sl FROM v WINDOW o AS (PARTITION BY c ORDER BY v)),
g AS (SELECT c, v, nl, b.n - nl AS nr, nl * p - sl AS gl, (b.n - nl) * p - (b.s - sl) AS gr, nl * p * (1 - p) AS hl,
  (b.n - nl) * p * (1 - p) AS hr FROM l, b WHERE nl >= 35 AND b.n - nl >= 35),
o AS (SELECT *, {_OUT.format(g='gl', h='hl', n='nl')} AS ol, {_OUT.format(g='gr', h='hr', n='nr')} AS r FROM g),
k AS (SELECT c, v, ol, r, -(2 * {_HIT.format(g='gl')} * ol + (hl + 2) * ol * ol) - (2 * {_HIT.format(g='gr')} * r + (hr + 2) * r * r)
  AS gain FROM o),
w AS (SELECT * FROM k WHERE gain > 0 ORDER BY gain DESC, c, v LIMIT 1),
z AS (SELECT x.*, ln(p / (1 - p)) + 0.5 * coalesce(CASE WHEN CASE w.c WHEN 0 THEN q WHEN 1 THEN d ELSE t END <= w.v
  THEN ol ELSE r END, 0) AS m FROM x CROSS JOIN b LEFT JOIN w ON true)
SELECT l_orderkey, l_linenumber, round(1 / (1 + exp(-m)), 6) AS p, (m > 0)::INTEGER AS prediction FROM z""")
def boost_one_split(spark, d):
    """One round of one split: its column, cut and smoothed leaf values, over all values of three columns."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *FEW, (F.col("l_returnflag") == "R").cast("int").alias("y"))
    model = boost.fit_boosted(rows, Prep(FEW, remainder="pass", scale=False), "y", **ONE_SPLIT)
    return rounded(sc.score(rows, model, probability="p").select("l_orderkey", "l_linenumber", "p", "prediction"))


@query("gbt_explain")
def gbt_explain(spark, d):
    """Shapley values of every row by the whole ensemble of ``gbt_score``; they add up to the margin, as a test checks."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *FEATURES,
                                              (F.col("l_returnflag") == "R").cast("int").alias("y"))
    told = boost.explain(rows, boost.fit_boosted(rows, PREP, "y", **GBT), PREP.used())
    return rounded(told.select("l_orderkey", "l_linenumber", "explanation.*"))


@query("gbt_importance")
def gbt_importance(spark, d):
    model = boost.fit_boosted(labelled_lines(spark, d), PREP, "y", **GBT)
    return rounded(ev.importance(model, PREP.used()))


@query("logistic_score")
def logistic_score(spark, d):
    rows = labelled_lines(spark, d)
    return rounded(sc.score(rows, train.fit_logistic(rows, PREP, "y"), probability="p"), 4)


@query("baseline_sweep")
def baseline_sweep(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", "o_custkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    parts = stratified_split(orders, "o_orderkey", "y", seed=2)
    return rounded(train.baseline_sweep(
        parts.filter("split = 'train'"), parts.filter("split = 'test'"),
        Prep(["o_totalprice", "o_custkey"], remainder="pass"), "y",
        ["logistic", "decision_tree", "random_forest", "boosted_trees", "gaussian_bayes"]))


@query("gaussian_bayes", """
WITH z AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
    (o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER () AS a,
    (o_custkey - avg(o_custkey) OVER ()) / stddev_pop(o_custkey) OVER () AS b FROM orders),
m AS (SELECT y, ln(count(*) / (SELECT count(*) FROM z)) AS prior, avg(a) ma, avg(b) mb, var_pop(a) + 1e-9 va, var_pop(b) + 1e-9 vb
  FROM z GROUP BY y),
s AS (SELECT o_orderkey, m.y, prior - 0.5 * (ln(2 * pi() * va) + (a - ma) * (a - ma) / va + ln(2 * pi() * vb) + (b - mb) * (b - mb) / vb) AS ll
  FROM z, m)
SELECT o_orderkey, CAST(CASE WHEN max(ll) FILTER (y = 1) > max(ll) FILTER (y = 0) THEN 1 ELSE 0 END AS INTEGER) AS prediction
FROM s GROUP BY o_orderkey""")
def gaussian_bayes(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", "o_custkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    model = train.fit_classifier(orders, Prep(["o_totalprice", "o_custkey"], remainder="pass"), train.BASELINES["gaussian_bayes"](), "y")
    return sc.score(orders, model).select("o_orderkey", "prediction")


def _u(name, key, seed=9):
    return f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{name}|{seed}'), 1, 8) AS BIGINT) / 4294967296.0)"


def _draws(key):
    return f"""round({_u('colsample_bytree', key)}, 6) AS colsample_bytree, round({_u('lambda_l1', key)} * 0.5, 6) AS lambda_l1,
  round({_u('lambda_l2', key)} * 0.5, 6) AS lambda_l2,
  round(exp(sqrt(-2 * ln(1 - {_u('learning_rate_r', key)})) * cos(2 * pi() * {_u('learning_rate_a', key)})), 6) AS learning_rate,
  CAST(50 + floor({_u('max_bin', key)} * 205) AS INTEGER) AS max_bin, CAST(10 + floor({_u('max_depth', key)} * 10) AS INTEGER) AS max_depth,
  35 AS min_child_samples, 181 AS n_estimators, 90 AS num_leaves, round(82.58514740065912::DOUBLE, 6) AS path_smooth,
  round(0.7664087623951591::DOUBLE, 6) AS subsample, 50122439 AS random_state"""


@query("draw_params", f"SELECT c_custkey AS run_id, {_draws('c_custkey')} FROM customer")
def draw_params(spark, d):
    keys = table(spark, d, "customer").select(F.col("c_custkey").alias("run_id"))
    return rounded(tune.draw_params(keys, "run_id", tune.SEARCH_SPACE, seed=9))


RULE_SPACE = {"cut": ("uniform", 0.0, 0.1)}
RUNS_SQL = f"""
WITH t AS (SELECT i AS run_id, {_u('cut', 'i')} * 0.1 AS cut FROM (SELECT unnest(range(0, 5)) AS i)),
c AS (SELECT run_id, cut, sum(CASE WHEN l_returnflag = 'R' AND l_discount > cut THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN l_returnflag <> 'R' AND l_discount > cut THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN l_returnflag = 'R' AND l_discount <= cut THEN 1 ELSE 0 END) AS fn,
  sum(CASE WHEN l_returnflag <> 'R' AND l_discount <= cut THEN 1 ELSE 0 END) AS tn FROM lineitem, t GROUP BY ALL)
SELECT run_id, round(cut, 6) AS cut, round(2 * tp / (2 * tp + fp + fn), 6) AS f1score,
  round((tp / (tp + fp) + tn / (tn + fn)) / 2, 6) AS roc_score, round(-2 * tp / (2 * tp + fp + fn), 6) AS loss FROM c"""


def rule_runs(spark, d):
    rows = labelled_lines(spark, d)
    trials = tune.sample_space(spark, 5, seed=9, space=RULE_SPACE)
    return tune.run_trials(rows, rows, trials, lambda _, p: rule(f"l_discount > {p['cut']!r}D"), "y")


@query("run_trials", RUNS_SQL)
def run_trials(spark, d):
    return rounded(rule_runs(spark, d))


@query("best_run", f"SELECT * FROM ({RUNS_SQL}) ORDER BY f1score DESC, run_id LIMIT 1")
def best_run(spark, d):
    return rounded(tune.best_run(rule_runs(spark, d)))


TRIALS = 5


@query("tune_gbt")
def tune_gbt(spark, d):
    """Random search with real fits: tuned on a validation part of the training rows, all trials in the same passes."""
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", "o_custkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    outer = stratified_split(orders, "o_orderkey", "y", seed=2).filter("split = 'train'").drop("split")
    inner = stratified_split(outer, "o_orderkey", "y", seed=3)
    plan = Prep(["o_totalprice", "o_custkey"], remainder="pass")
    return rounded(tune.run_boosted(inner.filter("split = 'train'"), inner.filter("split = 'test'"),
                                    tune.sample_space(spark, TRIALS, seed=4), plan, "y"))


@query("suggest_trials")
def suggest_trials(spark, d):
    """Ten cuts that Parzen search proposes after twenty measured ones."""
    rows = labelled_lines(spark, d)
    trials = tune.sample_space(spark, 20, seed=9, space=RULE_SPACE)
    runs = tune.run_trials(rows, rows, trials, lambda _, p: rule(f"l_discount > {p['cut']!r}D"), "y")
    return rounded(tune.suggest(runs, 10, RULE_SPACE, seed=1))


@query("cross_val", """
WITH f AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, o_totalprice AS x FROM orders),
k AS (SELECT *, ntile(5) OVER (PARTITION BY y ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|6')) - 1 AS fold FROM f),
m AS (SELECT a.i AS fold, avg(x) AS cut FROM k, (SELECT unnest(range(0, 5)) AS i) a WHERE k.fold <> a.i GROUP BY 1)
SELECT CAST(k.fold AS INTEGER) AS fold, round(2 * sum(CASE WHEN x > cut THEN y ELSE 0 END) /
  (sum(y) + sum(CASE WHEN x > cut THEN 1 ELSE 0 END)), 6) AS f1 FROM k JOIN m ON k.fold = m.fold GROUP BY 1""")
def cross_val(spark, d):
    rows = table(spark, d, "orders").select(
        "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("y"), F.col("o_totalprice").alias("x"))

    def fit(part):
        return rule(f"x > {part.agg(F.avg('x')).first()[0]!r}D")

    return rounded(tune.cross_val(rows, "o_orderkey", "y", fit, k=5, seed=6))


# --- scoring -----------------------------------------------------------------------------

LINEAR = "l_quantity * 0.02 + l_discount * 10 - l_tax * 5 > 0.8"


@query("score", f"SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, CAST({LINEAR} AS INTEGER) AS prediction FROM lineitem")
def score(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    uri = train.save_model(rule(LINEAR), scratch(spark, "rule"), rows)
    return sc.score(rows, train.load_model(spark, uri))


@query("score_batches", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, CAST(l_quantity * 1000.0 - l_extendedprice > 500 AS INTEGER) AS prediction FROM lineitem""")
def score_batches(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return sc.score_batches(rows, sc.linear_predictor([1000.0, -1.0], 0.0, 500.0), ["l_quantity", "l_extendedprice"])


@query("score_batches_trees", "SELECT count(*) AS n, count(*) AS agree FROM lineitem")
def score_batches_trees(spark, d):
    """A fitted ensemble outside its pipeline, scored in Arrow batches, beside what the pipeline predicts."""
    rows = labelled_lines(spark, d)
    model = boost.fit_boosted(rows, PREP, "y", **{**GBT, "n_estimators": 20})
    prepared = [f"{c}_prep" for c in PREP.used()]
    own = model.transform(rows).select(*prepared, F.col("prediction").cast("int").alias("by_pipeline"))
    both = sc.score_batches(own, sc.ensemble_predictor(model.stages[-1]), prepared)
    return both.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("by_pipeline") == F.col("prediction")).cast("long")).alias("agree"))


WORDY = "words > 100 AND digits * 20 < chars"


def wordy_model(spark, d):
    made = text_table(spark, d)
    frame, specs = lk.training_set(table(spark, d, "labels").select("doc_id", "quality"),
                                   [lk.Lookup(made.table.path, ["words", "digits"], ["doc_id"]),
                                    lk.Lookup(made.table.path, ["chars"], ["doc_id"])], label="quality")
    return train.save_model(rule(WORDY), scratch(spark, "wordy"), frame.drop("quality"), specs)


@query("score_with_lookup", f"""
SELECT l.doc_id, toxic, words, digits, chars, CAST({WORDY} AS INTEGER) AS prediction
FROM labels l LEFT JOIN ({TEXT_SQL}) f ON l.doc_id = f.doc_id""")
def score_with_lookup(spark, d):
    return sc.score_with_lookup(table(spark, d, "labels").select("doc_id", "toxic"), wordy_model(spark, d))


@query("score_requests", """
WITH o AS (SELECT o_orderkey, o_totalprice AS a, o_custkey AS b, o_orderkey % 4 AS kind FROM orders),
x AS (SELECT o_orderkey, unnest([0, 1]) AS row, unnest([a, a / 2]) AS price, unnest([b, b + 1]) AS cust FROM o WHERE kind < 2)
SELECT o_orderkey, row, CAST(price AS DOUBLE) AS price, CAST(cust AS DOUBLE) AS cust,
  CAST(price > 100000 AND cust % 2 = 0 AS INTEGER) AS prediction, NULL AS error FROM x
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, 'malformed body' FROM o WHERE kind = 2
UNION ALL SELECT o_orderkey, 0, NULL, NULL, NULL, 'value is not a number' FROM o WHERE kind = 3""")
def score_requests(spark, d):
    """Request bodies of four kinds, one per order: split form, inputs form, broken, not a number."""
    a, b = F.col("o_totalprice"), F.col("o_custkey")
    split_form = F.to_json(F.struct(F.struct(
        F.array(F.lit("cust"), F.lit("price")).alias("columns"),
        F.array(F.array(b.cast("double"), a), F.array((b + 1).cast("double"), a / 2)).alias("data")).alias("dataframe_split")))
    inputs_form = F.to_json(F.struct(F.struct(
        F.array(a, a / 2).alias("price"), F.array(b, b + 1).alias("cust")).alias("inputs")))
    broken = F.concat(F.lit('{"dataframe_split": {"columns": ['), b.cast("string"))
    not_number = F.concat(F.lit('{"dataframe_split": {"columns": ["price", "cust"], "data": [["x", '), b.cast("string"), F.lit("]]}}"))
    kind = F.col("o_orderkey") % 4
    bodies = table(spark, d, "orders").select("o_orderkey", F.when(kind == 0, split_form).when(
        kind == 1, inputs_form).when(kind == 2, broken).otherwise(not_number).alias("body"))
    return sc.score_requests(bodies, "body", rule("price > 100000 AND cust % 2 = 0"), ["price", "cust"]).drop("body")
