"""Profiling and correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.operators import corr, phik, profile, profile_state
from tabulon.operators.shape import zero_to_null
from tabulon.plans.shared import materialise
from workload.registry import query, r, rounded, table
from workload.star import MEASURES, STAR_SQL, long_sql, star

STAR_MEASURES = ["c_acctbal", "n_orders", "total_spend", "zero_tax_lines"]
LINES_LONG = long_sql(MEASURES, "lineitem")


def lines(spark, d):
    return table(spark, d, "lineitem")


@query("assemble_star", f"""
SELECT * REPLACE (round(total_spend, 2) AS total_spend) FROM ({STAR_SQL})""")
def assemble_star(spark, d):
    return star(spark, d).withColumn("total_spend", F.round("total_spend", 2))


DESCRIBE = """
SELECT {lead} "column", unnest(['count','mean','std','min','25%','50%','75%','max']) AS stat,
  unnest([c, round(m, {k}), round(s, {k}), round(lo, {k}), round(q1, {k}), round(q2, {k}), round(q3, {k}), round(hi, {k})]) AS value
FROM (SELECT {lead} "column", CAST(count(*) AS DOUBLE) c, avg(value) m, stddev_samp(value) s, min(value) lo,
  quantile_cont(value, 0.25) q1, quantile_cont(value, 0.5) q2, quantile_cont(value, 0.75) q3, max(value) hi
  FROM ({source}) GROUP BY {lead} "column")"""


@query("flagship_star_profile", DESCRIBE.format(k=6, lead="c_mktsegment,", source=long_sql(
    ["c_acctbal", "total_spend", "zero_tax_lines", "zero_discount_lines"],
    f"(SELECT * REPLACE (nullif(zero_tax_lines, 0) AS zero_tax_lines, nullif(zero_discount_lines, 0)"
    f" AS zero_discount_lines) FROM ({STAR_SQL}))", "c_mktsegment")))
def flagship_star_profile(spark, d):
    """Entity tables joined per customer, zeros made missing, described per market segment."""
    frame = materialise(zero_to_null(star(spark, d), ["zero_tax_lines", "zero_discount_lines"]), "star")
    return rounded(profile.describe(
        frame, ["c_acctbal", "total_spend", "zero_tax_lines", "zero_discount_lines"], ["c_mktsegment"]))


@query("zero_counts", "SELECT " + ", ".join(
    f'CAST(sum(CASE WHEN {c} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS {c}_count0' for c in MEASURES) + " FROM lineitem")
def zero_counts(spark, d):
    return profile.zero_counts(lines(spark, d), MEASURES)


@query("describe", DESCRIBE.format(k=7, lead="", source=LINES_LONG))
def describe(spark, d):
    return rounded(profile.describe(lines(spark, d), MEASURES), 7)


@query("describe_by", DESCRIBE.format(k=7, lead="l_returnflag,", source=long_sql(MEASURES, "lineitem", "l_returnflag")))
def describe_by(spark, d):
    return rounded(profile.describe(lines(spark, d), MEASURES, ["l_returnflag"]), 7)


@query("quick_summary", f"""
SELECT "column", count(*) AS count, CAST(0 AS BIGINT) AS missing, count(*) FILTER (value = 0) AS zeros, round(avg(value), 7) AS mean,
  round(stddev_samp(value), 6) AS std, min(value) AS min, max(value) AS max, true AS median_inside,
  count(*) AS histogram_rows, true AS distinct_close
FROM ({LINES_LONG}) GROUP BY "column" """)
def quick_summary(spark, d):
    """The exact parts as they are; the sketched ones by what must hold of them."""
    s = profile.quick_summary(lines(spark, d), MEASURES)
    exact = lines(spark, d).agg(*[F.count_distinct(c).alias(c) for c in MEASURES]).unpivot([], MEASURES, "column", "d")
    s = s.join(exact, "column").select(
        "column", "count", "missing", "zeros", r(F.col("mean"), 7).alias("mean"), r(F.col("std")).alias("std"), "min", "max",
        F.col("median").between(F.col("min"), F.col("max")).alias("median_inside"),
        F.round(F.aggregate(F.transform("histogram", lambda h: h["y"]), F.lit(0.0), lambda a, x: a + x)).cast("long").alias(
            "histogram_rows"),
        (F.abs(F.col("approx_distinct") - F.col("d")) <= F.col("d") * 0.25 + 1).alias("distinct_close"))
    return s


@query("profile_overview", """
SELECT CAST(sum(k) AS BIGINT) AS n_rows, CAST(4 AS BIGINT) AS n_columns,
  CAST(sum(nulls * k) AS BIGINT) AS missing_cells, round(sum(nulls * k) * 100.0 / (sum(k) * 4), 6) AS missing_pct,
  count(*) FILTER (k > 1) AS duplicated_groups, CAST(sum(k - 1) AS BIGINT) AS duplicate_rows,
  round(sum(k - 1) * 100.0 / sum(k), 6) AS duplicate_pct,
  CAST(3 AS BIGINT) AS numeric_columns, CAST(1 AS BIGINT) AS text_columns, CAST(0 AS BIGINT) AS other_columns
FROM (SELECT l_quantity, l_discount, l_tax, l_returnflag, count(*) AS k,
        CASE WHEN l_discount IS NULL THEN 1 ELSE 0 END + CASE WHEN l_tax IS NULL THEN 1 ELSE 0 END AS nulls
      FROM (SELECT l_quantity, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax, l_returnflag FROM lineitem)
      GROUP BY ALL)""")
def profile_overview(spark, d):
    frame = zero_to_null(lines(spark, d).select("l_quantity", "l_discount", "l_tax", "l_returnflag"),
                         ["l_discount", "l_tax"])
    return rounded(profile.profile_overview(frame))


def _profile_sql(source, long, k):
    return f"""
WITH v AS ({long}), t AS (SELECT count(*) AS n_all FROM {source}),
s AS (SELECT "column", count(*) AS n, count(*) FILTER (value = 0) AS zeros, count(*) FILTER (value < 0) AS negatives,
  avg(value) AS mean, sum(value) AS total, min(value) AS lo, max(value) AS hi, stddev_samp(value) AS sd,
  var_samp(value) AS vs, skewness(value) AS sk, kurtosis(value) AS ku, count(DISTINCT value) AS dis,
  quantile_cont(value, 0.05) q0, quantile_cont(value, 0.25) q1, quantile_cont(value, 0.5) q2,
  quantile_cont(value, 0.75) q3, quantile_cont(value, 0.95) q4 FROM v GROUP BY "column"),
m AS (SELECT v."column", quantile_cont(abs(value - q2), 0.5) AS mad FROM v JOIN s ON v."column" = s."column"
  GROUP BY v."column")
SELECT s."column", n_all AS rows, n AS count, n_all - n AS missing, zeros, negatives, round(mean, {k}) AS mean,
  round(total, 2) AS sum, round(lo, 4) AS min, round(hi, 4) AS max, round(hi - lo, 4) AS range, round(sd, 4) AS std,
  round(vs, 2) AS variance, round(sd / mean, 4) AS cv, round(sk, 4) AS skewness, round(ku, 4) AS kurtosis,
  round(q0, 4) AS p05, round(q1, 4) AS p25, round(q2, 4) AS median, round(q3, 4) AS p75, round(q4, 4) AS p95,
  dis AS "distinct", round(mad, 4) AS mad, round(q3 - q1, 4) AS iqr
FROM s JOIN m ON s."column" = m."column", t"""


def _rounded_profile(df, digits):
    return rounded(rounded(rounded(df, digits, ("mean",)), 2, ("sum", "variance")), 4, [
        c for c in df.columns if c not in ("mean", "sum", "variance")])


@query("profile_columns", _profile_sql("lineitem", LINES_LONG, 7))
def profile_columns(spark, d):
    return _rounded_profile(profile.profile_columns(lines(spark, d), MEASURES), 7)


@query("profile_columns_star", _profile_sql(f"({STAR_SQL})", long_sql(STAR_MEASURES, f"({STAR_SQL})"), 6))
def profile_columns_star(spark, d):
    return _rounded_profile(profile.profile_columns(materialise(star(spark, d), "star"), STAR_MEASURES), 6)


@query("profile_columns_approx", f"""
SELECT "column", count(*) AS count, count(*) FILTER (value = 0) AS zeros, round(avg(value), 7) AS mean, min(value) AS min,
  max(value) AS max, round(stddev_samp(value), 4) AS std, round(skewness(value), 4) AS skewness,
  round(kurtosis(value), 4) AS kurtosis, true AS median_close
FROM ({LINES_LONG}) GROUP BY "column" """)
def profile_columns_approx(spark, d):
    """Sketched profile: the exact statistics, and whether the sketched median has a rank near one half."""
    p = profile.profile_columns(lines(spark, d), MEASURES, exact=False)
    medians = {x["column"]: x["median"] for x in p.select("column", "median").collect()}
    ranks = lines(spark, d).agg(*[
        ((F.sum((F.col(c) < medians[c]).cast("long")) <= F.count(c) * 0.5005)
         & (F.sum((F.col(c) <= medians[c]).cast("long")) >= F.count(c) * 0.4995)).alias(c) for c in MEASURES])
    return rounded(rounded(p.join(ranks.unpivot([], MEASURES, "column", "median_close"), "column").select(
        "column", "count", "zeros", "mean", "min", "max", "std", "skewness", "kurtosis", "median_close"),
        7, ("mean",)), 4, ("std", "skewness", "kurtosis"))


@query("monotone", """
SELECT 'event_id' AS "column", bool_and(a >= 0) AS increasing, bool_and(a <= 0) AS decreasing
FROM (SELECT event_id - lag(event_id) OVER (ORDER BY ts) AS a FROM events)
UNION ALL SELECT 'value', bool_and(a >= 0), bool_and(a <= 0)
FROM (SELECT value - lag(value) OVER (ORDER BY ts) AS a FROM events)""")
def monotone(spark, d):
    return profile.monotone(table(spark, d, "events"), ["event_id", "value"], "ts")


@query("top_values", """
SELECT l_quantity AS value, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, value LIMIT 10""")
def top_values(spark, d):
    return profile.top_values(lines(spark, d), "l_quantity", 10)


@query("extremes", """
(SELECT 'smallest' AS side, l_extendedprice AS value, count(*) AS n FROM lineitem GROUP BY 2 ORDER BY 2 LIMIT 5)
UNION ALL
(SELECT 'largest', l_extendedprice, count(*) FROM lineitem GROUP BY 2 ORDER BY 2 DESC LIMIT 5)""")
def extremes(spark, d):
    return profile.extremes(lines(spark, d), "l_extendedprice", 5)


def _edges_sql(long, bins=None):
    count = str(bins) if bins else (
        "greatest(1, CAST(ceil((hi - lo) / least((hi - lo) / (log2(n) + 1), CASE WHEN iqr > 0 THEN "
        "2 * iqr / pow(n, 1.0 / 3.0) ELSE hi - lo END)) AS BIGINT))")
    return f"""SELECT "column", lo, hi, {count} AS k FROM (SELECT "column", min(value) lo, max(value) hi, count(*) n,
    quantile_cont(value, 0.75) - quantile_cont(value, 0.25) iqr FROM ({long}) GROUP BY "column")"""


@query("histogram", f"""
WITH v AS ({LINES_LONG}), e AS ({_edges_sql(LINES_LONG)}),
c AS (SELECT v."column", CAST(least(floor((value - lo) / ((hi - lo) / k)), k - 1) AS BIGINT) AS bin, count(*) AS n
  FROM v JOIN e ON v."column" = e."column" GROUP BY 1, 2),
g AS (SELECT "column", lo, (hi - lo) / k AS w, unnest(range(0, k)) AS bin FROM e)
SELECT g."column", g.bin, round(lo + g.bin * w, 6) AS "left", round(lo + (g.bin + 1) * w, 6) AS "right",
  coalesce(n, 0) AS n FROM g LEFT JOIN c ON g."column" = c."column" AND g.bin = c.bin""")
def histogram(spark, d):
    return rounded(profile.histogram(lines(spark, d), MEASURES, empty=True))


BY_LONG = long_sql(MEASURES, "lineitem", "l_returnflag")


@query("histogram_by_class", f"""
WITH v AS ({BY_LONG}), e AS ({_edges_sql(LINES_LONG, 12)})
SELECT l_returnflag, "column", bin, round(lo + bin * (hi - lo) / 12, 6) AS "left",
  round(lo + (bin + 1) * ((hi - lo) / 12), 6) AS "right", count(*) AS n
FROM (SELECT l_returnflag, v."column", lo, hi,
  CAST(least(floor((value - lo) / ((hi - lo) / 12)), 11) AS BIGINT) AS bin FROM v JOIN e ON v."column" = e."column")
GROUP BY l_returnflag, "column", bin, lo, hi""")
def histogram_by_class(spark, d):
    return rounded(profile.histogram(lines(spark, d), MEASURES, bins=12, by="l_returnflag"))


def _kde_sql(by=""):
    lead, using = (f"{by}, ", f"USING ({by})") if by else ("", "ON true")
    return f"""
WITH lim AS (SELECT min(l_quantity) lo, max(l_quantity) hi FROM lineitem),
s AS (SELECT {lead} count(*) n, stddev_samp(l_quantity) * pow(count(*), -0.2) h FROM lineitem {'GROUP BY ' + by if by else ''}),
c AS (SELECT {lead} l_quantity v, count(*) m FROM lineitem GROUP BY ALL),
g AS (SELECT lo + i * ((hi - lo) / 49) AS x FROM lim, (SELECT unnest(range(0, 50)) AS i))
SELECT {lead} round(x, 6) AS x, round(sum(m * exp(-0.5 * ((x - v) / h) * ((x - v) / h)) / (n * h)) / sqrt(2 * pi()), 8) AS density
FROM g, c JOIN s {using} GROUP BY {lead} x"""


@query("kde", _kde_sql())
def kde(spark, d):
    return rounded(rounded(profile.kde(lines(spark, d), "l_quantity", grid=50), 8), 6, ("x",))


@query("kde_by_class", _kde_sql("l_returnflag"))
def kde_by_class(spark, d):
    return rounded(rounded(profile.kde(lines(spark, d), "l_quantity", grid=50, by="l_returnflag"), 8), 6, ("x",))


@query("kde_continuous")
def kde_continuous(spark, d):
    """The operator's own grid over the continuous measure; kde has a column and a grid that its SQL can check."""
    return rounded(rounded(profile.kde(lines(spark, d), "l_extendedprice", tolerance=1e-7), 12, ("density",)), 6, ("x",))


@query("kde_continuous_by_class")
def kde_continuous_by_class(spark, d):
    return rounded(rounded(profile.kde(lines(spark, d), "l_extendedprice", by="l_returnflag", tolerance=1e-7), 12, ("density",)), 6, ("x",))


def _box_sql(long, by=""):
    lead = f"{by}, " if by else ""
    same = f'AND v.{by} = f.{by}' if by else ""
    pick = f"v.{by}, " if by else ""
    return f"""
WITH v AS ({long}), f AS (SELECT {lead} "column", quantile_cont(value, 0.25) q1, quantile_cont(value, 0.5) q2,
  quantile_cont(value, 0.75) q3 FROM v GROUP BY {lead} "column")
SELECT {pick} v."column", round(q1, 4) AS q1, round(q2, 4) AS median, round(q3, 4) AS q3,
  min(value) FILTER (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(value) FILTER (value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers
FROM v JOIN f ON v."column" = f."column" {same} GROUP BY {pick} v."column", q1, q2, q3"""


SPEND = """SELECT {lead} 'total_spend' AS "column", s AS value FROM (SELECT o_custkey, o_orderstatus,
  round(sum(o_totalprice), 2) AS s FROM orders GROUP BY 1, 2)"""


@query("box_stats", _box_sql(LINES_LONG))
def box_stats(spark, d):
    return rounded(profile.box_stats(lines(spark, d), MEASURES), 4)


@query("box_stats_by_class", _box_sql(SPEND.format(lead="o_orderstatus,"), "o_orderstatus"))
def box_stats_by_class(spark, d):
    spend = table(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(
        r(F.sum("o_totalprice"), 2).alias("total_spend"))
    return rounded(profile.box_stats(spend, ["total_spend"], by="o_orderstatus"), 4)


@query("flag_outliers", """
SELECT o_custkey, o_orderstatus, s AS total_spend, s < q1 - 1.5 * (q3 - q1) OR s > q3 + 1.5 * (q3 - q1)
  AS total_spend_outlier
FROM (SELECT o_custkey, o_orderstatus, round(sum(o_totalprice), 2) AS s FROM orders GROUP BY 1, 2)
JOIN (SELECT o_orderstatus, quantile_cont(s, 0.25) q1, quantile_cont(s, 0.75) q3 FROM
  (SELECT o_custkey, o_orderstatus, round(sum(o_totalprice), 2) AS s FROM orders GROUP BY 1, 2) GROUP BY 1)
USING (o_orderstatus)""")
def flag_outliers(spark, d):
    spend = table(spark, d, "orders").groupBy("o_custkey", "o_orderstatus").agg(
        r(F.sum("o_totalprice"), 2).alias("total_spend"))
    return profile.flag_outliers(spend, ["total_spend"], by="o_orderstatus")


@query("filter_outliers_std", """
SELECT o_orderkey, o_totalprice FROM orders, (SELECT avg(o_totalprice) m, stddev_samp(o_totalprice) s FROM orders)
WHERE o_totalprice BETWEEN m - 1.5 * s AND m + 1.5 * s""")
def filter_outliers_std(spark, d):
    return profile.flag_outliers(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"],
                                 rule="std", k=1.5, keep="inliers")


NULLED = """(SELECT l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax
FROM lineitem)"""


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def _full(half, cols):
    """Both triangles and the diagonal from the upper triangle."""
    diag = " UNION ALL ".join(f"SELECT '{c}' AS x, '{c}' AS y, 1.0::DOUBLE AS r" for c in cols)
    return f"WITH h AS ({half}) SELECT * FROM h UNION ALL SELECT y, x, r FROM h UNION ALL {diag}"


def _pearson_sql(cols, source):
    return " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM {source}"
                              for a, b in _pairs(cols))


@query("corr_pearson", _full(_pearson_sql(MEASURES, NULLED), MEASURES))
def corr_pearson(spark, d):
    frame = zero_to_null(lines(spark, d).select(*MEASURES), ["l_discount", "l_tax"])
    return rounded(corr.corr_matrix(frame, MEASURES))


@query("corr_lower", " UNION ALL ".join(
    f"SELECT '{b}' AS x, '{a}' AS y, round(corr({a}, {b}), 6) AS r FROM ({STAR_SQL})" for a, b in _pairs(STAR_MEASURES)))
def corr_lower(spark, d):
    return rounded(corr.corr_matrix(star(spark, d), STAR_MEASURES, lower=True))


def _spearman_one(a, b, source):
    return f"""SELECT '{a}' AS x, '{b}' AS y, round(corr(ra, rb), 6) AS r FROM (
  SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS ra,
         rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS rb
  FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


@query("corr_spearman", _full(" UNION ALL ".join(
    _spearman_one(a, b, NULLED) for a, b in _pairs(MEASURES)), MEASURES))
def corr_spearman(spark, d):
    frame = zero_to_null(lines(spark, d).select(*MEASURES), ["l_discount", "l_tax"])
    return rounded(corr.corr_matrix(frame, MEASURES, "spearman"))


def _kendall_one(a, b, source):
    return f"""SELECT '{a}' AS x, '{b}' AS y, round((SELECT sum(CAST(p.m AS DOUBLE) * q.m * sign(p.a - q.a) * sign(p.b - q.b)) / 2
  FROM (SELECT {a} AS a, {b} AS b, count(*) AS m FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2) p,
       (SELECT {a} AS a, {b} AS b, count(*) AS m FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2) q)
  / (sqrt((SELECT sum(m)::DOUBLE * (sum(m) - 1) / 2 - sum(m::DOUBLE * (m - 1) / 2) FROM (SELECT count(*) AS m FROM {source}
       WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {a})))
   * sqrt((SELECT sum(m)::DOUBLE * (sum(m) - 1) / 2 - sum(m::DOUBLE * (m - 1) / 2) FROM (SELECT count(*) AS m FROM {source}
       WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY {b})))), 6) AS r"""


GRID = ["l_quantity", "l_discount", "l_tax"]


@query("corr_kendall", _full(" UNION ALL ".join(_kendall_one(a, b, NULLED) for a, b in _pairs(GRID)), GRID))
def corr_kendall(spark, d):
    frame = zero_to_null(lines(spark, d).select(*GRID), ["l_discount", "l_tax"])
    return rounded(corr.corr_matrix(frame, GRID, "kendall"))


@query("corr_kendall_measures")
def corr_kendall_measures(spark, d):
    """Every pair of the measures, the continuous l_extendedprice too; corr_kendall has the pairs that its quadratic SQL can check."""
    frame = zero_to_null(lines(spark, d).select(*MEASURES), ["l_discount", "l_tax"])
    return rounded(corr.corr_matrix(frame, MEASURES, "kendall"))


def _chi_one(a, b, k=10):
    def binned(c):
        return f"CAST(least(floor(({c} - lo_{c}) / ((hi_{c} - lo_{c}) / {k})), {k - 1}) AS BIGINT)"

    return f"""SELECT '{a}' AS x, '{b}' AS y, CAST(n AS BIGINT) AS n, round(chi2, 4) AS chi2,
  round(sqrt(chi2 / (n * (least(kx, ky) - 1))), 6) AS cramers_v
FROM (SELECT max(n) AS n, max(kx) AS kx, max(ky) AS ky, sum(pow(coalesce(m, 0) - e, 2) / e) AS chi2 FROM (
  SELECT x.x, y.y, tx * ty * 1.0 / n AS e, m, n, kx, ky FROM
    (SELECT {binned(a)} AS x, count(*) AS tx FROM lineitem, lim GROUP BY 1) x,
    (SELECT {binned(b)} AS y, count(*) AS ty FROM lineitem, lim GROUP BY 1) y
    LEFT JOIN (SELECT {binned(a)} AS x, {binned(b)} AS y, count(*) AS m FROM lineitem, lim GROUP BY 1, 2) c
      ON c.x = x.x AND c.y = y.y,
    (SELECT count(*) AS n, count(DISTINCT {binned(a)}) AS kx, count(DISTINCT {binned(b)}) AS ky FROM lineitem, lim)))"""


@query("cramers_v", "WITH lim AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in MEASURES)
       + " FROM lineitem) " + " UNION ALL ".join(_chi_one(a, b) for a, b in _pairs(MEASURES)))
def cramers_v(spark, d):
    return rounded(rounded(corr.contingency_tests(lines(spark, d), MEASURES, 10), 4, ("chi2",)))


@query("missing_report", f"""
SELECT unnest(['l_discount', 'l_tax', 'l_quantity']) AS "column", unnest([a, b, c]) AS missing,
  unnest([round(a * 100.0 / n, 6), round(b * 100.0 / n, 6), round(c * 100.0 / n, 6)]) AS missing_pct
FROM (SELECT count(*) n, count(*) FILTER (l_discount IS NULL) a, count(*) FILTER (l_tax IS NULL) b,
  count(*) FILTER (l_quantity IS NULL) c FROM {NULLED})""")
def missing_report(spark, d):
    frame = zero_to_null(lines(spark, d), ["l_discount", "l_tax"])
    return rounded(profile.missing_report(frame, ["l_discount", "l_tax", "l_quantity"]))


@query("nullity_corr", _full(f"""SELECT 'l_discount' AS x, 'l_tax' AS y, round(corr(CASE WHEN l_discount IS NULL
THEN 1.0 ELSE 0.0 END, CASE WHEN l_tax IS NULL THEN 1.0 ELSE 0.0 END), 6) AS r FROM {NULLED}""", ["l_discount", "l_tax"]))
def nullity_corr(spark, d):
    return rounded(corr.nullity_corr(zero_to_null(lines(spark, d), ["l_discount", "l_tax"]), ["l_discount", "l_tax"]))


@query("joint_hist", """
SELECT l_returnflag, CAST(least(floor((l_quantity - a) / ((b - a) / 8)), 7) AS BIGINT) AS bin_x,
  CAST(least(floor((l_extendedprice - c) / ((e - c) / 8)), 7) AS BIGINT) AS bin_y, count(*) AS n
FROM lineitem, (SELECT min(l_quantity) a, max(l_quantity) b, min(l_extendedprice) c, max(l_extendedprice) e FROM lineitem)
GROUP BY 1, 2, 3""")
def joint_hist(spark, d):
    return profile.joint_hist(lines(spark, d), "l_quantity", "l_extendedprice", 8, by="l_returnflag")


@query("sample_points", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|3'), 1, 8) AS BIGINT) < CAST(0.1 * 4294967296 AS BIGINT)""")
def sample_points(spark, d):
    return profile.sample_points(table(spark, d, "orders"), "o_orderkey", ["o_totalprice"], 0.1, seed=3)


@query("group_profile", """
SELECT n_name, count(*) AS n, round(avg(c_acctbal), 8) AS c_acctbal_mean FROM customer
JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def group_profile(spark, d):
    nation = table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return rounded(profile.group_profile(table(spark, d, "customer").join(nation, "c_nationkey"), "n_name", ["c_acctbal"]), 8)


SKEWED = "(SELECT o_custkey, exp(o_totalprice / 100000) AS e, o_totalprice FROM orders)"


@query("suggest_imputation", f"""
SELECT "column", round(s, 4) AS skewness, CASE WHEN abs(s) > 1 THEN 'median' ELSE 'mean' END AS strategy FROM (
  SELECT 'e' AS "column", skewness(e) AS s FROM {SKEWED} UNION ALL SELECT 'o_totalprice', skewness(o_totalprice) FROM {SKEWED})""")
def suggest_imputation(spark, d):
    frame = table(spark, d, "orders").select(F.exp(F.col("o_totalprice") / 100000).alias("e"), "o_totalprice")
    return rounded(profile.suggest_imputation(profile.profile_columns(frame, ["e", "o_totalprice"], exact=False)), 4)


@query("compare_profiles", f"""
SELECT "column", a.n AS count_a, b.n AS count_b, b.n - a.n AS count_diff, round(a.m, 7) AS mean_a,
  round(b.m, 7) AS mean_b, round(b.m - a.m, 7) AS mean_diff
FROM (SELECT "column", count(*) n, avg(value) m FROM ({LINES_LONG}) GROUP BY 1) a
JOIN (SELECT "column", count(*) n, avg(value) m FROM ({long_sql(MEASURES, NULLED)}) GROUP BY 1) b USING ("column")""")
def compare_profiles(spark, d):
    before = lines(spark, d).select(*MEASURES)
    after = zero_to_null(before, ["l_discount", "l_tax"])
    return rounded(profile.compare_profiles(profile.profile_columns(before, MEASURES, exact=False),
                                            profile.profile_columns(after, MEASURES, exact=False), ["count", "mean"]), 7)


@query("alerts", f"""
WITH f AS (SELECT o_orderkey, o_totalprice, o_totalprice * 2 + o_custkey AS twin, 1 AS one,
  CASE WHEN o_orderstatus = 'O' THEN 0 ELSE o_custkey + 1 END AS z,
  CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS gaps FROM orders)
SELECT 'one' AS "column", 'constant' AS alert, 1.0::DOUBLE AS value
UNION ALL SELECT 'o_orderkey', 'unique', CAST(count(*) AS DOUBLE) FROM f
UNION ALL SELECT 'z', 'zeros', round(count(*) FILTER (z = 0) * 1.0 / count(*), 6) FROM f
UNION ALL SELECT 'gaps', 'missing', round(count(*) FILTER (gaps IS NULL) * 1.0 / count(*), 6) FROM f
UNION ALL SELECT 'o_totalprice', 'high_correlation', round(abs(corr(o_totalprice, twin)), 6) FROM f
UNION ALL SELECT 'twin', 'high_correlation', round(abs(corr(o_totalprice, twin)), 6) FROM f""")
def alerts(spark, d):
    o = table(spark, d, "orders")
    frame = o.select(
        "o_orderkey", "o_totalprice", (F.col("o_totalprice") * 2 + F.col("o_custkey")).alias("twin"), F.lit(1).alias("one"),
        F.when(F.col("o_orderstatus") == "O", F.lit(0)).otherwise(F.col("o_custkey") + 1).alias("z"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("gaps"))
    prof = profile.profile_columns(frame, ["o_orderkey", "one", "z", "gaps"])
    matrix = corr.corr_matrix(frame, ["o_totalprice", "twin", "o_orderkey"])
    return rounded(profile.alerts(prof, matrix, high=0.9))


@query("full_profile", f"""
WITH p AS (SELECT "column", count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std,
  round(skewness(value), 4) AS skewness, min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.05), 4) AS p05,
  round(quantile_cont(value, 0.95), 4) AS p95 FROM ({LINES_LONG}) GROUP BY 1)
SELECT * FROM p JOIN ({_box_sql(LINES_LONG)}) b USING ("column")""")
def full_profile(spark, d):
    """Statistics and box statistics of one full profile: three scans for all of its parts."""
    full = profile_state.full_profile(lines(spark, d), MEASURES)
    stats = full.statistics.select("column", "count", r(F.col("mean")).alias("mean"), r(F.col("std")).alias("std"),
                                   r(F.col("skewness"), 4).alias("skewness"), "min", "max",
                                   r(F.col("p05"), 4).alias("p05"), r(F.col("p95"), 4).alias("p95"))
    return stats.join(rounded(full.box, 4), "column")


@query("full_profile_histogram", f"""
WITH v AS ({LINES_LONG}), e AS ({_edges_sql(LINES_LONG)}),
c AS (SELECT v."column", lo, (hi - lo) / k AS w, CAST(least(floor((value - lo) / ((hi - lo) / k)), k - 1) AS BIGINT) AS bin, count(*) AS n
  FROM v JOIN e ON v."column" = e."column" GROUP BY 1, 2, 3, 4)
SELECT "column", bin, round(lo + bin * w, 6) AS "left", round(lo + (bin + 1) * w, 6) AS "right", n FROM c""")
def full_profile_histogram(spark, d):
    return rounded(profile_state.full_profile(lines(spark, d), MEASURES).histogram)


@query("full_profile_corr", " UNION ALL ".join(
    f"""SELECT '{a}' AS "column", '{b}' AS other, round(corr({a}, {b}), 6) AS corr FROM lineitem""" for a, b in _pairs(MEASURES)))
def full_profile_corr(spark, d):
    return rounded(profile_state.full_profile(lines(spark, d), MEASURES).correlation)


@query("merged_profile", f"""
SELECT "column", count(*) AS count, count(*) FILTER (value = 0) AS zeros, round(avg(value), 7) AS mean, min(value) AS min,
  max(value) AS max, round(stddev_samp(value), 4) AS std, round(skewness(value), 4) AS skewness,
  round(kurtosis(value), 4) AS kurtosis, true AS median_close, true AS distinct_close
FROM ({LINES_LONG}) GROUP BY "column" """)
def merged_profile(spark, d):
    """States of the rows of each flag and status, merged: exact parts as they are, sketched ones by what must hold."""
    states = profile_state.profile_states(lines(spark, d), MEASURES, ["l_returnflag", "l_linestatus"])
    p = profile_state.statistics(profile_state.merge_states(materialise(states, "states")))
    held = {x["column"]: (x["median"], x["distinct"]) for x in p.select("column", "median", "distinct").collect()}
    close = lines(spark, d).agg(*[F.struct(
        ((F.sum((F.col(c) < held[c][0]).cast("long")) <= F.count(c) * 0.502)
         & (F.sum((F.col(c) <= held[c][0]).cast("long")) >= F.count(c) * 0.498)).alias("median_close"),
        (F.abs(F.count_distinct(c) - held[c][1]) <= F.count_distinct(c) * 0.1 + 1).alias("distinct_close")).alias(c) for c in MEASURES])
    close = close.unpivot([], MEASURES, "column", "c").select("column", "c.*")
    return rounded(rounded(p.join(close, "column").select(
        "column", "count", "zeros", "mean", "min", "max", "std", "skewness", "kurtosis", "median_close", "distinct_close"),
        7, ("mean",)), 4, ("std", "skewness", "kurtosis"))


PHIK_COLS = ["l_quantity", "l_discount", "l_returnflag", "l_linestatus"]
_TENTHS = ", ".join(f"{i / 10}" for i in range(1, 10))


@query("phik_tables", "WITH e AS (SELECT " + ", ".join(
    f"list_distinct(quantile_cont({c}::DOUBLE, [{_TENTHS}])) AS q_{c}" for c in PHIK_COLS[:2]) + " FROM lineitem), l AS (SELECT " + ", ".join(
    [f"CAST(len(list_filter(q_{c}, lambda q: {c} > q)) AS VARCHAR) AS {c}" for c in PHIK_COLS[:2]] + PHIK_COLS[2:]) + " FROM lineitem, e) "
    + " UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, {a} AS a, {b} AS b, count(*) AS m FROM l GROUP BY {a}, {b}" for a, b in _pairs(PHIK_COLS)))
def phik_tables(spark, d):
    """The contingency tables that phi_k is solved from."""
    return phik.cells_of_pairs(lines(spark, d), PHIK_COLS)


@query("phik_matrix")
def phik_matrix(spark, d):
    """phi_k of all pairs of numeric and text columns; a test compares known values."""
    return rounded(phik.phik_matrix(lines(spark, d), [*MEASURES, "l_returnflag", "l_linestatus"]))
