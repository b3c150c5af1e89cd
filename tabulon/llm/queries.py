"""Registered queries of the text operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm import (alignment, decontaminate, exact_dedup, line_dedup, near_dedup, ordinal, packing, repeats,
                         rules, runs, secrets, toxicity, warc)
from tabulon.plans.shared import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# words [^\x20\x09-\x0D]+ of a text in DuckDB
_WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"
_LOWER = ("translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


@_query("op1_ordinal_grades")
def ordinal_grades(spark, d):
    docs, labels = _table(spark, d, "documents"), _table(spark, d, "labels")
    # three grades: junk, toxic prose, prose
    ratings = labels.select("doc_id", F.expr("quality * (2 - toxic)").alias("grade"))
    return ordinal.grade(docs, ordinal.fit_ordinal(docs, ratings))


@_query("op2_decision_list")
def decision_list(spark, d):
    return rules.judge(_table(spark, d, "documents"), _table(spark, d, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@_query("op3_line_similarity", """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, p, ls[p + 1] AS t FROM (SELECT doc_id, ls, unnest(range(0, len(ls))) AS p FROM d)),
s AS (SELECT doc_id, p, t, list_sort(list_distinct(regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+'))) AS g FROM l),
c AS (SELECT g, len(g) AS n, min((doc_id, p)) AS f FROM s WHERE len(g) > 0 GROUP BY g),
tok AS (SELECT f, n, unnest(g) AS x FROM c),
fr AS (SELECT x, count(*) AS k FROM tok GROUP BY x),
o AS (SELECT f, n, tok.x, row_number() OVER (PARTITION BY f ORDER BY k, tok.x) AS r FROM tok JOIN fr USING (x)),
pre AS (SELECT f, n, x FROM o WHERE r <= n - ceil(n * 80 / 100.0) + 1),
cand AS (SELECT DISTINCT a.f AS a, b.f AS b FROM pre a JOIN pre b
  ON a.x = b.x AND a.f < b.f AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n),
late AS (SELECT DISTINCT b.f AS f FROM cand JOIN c a ON a.f = cand.a JOIN c b ON b.f = cand.b
  WHERE 100 * len(list_intersect(a.g, b.g)) >= 80 * (a.n + b.n - len(list_intersect(a.g, b.g)))),
gone AS (SELECT s.doc_id, s.p, s.t, len(s.g) > 0 AND ((s.doc_id, s.p) <> c.f OR late.f IS NOT NULL) AS out
  FROM s LEFT JOIN c ON s.g = c.g LEFT JOIN late ON late.f = c.f),
kept AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE out) AS n_removed,
  string_agg(t, chr(10) ORDER BY p) FILTER (WHERE NOT coalesce(out, false)) AS k FROM gone GROUP BY doc_id)
SELECT documents.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256 FROM documents LEFT JOIN kept USING (doc_id)""")
def line_similarity(spark, d):
    return line_dedup.drop_later_lines(_table(spark, d, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@_query("op4_relative_parsing", f"""
WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(0, greatest(len(w) - 49, 0))) AS p, w FROM d),
h AS (SELECT doc_id, p, array_to_string(w[p + 1:p + 50], ' ') AS k FROM win),
f AS (SELECT k, min(doc_id) AS m FROM h GROUP BY k HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT h.doc_id, list(p) AS ps FROM h JOIN f USING (k) WHERE m < h.doc_id GROUP BY h.doc_id),
gone AS (SELECT doc_id, list_distinct(flatten(list_transform(ps, lambda x: range(x, x + 50)))) AS g FROM hit),
kept AS (SELECT d.doc_id, len(w) AS n, coalesce(len(g), 0) AS r,
  CASE WHEN g IS NULL THEN w
       ELSE list_transform(list_filter(list_zip(w, range(0, len(w))), lambda x: NOT list_contains(g, x[2])), lambda x: x[1])
  END AS k FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(r AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(k, ' '), '')) AS kept_sha256 FROM kept""")
def relative_parsing(spark, d):
    return repeats.cut_repeats(_table(spark, d, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


@_query("op5_inferred_formats")
def inferred_formats(spark, d):
    found = secrets.scan(_table(spark, d, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(secrets.joined("base"), 256).alias("base_sha256"),
                        secrets.joined("spans").alias("spans"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def packed(docs: DataFrame, **bounds: int) -> DataFrame:
    """The pieces of ``packing.pack`` with the CRC-32 of their ids in place of the ids."""
    return packing.pack(docs, tokenizer_path(), **bounds).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier",
        "step")


@_query("op6_tiered_packing")
def tiered_packing(spark, d):
    return packed(_table(spark, d, "documents"))


@_query("op7_chunked_records")
def chunked_records(spark, d):
    path = scratch(spark, "archive")
    warc.write_archive(_table(spark, d, "pages"), path)
    return warc.read_archive(spark, path)


@_query("op8_coordinate_join", f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER.format('text'))} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(0, len(w) - 3), lambda i: array_to_string(w[i + 1:i + 4], ' ')) END) AS g FROM d),
r AS (SELECT g, min(doc_id) AS id, len(g) AS n FROM (SELECT doc_id, list_sort(g) AS g FROM s WHERE len(g) > 0)
  GROUP BY g),
e AS (SELECT id, n, unnest(g) AS x FROM r),
c AS (SELECT a.id AS a, b.id AS b FROM e a JOIN e b ON a.x = b.x AND a.id < b.id
  AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM c UNION ALL SELECT b, a FROM c UNION ALL SELECT id, id FROM r),
reach(a, b) AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
top AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(top.root, s.doc_id) AS component_id,
       coalesce(top.root, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN r ON list_sort(s.g) = r.g LEFT JOIN top ON top.id = r.id""")
def coordinate_join(spark, d):
    return near_dedup.near_duplicates(_table(spark, d, "documents"), k=4).select(
        "doc_id", "n_shingles", "component_id", "kept")


@_query("op9_lexicon_automata")
def lexicon_automata(spark, d):
    return toxicity.score(_table(spark, d, "documents"), _table(spark, d, "labels"))


_ITEM_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@_query("op10_window_containment", f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS.format(_LOWER.format('text'))} AS w FROM documents),
i AS (SELECT item_id, {_ITEM_WORDS.format(_LOWER.format('text'))} AS w FROM benchmark),
j AS (SELECT item_id, w, least(13, len(w)) AS z FROM i WHERE len(w) > 0 AND item_id IS NOT NULL),
iw AS (SELECT item_id, z, array_to_string(w[p + 1:p + z], ' ') AS k
  FROM (SELECT item_id, w, z, unnest(range(0, len(w) - z + 1)) AS p FROM j)),
dw AS (SELECT doc_id, p, z, array_to_string(w[p + 1:p + z], ' ') AS k FROM (
  SELECT doc_id, w, z, unnest(range(0, greatest(len(w) - z + 1, 0))) AS p FROM d, (SELECT DISTINCT z FROM iw))),
m AS (SELECT DISTINCT doc_id, p, z, item_id FROM dw JOIN iw USING (z, k)),
h AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + z)) AS q FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS s
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
  sha256(coalesce(t.s, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""")
def window_containment(spark, d):
    found = decontaminate.contamination(_table(spark, d, "documents"), _table(spark, d, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@_query("op11_token_spans")
def token_spans(spark, d):
    return alignment.link_statistics(
        _table(spark, d, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@_query("op12_content_sort", """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""")
def content_sort(spark, d):
    return exact_dedup.exact_copies(_table(spark, d, "documents"), keep="largest")


# CRC-32 of the id in decimal, bit by bit
_ID_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one document of ten, by the hash of its id, the words from some place on repeat with a period."""
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, F.array_remove(F.split("text", "[\\x20\\x09-\\x0D]+"), "")))
    rows = rows.withColumns({"n": F.size("w"), "g": F.expr("h div 10")})
    rows = rows.withColumn("a", F.expr("if(n > 0, g % n, 0)"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("array_join(transform(w, (x, i) -> if(i < a, x, get(w, int(a + (i - a) % p)))), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text"))


@_query("op13_minimizer_runs", f"""
WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w, {_ID_CRC} AS h FROM documents),
e AS (SELECT *, h // 10 AS g, len(w) AS n FROM d),
f AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM e),
t AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_concat(w[1:a], list_transform(range(a, n),
  lambda i: w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1])) END AS w FROM f),
x AS (SELECT doc_id, n, unnest(range(0, n)) AS i, unnest(w) AS v FROM t),
s AS (SELECT p.doc_id, q.i - p.i AS lag, p.i FROM x p JOIN x q ON p.doc_id = q.doc_id AND p.v = q.v AND q.i > p.i AND 2 * (q.i - p.i) <= p.n),
k AS (SELECT doc_id, lag, min(i) AS s, max(i) + 1 + lag AS e
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM s) GROUP BY doc_id, lag, island
  HAVING count(*) + lag >= greatest(12, 2 * lag)),
r AS (SELECT doc_id, s, e, min(lag) AS q FROM k GROUP BY doc_id, s, e),
o AS (SELECT doc_id, count(*) AS n_runs, max((e - s, -s, -q)) AS b,
  string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM r GROUP BY doc_id),
z AS (SELECT doc_id, string_agg(v, ' ' ORDER BY i) AS kept FROM x WHERE NOT EXISTS (
  SELECT 1 FROM r WHERE r.doc_id = x.doc_id AND x.i >= r.s + r.q AND x.i < r.e) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -b[2] AS start, b[1] AS length, -b[3] AS period, 1000 * b[1] // -b[3] AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM documents LEFT JOIN o USING (doc_id) LEFT JOIN z USING (doc_id)""")
def minimizer_runs(spark, d):
    found = runs.periodic_runs(with_planted_runs(_table(spark, d, "documents")))
    # the greatest length, then the smallest start, then the smallest period
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as s, -r.period as p)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
