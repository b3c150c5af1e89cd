"""Sources, sinks, keys and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulon.functions import people
from tabulon.operators import shape
from tabulon.operators.lookup import assemble
from tabulon.plans.shared import scratch
from tabulon.sources.tables import VersionedTable, read_csv, read_table, snapshot, write_csv
from workload.registry import query, table
from workload.star import STAR_SQL, star


def _words(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _hash(salt, key="c_custkey"):
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{salt}7'), 1, 8) AS BIGINT)"


def _pick(words, salt):
    return f"{_words(words)}[CAST({_hash(salt)} % {len(words)} AS INTEGER) + 1]"


PERSON_SQL = f"""
SELECT c_custkey, "FirstName", "LastName",
       CAST({_hash('number')} % 900 + 100 AS VARCHAR) || ' ' || {_pick(people.STREETS, 'street')} || chr(10)
       || {_pick(people.CITIES, 'city')} || ', ' || {_pick(people.STATES, 'state')} || ' '
       || lpad(CAST({_hash('zip')} % 100000 AS VARCHAR), 5, '0') AS "Address",
       lower("FirstName") || '.' || lower("LastName") || CAST(c_custkey AS VARCHAR) || '@'
       || {_pick(people.MAIL_HOSTS, 'host')} AS "Email"
FROM (SELECT *, {_pick(people.FIRST_NAMES, 'first')} AS "FirstName", {_pick(people.LAST_NAMES, 'last')} AS "LastName"
      FROM customer)
"""


def people_of(spark, d):
    return shape.add_fake_person(table(spark, d, "customer"), "c_custkey", seed=7)


@query("csv_round_trip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark, d):
    source = table(spark, d, "customer")
    path = scratch(spark, "csv")
    write_csv(source, path)
    return read_csv(spark, path, source.schema)


@query("csv_inferred", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_inferred(spark, d):
    path = scratch(spark, "csv")
    write_csv(table(spark, d, "customer"), path)
    return read_csv(spark, path).select(
        F.col("c_custkey").cast("long").alias("c_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment")


@query("read_table", "SELECT * FROM nation")
def read_by_name(spark, d):
    return read_table(spark, f"{d}/nation.parquet")


@query("table_overwrite", """
SELECT p_partkey, p_brand, p_size + 1 AS p_size, p_retailprice FROM part""")
def table_overwrite(spark, d):
    kept = VersionedTable(spark, scratch(spark, "table"))
    kept.write(table(spark, d, "part").select("p_partkey", "p_brand", "p_size", "p_retailprice"))
    kept.write(kept.read().withColumn("p_size", F.col("p_size") + 1))  # a table overwritten from itself
    return kept.read()


@query("snapshot", f"""
SELECT "Id", n_orders, total_spend FROM (SELECT "Id", n_orders, round(total_spend, 2) AS total_spend
FROM ({STAR_SQL})) ORDER BY "Id" LIMIT 50""")
def snapshot_query(spark, d):
    top = snapshot(star(spark, d), ["Id", "n_orders", "total_spend"], 50, "Id")
    return top.withColumn("total_spend", F.round("total_spend", 2))


@query("surrogate_key", """
SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS "Id",
       l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem""")
def surrogate_key(spark, d):
    lines = table(spark, d, "lineitem")
    return shape.add_key(lines, "Id", order_by=[
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]).select(
        "Id", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("surrogate_key_fast", "SELECT count(*) AS n, count(*) AS distinct_ids FROM lineitem")
def surrogate_key_fast(spark, d):
    return shape.add_key(table(spark, d, "lineitem"), "Id").agg(
        F.count("Id").alias("n"), F.count_distinct("Id").alias("distinct_ids"))


@query("fake_person", PERSON_SQL)
def fake_person(spark, d):
    return people_of(spark, d).select("c_custkey", "FirstName", "LastName", "Address", "Email")


@query("split_entities", f"""
SELECT 'contact' AS entity, c_custkey, "FirstName" AS a, "Email" AS b FROM ({PERSON_SQL})
UNION ALL SELECT 'account', c_custkey, CAST(c_nationkey AS VARCHAR), c_mktsegment FROM customer""")
def split_entities(spark, d):
    parts = shape.split_entities(people_of(spark, d), "c_custkey", {
        "contact": ["FirstName", "Email"], "account": ["c_nationkey", "c_mktsegment"]})
    contact = parts["contact"].select(F.lit("contact").alias("entity"), "c_custkey",
                                      F.col("FirstName").alias("a"), F.col("Email").alias("b"))
    account = parts["account"].select(F.lit("account").alias("entity"), "c_custkey",
                                      F.col("c_nationkey").cast("string").alias("a"),
                                      F.col("c_mktsegment").alias("b"))
    return contact.unionByName(account)


@query("split_assemble", f"""
SELECT p.c_custkey, "FirstName", "Email", c_nationkey, c_mktsegment, c_acctbal
FROM ({PERSON_SQL}) p JOIN customer c ON p.c_custkey = c.c_custkey""")
def split_assemble(spark, d):
    parts = shape.split_entities(people_of(spark, d), "c_custkey", {
        "contact": ["FirstName", "Email"], "account": ["c_nationkey", "c_mktsegment"], "money": ["c_acctbal"]})
    return assemble(parts["contact"], [parts["account"], parts["money"]], "c_custkey",
                    ["c_custkey", "FirstName", "Email", "c_nationkey", "c_mktsegment", "c_acctbal"])


@query("drop_pii", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def drop_pii(spark, d):
    return shape.drop_pii(people_of(spark, d), ["c_name", "FirstName", "LastName", "Address", "Email", "absent"])


@query("parse_address", f"""
SELECT c_custkey, "State", "Zip" FROM (SELECT c_custkey, string_split("Address", ' ')[-2] AS "State",
       string_split("Address", ' ')[-1] AS "Zip" FROM ({PERSON_SQL}))""")
def parse_address(spark, d):
    return shape.parse_address(people_of(spark, d), "Address", state=True, zip=True).select(
        "c_custkey", "State", "Zip")


@query("insert_col", f"""
SELECT c_custkey, c_name, string_split("Address", ' ')[-2] AS "State", c_nationkey, c_acctbal, c_mktsegment
FROM ({PERSON_SQL}) JOIN customer USING (c_custkey)""")
def insert_col(spark, d):
    with_state = shape.parse_address(people_of(spark, d), "Address")
    clean = shape.drop_pii(with_state, ["FirstName", "LastName", "Address", "Email"])
    return shape.insert_col(clean, "State", 2)


@query("zero_to_null", """
SELECT l_orderkey, l_linenumber, l_quantity, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax
FROM lineitem""")
def zero_to_null(spark, d):
    return shape.zero_to_null(table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"), ["l_discount", "l_tax"])


@query("coerce_numeric", """
SELECT p_partkey, try_cast(CASE WHEN p_size % 3 = 0 THEN p_type ELSE CAST(p_size AS VARCHAR) END AS DOUBLE) AS v
FROM part""")
def coerce_numeric(spark, d):
    mixed = table(spark, d, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, F.col("p_type")).otherwise(
        F.col("p_size").cast("string")).alias("v"))
    return shape.coerce_numeric(mixed, ["v"])


@query("check_contract", """
SELECT 'p_partkey' AS "column", 'bigint' AS type, false AS missing, CAST(0 AS BIGINT) AS cast_failures,
       CAST(0 AS BIGINT) AS nulls
UNION ALL SELECT 'p_size', 'int', false, count(*) FILTER (p_size % 3 = 0), count(*) FILTER (p_size % 5 = 0 AND p_size % 3 <> 0)
FROM part
UNION ALL SELECT 'p_retailprice', 'double', true, NULL, NULL""")
def check_contract(spark, d):
    part = table(spark, d, "part")
    contract = shape.infer_contract(part.select("p_partkey", "p_size", "p_retailprice"))
    arrived = part.select("p_partkey", F.when(F.col("p_size") % 3 == 0, F.col("p_type")).when(
        F.col("p_size") % 5 != 0, F.col("p_size").cast("string")).alias("p_size"))
    return shape.check_contract(arrived, contract)
