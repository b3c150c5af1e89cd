"""Keys, projections and scalar clean-up."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.functions import people
from tabulon.functions.columns import hash_int, hash_text, pick
from tabulon.plans.ordered import dense_ids


def add_key(df: DataFrame, name: str = "Id", order_by=None, start: int = 0) -> DataFrame:
    """A unique 64-bit key.

    Without ``order_by``: unique, increasing in a partition, with gaps, dependent on the layout.
    With ``order_by``: consecutive numbers in that order.
    """
    if order_by is None:
        return df.withColumn(name, F.monotonically_increasing_id())
    return dense_ids(df, [order_by] if isinstance(order_by, str) else list(order_by), name, start)


def add_fake_person(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """FirstName, LastName, Address, Email per row: a function of key and seed only."""
    def salt(what: str):
        return F.lit(f"{what}{seed}")

    first = pick(people.FIRST_NAMES, key, salt("first"))
    last = pick(people.LAST_NAMES, key, salt("last"))
    number = F.pmod(hash_int(hash_text(key, salt("number"))), F.lit(900)) + 100
    zip_code = F.lpad(F.pmod(hash_int(hash_text(key, salt("zip"))), F.lit(100000)).cast("string"), 5, "0")
    address = F.concat(
        number.cast("string"), F.lit(" "), pick(people.STREETS, key, salt("street")), F.lit("\n"),
        pick(people.CITIES, key, salt("city")), F.lit(", "),
        pick(people.STATES, key, salt("state")), F.lit(" "), zip_code)
    email = F.concat(F.lower(first), F.lit("."), F.lower(last), F.col(key).cast("string"), F.lit("@"),
                     pick(people.MAIL_HOSTS, key, salt("host")))
    return df.withColumns({"FirstName": first, "LastName": last, "Address": address, "Email": email})


def split_entities(df: DataFrame, key: str, entities: dict[str, list[str]]) -> dict[str, DataFrame]:
    """One wide frame to several entity tables that share the key."""
    return {name: df.select(key, *[c for c in cols if c != key]) for name, cols in entities.items()}


def drop_pii(df: DataFrame, cols) -> DataFrame:
    """Drop the named columns; names that are not there are ignored."""
    return df.drop(*cols)


def insert_col(df: DataFrame, name: str, at: int, value=None) -> DataFrame:
    """Put a column after the first ``at`` columns; ``value`` defaults to the existing column."""
    others = [c for c in df.columns if c != name]
    new = (F.col(name) if value is None else value).alias(name)
    return df.select(*others[:at], new, *others[at:])


def parse_address(df: DataFrame, col: str, state: bool = True, zip: bool = False) -> DataFrame:
    """State and zip as the last but one and the last word of the address (split on one space)."""
    words = F.split(F.col(col), " ")
    new = {}
    if state:
        new["State"] = F.try_element_at(words, F.lit(-2))
    if zip:
        new["Zip"] = F.try_element_at(words, F.lit(-1))
    return df.withColumns(new) if new else df


def zero_to_null(df: DataFrame, cols) -> DataFrame:
    """Zero means missing: 0 to NULL, everything else to double, in one projection."""
    cols = set(cols)
    return df.select(*[
        F.when(F.col(c) != 0, F.col(c).cast("double")).alias(c) if c in cols else F.col(c)
        for c in df.columns])


def coerce_numeric(df: DataFrame, cols) -> DataFrame:
    """Text to double; text that is not a number becomes NULL."""
    cols = set(cols)
    return df.select(*[
        F.col(c).try_cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def infer_contract(df: DataFrame) -> str:
    """Names and types of the frame as JSON."""
    return json.dumps([[f.name, f.dataType.simpleString()] for f in df.schema.fields])


def check_contract(df: DataFrame, contract: str) -> DataFrame:
    """One row per contract column: missing column, rows that fail the cast, rows with NULL."""
    spec = json.loads(contract)
    have = set(df.columns)
    totals = df.agg(F.count(F.lit(1)).alias("_rows"), *[
        F.struct(
            F.sum((F.col(c).try_cast(t).isNull() & F.col(c).isNotNull()).cast("long")).alias("bad"),
            F.sum(F.col(c).isNull().cast("long")).alias("nulls")).alias(f"c{i}")
        for i, (c, t) in enumerate(spec) if c in have])
    rows = []
    for i, (c, t) in enumerate(spec):
        present = c in have
        rows.append(F.struct(
            F.lit(c).alias("column"), F.lit(t).alias("type"), F.lit(not present).alias("missing"),
            F.coalesce(F.col(f"c{i}.bad"), F.lit(0)).cast("long").alias("cast_failures") if present
            else F.lit(None).cast("long").alias("cast_failures"),
            F.coalesce(F.col(f"c{i}.nulls"), F.lit(0)).cast("long").alias("nulls") if present
            else F.lit(None).cast("long").alias("nulls")))
    return totals.select(F.inline(F.array(*rows)))


def schema_of(contract: str) -> T.StructType:
    """The contract as a Spark schema."""
    return T._parse_datatype_string(", ".join(f"`{n}` {t}" for n, t in json.loads(contract)))
