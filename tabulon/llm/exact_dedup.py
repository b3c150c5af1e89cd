"""Exact dedup by content sort: texts range-partitioned by sampled splitters, sorted, neighbours compared in full."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabulon.llm.words import free_name
from tabulon.plans.shared import broadcast_if_small, materialise

# Splitters are cut to this many bytes: they only place rows, the sort and the comparison read whole texts.
SPLITTER_BYTES = 48
# One text's rows are sorted in parts of about this share of a partition.
PARTS_OF_A_PARTITION = 4
# Broadcast: fewer than twice as many pairs of numbers.
MOST_SHARES = 1 << 19
_KEY = ("_head", "_hash", "_part")


def _shares(df: DataFrame) -> int:
    return min(PARTS_OF_A_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_SHARES)


def _with_parts(rows: DataFrame) -> DataFrame:
    """Rows with ``_part``: 0 but for texts with so many rows or bytes that they are sorted in several parts.

    Row counts and bytes by text hash are added up before any text is shuffled.  Fewer hashes than twice the shares can
    hold more than a share of the rows, or of the bytes, so what is broadcast is bounded.
    """
    shares = _shares(rows)
    held = materialise(rows.groupBy("_hash").agg(F.count("*").alias("n"), F.sum(F.length("_bytes")).alias("b")), "held")
    whole = held.agg(F.sum("n").alias("n"), F.sum("b").alias("b")).first()
    most_rows, most_bytes = max(1, (whole["n"] or 0) // shares), max(1, (whole["b"] or 0) // shares)
    hot = held.filter(f"n > 1 and (n > {most_rows} or b > {most_bytes})").select(
        "_hash", F.expr(f"int(greatest(ceil(n / {most_rows}), least(n, ceil(b / {most_bytes}))))").alias("_parts"))
    return rows.join(F.broadcast(hot), "_hash", "left").withColumn(
        "_part", F.coalesce(F.pmod(F.xxhash64("_id"), F.col("_parts")), F.lit(0)))


def _runs(docs: DataFrame, id_col: str, text: str, largest: bool, normalise, carried: Column | None) -> DataFrame:
    content = F.col(f"`{text}`") if normalise is None else normalise(F.col(f"`{text}`"))
    whole = F.coalesce(content.cast("binary"), F.lit(b""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), whole.alias("_bytes"),
                       *([] if carried is None else [carried.alias("_row")]))
    rows = _with_parts(rows.select("*", F.xxhash64("_bytes").alias("_hash"),
                                   F.substring("_bytes", 1, SPLITTER_BYTES).alias("_head")))
    # the window sorts every part by the whole text and compares each row with the one before
    same = W.partitionBy(*_KEY, "_bytes")
    first = same.orderBy(F.col("_id").desc_nulls_last() if largest else F.col("_id").asc_nulls_last())
    found = rows.repartitionByRange(*_KEY).select(
        "_id", "_hash", "_part", F.row_number().over(first).alias("_at"), F.first("_id").over(first).alias("_best"),
        F.count("*").over(same).alias("_n"), F.sha2("_bytes", 256).alias("_sha"),
        F.when(F.col("_parts").isNotNull(), F.col("_bytes")).alias("_bytes"), *([] if carried is None else ["_row"]))
    # only the first row of a part is compared with other parts
    return materialise(found.withColumn("_bytes", F.when(F.col("_at") == 1, F.col("_bytes"))), "sorted")


def _groups(docs: DataFrame, id_col: str, text: str, keep: str, normalise, carried: Column | None = None) -> DataFrame:
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    largest = keep == "largest"
    runs = _runs(docs, id_col, text, largest, normalise, carried)
    # one row for each part of a text
    heads = runs.filter("_bytes is not null")
    best = (F.max if largest else F.min)("_best")
    merged = heads.groupBy("_bytes").agg(best.alias("keep"), F.sum("_n").alias("size"), F.collect_list(
        F.struct("_hash", "_sha", "_part", "_best")).alias("parts"))
    winner = F.array_min(F.expr("transform(filter(parts, p -> p._best <=> keep), p -> p._part)"))
    merged = merged.select("keep", "size", winner.alias("winner"), F.inline("parts")).select(
        "_hash", "_sha", "_part", F.coalesce("_best", F.lit(0)).alias("_b"), F.col("_best").isNull().alias("_none"),
        "keep", "size", (F.col("_part") == F.col("winner")).alias("_wins"))
    small = broadcast_if_small(materialise(merged, "parts"))
    rows = runs.drop("_bytes").withColumns({"_b": F.coalesce("_best", F.lit(0)), "_none": F.col("_best").isNull()})
    return rows.join(small, ["_hash", "_sha", "_part", "_b", "_none"], "left").withColumns({
        "keep_id": F.when(F.col("size").isNull(), F.col("_best")).otherwise(F.col("keep")),
        "group_size": F.coalesce("size", "_n"),
        "kept": (F.col("_at") == 1) & F.coalesce("_wins", F.lit(True))})


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", keep: str = "smallest",
                 normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row: its group of equal texts and who stays.

    Texts are equal when their normalised bytes are; ``normalise`` maps the text column (default: no change).
    Sampled splitters deal the rows by the first bytes and a hash of the text, an external sort lays equal texts side
    by side, and each whole text is compared with its neighbour's; a hash never decides.  Texts with many rows are
    sorted in parts, of which only the first rows meet again.

    A null text counts as empty, whatever ``normalise`` does with it.  A null id is never preferred to another; if a
    group has no other, keep_id is null.  Of rows with equal text and id one is kept.  Other columns are not read.
    """
    return _groups(docs, id_col, text, keep, normalise).select(
        F.col("_id").alias(id_col), "keep_id", "group_size", "kept", F.col("_sha").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text", keep: str = "smallest",
                normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """One whole row of each group of equal texts (``exact_copies``), with the columns that the frame has."""
    own = free_name("kept_row", docs.columns)
    rows = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return _groups(docs, id_col, text, keep, normalise, rows).filter("kept").select(F.col("_row").alias(own)).select(f"{own}.*")
