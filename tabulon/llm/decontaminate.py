"""Benchmark decontamination: a prefix-filtered join of item windows with documents, DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Item windows that one broadcast may hold; more are joined in blocks, one after the other.
BLOCK_WINDOWS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased; null has none."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(lowered, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), "")


def item_windows(items: DataFrame, item_id: str, text: str, size: int) -> DataFrame:
    """(words, items): distinct windows of ``size`` item words, or of a shorter item's, with their item ids."""
    found = items.select(F.col(f"`{item_id}`").cast("string").alias("item"), words(F.col(f"`{text}`")).alias("w"))
    found = found.filter("item is not null and size(w) > 0").withColumn("size", F.least(F.size("w"), F.lit(size)))
    found = found.withColumn("at", F.explode(F.sequence(F.lit(1), F.expr("size(w) - size + 1"))))
    return (found.select("item", F.expr("slice(w, at, size)").alias("words"))
            .groupBy("words").agg(F.collect_set("item").alias("items")))


def _rarest(block: DataFrame, docs: DataFrame) -> DataFrame:
    """(token, at, size, words, items): each window under the word of it that documents hold least often.

    Containment of a whole window needs a prefix of one token of its words in order of rarity.
    """
    vocabulary = block.select(F.explode("words").alias("token")).distinct()
    held = (docs.select(F.explode("w").alias("token")).join(F.broadcast(vocabulary), "token")
            .groupBy("token").agg(F.count("*").alias("held")))
    places = block.select(F.xxhash64("words").alias("key"), "words", "items",
                          F.posexplode("words").alias("at", "token"))
    places = places.join(held, "token", "left").withColumn(
        "order", F.struct(F.coalesce("held", F.lit(0)).alias("held"), "token", "at"))
    return places.groupBy("words").agg(F.min("order").alias("least"), F.first("items").alias("items")).select(
        F.col("least.token").alias("token"), F.col("least.at").alias("at"), F.size("words").alias("size"),
        "words", "items")


def benchmark_hits(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text", size: int = 13) -> DataFrame:
    """(doc_id, n_words, spans, items): where a document holds windows of benchmark items, and of which.

    Every document word is looked up among the windows' rarest words; the length and place bounds and the
    comparison of all words of the window stand in the join, so only true occurrences leave it.  ``spans`` has
    [start, end) word places, in order, overlapping.  Windows are broadcast in blocks of a fixed size.

    Null and empty texts have no words: such items match nothing, such documents have no hits.  Items without an
    id are left out.  Repeated rows each get their result.  Other columns are not read.
    """
    docs = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    docs = docs.select("doc_id", F.xxhash64("text").alias("own"), words(F.col("text")).alias("w"))
    windows = item_windows(items, item_id, item_text, size)
    blocks = max(1, -(-windows.count() // BLOCK_WINDOWS))
    found = None
    for i in range(blocks):
        block = windows if blocks == 1 else windows.filter(F.expr(f"pmod(xxhash64(words), {blocks}) = {i}"))
        index = _rarest(block, docs)
        if i == 0:  # the empty word stands behind each document's words and brings its row through the join
            end = docs.sparkSession.range(1).select(
                F.lit("").alias("token"), F.lit(0).alias("at"), F.lit(0).alias("size"),
                F.array().cast("array<string>").alias("words"), F.array().cast("array<string>").alias("items"))
            index = index.unionByName(end)
        rows = docs.select("doc_id", "own", "w", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("p", "token"))
        same = F.expr("size = 0 or (p >= at and p - at + size <= size(w) and slice(w, p - at + 1, size) = words)")
        hits = rows.join(F.broadcast(index), (rows.token == index.token) & same).select(
            "doc_id", "own", F.size("w").alias("n"), (F.col("p") - F.col("at")).alias("start"), "size", "items")
        found = hits if found is None else found.unionByName(hits)
    one = found.groupBy("doc_id", "own").agg(
        F.max("n").alias("n"), F.sum(F.expr("int(size = 0)")).alias("copies"),
        F.sort_array(F.collect_set(F.when(F.col("size") > 0, F.struct(
            "start", (F.col("start") + F.col("size")).alias("end"))))).alias("spans"),
        F.collect_set(F.when(F.col("size") > 0, F.col("items"))).alias("items"))
    one = one.withColumn("copy", F.explode(F.expr("sequence(1, copies)")))
    return one.select("doc_id", F.col("n").cast("long").alias("n_words"), "spans",
                      F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))


def contamination(docs: DataFrame, items: DataFrame, **named) -> DataFrame:
    """``benchmark_hits`` with n_hit, the words inside any occurrence, and whether they are a twentieth or more."""
    covered = F.expr("""aggregate(spans, struct(0 as n, 0 as upto), (x, s) ->
        struct(x.n + greatest(0, s.end - greatest(s.start, x.upto)) as n, greatest(x.upto, s.end) as upto)).n""")
    return benchmark_hits(docs, items, **named).withColumn("n_hit", covered.cast("long")).withColumn(
        "contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))
