"""Line dedup by an exact set-similarity join over line words, DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabulon.llm.words import free_name
from tabulon.plans.shared import broadcast_if_small, materialise

# Word counts are kept by hash in a table of this size, whatever the corpus; it only sets the order of words.
COUNTS = 1 << 20
# Lines, or document ids, sent to every executor at most, some 70 bytes each; beyond that the texts are shuffled instead.
IDS_BROADCAST = 1_000_000
# More than any place of a rare word in a line; with it the bounds are still within 32 bits.
_FAR = 1 << 22
_ADDED = ("n_lines", "n_removed")
_SPACE = "[\\t-\\r ]+"
_FACTS = ["doc_id", "line", "n", "bits", "more", "at"]
_PAIR = ["a_doc", "a_line", "b_doc", "b_line"]
_ENDS = ["a_doc_id a_doc", "a_line", "b_doc_id b_doc", "b_line"]


def _words(line: Column) -> Column:
    # the pattern is only needed where blanks other than the space occur
    return F.array_remove(F.when(line.rlike("[\\t-\\r]"), F.split(line, _SPACE)).otherwise(F.split(line, " ")), "")


def _rarity(docs: DataFrame) -> Column:
    """An array of COUNTS levels, the logarithm of how often the corpus holds words of that hash, in the highest byte."""
    spark = docs.sparkSession
    # words between other blanks than spaces and line feeds are counted as one: it only places them otherwise
    pieces = F.split(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), " ")
    counts = (docs.select(F.explode(pieces).alias("word")).filter("word <> ''")
              .groupBy(F.expr(f"int(xxhash64(word) & {COUNTS - 1})").alias("at")).agg(F.count("*").alias("n")))
    every = spark.range(COUNTS).select(F.col("id").cast("int").alias("at")).join(counts, "at", "left").select(
        "at", F.expr("int(4 * log2(1 + coalesce(n, 0)))").alias("level"))
    levels = materialise(every, "rarity").agg(F.expr(
        "transform(array_sort(collect_list(at * 256L + level)), x -> shiftleft(least(x & 255, 127), 56))").alias("levels"))
    return levels.scalar()


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "content"))


def _sets(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, line, s1, s2, n, head, bits, more): each line's word set by name, size, rarest words and bit sketch.

    Words are 64-bit keys that sort by rarity.  A set agrees with another in percent of their union only if both
    hold one of the other's n - ceil(percent * n) + 1 rarest words; ``head`` has the upper half of their keys, as two
    words of one half only meet for nothing.  ``bits`` flips a bit for each word: two sets' sketches differ in at
    most as many bits as the sets in words.
    """
    # the filter looks for a word by itself: on the words it would be pushed down and split each line twice
    rows = _lines(docs).filter(F.col("content").rlike("[^\\t-\\r ]")).select(
        "doc_id", "line", F.transform(_words(F.col("content")), lambda w: F.xxhash64(w)).alias("w"))
    rows = rows.withColumn("levels", _rarity(docs))
    # no level is missing: an array that cannot hold null is sorted as numbers, not as objects
    key = F.array_distinct(F.transform("w", lambda h: F.coalesce(F.get(
        F.col("levels"), h.bitwiseAND(F.lit(COUNTS - 1)).cast("int")), F.lit(0).cast("long")).bitwiseOR(
        F.shiftrightunsigned(h, 8))))
    rows = rows.select("doc_id", "line", F.sort_array(key).alias("keys")).withColumn("n", F.size("keys"))
    flip = "aggregate(keys, 0L, (x, k) -> x ^ shiftleft(1L, cast({} & 63 as int)))"
    return rows.select(
        "doc_id", "line", F.xxhash64("keys").alias("s1"), F.xxhash64(F.lit(1), "keys").alias("s2"), "n",
        F.expr(f"transform(slice(keys, 1, n - cast((n * {percent} + 99) div 100 as int) + 1), "
               "k -> cast(shiftright(k, 32) as int))").alias("head"),
        F.expr(flip.format("k")).alias("bits"), F.expr(f"if(n > 96, {flip.format('k >> 6')}, 0L)").alias("more"))


def _possible(left: str, right: str, percent: int) -> Column:
    """The length bound, the place bound of a shared word, and the sketch bound on the words that differ."""
    return F.expr(f"""
        100 * {left}n >= {percent} * {right}n and 100 * {right}n >= {percent} * {left}n
        and (100 + {percent}) * (1 + least({left}n - {left}at, {right}n - {right}at) - 1)
            >= {percent} * ({left}n + {right}n)
        and (100 + {percent}) * bit_count({left}bits ^ {right}bits) <= (100 - {percent}) * ({left}n + {right}n)
        and (100 + {percent}) * bit_count({left}more ^ {right}more) <= (100 - {percent}) * ({left}n + {right}n)
            + if(({left}n > 96) = ({right}n > 96), 0, 1000000)""")


def _by_document(lines: DataFrame, name: str) -> DataFrame:
    """One row per doc_id of a stored (doc_id, line), its lines in an array; broadcast if there are few lines in all."""
    found = lines.groupBy("doc_id").agg(F.collect_list("line").alias(name))
    return F.broadcast(found) if lines.limit(IDS_BROADCAST + 1).count() <= IDS_BROADCAST else found


def _confirm(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Distinct (b_doc, b_line) of the pairs whose word sets, compared as strings, agree in percent of the union."""
    ends = materialise(pairs.select(F.col("a_doc").alias("doc_id"), F.col("a_line").alias("line"))
                       .union(pairs.select("b_doc", "b_line")).distinct(), "ends")
    # texts meet the numbers of their lines, and only these lines leave the task
    rows = docs.join(_by_document(ends, "at"), "doc_id").select("doc_id", F.inline(F.get(F.transform(
        F.array(F.split("text", "\n")), lambda lines: F.transform("at", lambda i: F.struct(
            i.alias("line"), F.get(lines, i).alias("content")))), F.lit(0))))
    # lines travel as they are, as their words take several times the room
    sets = materialise(rows.filter("content is not null").dropDuplicates(["doc_id", "line"]), "sets")
    for p in "ab":
        pairs = pairs.join(sets.select(F.col("doc_id").alias(f"{p}_doc"), F.col("line").alias(f"{p}_line"),
                                       F.col("content").alias(f"{p}_t")), [f"{p}_doc", f"{p}_line"])
    # inside the array each line is split once, as columns the three counts would split it again
    words = F.array(F.struct(*[F.array_distinct(_words(F.col(f"{p}_t"))).alias(p) for p in "ab"]))
    sizes = F.transform(words, lambda w: F.struct(F.size(w["a"]).alias("a"), F.size(w["b"]).alias("b"), F.size(
        F.array_intersect(w["a"], w["b"])).alias("both")))
    pairs = pairs.select("b_doc", "b_line", F.inline(sizes))
    return pairs.filter(f"100 * both >= {percent} * (a + b - both)").select("b_doc", "b_line").distinct()


def _near(under: DataFrame, percent: int) -> DataFrame:
    """Each line with the one earlier line most like it by the sketch, of three under each of its rarest words.

    The three are the first, the last and the most copied.
    """
    order = W.partitionBy("word").orderBy("doc_id", "line")
    line = F.struct("copies", *_FACTS)
    rows = under.select(*[F.col(c).alias(f"b_{c}") for c in _FACTS], F.row_number().over(order).alias("place"),
                        F.first(line).over(order).alias("x"), F.lag(line).over(order).alias("y"),
                        F.max(line).over(order.rowsBetween(W.unboundedPreceding, -1)).alias("z")).filter("place > 1")
    best = F.least(*[F.when(_possible(f"{c}.", "b_", percent), F.expr(
        f"struct(bit_count({c}.bits ^ b_bits) + bit_count({c}.more ^ b_more) apart, {c}.doc_id a_doc, {c}.line a_line)"))
        for c in "xyz"])
    # a filter on the column itself would compute it twice
    found = rows.select(F.col("b_doc_id").alias("b_doc"), "b_line", F.explode(F.array(best)).alias("a")).filter(
        "a is not null")
    return found.groupBy("b_doc", "b_line").agg(F.min("a").alias("a")).select(
        "a.a_doc", "a.a_line", "b_doc", "b_line")


def later_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """(doc_id, line): the lines, counted from 0, whose word set an earlier line matches to Jaccard >= percent.

    Earlier is a smaller doc_id, or the same and a smaller line; lines are judged on the input, not on what is
    left.  Lines with equal word sets are one class, of which the first line stays for comparison.  Classes meet
    under their rarest words, within length, place and sketch bounds; matches are confirmed on the words.  Lines
    that match the most similar of the first, last and most copied earlier lines under their rare words are done, so
    that variants of one line do not meet in pairs; the others are compared with all lines they meet.

    Null texts and rows without a doc_id have no lines here; lines without a word are never removed.  Rows that
    repeat a doc_id with its text count once; if the texts differ, their lines are compared like others of the
    same number.  Other columns are not read.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).filter(
        "doc_id is not null and text is not null")
    sets = materialise(_sets(docs, percent), "lines")
    heads = materialise(sets.groupBy("s1", "s2").agg(
        F.min(F.struct("doc_id", "line", "n", "bits", "more", "head")).alias("first"),
        F.count("*").alias("copies")).select("s1", "s2", "copies", "first.*"),
        "heads")
    at_line = ["doc_id", "line"]
    under = heads.select("copies", *_FACTS[:-1], F.posexplode("head").alias("at", "word"))
    near = materialise(_near(under, percent), "near")
    done = materialise(_confirm(near, docs, percent).select(F.col("b_doc").alias("doc_id"),
                                                            F.col("b_line").alias("line")), "done")
    # One shuffle serves both sides of the join, so no filter may part them: lines that are done stand under places so
    # high that the place bound, which takes both sides, turns them away as later lines; as earlier ones they stay.
    few = broadcast_if_small(done.withColumn("far", F.lit(_FAR)), IDS_BROADCAST)
    posted = heads.join(few, at_line, "left").select(
        *_FACTS[:-1], F.coalesce("far", F.lit(0)).alias("far"), F.posexplode("head").alias("at", "word")).select(
        "word", *_FACTS[:-1], (F.col("at") + F.col("far")).alias("at")).repartition("word")
    earlier, later = (posted.select("word", *[F.col(c).alias(f"{p}_{c}") for c in _FACTS]) for p in "ab")
    met = earlier.withColumn("a_at", F.col("a_at").bitwiseAND(F.lit(_FAR - 1))).join(later, "word")
    met = met.filter("a_doc_id < b_doc_id or (a_doc_id = b_doc_id and a_line < b_line)")
    rest = met.filter(_possible("a_", "b_", percent)).selectExpr(*_ENDS).distinct()
    more = _confirm(materialise(rest.join(near, _PAIR, "left_anti"), "rest"), docs, percent)
    found = done.unionByName(more.select(F.col("b_doc").alias("doc_id"), F.col("b_line").alias("line")))
    kept = heads.select("s1", "s2", *at_line).join(found, at_line, "left_anti")
    return sets.select("s1", "s2", *at_line).join(kept, ["s1", "s2", *at_line], "left_anti").select(*at_line).distinct()


def drop_later_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """The documents with their later similar lines (``later_lines``) cut out, and ``n_lines``, ``n_removed``.

    The text keeps its other lines, joined by line feeds; a null text stays null, with no lines.  Columns that
    have the names of the two counts are replaced.
    """
    names = docs.columns
    own, cut = free_name("later_id", names), free_name("later_lines", names)
    gone = _by_document(materialise(later_lines(docs, id_col, text, percent), "gone"), cut).withColumnRenamed("doc_id", own)
    rows = docs.join(gone, docs[f"`{id_col}`"] == F.col(own), "left")
    lines = F.split(F.col(f"`{text}`"), "\n")
    kept = F.when(F.col(own).isNull(), F.col(f"`{text}`")).otherwise(
        F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(cut, i)), "\n"))
    counts = [F.coalesce(F.size(lines), F.lit(0)), F.coalesce(F.size(cut), F.lit(0))]
    return rows.select(*[kept.alias(c) if c == text else F.col(f"`{c}`") for c in names if c not in _ADDED],
                       *[c.cast("long").alias(name) for c, name in zip(counts, _ADDED)])
