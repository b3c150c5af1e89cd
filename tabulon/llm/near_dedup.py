"""MinHash near-duplicates: an inverted join over signature coordinates, confirmed on full shingle sets."""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabulon.llm.components import components
from tabulon.llm.words import Codes, Rolling, long_lists, mix, per_batch, words
from tabulon.plans.shared import broadcast_if_small, materialise

COORDINATES = 16
# Further coordinates, kept by one bit each, compared before a pair leaves the join.
CHECKS = 384
# The chance at most that two sets just at the threshold fail the test of the posted coordinates, and that of the checks.
MISS = 5e-7
# Bits that a set flips, one for each shingle: two sets never differ in more bits than in shingles.
FLIPPED = 1024
# Document ids sent to every executor at most, 8 bytes each; beyond that the texts are shuffled instead.
IDS_BROADCAST = 1_000_000
_POSTED = [f"s{i}" for i in range(COORDINATES)]
_CHECKED = [f"c{i}" for i in range(CHECKS // 64)]
_SKETCH = [*_CHECKED, "flips"]


def limits(percent: int) -> tuple[int, int]:
    """How many posted coordinates must agree, and how many checked bits may differ, for pairs of Jaccard >= percent.

    A coordinate agrees with the chance of the Jaccard similarity; one of its bits differs in half of the other cases.
    Below the least similarity at which one coordinate in common is near enough to certain, there is no such number.
    """
    def chance(n, p, counts):
        return sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in counts)

    least = next(p for p in range(1, 101) if (1 - p / 100) ** COORDINATES <= MISS)
    if not least <= percent <= 100:
        raise ValueError(f"percent is {percent}: signatures of {COORDINATES} coordinates find pairs of {least} to 100 percent only")
    alike = percent / 100
    matches = max(m for m in range(1, COORDINATES + 1) if chance(COORDINATES, alike, range(m)) <= MISS)
    apart = min(d for d in range(CHECKS + 1) if chance(CHECKS, (1 - alike) / 2, range(d + 1, CHECKS + 1)) <= MISS)
    return matches, apart


def shingles(text: bytes | None, k: int, codes: Codes) -> np.ndarray:
    """Sorted distinct codes of the ``k``-word shingles, A-Z lower-cased; a shorter text is one shingle."""
    found = words(text.lower() if text else text)
    if not found:
        return np.empty(0, np.uint64)
    rolling = Rolling(codes.of(found))
    return np.unique(rolling.every(min(k, len(found))))


def _least(found: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """The least of the codes under each of the given multiplications, in slices of bounded size."""
    step = max(1, (1 << 20) // len(odd))
    least = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), step):
        least = np.minimum(least, (found[at:at + step] * odd[:, None]).min(axis=1))
    return least


def signatures(docs: DataFrame, id_col: str, text: str, k: int) -> DataFrame:
    """(doc_id, n, set_id, s0.., c0.., flips): size and 128-bit name of the shingle set, posted coordinates and sketches."""
    odd = mix(np.arange(1, COORDINATES + CHECKS + 1, dtype=np.uint64)) | np.uint64(1)

    def run(kept, texts):
        codes = run.codes = getattr(run, "codes", None) or Codes()
        sizes, ids = [], []
        posted = np.zeros((len(texts), COORDINATES), np.int32)
        sketch = np.zeros((len(texts), (CHECKS + FLIPPED) // 64), np.uint64)
        for row, t in enumerate(texts):
            found = shingles(t, k, codes)
            sizes.append(len(found))
            ids.append(xxhash.xxh3_128_digest(found.tobytes()))
            if len(found):
                least = _least(found, odd)
                posted[row] = (least[:COORDINATES] >> np.uint64(16)).astype(np.uint32).view(np.int32)
                bits = ((least[COORDINATES:] >> np.uint64(24)) & np.uint64(1)).astype(np.uint8)
                flips = (np.bincount((found & np.uint64(FLIPPED - 1)).astype(np.int64), minlength=FLIPPED) & 1)
                sketch[row] = np.packbits(np.concatenate([bits, flips.astype(np.uint8)]), bitorder="little").view(
                    np.uint64)
        return {"doc_id": kept[0], "n": pa.array(sizes, pa.int64()), "set_id": pa.array(ids, pa.binary()),
                **{c: pa.array(posted[:, i]) for i, c in enumerate(_POSTED)},
                **{c: pa.array(sketch[:, i].view(np.int64)) for i, c in enumerate(_CHECKED)},
                "flips": long_lists(sketch[:, len(_CHECKED):].ravel(), np.full(len(texts), FLIPPED // 64))}

    return per_batch(docs, text, [id_col], run, "doc_id long, n long, set_id binary, " + ", ".join(
        [f"{c} int" for c in _POSTED] + [f"{c} long" for c in _CHECKED] + ["flips array<long>"]))


def _sets(docs: DataFrame, id_col: str, text: str, k: int, wanted: DataFrame) -> DataFrame:
    """(id, shingles) of the wanted ids only."""
    few = broadcast_if_small(wanted, IDS_BROADCAST)
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("t")).join(few, "id", "left_semi")

    def run(kept, texts):
        codes = run.codes = getattr(run, "codes", None) or Codes()
        found = [shingles(t, k, codes) for t in texts]
        return {"id": kept[0], "found": long_lists(np.concatenate([*found, np.empty(0, np.uint64)]),
                                                   np.array([len(x) for x in found], np.int64))}

    return per_batch(picked, "t", ["id"], run, "id long, found array<long>")


def _confirm(pairs: DataFrame, docs: DataFrame, id_col: str, text: str, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    ids = materialise(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ids")
    sets = materialise(_sets(docs, id_col, text, k, ids), "sets")
    joined = (pairs.join(sets.select(F.col("id").alias("a"), F.col("found").alias("x")), "a")
              .join(sets.select(F.col("id").alias("b"), F.col("found").alias("y")), "b"))

    def run(batches):
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            keep = []
            for i in range(batch.num_rows):
                one, two = x[i].values.to_numpy(), y[i].values.to_numpy()
                both = len(one) + len(two) - len(np.union1d(one, two))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return joined.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _postings(reps: DataFrame, matches: int) -> DataFrame:
    """(coordinate, value, id, weight): of each document's postings the rarest 16 - matches + 1 that others share.

    ``weight`` adds up how many documents share each coordinate; the text that others are copies of has most.

    Two signatures that agree in ``matches`` coordinates share one of those, whatever the order; rarest first keeps
    the lists short and skips the lists of boiler-plate.  Values that occur once use up places and join nothing.
    """
    rows = reps.select("id", F.xxhash64("set_id").alias("own"),
                       F.posexplode(F.array(*_POSTED)).alias("coordinate", "value"))
    lists = rows.groupBy("coordinate", "value").agg(F.count("*").alias("held")).filter("held > 1")
    shared = rows.join(lists, ["coordinate", "value"])
    of_doc = W.partitionBy("id", "own")
    return (shared.withColumn("shared", F.count("*").over(of_doc))
            .withColumn("weight", F.sum("held").over(of_doc))
            .withColumn("place", F.row_number().over(of_doc.orderBy("held", "coordinate", "value")))
            .filter(F.col("place") + (COORDINATES - F.col("shared")) <= COORDINATES - matches + 1)
            .select("coordinate", "value", "id", "weight"))


def _flipped(left: str, right: str) -> str:
    """In how many flipped bits two rows differ."""
    return f"aggregate(zip_with({left}flips, {right}flips, (x, y) -> bit_count(x ^ y)), 0, (x, y) -> x + y)"


def _alike(left: str, right: str, percent: int) -> F.Column:
    """Sizes within the bound, enough posted and checked coordinates in common, few enough flipped bits apart."""
    matches, apart = limits(percent)
    same = "+".join(f"int({left}{c} = {right}{c})" for c in _POSTED)
    checked = "+".join(f"bit_count({left}{c} ^ {right}{c})" for c in _CHECKED)
    return F.expr(f"100 * {left}n >= {percent} * {right}n and 100 * {right}n >= {percent} * {left}n "
                  f"and {same} >= {matches} and {checked} <= {apart} "
                  f"and {100 + percent} * {_flipped(left, right)} "
                  f"<= {100 - percent} * ({left}n + {right}n)")


def _leader_pairs(facts: DataFrame, placed: DataFrame, percent: int, leader: str) -> DataFrame:
    """(a, b): each document with the leader most like it, of the lists it shares with other components.

    A list's leader is its document with the greatest ``leader``.
    """
    leaders = placed.groupBy("coordinate", "value").agg(
        F.min("component").alias("x"), F.max("component").alias("y"),
        F.max_by(F.struct("id", "component"), F.expr(leader)).alias("lead")).filter("x < y").select(
            "coordinate", "value", F.col("lead.id").alias("a"), F.col("lead.component").alias("x"))
    pairs = (placed.join(leaders, ["coordinate", "value"]).filter("component <> x")
             .select("a", F.col("id").alias("b")).distinct())
    pairs = (pairs.join(facts.select(*[F.col(c).alias(f"l_{c}") for c in facts.columns]), F.col("a") == F.col("l_id"))
             .join(facts.select(*[F.col(c).alias(f"r_{c}") for c in facts.columns]), F.col("b") == F.col("r_id"))
             .filter(_alike("l_", "r_", percent)).select("a", "b", F.expr(_flipped("l_", "r_")).alias("apart")))
    return pairs.groupBy("b").agg(F.expr("min_by(a, struct(apart, a))").alias("a")).select("a", "b")


def _with_component(rows: DataFrame, place: DataFrame | None) -> DataFrame:
    if place is None:
        return rows.withColumn("component", F.col("id"))
    return rows.join(place, "id", "left").withColumn("component", F.coalesce("component", "id"))


def _merge(links: DataFrame, place: DataFrame | None) -> DataFrame:
    """(id, component) after further links; only components that a link touches are worked on."""
    if place is None:
        return materialise(components(links), "place")
    ends = [place.select(F.col("id").alias(c), F.col("component").alias(f"{c}c")) for c in "ab"]
    short = (links.join(ends[0], "a", "left").join(ends[1], "b", "left")
             .select(F.coalesce("ac", "a").alias("a"), F.coalesce("bc", "b").alias("b")).distinct())
    moved = components(short).select(F.col("id").alias("component"), F.col("component").alias("to"))
    old = place.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    new = moved.select(F.col("component").alias("id"), F.col("to").alias("component"))
    return materialise(old.unionByName(new.join(place.select("id"), "id", "left_anti")), "place")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5,
                    percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): groups of documents linked by shingle sets of Jaccard >= percent.

    Equal sets are one class.  Each class posts under its signature coordinates.  In two rounds, classes that
    share a list with a leader of another component are compared with it, which joins large groups without pairs
    inside them.  Then all pairs of a list from different components that agree in enough of 16 posted
    coordinates, differ in few enough of 384 checked bits and in no more flipped bits than their sizes allow are
    compared, so no pair that could join two components is left out.  ``limits`` sets the first two from percent (4 and
    70 for 80): two sets at the threshold fail them with a chance below one in a million, and never the third.
    A percent below 60 is an error, as too many pairs would have no coordinate in common.  Links count only
    after 100 * intersection >= percent * union on the full sets.

    Null and empty texts have no shingles, link with nothing and are kept, and so are rows without a doc_id; a
    text of fewer than ``k`` words has one shingle, all its words.  Rows that repeat a doc_id count as one
    document and each get its result.  Other columns are not read.
    """
    matches, _ = limits(percent)
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    signed = materialise(signatures(docs, "doc_id", "text", k), "signatures")
    reps = materialise(signed.filter("n > 0 and doc_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("id"), F.first("n").alias("n"),
        *[F.first(c).alias(c) for c in _POSTED + _SKETCH]), "classes")
    postings = materialise(_postings(reps, matches), "postings")
    facts = reps.select("id", "n", *_POSTED, *_SKETCH)

    place = None
    for leader in ("struct(weight, -id)", "-component"):
        pairs = materialise(_leader_pairs(facts, _with_component(postings, place), percent, leader), "pairs")
        links = materialise(_confirm(pairs, docs, "doc_id", "text", k, percent), "links")
        if links.isEmpty():
            break
        place = _merge(links, place)

    # a bit for each coordinate that a document posts: a pair is compared under the first that both post and share
    bits = postings.groupBy("id").agg(F.expr("bit_or(shiftleft(1, coordinate))").alias("bits"))
    placed = _with_component(postings, place)
    mixed = placed.groupBy("coordinate", "value").agg(
        F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("coordinate", "value")
    open_ = materialise(placed.drop("weight").join(mixed, ["coordinate", "value"]).join(facts, "id").join(bits, "id"),
                        "open")
    sides = [open_.select("coordinate", "value", *[
        F.col(c).alias(f"{p}_{c}") for c in ["component", "bits", *facts.columns]]) for p in "lr"]
    both = "|".join(f"if(l_{c} = r_{c}, {1 << i}, 0)" for i, c in enumerate(_POSTED))
    once = F.expr(f"(shiftleft(1, coordinate) - 1) & l_bits & r_bits & ({both}) = 0")
    rest = (sides[0].join(sides[1], ["coordinate", "value"])
            .filter((F.col("l_component") < F.col("r_component")) & _alike("l_", "r_", percent) & once)
            .select(F.col("l_id").alias("a"), F.col("r_id").alias("b")).distinct())
    links = materialise(_confirm(materialise(rest, "rest"), docs, "doc_id", "text", k, percent), "links")
    if not links.isEmpty():
        place = _merge(links, place)

    whole = reps.select("set_id", "id")
    place = _with_component(whole, place).select("set_id", "component")
    one = signed.select("doc_id", "n", "set_id")
    return (one.join(place, "set_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
