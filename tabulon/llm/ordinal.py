"""Quality classifier: cumulative-link regression of graded ratings on hashed text."""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.fitting import drawn, minimise, sigmoid
from tabulon.llm.words import per_batch
from tabulon.plans.shared import materialise

BITS = 15
SIZE = 1 << BITS
# Rated rows that the model is fitted to at most, drawn by a hash of the id.
FIT_ROWS = 20_000
_REMEMBERED = 1 << 17
_KINDS = [(re.compile(p), r) for p, r in ((rb"[a-z\x80-\xff]+", b"a"), (rb"[A-Z]+", b"A"), (rb"[0-9]+", b"0"))]


class Features(dict):
    """Places of a word, its last letters and its shape in the hashed vector, three numbers of BITS bits in one."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        shape = word
        for kind, letter in _KINDS:
            shape = kind.sub(letter, shape)
        parts = b"w" + word.lower(), b"e" + word[-3:], b"s" + shape[-8:]
        packed = 0
        for i, p in enumerate(parts):
            packed |= (xxhash.xxh3_64_intdigest(p) & (SIZE - 1)) << (i * BITS)
        self[word] = packed
        return packed

    def of(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """(places, values) of a text: logarithms of counts, scaled to length 1."""
        found = (text or b"").split()
        if not found:
            return np.empty(0, np.int64), np.empty(0)
        packed = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        counts = np.bincount(np.concatenate([(packed >> (i * BITS)) & (SIZE - 1) for i in range(3)]), minlength=SIZE)
        places = np.flatnonzero(counts)
        values = np.log1p(counts[places])
        return places, values / np.sqrt(values @ values)


@functools.lru_cache(maxsize=1)
def features_of_words() -> Features:
    """One table of known words for all tasks of a worker process."""
    return Features()


@dataclass
class Ordinal:
    """P(grade >= k) = sigmoid(w . x - cuts[k - 1]) for grades 0..len(cuts), with rising cuts."""

    weights: np.ndarray
    cuts: np.ndarray

    def tails(self, margin: np.ndarray) -> np.ndarray:
        return sigmoid(np.asarray(margin)[:, None] - self.cuts[None, :])


def _cuts(free: np.ndarray) -> np.ndarray:
    """The first cut, and logarithms of the distances to the next ones."""
    return np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])


def _loss(margin: np.ndarray, grade: np.ndarray, free: np.ndarray):
    """Summed negative log-likelihood, and its slopes by margin and by the free threshold parameters."""
    cuts = _cuts(free)
    tails = np.concatenate([np.ones((len(margin), 1)), sigmoid(margin[:, None] - cuts), np.zeros((len(margin), 1))], 1)
    slope = tails * (1 - tails)
    rows = np.arange(len(margin))
    chance = np.maximum(tails[rows, grade] - tails[rows, grade + 1], 1e-12)
    by_margin = -(slope[rows, grade] - slope[rows, grade + 1]) / chance
    by_cut = np.zeros((len(margin), len(cuts) + 2))
    by_cut[rows, grade] += slope[rows, grade] / chance
    by_cut[rows, grade + 1] -= slope[rows, grade + 1] / chance
    by_cut = by_cut[:, 1:-1].sum(axis=0)
    by_free = np.concatenate([[by_cut.sum()], [by_cut[i:].sum() * np.exp(free[i]) for i in range(1, len(free))]])
    return -np.log(chance).sum(), by_margin, by_free


def fit_ordinal(docs: DataFrame, ratings: DataFrame, grade: str = "grade", id_col: str = "doc_id", text: str = "text",
                rows: int = FIT_ROWS, penalty: float = 1e-4, rounds: int = 40) -> Ordinal | None:
    """Fit to at most ``rows`` rated documents; None when they hold less than two grades.

    Grades are whole numbers from 0; of several of an id the lowest counts.  The hashed vectors are stored once;
    each step sums the loss and its slope over their partitions in Spark, and only those sums, of fixed size,
    reach the driver.
    """
    rated = ratings.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{grade}`").cast("int").alias("grade"))
    rated = rated.filter("doc_id is not null and grade >= 0").groupBy("doc_id").agg(
        F.min("grade").alias("grade"))
    rows_ = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("t")).join(
        F.broadcast(drawn(rated, rows)), "doc_id")

    def vectors(kept, texts):
        features = features_of_words()
        found = [features.of(t) for t in texts]
        return {"grade": kept[0], "places": pa.array([p for p, _ in found], pa.list_(pa.int32())),
                "values": pa.array([v for _, v in found], pa.list_(pa.float32()))}

    sample = materialise(per_batch(rows_, "t", ["grade"], vectors, "grade int, places array<int>, values array<float>"),
                         "vectors")
    counts = {r.grade: r.n for r in sample.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return None
    top, total = max(counts), sum(counts.values())

    def loss(at):
        weights, free = at[:SIZE], at[SIZE:]

        def part(batches):
            value, slope = 0.0, np.zeros(len(at))
            for b in batches:
                places, values = b.column(1), b.column(2)
                sizes = np.diff(places.offsets.to_numpy())
                p, v = places.flatten().to_numpy(), values.flatten().to_numpy()
                row = np.repeat(np.arange(len(sizes)), sizes)
                margin = np.bincount(row, weights[p] * v, minlength=len(sizes))
                got, by_margin, by_free = _loss(margin, b.column(0).to_numpy(), free)
                value += got
                slope[:SIZE] += np.bincount(p, by_margin[row] * v, minlength=SIZE)
                slope[SIZE:] += by_free
            yield pa.RecordBatch.from_arrays([pa.array([value]), pa.array([slope.tobytes()], pa.binary())],
                                             names=["value", "slope"])

        got = sample.mapInArrow(part, "value double, slope binary").collect()
        value = sum(r.value for r in got) / total + penalty * (weights @ weights) / 2
        slope = sum(np.frombuffer(bytes(r.slope)) for r in got) / total
        slope[:SIZE] += penalty * weights
        return value, slope

    share = np.array([sum(n for g, n in counts.items() if g >= k) for k in range(1, top + 1)]) / total
    cuts = -np.log(np.clip(share, 1e-6, 1 - 1e-6) / (1 - np.clip(share, 1e-6, 1 - 1e-6)))
    free = np.concatenate([cuts[:1], np.log(np.maximum(np.diff(cuts), 0.1))])
    at = minimise(loss, np.concatenate([np.zeros(SIZE), free]), rounds)
    return Ordinal(at[:SIZE].astype(np.float32), _cuts(at[SIZE:]))


def grade(docs: DataFrame, model: Ordinal | None, id_col: str = "doc_id", text: str = "text", tail: int = 1,
          least: float = 0.5) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, kept) for every whole text.

    ``tail_probability`` is of a grade of ``tail`` or more; ``kept`` says whether it is at least ``least``.  Null
    and empty texts have no words and get what the thresholds alone say.  Without a model the numbers are null
    and all rows are kept.  Repeated rows each get their result.  Other columns are not read.
    """

    def score(kept, texts):
        features = features_of_words()
        if model is None:
            return {"doc_id": kept[0], **{c: pa.nulls(len(texts), pa.float64()) for c in ("expected_grade",
                                                                                        "tail_probability")}}
        margin = np.zeros(len(texts))
        for row, t in enumerate(texts):
            places, values = features.of(t)
            margin[row] = model.weights[places] @ values
        tails = model.tails(margin)
        of = tails[:, min(tail, tails.shape[1]) - 1]
        return {"doc_id": kept[0], "expected_grade": pa.array(tails.sum(axis=1)), "tail_probability": pa.array(of)}

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = per_batch(narrow, "text", ["doc_id"], score, "doc_id long, expected_grade double, tail_probability double")
    return out.withColumn("kept", F.coalesce(F.col("tail_probability") >= least, F.lit(True)))
