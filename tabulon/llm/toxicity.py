"""Toxicity: a learned lexicon in a trie, met by Levenshtein automata, with scores of the words around a hit."""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.fitting import drawn, minimise, sigmoid
from tabulon.llm.words import per_batch
from tabulon.plans.shared import materialise

# Labelled rows that lexicon and weights are learned from at most, drawn by a hash of the id; terms kept at most.
FIT_ROWS = 20_000
TERMS = 2_000
AROUND = 6
STEM = range(4, 9)
_WORD = re.compile(r"[^\W_]+")
_QUOTES = "\"“”„«»‹›`"
_REMEMBERED = 1 << 17
FEATURES = ["bias", "plain", "fuzzy", "quoted", "quoted_fuzzy", "near", "share"]


class Automaton:
    """All words within the allowed edits of a lexicon: the trie and its Levenshtein automata, run together.

    A state is the set of (trie node, edits so far) that the letters read can have led to; states are numbered and
    their moves built when first met.  Letters that no term has are all alike.  Terms ending in ``*`` are stems, met
    exactly, whatever follows.  Terms of 5 letters allow one edit, of 9 or more two.
    """

    STATES = 1 << 16

    def __init__(self, terms: list[str]):
        self.children, self.ends, self.stems, self.room = [{}], {}, set(), [0]
        for term in terms:
            stem, word = term.endswith("*"), term.rstrip("*")
            edits = 0 if stem or len(word) < 5 else 1 if len(word) < 9 else 2
            node = 0
            for letter in word:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.room.append(0)
                self.room[node] = max(self.room[node], edits)
                node = self.children[node][letter]
            self.room[node] = max(self.room[node], edits)
            if stem:
                self.stems.add(node)
            else:
                self.ends[node] = edits
        self.letters = {c for children in self.children for c in children}
        self._reset()

    def _reset(self) -> None:
        self.number, self.states, self.moves, self.result = {}, [], [], []
        self._enter(self._closed({0: 0}))

    def _enter(self, state: frozenset) -> int:
        """The number of a state, -1 if it is empty; its result is -1 behind a stem, else the edits or None."""
        if not state:
            return -1
        if state not in self.number:
            self.number[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            found = [e for n, e in state if n in self.ends and e <= self.ends[n]]
            stem = any(n in self.stems and e == 0 for n, e in state)
            self.result.append(-1 if stem else min(found) if found else None)
        return self.number[state]

    def _closed(self, places: dict[int, int]):
        """Let letters of the lexicon be left out, as long as edits are allowed."""
        todo = list(places.items())
        while todo:
            node, edits = todo.pop()
            if edits < self.room[node]:
                for child in self.children[node].values():
                    if edits + 1 <= self.room[child] and edits + 1 < places.get(child, 9):
                        places[child] = edits + 1
                        todo.append((child, edits + 1))
        return frozenset(places.items())

    def _move(self, state, letter: str):
        places: dict[int, int] = {}

        def put(node, edits):
            if edits <= self.room[node] and edits < places.get(node, 9):
                places[node] = edits

        for node, edits in state:
            for known, child in self.children[node].items():
                put(child, edits + (known != letter))
            put(node, edits + 1)
        return self._closed(places)

    def match(self, word: str) -> int | None:
        """Edits to the nearest term, 0 for a stem's words; None when no term is near enough."""
        if len(self.states) > self.STATES:
            self._reset()
        at, moves, result = 0, self.moves, self.result
        for letter in word:
            to = moves[at].get(letter)
            if to is None:
                known = letter if letter in self.letters else ""
                to = moves[at].get(known)
                if to is None:
                    to = moves[at][known] = self._enter(self._move(self.states[at], known))
                moves[at][letter] = to
            if to < 0:
                return None
            at = to
            if result[at] == -1:
                return 0
        return result[at]


@dataclass
class Toxicity:
    terms: list[str] = field(default_factory=list)
    common: frozenset[str] = frozenset()
    weights: np.ndarray = field(default_factory=lambda: np.array([-5.0] + [0.0] * (len(FEATURES) - 1)))


class Reader:
    """Finds hits and describes a text by what stands around them."""

    def __init__(self, terms: list[str], common: frozenset[str]):
        self.automaton, self.common, self.clean = Automaton(terms), common, set()

    def hits(self, found: list[str]) -> dict[str, int]:
        """The words that are hits, with their edits; words that clean texts use are no misspellings."""
        out = {}
        for word in {*found}.difference(self.clean):
            got = self.automaton.match(word)
            if got is None or got and word in self.common:
                if len(self.clean) >= _REMEMBERED:
                    self.clean.clear()
                self.clean.add(word)
            else:
                out[word] = got
        return out

    def features(self, text: bytes | None) -> np.ndarray:
        out = np.zeros(len(FEATURES))
        out[0] = 1
        lowered = (text or b"").decode("utf-8", "replace").lower()
        found = _WORD.findall(lowered)
        hits = self.hits(found)
        if not hits:
            return out
        which = [i for i, w in enumerate(found) if w in hits]
        places = [m.span() for m in _WORD.finditer(lowered)]
        for j, i in enumerate(which):
            lo, hi = places[max(0, i - AROUND)][0], places[min(len(places) - 1, i + AROUND)][1]
            before, after = lowered[lo:places[i][0]], lowered[places[i][1]:hi + 1]
            quoted = any(q in before for q in _QUOTES) and any(q in after for q in _QUOTES)
            out[1 + 2 * quoted + (hits[found[i]] > 0)] += 1
            out[5] += j > 0 and i - which[j - 1] <= AROUND
        out[1:6] = np.log1p(out[1:6])
        out[6] = len(which) / len(found)
        return out


@functools.lru_cache(maxsize=2)
def reader(terms: tuple[str, ...], common: frozenset[str]) -> Reader:
    """One reader for all tasks of a worker process: its automaton and the words it knows stay."""
    return Reader(list(terms), common)


def _sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """(half, y, t): the drawn labelled texts; one half teaches the lexicon, the other the weights."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y"))
    known = (known.filter("doc_id is not null and y in (0, 1) and crc32(cast(doc_id as string)) % 4 <> 2")
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    return docs.join(F.broadcast(drawn(known, rows)), "doc_id").select(
        F.expr("int(pmod(xxhash64(doc_id, 1), 2))").alias("half"), "y", F.col("text").alias("t"))


def _words(sample: DataFrame) -> DataFrame:
    """(word, bad, good): in how many toxic and clean texts a word stands."""

    def run(kept, texts):
        counts: dict[str, list[int]] = {}
        for y, t in zip(kept[0].to_pylist(), texts):
            for w in set(_WORD.findall((t or b"").decode("utf-8", "replace").lower())):
                counts.setdefault(w, [0, 0])[1 - y] += 1
        return {"word": pa.array(list(counts), pa.string()), "bad": pa.array([c[0] for c in counts.values()], pa.int64()),
                "good": pa.array([c[1] for c in counts.values()], pa.int64())}

    return per_batch(sample, "t", ["y"], run, "word string, bad long, good long").groupBy("word").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS) -> Toxicity:
    """Lexicon and weights from labelled rows whose crc32(doc_id) mod 4 is not 2, at most ``rows`` of them.

    Words and stems of 4 to 8 letters that stand in toxic texts nine times of ten become terms; a stem must hold
    three such words.  Words of clean texts near a term are noted.  Weights of the hits, by how they stand, come
    from the half of the rows that the lexicon was not taken from.
    """
    sample = materialise(_sample(docs, labels, label, rows), "labelled")
    words = materialise(_words(sample.filter("half = 0")), "words")
    bad = "bad >= 4 and bad >= 9 * good"
    stems = (words.filter(f"length(word) > {STEM[0]}").select(
        F.explode(F.expr(f"transform(sequence({STEM[0]}, least({STEM[-1]}, length(word) - 1)), n -> left(word, n))"))
        .alias("word"), "bad", "good").groupBy("word").agg(
            F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.expr("count_if(bad > 0)").alias("forms"))
        .filter(f"{bad} and forms >= 3").orderBy(F.desc("bad"), F.length("word"), "word").limit(TERMS).collect())
    exact = words.filter(f"{bad} and length(word) >= 3").orderBy(F.desc("bad"), "word").limit(TERMS).collect()
    chosen: list[str] = []
    for r in sorted(stems, key=lambda r: (len(r.word), r.word)):
        if not any(r.word.startswith(c) for c in chosen):
            chosen.append(r.word)
    terms = [c + "*" for c in chosen] + [r.word for r in exact if not any(r.word.startswith(c) for c in chosen)]
    if not terms:
        return Toxicity()

    def near(batches):
        automaton = Automaton(terms)
        for b in batches:
            keep = [bool(automaton.match(w)) for w in b.column(0).to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    usual = words.filter("good > 0 and bad < 9 * good").select("word").mapInArrow(near, "word string")
    common = frozenset(r.word for r in usual.orderBy("word").limit(50 * TERMS).collect())

    def features(kept, texts):
        found = reader(tuple(terms), common)
        return {"y": kept[0], "x": pa.array([found.features(t).tolist() for t in texts], pa.list_(pa.float64()))}

    got = per_batch(sample.filter("half = 1"), "t", ["y"], features, "y int, x array<double>").collect()
    x, y = np.array([r.x for r in got]).reshape(-1, len(FEATURES)), np.array([r.y for r in got], float)

    def loss(w):
        p = sigmoid(x @ w)
        value = -(y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)).mean() + 1e-4 * (w[1:] @ w[1:])
        return value, x.T @ (p - y) / len(y) + 2e-4 * np.concatenate([[0], w[1:]])

    weights = minimise(loss, np.zeros(len(FEATURES)), 200, tolerance=1e-9) if len(y) else Toxicity().weights
    return Toxicity(terms, common, weights)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
          least: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted, hits): how toxic each whole text is, 0 to 1, and 1 from ``least`` on.

    A hit is a word near a term of the learned lexicon; hits between quotation marks, misspelled ones and several
    close together are weighed apart.  Labels are learned from rows whose crc32(doc_id) mod 4 is not 2 and are no
    input of a score.

    Null and empty texts have no hits and the score of such texts.  Rows without a doc_id are scored and not held
    out.  Without labels of both kinds the lexicon is empty and scores are low.  Repeated rows each get their
    result; of several labels of an id the highest counts.  Other columns are not read.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    model = learn(docs, labels, label)

    def run(kept, texts):
        found = reader(tuple(model.terms), model.common)
        rows = [found.features(t) for t in texts]
        return {"doc_id": kept[0], "score": pa.array(sigmoid(np.array(rows).reshape(-1, len(FEATURES)) @ model.weights)),
                "hits": pa.array([int(round(np.expm1(r[1:5]).sum())) for r in rows], pa.int64())}

    out = per_batch(docs, "text", ["doc_id"], run, "doc_id long, score double, hits long")
    return out.select("doc_id", F.coalesce(F.expr("crc32(cast(doc_id as string)) % 4 = 2"), F.lit(False)).alias(
        "held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"), "hits")
