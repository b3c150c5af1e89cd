"""Periodic runs of words: multi-scale minimizers seed them, short periods are scanned lag by lag."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.words import Rolling, words

# Periods below this are scanned at every lag; from here on, scales [w, 2w) are seeded by minimizers.
SCANNED = 32
SHORTEST = 12
# Words laid side by side at most, but for one document, which stays whole.
_TOGETHER = 1 << 18
_LOW = np.uint64((1 << 32) - 1)


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal stretches of True of at least ``least``."""
    edges = np.flatnonzero(np.diff(same, prepend=False, append=False))
    start, end = edges[::2], edges[1::2]
    long = end - start >= least
    return start[long], end[long]


def _reach(codes: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The maximal stretch [start, end) around ``at`` in which words a lag apart are equal, its second copy included."""
    start, step = at, 64
    while start > 0:
        n = min(step, start)
        differ = np.flatnonzero(codes[start - n:start] != codes[start - n + lag:start + lag])
        if len(differ):
            start += int(differ[-1]) + 1 - n
            break
        start, step = start - n, step * 2
    end, step, last = at, 64, len(codes) - lag
    while end < last:
        n = min(step, last - end)
        differ = np.flatnonzero(codes[end:end + n] != codes[end + lag:end + lag + n])
        if len(differ):
            end += int(differ[0])
            break
        end, step = end + n, step * 2
    return start, end + lag


def _minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """Places of the leftmost least hash of every window of ``width`` (a power of two) places."""
    key = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while step < width:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    at = key & _LOW
    return at[np.flatnonzero(np.diff(at, prepend=_LOW))].astype(np.int64)


class _Found:
    """Runs by (start, end), each with its smallest period."""

    def __init__(self):
        self.period: dict[tuple[int, int], int] = {}

    def add(self, start: int, end: int, period: int) -> None:
        if end - start >= max(SHORTEST, 2 * period):
            have = self.period.get((start, end))
            self.period[start, end] = period if have is None else min(have, period)


def _chains(at, grams, found: _Found, length: int):
    """(first, last, step, hash) of seeds; those inside one run of a period below half a gram make one chain.

    Inside such a run a gram repeats at each period, and pairs of these places say nothing but that run.
    """
    short = sorted((s, e, p) for (s, e), p in found.period.items() if 2 * p <= length <= e - s)
    label, step = np.full(len(at), -1), np.zeros(len(at), np.int64)
    if short:
        starts, ends, periods = (np.array(c) for c in zip(*short))
        near = np.searchsorted(starts, at, side="right") - 1
        inside = (near >= 0) & (at + length <= ends[near])
        label[inside], step[inside] = near[inside], periods[near[inside]]
    order = np.argsort(grams[at], kind="stable")
    at, label, step, value = at[order], label[order], step[order], grams[at[order]]
    opens = np.ones(len(at), bool)
    opens[1:] = (value[1:] != value[:-1]) | (label[1:] < 0) | (label[1:] != label[:-1])
    heads = np.flatnonzero(opens)
    tails = np.append(heads[1:], len(at)) - 1
    return at[heads], at[tails], step[heads], value[heads]


def _scale(codes: np.ndarray, w: int, found: _Found) -> None:
    """Runs with a period in [w, 2w), from pairs of equal minimizers that far apart.

    Grams and windows of w/2 words lie inside one period, so the least gram of a run's first window comes again one
    period later.
    """
    length = w // 2
    if len(codes) < 2 * w:
        return
    grams = Rolling(codes).every(length)
    first, last, step, value = _chains(_minimizers(grams, length), grams, found, length)
    reached: dict[int, int] = {}
    apart = 1
    seeds = []
    while apart < len(first):
        near = (value[apart:] == value[:-apart]) & (first[apart:] - last[:-apart] < 2 * w)
        if not near.any():
            break
        for i in np.flatnonzero(near):
            a, b, j = int(first[i]), int(last[i]), i + apart
            c, d = int(first[j]), int(last[j])
            by = max(1, int(step[i]), int(step[j]))
            low = c - b if c - b >= w else c - b + -(-(w - c + b) // by) * by
            # in chains, a lag at which their places meet
            seeds += [(lag, max(a, b - (lag - c + b) // by * by)) for lag in range(low, min(2 * w - 1, d - a) + 1, by)]
        apart += 1
    for lag, at in sorted(seeds):
        if at < reached.get(lag, 0) or at + lag >= len(codes) or codes[at] != codes[at + lag]:
            continue
        start, end = _reach(codes, at, lag)
        reached[lag] = end - lag
        found.add(start, end, lag)


def word_runs(codes: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs in documents of at most ``longest`` words laid side by side.

    A run has at least SHORTEST words and twice its smallest period, and no neighbour extends it.  ``codes`` are
    exact names of words; no two documents share the name that parts them.
    """
    found = _Found()
    for lag in range(1, min(SCANNED - 1, longest // 2) + 1):
        start, end = _stretches(codes[lag:] == codes[:-lag], max(SHORTEST, 2 * lag) - lag)
        for s, e in zip(start.tolist(), end.tolist()):
            found.add(s, e + lag, lag)
    w = SCANNED
    while 2 * w <= longest:
        _scale(codes, w, found)
        w *= 2
    return sorted((s, e, p) for (s, e), p in found.period.items())


def _side_by_side(texts: list[list[bytes]]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Documents of similar length together, longest first, each closed by a name of its own."""
    order = sorted((i for i, t in enumerate(texts) if len(t) >= SHORTEST), key=lambda i: -len(texts[i]))
    at = 0
    while at < len(order):
        part, held = [], 0
        while at < len(order) and (not part or held + len(texts[order[at]]) <= _TOGETHER
                                   and 2 * len(texts[order[at]]) > len(texts[part[0]])):
            part.append(order[at])
            held += len(texts[order[at]]) + 1
            at += 1
        names: dict[bytes, int] = {}
        codes = np.empty(held, np.uint64)
        place = 0
        for i in part:
            n = len(texts[i])
            codes[place:place + n] = [names.setdefault(w, len(names)) for w in texts[i]]
            codes[place + n] = (1 << 63) + i
            place += n + 1
        yield part, codes


def _describe(found: list[tuple[int, int, int]], tokens: list[bytes]) -> tuple[list, str]:
    dropped = np.zeros(len(tokens) + 1, np.int64)
    for s, e, p in found:
        dropped[s + p] += 1
        dropped[e] -= 1
    gone = np.cumsum(dropped)[:-1] > 0
    kept = b" ".join([w for w, g in zip(tokens, gone.tolist()) if not g] if found else tokens)
    return [(s, e - s, p) for s, e, p in found], kept.decode("utf-8")


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, runs, collapsed) of every row: runs as (start, length, period), the text without their repeats.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  A run is a maximal stretch of at least 12 words, and twice
    its smallest period, in which words a period apart are equal; runs are sorted by start, then period.  ``collapsed``
    keeps the words that no run holds after its first period, joined by one space.

    Runs are found within each row, so nothing is shuffled, and a long text is laid out alone.  Null and empty texts
    have no runs and an empty ``collapsed``.  Rows that repeat are each judged; null ids stay null; other columns are
    not read.
    """
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("d"), F.col(f"`{text}`").cast("binary").alias("t"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [words(t) for t in part.column(1).to_pylist()]
                found: list[list] = [[] for _ in texts]
                for members, codes in _side_by_side(texts):
                    ends = np.cumsum([len(texts[i]) + 1 for i in members])
                    for s, e, p in word_runs(codes, len(texts[members[0]])):
                        k = int(np.searchsorted(ends, s, side="right"))
                        base = int(ends[k - 1]) if k else 0
                        found[members[k]].append((s - base, e - base, p))
                told = [_describe(sorted(f, key=lambda r: (r[0], r[2])), t) for f, t in zip(found, texts)]
                runs = pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs, _ in told], run_type)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), runs, pa.array([k for _, k in told], pa.string())], names=["id", "runs", "collapsed"])

    found = narrow.mapInArrow(run, "id long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")
    return found.withColumnRenamed("id", id_col)


def run_digest(runs: list[tuple[int, int, int]]) -> str:
    """The digest of runs as text lines, for tests beside Spark's."""
    return hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
