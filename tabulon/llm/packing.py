"""Hierarchical packing: documents cut and packed into windows of several context sizes, in balanced steps."""

from __future__ import annotations

import functools
import gc
import json
import os
from bisect import bisect_left, insort
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (256, 512, 1024, 2048)
# Tokens that wait for a partner at most, in each task.
POOL_TOKENS = 1 << 16
STEP_WINDOWS = 16
# Pieces that a worker process remembers at most, some 200 bytes each.
REMEMBERED = 3 << 17
# Bytes of text that are told apart together, but for one text, which stays whole.
TOGETHER = 8 << 20


class Encoder:
    """Token ids of texts, by pieces between white space; at most ``remembered`` pieces are kept in mind.

    The tokenizer's own rules never reach over white space, so its ids of a text are those of the pieces.  Pieces of
    a batch are told apart in Arrow, new ones are tokenised once, and ids are gathered for all texts together.  When
    the table is full, new pieces serve the batch at hand only; when four times as many were new as it holds, it
    starts anew, so that it follows a change of language.
    """

    def __init__(self, path: str, end: int, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end, self.remembered = Tokenizer.from_file(path), end, remembered
        rules = json.loads(self.tokenizer.to_str())["normalizer"] or {}
        # a tokenizer that takes capitals for small letters has one table entry for both
        self.lower = any(r.get("type") == "Lowercase" for r in rules.get("normalizers", [rules]))
        self._clear()

    def _clear(self):
        self.place: dict[str, int] = {"": 0}
        self.ids, self.counts, self.strangers = np.zeros(0, np.uint32), np.zeros(1, np.int64), 0

    def _coded(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = [c.ids for c in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        counts = np.fromiter(map(len, coded), np.int64, len(coded))
        return np.fromiter(chain.from_iterable(coded), np.uint32, int(counts.sum())), counts

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text (binary UTF-8), closed by ``end``."""
        whole = texts.cast(pa.string()).fill_null("")
        whole = pc.ascii_lower(whole) if self.lower else whole
        split = pc.ascii_split_whitespace(whole)
        coded = split.flatten().dictionary_encode()
        if self.strangers > 4 * len(self.place):
            self._clear()
        pieces = coded.dictionary.to_pylist()
        place = np.fromiter(map(self.place.get, pieces, repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(place < 0)
        ids, counts = self.ids, self.counts
        if len(new):
            missing = [pieces[i] for i in new.tolist()]
            new_ids, new_counts = self._coded(missing)
            place[new] = np.arange(len(counts), len(counts) + len(new))
            ids, counts = np.concatenate([ids, new_ids]), np.concatenate([counts, new_counts])
            if len(self.place) + len(new) <= self.remembered:
                self.place.update(zip(missing, range(len(self.counts), len(counts))))
                self.ids, self.counts = ids, counts
            else:
                self.strangers += len(new)
        at = place[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int64)
        n = counts[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        begin = (np.cumsum(counts) - counts)[at]
        flat = ids[np.repeat(begin - ends[:-1], n) + np.arange(ends[-1])]
        # the lists of a slice count from its first one
        of_text = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]).astype(np.int64)
        close = np.array([self.end], np.uint32)
        stops = ends[of_text].tolist()
        return [np.concatenate([flat[i:j], close]) for i, j in zip(stops, stops[1:])]


@functools.lru_cache(maxsize=1)
def encoder(path: str, end: int, remembered: int) -> Encoder:
    """One encoder for all tasks of a worker process: the file is read once, and pieces stay known."""
    return Encoder(path, end, remembered)


class Packer:
    """Packs pieces (length, number, doc_id, start, ids, doc_tokens) of one task; ``windows`` is what is full."""

    def __init__(self, tiers=TIERS, pool_tokens: int = POOL_TOKENS):
        self.tiers, self.most, self.pool_tokens = tiers, tiers[-1], pool_tokens
        self.pool, self.waiting, self.number = [], 0, 0

    def _put(self, doc, start, ids, total):
        self.number += 1
        insort(self.pool, (len(ids), self.number, doc, start, ids, total), key=lambda p: p[:2])
        self.waiting += len(ids)

    def _take(self, at):
        piece = self.pool.pop(at)
        self.waiting -= piece[0]
        return piece

    def _fill(self, size):
        """One window of exactly ``size`` tokens, or of all that waits: longest first, best fits, then one cut."""
        window, gap = [], size
        while gap and self.pool:
            at = bisect_left(self.pool, gap + 1, key=lambda p: p[0]) - 1
            if at >= 0:
                piece = self._take(at)
            else:  # nothing fits: the shortest waiting piece fills the gap, its rest is routed again
                _, _, doc, start, ids, total = self._take(0)
                self._put(doc, start + gap, ids[gap:], total)
                piece = (gap, 0, doc, start, ids[:gap], total)
            window.append(piece)
            gap -= piece[0]
        return window

    def add(self, doc, ids):
        total, start = len(ids), 0
        while total - start >= self.most:
            yield [(self.most, 0, doc, start, ids[start:start + self.most], total)]
            start += self.most
        if start < total:
            self._put(doc, start, ids[start:], total)
        while self.waiting > self.pool_tokens:
            yield self._next()

    def _next(self):
        longest = self.pool[-1][0]
        return self._fill(next(t for t in self.tiers if t >= longest))

    def rest(self):
        """What still waits, in full windows as long as there are enough tokens for one."""
        while self.pool:
            longest = next(t for t in self.tiers if t >= self.pool[-1][0])
            whole = [t for t in self.tiers if t <= self.waiting]
            yield self._fill(min(longest, whole[-1]) if whole else self.most)


class Steps:
    """Deals windows to steps of equal tokens: two windows of a size make one of the next, 16 of the longest a step."""

    def __init__(self, most: int, windows: int):
        self.most, self.windows, self.held, self.step, self.filled = most, windows, {}, 0, 0

    def add(self, window):
        size, bundle = sum(p[0] for p in window), [window]
        while size < self.most and size in self.held:
            bundle = self.held.pop(size) + bundle
            size *= 2
        if size < self.most:
            self.held[size] = bundle
            return []
        out = [(self.step, w) for w in bundle]
        self.filled += 1
        if self.filled == self.windows:
            self.step, self.filled = self.step + 1, 0
        return out

    def rest(self):
        return [(self.step, w) for size in sorted(self.held, reverse=True) for w in self.held[size]]


def _parts(batch: pa.RecordBatch, together: int):
    """Consecutive rows with about ``together`` bytes of text."""
    number = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // together
    starts = np.flatnonzero(np.diff(number, prepend=-1)).tolist() if batch.num_rows else []
    for at, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(at, end - at)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", end: int = 1,
         tiers: tuple[int, ...] = TIERS, step_windows: int = STEP_WINDOWS, remembered: int = REMEMBERED,
         together: int = TOGETHER) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset, tier, step): where each piece of a text goes.

    ``tokenizer`` is the path of a tokenizer file on every machine; ``end`` closes each document.  ``tiers`` are
    powers of two.  Documents fill windows of the longest tier; their rests are routed to the shortest tier that
    holds them, packed there best fit first, and gaps are filled from shorter tiers, by one cut if nothing fits.
    So windows are full, but for one at most in each task, which is padded to the longest tier.  ``ids`` are
    little-endian 32-bit ids; ``step`` groups 16 x the longest tier of tokens within a task.

    ``remembered`` and ``together`` bound the memory of a worker: pieces whose ids are kept in mind, and bytes of text told
    apart at once; they change no result.

    Each task packs its own rows with a bounded pool, so nothing is shuffled; hand it a stored table, whose rows
    come in the same order when a task runs again.  Null and empty texts are one token, ``end``.  Repeated rows
    are packed each; a null doc_id stays null.  Other columns are not read.
    """
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("d"), F.col(f"`{text}`").cast("binary").alias("t"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                        ("tier", pa.int32()), ("step", pa.int64())])

    def run(batches):
        # nothing here makes reference cycles, and looking for them among many tokens takes time
        gc.disable()
        try:
            yield from packed(batches)
        finally:
            gc.enable()

    def packed(batches):
        first = TaskContext.get().partitionId() << 36
        encode, packer, steps = encoder(tokenizer, end, remembered), Packer(tiers), Steps(tiers[-1], step_windows)
        rows, count = [], 0

        def deal(found):
            nonlocal count
            for step, window in found:
                offset, size = 0, sum(p[0] for p in window)
                tier = size if size in tiers else tiers[-1]
                for length, _, doc, start, ids, total in window:
                    rows.append((doc, start, length, ids.astype("<u4").tobytes(), total, first + count, offset, tier, first + step))
                    offset += length
                count += 1

        def batch():
            cols = list(zip(*rows)) or [()] * len(schema)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for b in batches:
            for part in _parts(b, together):
                for doc, ids in zip(part.column(0).to_pylist(), encode(part.column(1))):
                    for window in packer.add(doc, ids):
                        deal(steps.add(window))
                if rows:
                    yield batch()
        for window in packer.rest():
            deal(steps.add(window))
        deal(steps.rest())
        yield batch()

    return narrow.mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, "
                                  "sequence_id long, offset long, tier int, step long")
