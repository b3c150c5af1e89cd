"""Substring dedup: documents cut into content-defined blocks that are looked up in an index of all documents' blocks."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.words import BASES, Codes, Rolling, long_lists, per_batch, words
from tabulon.plans.shared import broadcast_if_small, materialise

# Words of the piece that names a block; a block is found in any window that holds it whole.
ANCHOR = 16
# Document ids sent to every executor at most, 8 bytes each; beyond that the texts are shuffled instead.
IDS_BROADCAST = 1_000_000


def _blocks(codes: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(anchor, block, first window, windows) of a document's blocks.

    Every window is dealt to the piece of ANCHOR words in it with the least hash, which depends on the window's
    words alone; a block is a run of windows with one such piece and covers all their words.
    """
    if len(codes) < window:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    pieces = Rolling(codes, BASES[0]).every(ANCHOR)
    least = np.lib.stride_tricks.sliding_window_view(pieces, window - ANCHOR + 1).argmin(axis=1)
    least = least + np.arange(len(least))
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    count = np.diff(np.concatenate([first, [len(least)]]))
    return pieces[least[first]], Rolling(codes, BASES[1]).windows(first, first + count + window - 1), first, count


def _parse(docs: DataFrame, window: int) -> DataFrame:
    """One row per document: its number of words, the SHA-256 of its words, its blocks as parallel lists."""

    def run(kept, texts):
        codes = run.codes = getattr(run, "codes", None) or Codes()
        found = [words(t) for t in texts]
        blocks = [_blocks(codes.of(w), window) for w in found]
        sizes = np.array([len(b[0]) for b in blocks], np.int64)
        flat = [np.concatenate([b[i] for b in blocks]) if blocks else np.empty(0) for i in range(4)]
        return {"doc_id": kept[0], "n_words": pa.array([len(w) for w in found], pa.int64()),
                "sha": [hashlib.sha256(b" ".join(w)).hexdigest() for w in found],
                "anchor": long_lists(flat[0], sizes), "block": long_lists(flat[1], sizes),
                "place": long_lists(flat[2] * 64 + flat[3], sizes)}

    return per_batch(docs, "text", ["doc_id"], run, "doc_id long, n_words long, sha string, anchor array<long>, "
                                                    "block array<long>, place array<long>")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(broadcast_if_small(materialise(ids, "ids"), IDS_BROADCAST), "doc_id", "left_semi")


def _windows(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """(anchor, block, doc_id, at, w1, w2): the single windows of the wanted blocks (doc_id, anchor, block, place)."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "block", "place")).alias("want"))
    rows = _texts(docs, wanted.select("doc_id").distinct()).dropDuplicates(["doc_id"]).join(lists, "doc_id")
    rows = rows.select("doc_id", "text", "want.anchor", "want.block", "want.place")

    def run(kept, texts):
        codes = run.codes = getattr(run, "codes", None) or Codes()
        out = [[] for _ in range(6)]
        for row, t in enumerate(texts):
            found = codes.of(words(t))
            place = kept[3][row].values.to_numpy()
            first, count = place // 64, place % 64
            of = np.repeat(np.arange(len(place)), count)
            at = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            start = first[of] + at
            fits = start + window <= len(found)
            of, at, start = of[fits], at[fits], start[fits]
            for i, x in enumerate((kept[1][row].values.to_numpy()[of], kept[2][row].values.to_numpy()[of],
                                   np.full(len(of), kept[0][row].as_py(), np.int64), at,
                                   *(Rolling(found, b).windows(start, start + window).view(np.int64) for b in BASES))):
                out[i].append(x)
        flat = [np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in out]
        return dict(zip(("anchor", "block", "doc_id", "at", "w1", "w2"), flat))

    return per_batch(rows, "text", ["doc_id", "anchor", "block", "place"], run,
                     "anchor long, block long, doc_id long, at long, w1 long, w2 long")


def repeated_blocks(docs: DataFrame, parsed: DataFrame, window: int) -> DataFrame:
    """(doc_id, place, mask): blocks with windows that start in an earlier document too.

    Bit i of the mask stands for the block's i-th window.
    """
    every = parsed.filter("doc_id is not null").select(
        "doc_id", F.explode(F.arrays_zip("anchor", "block", "place")).alias("b")).select("doc_id", "b.*")
    known = every.groupBy("anchor").agg(F.min("doc_id").alias("m"), F.max("doc_id").alias("x")).filter("m < x")
    shared = materialise(every.join(known.select("anchor"), "anchor"), "shared")
    # the index: every reference block, with the first document that holds it
    index = materialise(shared.groupBy("anchor", "block").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("held")), "index")
    # blocks that share a piece but not all their words: factors end inside, so they are checked window by window
    several = index.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    ends = (shared.join(index, ["anchor", "block"]).filter("doc_id = first")
            .groupBy("anchor", "block", "doc_id").agg(F.min("place").alias("place"))
            .join(several, "anchor"))
    single = materialise(_windows(docs, materialise(ends, "ends"), window), "windows")
    earliest = single.groupBy("w1", "w2").agg(F.min("doc_id").alias("m"), F.max("doc_id").alias("x")).filter("m < x")
    partly = (single.join(earliest, ["w1", "w2"]).filter("m < doc_id").groupBy("anchor", "block")
              .agg(F.expr("bit_or(shiftleft(1L, cast(at as int)))").alias("mask")))
    found = index.filter("held > 1").select("anchor", "block", "first").join(
        partly, ["anchor", "block"], "full").withColumn("mask", F.coalesce("mask", F.lit(0)))
    rows = shared.join(found, ["anchor", "block"])
    return rows.select("doc_id", "place", F.when(F.col("doc_id") > F.col("first"), F.lit(-1).cast("long"))
                       .otherwise(F.col("mask")).alias("mask")).filter("mask <> 0")


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_sha256): words inside windows that an earlier document holds too.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  Content-cut blocks of all documents form the index.  A document
    is cut into blocks, in place of a greedy parse into longest factors; blocks known from a smaller doc_id go
    whole, and blocks that differ under one anchor are compared window by window, over all documents that share
    it.  Together this gives exactly the words covered by a window of ``window`` words that also starts in a smaller doc_id.
    ``spans`` lists them as [start, end) word places; ``kept_sha256`` is of the other words joined by a space.

    Null and empty texts have no words; rows without a doc_id lose nothing and count as no source.  Repeated rows
    get the same result each; rows that share a doc_id but not the text are cut by the spans of both.  Other
    columns are not read.  Blocks, the index and single windows go through shuffles; a list per document is
    bounded by its length, and common passages are pre-aggregated by block.
    """
    if not ANCHOR < window < ANCHOR + 60:
        raise ValueError("window must be longer than an anchor, and by less than 60 words")
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    parsed = materialise(_parse(docs, window), "parsed")
    found = materialise(repeated_blocks(docs, parsed, window).groupBy("doc_id").agg(
        F.collect_list("place").alias("place"), F.collect_list("mask").alias("mask")), "found")
    rows = _texts(docs, found.select("doc_id")).join(found, "doc_id")

    def run(kept, texts):
        out = {"doc_id": kept[0], "n_words": [], "n_removed": [], "start": [], "end": [], "kept_sha256": []}
        for row, t in enumerate(texts):
            all_words = words(t)
            n = len(all_words)
            place, mask = kept[1][row].values.to_numpy(), kept[2][row].values.to_numpy()
            count = place % 64
            of = np.repeat(np.arange(len(place)), count)
            at = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            start = (place // 64)[of] + at
            start = start[((mask[of] >> at) & 1).astype(bool) & (start + window <= n)]
            depth = np.zeros(n + 1, np.int64)
            np.add.at(depth, start, 1)
            np.add.at(depth, start + window, -1)
            gone = np.cumsum(depth)[:n] > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            out["n_words"].append(n)
            out["n_removed"].append(int(gone.sum()))
            out["start"].append(edge[::2].tolist())
            out["end"].append(edge[1::2].tolist())
            left = [all_words[i] for i in np.flatnonzero(~gone)]
            out["kept_sha256"].append(hashlib.sha256(b" ".join(left)).hexdigest())
        kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "start": pa.list_(pa.int64()),
                 "end": pa.list_(pa.int64()), "kept_sha256": pa.string()}
        return {k: pa.array(v, kinds[k]) if k in kinds else v for k, v in out.items()}

    cut = per_batch(rows, "text", ["doc_id", "place", "mask"], run, "doc_id long, n_words long, n_removed long, "
                    "start array<long>, end array<long>, kept_sha256 string")
    cut = cut.select("doc_id", "n_words", "n_removed", F.arrays_zip("start", "end").alias("spans"), "kept_sha256")
    whole = parsed.select("doc_id", "n_words", "sha").join(found.select("doc_id"), "doc_id", "left_anti").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"),
        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"), F.col("sha").alias("kept_sha256"))
    return cut.unionByName(whole)
