"""Cross-tokenizer alignment: where the tokens of two tokenizers end together, and which pairs meet how often."""

from __future__ import annotations

import gc
import os
import re
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.plans.shared import materialise
from tabulon.plans.skew import keyed_left_join

# Bytes that a task's table of aligned segments takes at most, about; it goes with the task.
TABLE_BYTES = 96 << 20
# Longer segments are aligned, but not remembered.
_REMEMBERED = 64
# Groups with more links are counted by distinct ids.
_BIG = 4096
_CUT = re.compile(r"(?<=\S)(?= )")
_ODD = re.compile(r"\s ")
_SPACE = "▁"


def _byte_names() -> dict[str, int]:
    """Byte-level tokenizers write a byte as a printable character: itself, or one of those after U+0100 in order."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Segments:
    """Aligned segments side by side: token and group counts, groups as text, and the linked id pairs of each.

    ``pairs`` holds ``linked[i]`` pairs of segment i after each other, ``links`` how often each is meant.  A segment
    with ``whole`` false has no tokens: the joined bytes of one side are not the segment.
    """

    whole: np.ndarray
    a: np.ndarray
    b: np.ndarray
    groups: np.ndarray
    texts: list[str]
    linked: np.ndarray
    pairs: np.ndarray
    links: np.ndarray


class Aligner:
    """Aligns segments of a text that neither tokenizer's tokens reach over.

    A text is cut before each space that follows a character other than white space: byte-level pre-tokens and
    pieces hold a space at their beginning only.
    """

    def __init__(self, byte_tokenizer: str, piece_model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_tokenizer)
        self.a.encode_special_tokens = True
        names = _byte_names()
        vocabulary = {i: bytes(names[c] for c in t) if all(c in names for c in t) else t.encode()
                      for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)]
        self.b = SentencePieceProcessor(model_file=piece_model)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
                        for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.a_length, self.b_length = (np.array([len(x) for x in own]) for own in (self.a_bytes, self.b_bytes))
        self.a_names, self.b_names = (np.array([str(i) for i in range(len(own))], object) for own in (self.a_bytes, self.b_bytes))
        self.space = self.b.piece_to_id(_SPACE)

    def segments(self, text: str) -> list[str]:
        """The segments of space + text, each without its leading space."""
        if _ODD.search(" " + text) is None:
            return text.split(" ")
        return [s[1:] for s in _CUT.split(" " + text)]

    def _tokens(self, segments: list[str]):
        """Ids and coarse ends of both sides for each segment; ends of A count characters, those of B bytes."""
        coded = self.a.encode_batch([" " + s for s in segments], add_special_tokens=False)
        pieces = [p.pieces for p in self.b.encode(segments, return_type="proto", num_threads=1)]
        # pieces count from behind the space that the model adds
        return ([c.ids for c in coded], [[end for _, end in c.offsets] for c in coded],
                [[p.id for p in ps] or [self.space] for ps in pieces], [[p.end + 1 for p in ps] or [1] for ps in pieces])

    def align(self, segments: list[str]) -> Segments:
        """The segments aligned, in order.

        Most are encoded together, as one text that is cut where they meet; those that end in white space or hold the
        sign that pieces use for the space go one by one, and all do if the joined bytes are not that text.
        """
        plain = [i for i, s in enumerate(segments) if s and not s[-1].isspace() and _SPACE not in s]
        together = self._align_together([segments[i] for i in plain]) if plain else None
        if together is None:
            return self._align_each(segments)
        if len(plain) == len(segments):
            return together
        other = sorted(set(range(len(segments))) - set(plain))
        found = _joined([together, self._align_each([segments[i] for i in other])])
        return _chosen(found, np.argsort(np.array(plain + other)))

    def _align_together(self, segments: list[str]) -> Segments | None:
        text = " ".join(segments)
        coded = self.a.encode(" " + text, add_special_tokens=False)
        pieces = self.b.encode([text], return_type="proto", num_threads=1)[0].pieces
        whole = (" " + text).encode()
        a_ids, b_ids = coded.ids, [p.id for p in pieces]
        if not b"".join([self.a_bytes[i] for i in a_ids]) == whole == b"".join([self.b_bytes[i] for i in b_ids]):
            return None
        code = np.frombuffer((" " + text).encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))])
        a_coarse = at[np.array([end for _, end in coded.offsets])].tolist()
        zero = np.zeros(1, np.int64)
        a_flat, a_ends = _ends([a_ids], [a_coarse], zero + len(a_ids), zero, self.a_length)
        b_flat, b_ends = _ends([b_ids], [[p.end + 1 for p in pieces]], zero + len(b_ids), zero, self.b_length)
        stops = np.cumsum([len(s.encode()) + 1 for s in segments])
        per = [np.diff(np.searchsorted(ends, stops, side="right"), prepend=0) for ends in (a_ends, b_ends)]
        return self._segments(np.ones(len(segments), bool), a_flat, a_ends, b_flat, b_ends, *per)

    def _align_each(self, segments: list[str]) -> Segments:
        a_ids, a_coarse, b_ids, b_coarse = self._tokens(segments)
        texts = [(" " + s).encode() for s in segments]
        whole = np.ones(len(segments), bool)
        for i, t in enumerate(texts):
            if not b"".join([self.a_bytes[x] for x in a_ids[i]]) == t == b"".join([self.b_bytes[x] for x in b_ids[i]]):
                whole[i] = False
                a_ids[i] = a_coarse[i] = b_ids[i] = b_coarse[i] = []
            elif len(t) > len(segments[i]) + 1:
                # characters of several bytes: their offsets become byte offsets
                at = np.cumsum([0] + [len(c.encode()) for c in " " + segments[i]]).tolist()
                a_coarse[i] = [at[x] for x in a_coarse[i]]
        a_count, b_count = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
        base = np.cumsum([0] + [len(t) for t in texts])[:-1]
        a_flat, a_ends = _ends(a_ids, a_coarse, a_count, base, self.a_length)
        b_flat, b_ends = _ends(b_ids, b_coarse, b_count, base, self.b_length)
        return self._segments(whole, a_flat, a_ends, b_flat, b_ends, a_count, b_count)

    def _segments(self, whole, a_flat, a_ends, b_flat, b_ends, a_count, b_count) -> Segments:
        """Groups and links of segments from all tokens and their ends."""
        n = len(whole)
        a_cut, b_cut = (np.isin(x, y, assume_unique=True, kind="sort") for x, y in ((a_ends, b_ends), (b_ends, a_ends)))
        # tokens of a side up to the end of each group; groups end with their segment at the latest
        a_stop, b_stop = np.flatnonzero(a_cut) + 1, np.flatnonzero(b_cut) + 1
        a_in, b_in = np.diff(a_stop, prepend=0), np.diff(b_stop, prepend=0)
        owner = np.repeat(np.arange(n), a_count)[a_stop - 1]
        pairs, links, group = _links(a_flat, b_flat, a_stop, b_stop, a_in, b_in)
        groups = np.bincount(owner, minlength=n)
        told = _told(self.a_names[a_flat].tolist(), self.b_names[b_flat].tolist(), a_stop, b_stop, groups)
        return Segments(whole, a_count, b_count, groups, told, np.bincount(owner[group], minlength=n), pairs, links)


def _ends(ids, coarse, count, base, length) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all tokens and their ends in bytes.

    Coarse ends are right for a token that ends alone: behind the one before it and before the next.  The others,
    parts of a character and byte pieces, end where the decoded bytes since their segment's begin say.
    """
    n = int(count.sum())
    flat, ends = (np.fromiter(chain.from_iterable(x), np.int64, n) for x in (ids, coarse))
    if not n:
        return flat, ends
    opens = np.zeros(n, bool)
    opens[(np.cumsum(count) - count)[count > 0]] = True
    alone = ends > 0
    alone[1:] &= opens[1:] | (ends[1:] > ends[:-1])
    alone[:-1] &= opens[1:] | (ends[1:] > ends[:-1])
    run = np.cumsum(length[flat])
    before = np.repeat((run - length[flat])[opens], count[count > 0])
    return flat, np.repeat(base, count) + np.where(alone, ends, run - before)


def _links(a, b, a_stop, b_stop, a_in, b_in) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked pairs, how often each is meant, and their group; long groups are counted by distinct ids."""
    big = a_in * b_in > _BIG
    n = np.where(big, 0, a_in * b_in)
    group = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    left = a[(a_stop - a_in)[group] + at // b_in[group]] if len(group) else at
    right = b[(b_stop - b_in)[group] + at % b_in[group]] if len(group) else at
    pairs, links = left << 32 | right, np.ones(len(group), np.int64)
    for g in np.flatnonzero(big).tolist():
        x, n = np.unique(a[a_stop[g] - a_in[g]:a_stop[g]], return_counts=True)
        y, m = np.unique(b[b_stop[g] - b_in[g]:b_stop[g]], return_counts=True)
        place = int(np.searchsorted(group, g))
        pairs = np.insert(pairs, place, (x[:, None] << 32 | y).ravel())
        links = np.insert(links, place, (n[:, None] * m).ravel())
        group = np.insert(group, place, np.full(len(x) * len(y), g))
    return pairs, links, group


def _told(left: list[str], right: list[str], a_stop, b_stop, groups) -> list[str]:
    """Each segment's groups as text."""
    parts, i, j = [], 0, 0
    for k, m in zip(a_stop.tolist(), b_stop.tolist()):
        if k - i == 1 and m - j == 1:
            parts.append(f"{left[i]}|{right[j]}")
        else:
            parts.append(f"{','.join(left[i:k])}|{','.join(right[j:m])}")
        i, j = k, m
    out, at = [], 0
    for n in groups.tolist():
        out.append(parts[at] if n == 1 else ";".join(parts[at:at + n]))
        at += n
    return out


class _Table:
    """Aligned segments of one task by their text, in bounded memory.

    When it is full, new segments are aligned for the documents at hand only; when four times as many were new as it
    holds, it starts anew, so that it follows a change of language.
    """

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        self.clear()

    def clear(self):
        self.place: dict[str, int] = {}
        self.kept = self.aligner.align([])
        self.held, self.strangers = 0, 0

    def of(self, documents: list[list[str]]) -> tuple[list[np.ndarray], Segments]:
        """Places of the documents' segments, and the segments they point into."""
        if self.strangers > 4 * len(self.place):
            self.clear()
        missing = list({s for d in documents for s in d if s not in self.place})
        new = [self.aligner.align(missing[at:at + 2000]) for at in range(0, len(missing), 2000)]
        here = _joined([self.kept, *new])
        place = {s: i for i, s in enumerate(missing, len(self.place))}
        get, other = self.place.get, place.__getitem__
        places = [np.array([other(s) if (p := get(s)) is None else p for s in d], np.int64) for d in documents]
        if self.held <= TABLE_BYTES and all(len(s) <= _REMEMBERED for s in missing):
            self.place |= place
            self.kept = here
            self.held += sum(400 + 2 * len(s) for s in missing) + sum(16 * len(n.pairs) for n in new)
        elif self.held <= TABLE_BYTES:  # without the long ones
            short = [s for s in missing if len(s) <= _REMEMBERED]
            for at in range(0, len(short), 2000):
                self.place |= {s: i for i, s in enumerate(short[at:at + 2000], len(self.place))}
            self.kept = _joined([self.kept, _chosen(here, np.array([place[s] for s in short], np.int64))])
            self.held += sum(500 + 2 * len(s) for s in short)
        else:
            self.strangers += len(missing)
        return places, here


def _joined(parts: list[Segments]) -> Segments:
    if len(parts) == 1:
        return parts[0]
    return Segments(*[[x for p in parts for x in p.texts] if f == "texts" else
                      np.concatenate([getattr(p, f) for p in parts]) for f in Segments.__dataclass_fields__])


def _pair_slots(found: Segments, places: np.ndarray) -> np.ndarray:
    """Where the pairs of the segments at ``places`` are, one after the other."""
    n = found.linked[places]
    begin = (np.cumsum(found.linked) - found.linked)[places]
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


def _chosen(found: Segments, places: np.ndarray) -> Segments:
    slots = _pair_slots(found, places)
    return Segments(found.whole[places], found.a[places], found.b[places], found.groups[places],
                    [found.texts[i] for i in places.tolist()], found.linked[places], found.pairs[slots], found.links[slots])


def _documents(table: _Table, texts: list[str | None]) -> list[pa.Array]:
    """Columns of ``align`` for a few documents."""
    segments = [table.aligner.segments(t) if t else [] for t in texts]
    places, found = table.of(segments)
    good = [len(p) > 0 and bool(found.whole[p].all()) for p in places]
    sizes = np.array([len(p) if g else 0 for p, g in zip(places, good)])
    flat = np.concatenate([np.zeros(0, np.int64), *[p for p, g in zip(places, good) if g]])
    slots = _pair_slots(found, flat)
    doc = np.repeat(np.repeat(np.arange(len(texts)), sizes), found.linked[flat])
    pairs, links = found.pairs[slots], found.links[slots]
    order = np.lexsort((pairs, doc))
    doc, pairs, links = doc[order], pairs[order], links[order]
    opens = np.ones(len(doc), bool)
    opens[1:] = (doc[1:] != doc[:-1]) | (pairs[1:] != pairs[:-1])
    at = np.flatnonzero(opens)
    links = np.add.reduceat(links, at) if len(at) else links
    distinct = np.bincount(doc[at], minlength=len(texts))
    ends = pa.array(np.concatenate([[0], np.cumsum(distinct)]).astype(np.int32))
    owner = np.repeat(np.arange(len(texts)), sizes)
    counts = [np.bincount(owner, c[flat], len(texts)).astype(np.int64) for c in (found.a, found.b, found.groups)]
    counts.append(np.bincount(doc[at], links, len(texts)).astype(np.int64))
    told = [";".join([found.texts[i] for i in p.tolist()]) if g else "" for p, g in zip(places, good)]
    return [*map(pa.array, counts), pa.array(told, pa.string()), pa.ListArray.from_arrays(ends, pa.array(pairs[at])),
            pa.ListArray.from_arrays(ends, pa.array(links))]


def align(docs: DataFrame, byte_tokenizer: str, piece_model: str, id_col: str = "doc_id",
          text: str = "text") -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups, pairs, links) of every row.

    space + text is encoded by a byte-level tokenizer file (A) and the text by a piece model (B, which adds the space);
    both paths are the same on every machine.  Byte offsets where tokens of both end cut them into groups, told as
    ``a1,a2|b1;a3|b2,b3``; every A-B pair inside a group is a link.  ``pairs`` are the distinct linked id pairs,
    A * 2**32 + B, and ``links`` how often each is linked; ``row`` names the row, whatever its id.

    Character offsets and piece spans give coarse cuts; tokens inside one character and byte pieces are cut by their
    decoded bytes.  Segments between white space are aligned once and remembered by the task, in bounded memory.
    Texts that are null, empty, or not what the joined token bytes of a side say, have no tokens: zeros, an empty
    ``groups``, no pairs.  Repeated rows are aligned each; null ids stay null; other columns are not read.
    """
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("d"), F.col(f"`{text}`").cast("string").alias("t"))
    names = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"]

    def run(batches):
        # nothing here makes reference cycles, and looking for them among many tokens takes time
        gc.disable()
        try:
            yield from told(batches)
        finally:
            gc.enable()

    def told(batches):
        table, row = _Table(Aligner(byte_tokenizer, piece_model)), TaskContext.get().partitionId() << 33
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                # a few documents at a time, so that long ones do not meet in memory
                n, held = 0, 0
                while at + n < batch.num_rows and n < 200 and (not n or held < 1 << 20):
                    held += len(batch.column(1)[at + n].as_py() or "")
                    n += 1
                part = batch.slice(at, n)
                rows = pa.array(np.arange(row, row + n))
                yield pa.RecordBatch.from_arrays(
                    [rows, part.column(0), *_documents(table, part.column(1).to_pylist())], names=names)
                at, row = at + n, row + n

    return narrow.mapInArrow(
        run, "row long, id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, "
             "links array<long>").withColumnRenamed("id", id_col)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, a, b, docs, best): in how many rows each id pair is linked, and whether no pair of its A id has more.

    An A id has as many pairs as B has ids at most, so its pairs may meet in one task.
    """
    counts = materialise(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(
        F.count("*").alias("docs")).withColumn("a", F.shiftright("pair", 32)), "pairs")
    most = counts.groupBy("a").agg(F.max("docs").alias("most"))
    return counts.join(most, "a").select("pair", "a", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("b"), "docs",
                                         (F.col("docs") == F.col("most")).alias("best"))


def link_statistics(docs: DataFrame, byte_tokenizer: str, piece_model: str, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``align`` with the corpus-wide counts of each row's links, and a digest of its groups in their place.

    Adds ``n_best`` (links whose pair has its A id's highest count, ties included), ``count_sum`` (counts added over the
    links) and ``groups_sha256`` (of ``groups``, empty without tokens).  Pairs linked in many rows are spread over all
    tasks when their counts are joined; the counts are broadcast only where their number is small.
    """
    groups = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    rows = materialise(align(docs, byte_tokenizer, piece_model, id_col, text).withColumn("groups_sha256", groups)
                       .drop("groups"), "aligned")
    counts = materialise(pair_counts(rows).select("pair", "docs", "best"), "counts")
    held = rows.select("row", F.inline(F.arrays_zip("pairs", "links")).alias("pair", "n"))
    told = keyed_left_join(held, counts, ["pair"], "left", right_rows=counts.count())
    sums = told.groupBy("row").agg(F.sum(F.expr("if(best, n, 0L)")).alias("n_best"),
                                   F.sum(F.expr("n * docs")).alias("count_sum"))
    return rows.drop("pairs", "links").join(sums, "row", "left").fillna(0, ["n_best", "count_sum"])
