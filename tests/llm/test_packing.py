"""Packing: every id in one piece, windows full, steps balanced."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tabulon.llm.packing import pack
from tabulon.llm.queries import packed

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, None), (2, ""), (None, "No id here."), (3, "a " * 9000), (4, "It's <|endoftext|> l'été x\x1fy z 12 ΑΣ á")]
    rows += [(10 + i, f"word{i} " * (i * 7 % 400)) for i in range(300)]
    return rows + [rows[-1]]


def test_pieces(spark, docs):
    df = spark.createDataFrame([(*r, 5) for r in docs], "doc_id long, text string, length int").repartition(3)
    got = pack(df, PATH).collect()
    tok = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for i, t in docs:
        want[i].append([*tok.encode(t or "", add_special_tokens=False).ids, 1])
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length > 0
        by_doc[r.doc_id].append((r.start, ids, r.doc_tokens))
        by_seq[r.sequence_id].append((r.offset, r.length, r.tier, r.step))
    for i, texts in want.items():
        if len(texts) == 1:
            flat = [x for _, ids, _ in sorted(by_doc[i]) for x in ids]
            assert flat == texts[0] and {n for *_, n in by_doc[i]} == {len(flat)}
    assert sum(r.length for r in got) == sum(len(t) for ts in want.values() for t in ts)
    short, steps = 0, defaultdict(int)
    for parts in by_seq.values():
        at = 0
        for offset, length, tier, step in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        short += at not in (256, 512, 1024, 2048)
        steps[step] += at
    assert short <= 3
    assert sorted(steps.values())[-len(steps) + 3:] == [16 * 2048] * (len(steps) - 3)


def test_digest(spark, docs):
    df = spark.createDataFrame(docs[:4], "doc_id long, text string")
    with_ids = {(r.doc_id, r.start): zlib.crc32(r.ids) for r in pack(df, PATH).collect()}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in packed(df).collect()} == with_ids


def test_empty(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
