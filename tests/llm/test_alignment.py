import hashlib
import random
from collections import Counter

import pytest

from tabulon.llm import alignment

public_tokenizers = pytest.importorskip("public_tokenizers")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = "ab \n\t\r  é🙂▁<|endoftext|>'s12., 　中文字́e‍Z\x00\x0b\x85 �"


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(A, B)


def brute(al, text):
    """Whole texts encoded at once, groups from decoded bytes, all pairs of each group."""
    if not text:
        return 0, 0, 0, 0, "", {}
    a, b = al.a.encode(" " + text, add_special_tokens=False).ids, al.b.encode(text)
    own = [[al.a_bytes[i] for i in a], [al.b_bytes[i] for i in b]]
    if any(b"".join(o) != (" " + text).encode() for o in own):
        return 0, 0, 0, 0, "", {}
    ends = [[sum(map(len, o[:i + 1])) for i in range(len(o))] for o in own]
    cuts, start = sorted(set(ends[0]) & set(ends[1])), 0
    groups, links = [], Counter()
    for cut in cuts:
        x = [i for i, e in zip(a, ends[0]) if start < e <= cut]
        y = [i for i, e in zip(b, ends[1]) if start < e <= cut]
        groups.append(f"{','.join(map(str, x))}|{','.join(map(str, y))}")
        links.update(p << 32 | q for p in x for q in y)
        start = cut
    return len(a), len(b), len(groups), sum(links.values()), ";".join(groups), dict(links)


def texts(seed, n):
    rnd = random.Random(seed)
    plain = ["The quick brown fox", "naïve café — Ünïcödé", "def f(x):\n    return x\r\n", "中文 字 texts", "a" * 700, "🙂" * 40]
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(40))) for _ in range(n)] + plain + [
        None, "", " ", "  ", " a", "a ", "\n", "<s> </s>", "<0x0A>", "<unk>", "▁"]


def test_segments_align_as_whole_texts(aligner):
    table = alignment._Table(aligner)
    for seed in range(3):
        part = texts(seed, 400)
        cols = [c.to_pylist() for c in alignment._documents(table, part)]
        for i, t in enumerate(part):
            want = brute(aligner, t)
            assert tuple(c[i] for c in cols[:5]) == want[:5], repr(t)
            assert dict(zip(cols[5][i], cols[6][i])) == want[5], repr(t)


def test_a_full_table_and_long_groups_change_nothing(aligner, monkeypatch):
    part = texts(9, 300) + ["word" * 100 + " " + "é" * 300]
    want = [c.to_pylist() for c in alignment._documents(alignment._Table(aligner), part)]
    monkeypatch.setattr(alignment, "TABLE_BYTES", 5_000)
    monkeypatch.setattr(alignment, "_BIG", 1)
    table = alignment._Table(aligner)
    for _ in range(3):
        got = [[] for _ in want]
        for at in range(0, len(part), 50):
            for col, more in zip(got, alignment._documents(table, part[at:at + 50])):
                col += more.to_pylist()
        assert got == want
    assert table.held < 200_000


def test_statistics_as_by_brute_force(spark, aligner):
    data = [(i % 95 or None, t, "x") for i, t in enumerate(texts(4, 90))]
    docs = spark.createDataFrame(data, "doc_id long, text string, n_a string").repartition(3)
    told = [(i, brute(aligner, t)) for i, t, _ in data]
    count = Counter(p for _, w in told for p in w[5])
    most = {}
    for p, n in count.items():
        most[p >> 32] = max(most.get(p >> 32, 0), n)
    want = sorted(((i, *w[:4], sum(n for p, n in w[5].items() if count[p] == most[p >> 32]),
                    sum(n * count[p] for p, n in w[5].items()), hashlib.sha256(w[4].encode()).hexdigest() if w[2] else "")
                   for i, w in told), key=repr)
    found = alignment.link_statistics(docs, A, B).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    # the counts joined by shuffle, hot pairs spread, say the same
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("tabulon.plans.skew.BROADCAST_ROWS", 1)
        again = alignment.link_statistics(docs, A, B).select(*found.columns)
        assert sorted((tuple(r) for r in again.collect()), key=repr) == want
    assert alignment.link_statistics(docs.limit(0), A, B).count() == 0
