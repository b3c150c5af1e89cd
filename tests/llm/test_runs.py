import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from tabulon.llm import queries, runs


def brute(words):
    """All maximal stretches by every lag; of equal ones the smallest period."""
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(12, 2 * p):
                found.setdefault((i, j + p), p)
            i = j
    return sorted((s, e, p) for (s, e), p in found.items())


def periodic(rnd, n, letters):
    words = [rnd.randrange(letters) for _ in range(n)]
    for _ in range(rnd.randrange(4)):
        a = rnd.randrange(n)
        p, e = rnd.randint(1, max(1, (n - a) // 2)), rnd.randint(a, n)
        for i in range(a + p, e):
            words[i] = words[i - p]
        if rnd.random() < 0.3:
            words[rnd.randrange(n)] = 99
    return words


@pytest.mark.parametrize("seed", range(60))
def test_runs_as_by_every_lag(seed):
    rnd = random.Random(seed)
    words = periodic(rnd, rnd.choice([30, 100, 400, 700]), rnd.choice([1, 2, 3, 50]))
    assert runs.word_runs(np.array(words, np.uint64), len(words)) == brute(words)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 60), st.lists(st.integers(0, 3), max_size=5),
       st.integers(1, 60))
def test_two_periodic_parts_side_by_side(unit, n, gap, m):
    words = (unit * n) + gap + (unit * m)
    assert runs.word_runs(np.array(words, np.uint64), len(words)) == brute(words)


def told(text):
    words = (text or "").encode().split()
    found = sorted(brute(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, e, p in found for i in range(s + p, e)}
    return [(s, e - s, p) for s, e, p in found], b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def test_operator_on_odd_tables(spark):
    rnd = random.Random(4)
    texts = [" ".join(f"w{x}" for x in periodic(rnd, rnd.randint(1, 400), 5)) for _ in range(120)]
    texts += [None, "", " \n", "a " * 30_000, "é ü " * 40, texts[0], "x y " * 30]
    data = [(i % 110 or None, t, "z") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(data, "doc_id long, text string, runs string").repartition(3)
    got = sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.periodic_runs(docs).collect()),
                 key=repr)
    expected = []
    for i, t, _ in data:
        if t and len(t) > 50_000:
            expected.append((i, [(0, 30_000, 1)], "a"))
        else:
            expected.append((i, *told(t)))
    assert got == sorted(expected, key=repr)
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_digest_columns(spark):
    """The query's columns from brute force, planted runs included."""
    import zlib

    rnd = random.Random(8)
    data = [(i, " ".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(0, 200)))) for i in range(150)] + [(900, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    planted = {r["doc_id"]: r["text"] for r in queries.with_planted_runs(docs).collect()}
    hit = 0
    for i, t in data:
        words, h = (t or "").split(), zlib.crc32(str(i).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            hit += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        assert (planted[i] or "").split() == words
    assert hit > 5
    found, kept = told("a b c " * 10)
    assert hashlib.sha256(b"0,30,3\n").hexdigest() == runs.run_digest(found) and kept == "a b c"
