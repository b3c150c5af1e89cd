"""Statistics against brute force; rules learned from planted labels."""

import re
from collections import Counter

import numpy as np

from tabulon.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text or "")
    win = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    hit = {i + j for i in range(len(w) - 4) if win[tuple(w[i:i + 5])] > 1 for j in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
        seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_statistics(spark, corpus):
    rows = corpus(5, n=40) + [(900_000, "a b c d e a b c d e x"), (900_001, "x\n\n x\nx\n\nx # é| "), (900_002, "k " * 50),
                              (900_003, "one two\r\none two\r\n"), (None, "a b")]
    got = {r.doc_id: tuple(r[c] for c in rules.COUNTS[:5]) for r in rules.statistics(
        spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_words long")).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_rules_find_planted_junk(spark):
    rnd = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(600):
        words = [f"w{rnd.integers(5000)}" for _ in range(60)]
        bad = i % 5 == 0
        if bad and i % 2:
            words = [x + "###" for x in words]
        elif bad:
            words = [x for x in words[:12] for _ in range(5)][:60:1]
            words = [w for pair in zip(words, words) for w in pair][:60]
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, int(not bad)))
    out = rules.judge(spark.createDataFrame(rows, "doc_id long, text string"),
                      spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, quality int"))
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert kept == {i: i % 5 != 0 for i in range(600)}


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, None), (3, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = rules.judge(docs, none).select("doc_id", "base_failed", "kept", "rule")
    assert sorted(map(tuple, out.collect())) == [(1, False, True, None), (2, True, False, None), (3, True, False, None)]
    assert rules.judge(docs.limit(0), none).count() == 0


def test_the_list_goes_on_after_a_rule_that_is_not_precise():
    """The first rule grown is right on the growing rows only; the next one is found all the same."""
    rng = np.random.default_rng(4)
    n = 900
    x = np.column_stack([rng.random(n), rng.random(n)])
    part = np.random.default_rng(7).permutation(n) % 3 > 0
    bad = (x[:, 1] > 0.8) & (rng.random(n) < 0.99)
    # junk of the growing rows that the pruning rows do not confirm
    lure = x[:, 0] > 0.7
    bad = np.where(lure & part, True, bad)
    found = rules.learn(x, bad, ["a", "b"])
    assert any(name == "b" and sign > 0 and 0.7 < limit < 0.9 for rule in found.rules for name, sign, limit in rule)
    assert not any([name for name, _, _ in rule] == ["a"] for rule in found.rules)


def test_rules_hold_one_bound_of_a_kind():
    assert rules._simple([("a", -1, 0.6), ("b", 1, 2.0), ("a", -1, 0.5), ("a", 1, 0.1), ("b", 1, 1.0)]) == [
        ("a", -1, 0.5), ("b", 1, 2.0), ("a", 1, 0.1)]
    ok = {("b",): (9, 9), ("a", "b"): (5, 6), ("a",): (5, 9)}
    short = rules._pruned([("a", 1, 0.0), ("b", 1, 0.0)], lambda r: ok[tuple(n for n, _, _ in r)])
    assert short[-1] == [("b", 1, 0.0)]


def test_the_drawn_rows_are_those_of_the_least_hashes(spark):
    from pyspark.sql import functions as F

    from tabulon.llm.fitting import drawn

    ids = spark.range(5000).withColumnRenamed("id", "doc_id")
    want = [r[0] for r in ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(300).collect()]
    assert sorted(r[0] for r in drawn(ids, 300).collect()) == sorted(want)
    assert drawn(ids.limit(10), 300).count() == 10 and drawn(ids.limit(0), 300).count() == 0
