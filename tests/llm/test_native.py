"""Line dedup and decontamination against brute force; the queries against their SQL; the pipeline's stages."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import oracle
from tabulon.llm import decontaminate, line_dedup, queries

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def brute_lines(rows, percent=80):
    lines = [((i, n), frozenset(SPACED.findall(x))) for i, t in rows if t is not None and i is not None
             for n, x in enumerate(t.split("\n"))]
    lines = sorted((p, s) for p, s in lines if s)
    out = set()
    for x, (p, s) in enumerate(lines):
        for q, r in lines[:x]:
            both = len(s & r)
            if q < p and 100 * both >= percent * (len(s) + len(r) - both):
                out.add(p)
                break
    return out


def line_rows(seed):
    rnd = random.Random(seed)
    vocab = [f"w{int(rnd.paretovariate(0.7)) % 300}" for _ in range(500)] + ["É", "Ñ,"]
    made, rows = [], []
    for i in range(60):
        lines = []
        for _ in range(rnd.randint(0, 6)):
            line = [rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 5, 12, 30, 130]))]
            if made and rnd.random() < 0.5:
                line = list(rnd.choice(made))
                for _ in range(rnd.randint(0, 1 + len(line) // 9)):
                    line[rnd.randrange(len(line))] = rnd.choice(vocab)
            made.append(line)
            lines.append(rnd.choice([" ", "\t", "  "]).join(line) + rnd.choice(["", " ", "\r"]))
        rows.append((i * 2, "\n".join(lines)))
    return rows + [(-5, rows[7][1]), (3, None), (None, rows[9][1]), (5, ""), (7, "\n \n")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_later_lines(spark, seed):
    rows = line_rows(seed)
    df = spark.createDataFrame([(i, t, "x", 4) for i, t in rows], "doc_id long, text string, line string, n int")
    got = line_dedup.later_lines(df.repartition(3))
    assert {(r.doc_id, r.line) for r in got.collect()} == brute_lines(rows)


def test_cut_text(spark):
    df = spark.createDataFrame([(1, "a b c\nd e f\na b c", "k"), (2, "x\nc b a\n\ny", "k"), (3, None, "k")],
                               "doc_id long, text string, later_id string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup.drop_later_lines(df).collect()}
    assert got == {1: ("a b c\nd e f", 3, 1), 2: ("x\n\ny", 4, 1), 3: (None, 0, 0)}
    assert line_dedup.drop_later_lines(df.limit(0)).count() == 0


def test_a_large_group_of_lines(spark):
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join([*base[:i % 60], f"x{i}", *base[i % 60 + 1:]])) for i in range(600)]
    got = line_dedup.later_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in got.collect()} == set(range(1, 600))


ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_hits(rows, items, size=13):
    def cut(t):
        return ITEM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    wins = {}
    for i, t in items:
        w = cut(t)
        z = min(size, len(w))
        for p in range(len(w) - z + 1 if w and i is not None else 0):
            wins.setdefault(tuple(w[p:p + z]), set()).add(str(i))
    out = []
    for i, t in rows:
        w, hit, found = cut(t), set(), set()
        for z in {len(k) for k in wins}:
            for p in range(len(w) - z + 1):
                if tuple(w[p:p + z]) in wins:
                    hit.update(range(p, p + z))
                    found |= wins[tuple(w[p:p + z])]
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1_000_000, 20])
def test_contamination(spark, block, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", block)
    rnd = random.Random(9)
    vocab = [f"v{i}" for i in range(60)] + ["É", "straße", "A1"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice([1, 5, 13, 14, 30])))) for i in range(12)]
    items += [(50, None), (51, "--- ,"), (None, "v1 v2"), (52, items[4][1])]
    rows = []
    for i in range(80):
        w = [rnd.choice(vocab).upper() if rnd.random() < 0.1 else rnd.choice(vocab) for _ in range(rnd.randint(0, 300))]
        for _ in range(rnd.randint(0, 2)):
            t = (rnd.choice(items)[1] or "").split()
            at = rnd.randint(0, len(w))
            w[at:at] = t[rnd.randint(0, 3):]
        rows.append((i, rnd.choice([" ", ", ", "\n"]).join(w)))
    rows += [(900, None), (901, ""), (None, items[3][1]), rows[0], (5, rows[5][1])]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, token string, size int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs, bench).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got), key=repr) == \
        brute_hits(rows, items)


def test_no_items_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.n_hit) for r in decontaminate.contamination(docs, none).collect()] == [(2, 0)]
    assert decontaminate.contamination(docs.limit(0), none).count() == 0


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, sf, name):
    assert oracle.compare(spark, oracle.connect(sf), queries.QUERIES[name], queries.SQL[name], sf) is None


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, before, sf)
        out = spark.createDataFrame(out.collect(), out.schema)
        if name != "packing":
            assert out.columns == docs.columns and out.count() <= before.count()
            if name != "line_dedup":
                assert out.join(before, docs.columns, "left_anti").count() == 0
        before, last = out, before
    assert before.select("doc_id").distinct().count() == last.count()
    assert before.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
