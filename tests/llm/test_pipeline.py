"""The pipeline over a small table against a brute-force version of every stage."""

import random
import zlib

import corpus_pipeline
from test_copies import brute_groups
from test_native import SPACED, brute_hits, brute_lines
from test_rules import brute as brute_counts

from tabulon.llm import queries


def table():
    rnd = random.Random(11)
    vocab = [f"w{i}" for i in range(900)] + ["Ünï", "é,"]
    items = [(f"b{i}", " ".join(rnd.choice(vocab) for _ in range(rnd.randint(13, 30)))) for i in range(6)]
    rows, templates = [], [[rnd.choice(vocab) for _ in range(14)] for _ in range(3)]
    for i in range(140):
        lines = [[rnd.choice(vocab) for _ in range(rnd.randint(6, 16))] for _ in range(rnd.randint(1, 6))]
        kind = rnd.random()
        if kind < 0.15:
            lines.append(list(rnd.choice(templates)))
        elif kind < 0.3 and rows:
            lines = [x.split() for x in rows[rnd.randrange(len(rows))][1].split("\n")]
            lines[0].insert(0, f"new{i}")
        elif kind < 0.4:
            lines.append(rnd.choice(items)[1].split())
        elif kind < 0.5:
            lines = [["short", "text"]]
        elif kind < 0.6:
            lines = [["again", "and", "again", "it", "goes"] * 6]
        rows.append((i * 3, "\n".join(" ".join(x) for x in lines)))
    return rows + [(1001, ""), (1004, None)], items


def test_run_as_by_brute_force(spark, tmp_path):
    rows, items = table()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    def failed(t):
        n, _, _, _, repeated = brute_counts(t)
        return n < 10 or 100 * repeated > 20 * n

    kept = [(i, t) for i, t in rows if not failed(t)]
    assert 0 < len(kept) < len(rows)
    later, cut = brute_lines(kept), []
    for i, t in kept:
        left = [x for n, x in enumerate(t.split("\n")) if (i, n) not in later]
        if len(left) == len(t.split("\n")) or SPACED.search("\n".join(left)):
            cut.append((i, "\n".join(left)))
    assert later and len(cut) <= len(kept)
    groups = brute_groups(cut, 5, 80)
    single = [(i, t) for i, t in cut if groups[i][2]]
    hits = {h[0]: h[-1] for h in brute_hits(single, items)}
    clean = [(i, t) for i, t in single if not hits[i]]
    assert len(clean) < len(single)

    stages = {}
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = spark.createDataFrame(stage(spark, before, str(tmp_path)).collect(), docs.schema)
        stages[name] = sorted(map(tuple, before.collect()))
    assert [stages[name] for name, _ in corpus_pipeline.STAGES[:-1]] == [sorted(x) for x in (kept, cut, single, clean)]

    from tokenizers import Tokenizer

    coder, pieces = Tokenizer.from_file(queries.tokenizer_path()), {}
    ids = {i: coder.encode(t, add_special_tokens=False).ids + [1] for i, t in clean}
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(ids)
    for i, parts in pieces.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            piece = ids[i][at:at + r.length]
            assert r.start == at and r.doc_tokens == len(ids[i])
            assert r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in piece))
            at += r.length
        assert at == len(ids[i])
