"""Near-duplicates and repeated passages against brute force."""

import hashlib
import re

import pytest

from tabulon.llm.components import components
from tabulon.llm.near_dedup import limits, near_duplicates
from tabulon.llm.repeats import cut_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def brute_groups(rows, k, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall(lower(t or ""))
        sets[i] = {tuple(w[j:j + min(k, len(w))]) for j in range(max(1, len(w) - k + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                r, s = sorted((find(a), find(b)))
                root[s] = r
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def brute_cut(rows, window):
    out, seen = {}, {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for j in range(len(w) - window + 1):
            key = tuple(w[j:j + window])
            seen[key] = min(seen.get(key, i), i)
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for j in range(len(w) - window + 1):
            if seen[tuple(w[j:j + window])] < i:
                gone.update(range(j, j + window))
        left = [x for j, x in enumerate(w) if j not in gone]
        out[i] = (len(w), len(gone), hashlib.sha256(" ".join(left).encode()).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_duplicates(spark, corpus, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df, k=4).collect()}
    assert got == brute_groups(rows, 4, 80)


@pytest.mark.parametrize("percent, n, both", [(60, 80, 60), (70, 85, 70), (90, 95, 90)])
def test_pairs_at_other_thresholds(spark, percent, n, both):
    """60 pairs of texts just at the threshold, in words of their own."""
    rows = []
    for i in range(60):
        words = [f"p{i}w{j}" for j in range(2 * n - both)]
        rows += [(2 * i, " ".join(words[:n])), (2 * i + 1, " ".join(words[n - both:]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(df, k=1, percent=percent).collect()}
    assert got == {i: i // 2 * 2 for i in range(120)}


def test_limits_follow_the_threshold(spark):
    assert limits(80) == (4, 70)
    for percent in (59, 0, 101):
        with pytest.raises(ValueError):
            near_duplicates(spark.createDataFrame([(1, "a")], "doc_id long, text string"), percent=percent)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_cut_repeats(spark, corpus, seed):
    rows = corpus(seed, n=80, length=200)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in cut_repeats(df).collect()}
    want = brute_cut(rows, 50)
    assert {k: (got.get(k), v) for k, v in want.items() if got.get(k) != v} == {} and len(got) == len(want)


def test_spans_name_the_removed_words(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, text), (2, "a b " + text + " c")], "doc_id long, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in cut_repeats(df).collect()}
    assert got == {1: [], 2: [(2, 62)]}


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(70))
    df = spark.createDataFrame([(None, text, 1), (3, text, 2), (3, text, 2), (4, text, None), (5, None, 1)],
                               "doc_id long, text string, component long")
    got = sorted((r.doc_id or 0, r.n_removed) for r in cut_repeats(df).collect())
    assert got == [(0, 0), (3, 0), (3, 0), (4, 70), (5, 0)]
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_duplicates(df).collect())
    assert got == [(0, 0, True), (3, 3, True), (3, 3, True), (4, 3, False), (5, 5, True)]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert cut_repeats(df).count() == 0
    assert near_duplicates(df).count() == 0


def test_long_text_and_large_group(spark):
    long = " ".join(f"w{i % 70_001}" for i in range(200_000))
    rows = [(0, long), (1, long + " end")]
    base = [f"b{i}" for i in range(100)]
    rows += [(10 + i, " ".join([*base[:i], f"x{i}", *base[i + 1:]])) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(df).collect()}
    assert got[1] == 0 and {got[10 + i] for i in range(100)} == {10}
    cut = {r.doc_id: r.n_removed for r in cut_repeats(df).collect()}
    assert cut[1] == 200_000 and cut[0] == 0


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(70, 60), (60, 60)], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(51)}, 60: 60, 70: 60}


def test_later_lines_have_one_near_candidate_each(spark, monkeypatch):
    from tabulon.llm import line_dedup

    stored = {}
    keep = line_dedup.materialise
    monkeypatch.setattr(line_dedup, "materialise", lambda df, label: stored.setdefault(label, keep(df, label)))
    sets = [{f"w{i % 3}_{j}" for j in range(20) if j != i % 7} | {f"x{i}"} for i in range(40)]
    docs = spark.createDataFrame([(i, " ".join(sorted(s))) for i, s in enumerate(sets)], "doc_id long, text string")
    got = {r["doc_id"] for r in line_dedup.later_lines(docs).collect()}
    assert got == {i for i, s in enumerate(sets) if any(100 * len(s & t) >= 80 * len(s | t) for t in sets[:i])}
    near = stored["near"]
    assert near.count() == near.select("b_doc", "b_line").distinct().count() > 10


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_texts_stay_where_they_are_for_few_lines(spark, monkeypatch, limit):
    import corpus_pipeline
    from tabulon.llm import line_dedup

    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.setattr(line_dedup, "IDS_BROADCAST", limit)
    monkeypatch.setattr(corpus_pipeline, "IDS_BROADCAST", limit)
    long = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"a b c\n{long}"), (2, f"x y\n{long} z\nc b a\n"), (2, f"x y\n{long} z\nc b a\n"),
                                  (3, None), (None, "a b c")], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cut = line_dedup.drop_later_lines(docs)
        left = corpus_pipeline._without(docs, docs.filter("doc_id = 2"))
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (cut, left)]
        got = sorted((r.doc_id or 0, r.text, r.n_removed) for r in cut.filter("text is not null").collect())
        stay = [r.doc_id for r in left.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert got == [(0, "a b c", 0), (1, f"a b c\n{long}", 0), (2, "x y\n", 2), (2, "x y\n", 2)]
    assert sorted(stay, key=str) == [1, 3, None]
    assert ["SortMergeJoin" in p for p in plans] == [not limit] * 2
