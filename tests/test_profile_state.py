import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulon.operators import corr, profile, profile_state as ps
from tabulon.plans.shared import scratch

COLS = ["a", "b", "c"]


def make(spark, seed, n=3000, shift=0.0):
    rnd = random.Random(seed)
    data = [(rnd.gauss(shift, 2.0) if rnd.random() > 0.05 else None, float(rnd.randrange(-3, 12)),
             None if shift > 100 else rnd.expovariate(0.1) * (100 if rnd.random() < 0.01 else 1)) for _ in range(n)]
    return spark.createDataFrame(data, "a double, b double, c double").repartition(3)


EXACT = ["rows", "count", "missing", "zeros", "negatives", "min", "max", "mean", "sum", "std", "skewness", "kurtosis"]


def test_merged_states_are_those_of_the_whole(spark):
    parts = [make(spark, i, shift=i * 50.0) for i in range(4)]
    states = None
    for i, p in enumerate(parts):
        one = ps.profile_states(p, COLS).withColumn("part", F.lit(i))
        states = one if states is None else states.unionByName(one)
    df = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    whole = {r["column"]: r for r in profile.profile_columns(df, COLS).collect()}
    twice = ps.merge_states(ps.merge_states(states.withColumn("half", F.col("part") < 2), ["half"]))
    for merged in (ps.merge_states(states), twice):
        for r in ps.statistics(merged).collect():
            want = whole[r["column"]]
            for name in EXACT:
                assert r[name] == pytest.approx(want[name], rel=1e-9, abs=1e-9), (r["column"], name)
            values = np.sort([x[0] for x in df.select(r["column"]).dropna().collect()])
            for name, p in ps._PROBS.items():
                low, high = np.searchsorted(values, r[name], "left"), np.searchsorted(values, r[name], "right")
                assert low / len(values) - 0.01 <= p <= high / len(values) + 0.01
            assert abs(r["distinct"] - want["distinct"]) <= 0.1 * want["distinct"] + 1


def test_a_new_file_is_the_only_one_read(spark, tmp_path):
    folder, store = f"{tmp_path}/rows", ps.ProfileStore(spark, scratch(spark, "states"), COLS)
    assert store.states() is None
    make(spark, 1).coalesce(1).write.mode("append").parquet(folder)
    store.add(spark.read.parquet(folder))
    first = {r[0] for r in store.states().select("source").distinct().collect()}
    make(spark, 2, shift=9.0).coalesce(1).write.mode("append").parquet(folder)
    files = spark.read.parquet(folder)
    # the old file is gone: only the new one may be read
    for name in first:
        old = tmp_path / "rows" / name.rsplit("/", 1)[-1]
        old.write_bytes(b"not parquet any more")
    store.add(files)
    store.add(files)
    assert store.states().select("source").distinct().count() == 2
    both = make(spark, 1).union(make(spark, 2, shift=9.0))
    got = {r["column"]: r for r in ps.statistics(store.merged()).collect()}
    for c in COLS:
        want = both.agg(F.count(c), F.avg(c), F.stddev(c), F.skewness(c)).first()
        assert got[c]["count"] == want[0] and got[c]["mean"] == pytest.approx(want[1])
        assert got[c]["std"] == pytest.approx(want[2])


def test_full_profile_equals_the_single_operators(spark, rows):
    df = make(spark, 5).union(make(spark, 6, shift=200.0)).persist()
    full = ps.full_profile(df, COLS)
    want = {r["column"]: r for r in profile.profile_columns(df, COLS).collect()}
    for r in full.statistics.collect():
        for name in [*EXACT, "p05", "p25", "median", "p75", "p95", "iqr", "range"]:
            assert r[name] == pytest.approx(want[r["column"]][name], rel=1e-9, abs=1e-9), (r["column"], name)
    assert rows(full.box, "column", "whisker_low", "whisker_high", "outliers") == rows(
        profile.box_stats(df, COLS), "column", "whisker_low", "whisker_high", "outliers")
    assert rows(full.histogram, "column", "bin", "n") == rows(profile.histogram(df, COLS), "column", "bin", "n")
    for r in full.correlation.collect():
        assert r["corr"] == pytest.approx(df.dropna(subset=[r["column"], r["other"]]).agg(F.corr(r["column"], r["other"])).first()[0])
    assert full.correlation.count() == 3
    stored = ps.full_profile(df, COLS, states=ps.profile_states(df, COLS))
    assert rows(stored.box) == rows(full.box)


def test_scans(spark, tmp_path):
    """Three passes over the rows, by the rows that the scans of all stages read."""
    make(spark, 7).coalesce(1).write.parquet(f"{tmp_path}/t")
    df, passes = spark.read.parquet(f"{tmp_path}/t"), spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            passes.add(b.num_rows)
            yield b

    watched = df.mapInArrow(count, df.schema)
    full = ps.full_profile(watched, COLS)
    for frame in (full.statistics, full.histogram, full.box, full.correlation):
        frame.collect()
    assert passes.value == 3 * df.count()


def test_empty_and_constant_columns(spark, rows):
    df = spark.createDataFrame([(1.0, None, 2.0)] * 5, "a double, b double, c double")
    full = ps.full_profile(df, COLS)
    assert rows(full.statistics, "column", "count", "missing", "distinct") == [("a", 5, 0, 1), ("b", 0, 5, 0), ("c", 5, 0, 1)]
    assert rows(full.histogram, "column", "n") == [("a", 5), ("c", 5)]
    assert rows(full.correlation, "column", "other", "corr") == [("a", "c", None)]
    none = ps.full_profile(df.limit(0), COLS)
    assert none.histogram.count() == 0 and none.box.count() == 0
