import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tabulon.operators import boost, tune
from tabulon.operators import score as sc
from tabulon.operators import train
from tabulon.operators.prep import Prep
from tabulon.plans.shared import scratch

COLS = ["a", "b", "c"]
PLAN = Prep(COLS, remainder="pass", scale=False)
SPACE_LIKE = {"n_estimators": 4, "learning_rate": 0.7, "num_leaves": 9, "max_depth": 4, "min_child_samples": 12,
              "lambda_l1": 0.3, "lambda_l2": 0.4, "path_smooth": 20.0, "max_bin": 255}


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(3)
    out = []
    for i in range(700):
        a, b, c = rnd.randrange(12), rnd.randrange(7), rnd.randrange(20)
        out.append((i, float(a), float(b), float(c), int(rnd.random() < (0.8 if (a > 5) ^ (b > 3) or c > 16 else 0.2))))
    return out


@pytest.fixture(scope="module")
def frame(spark, data):
    return spark.createDataFrame(data, "id long, a double, b double, c double, y int").repartition(3)


def brute(data, p, rounds=None):
    """Row by row, leaf by leaf, one split at a time; the margins of all rows, and the first tree's (gain, column, cut)."""
    x = [r[1:4] for r in data]
    y = [r[4] for r in data]
    share = sum(y) / len(y)
    margin, first = [math.log(share / (1 - share))] * len(y), []

    def soft(g):
        return math.copysign(max(abs(g) - p["lambda_l1"], 0.0), g)

    def value(rows, parent):
        g, h, w = sum(grad[i] for i in rows), sum(hess[i] for i in rows), len(rows) / p["path_smooth"]
        return g, h, -soft(g) / (h + p["lambda_l2"]) * w / (w + 1) + parent / (w + 1)

    def taken(g, h, out):
        return -(2 * soft(g) * out + (h + p["lambda_l2"]) * out * out)

    def best(rows, out, depth):
        top = None
        if depth >= p["max_depth"]:
            return None
        g, h, _ = value(rows, 0.0)
        for f in range(len(COLS)):
            for cut in sorted({x[i][f] for i in rows}):
                left, right = [i for i in rows if x[i][f] <= cut], [i for i in rows if x[i][f] > cut]
                if min(len(left), len(right)) < p["min_child_samples"]:
                    continue
                (gl, hl, ol), (gr, hr, other) = value(left, out), value(right, out)
                gain = taken(gl, hl, ol) + taken(gr, hr, other) - taken(g, h, out)
                if gain > 1e-9 and (top is None or gain > top[0] + 1e-9):
                    top = (gain, f, cut, left, right, ol, other)
        return top

    for number in range(rounds or p["n_estimators"]):
        prob = [1 / (1 + math.exp(-m)) for m in margin]
        grad, hess = [q - t for q, t in zip(prob, y)], [q * (1 - q) for q in prob]
        every = list(range(len(y)))
        root = value(every, 0.0)[2]
        leaves = [(every, root, 0, best(every, root, 0))]
        while len(leaves) < p["num_leaves"]:
            at = max((i for i, leaf in enumerate(leaves) if leaf[3]), key=lambda i: leaves[i][3][0], default=None)
            if at is None:
                break
            _, _, depth, (gain, f, cut, left, right, ol, other) = leaves.pop(at)
            if number == 0:
                first.append((gain, f, cut))
            leaves += [(left, ol, depth + 1, best(left, ol, depth + 1)), (right, other, depth + 1, best(right, other, depth + 1))]
        if len(leaves) > 1:
            for rows, out, _, _ in leaves:
                for i in rows:
                    margin[i] += p["learning_rate"] * out
    return margin, first


def margins(model, frame):
    vector = PipelineModel(model.stages[:-1]).transform(frame)
    return [m for _, m in sorted(vector.select("id", model.stages[-1].margin(F.col("features"))).collect())]


@pytest.mark.parametrize("change", [{}, {"num_leaves": 3}, {"max_depth": 2, "num_leaves": 90}, {"path_smooth": 1e-9},
                                    {"learning_rate": 2.5, "n_estimators": 3}, {"lambda_l1": 4.0, "lambda_l2": 9.0}])
def test_trees_as_by_brute_force(frame, data, change):
    params = {**SPACE_LIKE, **change}
    model = boost.fit_boosted(frame, PLAN, "y", **params)
    want, first = brute(data, params)
    assert margins(model, frame) == pytest.approx(want, abs=1e-9)
    tree = model.stages[-1].parts()[2][0]
    got = sorted((g, f, c) for g, f, c in zip(tree.gain, tree.feature, tree.cut) if f >= 0)
    assert [g for g, _, _ in got] == pytest.approx([g for g, _, _ in sorted(first)])
    assert [(f, c) for _, f, c in got] == [(f, c) for _, f, c in sorted(first)]


@pytest.mark.parametrize("key,value", [
    ("colsample_bytree", 0.4), ("lambda_l1", 5.0), ("lambda_l2", 8.0), ("learning_rate", 1.9), ("max_bin", 3),
    ("max_depth", 2), ("min_child_samples", 90), ("n_estimators", 2), ("num_leaves", 3), ("path_smooth", 300.0),
    ("subsample", 0.5)])
def test_every_parameter_of_the_space_changes_the_model(frame, key, value):
    assert key in tune.SEARCH_SPACE
    one, other = boost.fit_boosted_many(frame, PLAN, "y", [SPACE_LIKE, {**SPACE_LIKE, key: value}])
    assert margins(one, frame) != margins(other, frame)


def test_the_seed_draws_rows_and_columns(frame):
    drawn = {**SPACE_LIKE, "subsample": 0.6, "colsample_bytree": 0.5}
    a, b, c = boost.fit_boosted_many(frame, PLAN, "y", [{**drawn, "random_state": s} for s in (1, 2, 1)])
    assert margins(a, frame) == margins(c, frame) != margins(b, frame)
    assert margins(boost.fit_boosted(frame.coalesce(1), PLAN, "y", **drawn, random_state=1), frame) == pytest.approx(
        margins(a, frame), abs=1e-9)


def test_rows_of_the_same_bins_are_one_cell():
    rnd = np.random.default_rng(4)
    bins, y = rnd.integers(0, 3, (2, 5000)).astype(np.uint8), rnd.integers(0, 2, 5000).astype(np.int8)
    key, fold = rnd.integers(0, 1 << 63, 5000).astype(np.uint64), rnd.integers(0, 3, 5000).astype(np.int32)
    block = boost._cells((bins, y, key, fold))
    assert block[0].shape == (2, 9) and len(block[1]) == 9
    params = {0: boost.BoostParams(subsample=0.6, random_state=5), 1: boost.BoostParams()}
    cells, _, counts, ones = boost._drawn(params, 2, [None, 1])((*block, np.zeros((2, 9))))
    for i, keep in enumerate([boost._in_bag(key, params[0], 2), fold != 1]):
        for cell, n, s in zip(cells.T, counts[i], ones[i]):
            rows = keep & (bins == cell[:, None]).all(axis=0)
            assert (n, s) == (rows.sum(), y[rows].sum())


def test_shared_passes_equal_separate_fits(frame, monkeypatch):
    trials = [SPACE_LIKE, {**SPACE_LIKE, "num_leaves": 4, "max_bin": 6, "n_estimators": 7}, {**SPACE_LIKE, "subsample": 0.7}]
    together = [margins(m, frame) for m in boost.fit_boosted_many(frame, PLAN, "y", trials)]
    # in passes over several tasks, too
    monkeypatch.setattr(boost, "REBASE", 2)
    monkeypatch.setattr(boost, "FLAT_TASKS", 0)
    monkeypatch.setattr(boost, "TASK_ROWS", 100)
    for trial, want in zip(trials, together):
        if trial["max_bin"] == 255:
            assert margins(boost.fit_boosted(frame, PLAN, "y", **trial), frame) == pytest.approx(want, abs=1e-9)


def test_folds_share_passes(frame, data):
    folded = frame.withColumn("fold", (F.col("id") % 3).cast("int"))
    models = boost.fit_boosted_many(folded, PLAN, "y", [SPACE_LIKE] * 3, "fold", [0, 1, 2])
    for i, model in enumerate(models):
        want, _ = brute([r for r in data if r[0] % 3 != i], SPACE_LIKE)
        assert margins(model, frame.filter(F.col("id") % 3 != i)) == pytest.approx(want, abs=1e-9)


def test_odd_tables(spark, frame):
    same = spark.createDataFrame([(1.0, 1.0, 1.0, 1)] * 50 + [(1.0, 1.0, 1.0, None)], "a double, b double, c double, y int")
    scored = sc.score(same, boost.fit_boosted(same, PLAN, "y", n_estimators=3), probability="p")
    assert scored.count() == 51 and scored.agg(F.min("p")).first()[0] > 0.99
    assert sc.score(frame.limit(0), boost.fit_boosted(frame, PLAN, "y", n_estimators=1)).count() == 0
    model = boost.fit_boosted(frame, PLAN, "y", **SPACE_LIKE)
    uri = train.save_model(model, scratch(spark, "boosted"), frame.select(*COLS))
    loaded = train.load_model(spark, uri)
    assert margins(loaded.model, frame) == margins(model, frame)
    shares = model.stages[-1].featureImportances.toArray()
    assert shares.sum() == pytest.approx(1.0) and shares.max() < 1.0


def test_explanations_add_up_and_equal_all_subsets(frame, data):
    model = boost.fit_boosted(frame, PLAN, "y", **SPACE_LIKE)
    start, n, trees = model.stages[-1].parts()
    told = {r["id"]: r["explanation"] for r in boost.explain(frame, model, COLS).select("id", "explanation").collect()}
    for (i, *_), margin in zip(sorted(data), margins(model, frame)):
        assert sum(told[i]) == pytest.approx(margin, abs=1e-9)

    def known(tree, row, chosen, node=0):
        """The tree's value where only the chosen columns are known."""
        f = tree.feature[node]
        if f < 0:
            return tree.value[node]
        if f in chosen:
            return known(tree, row, chosen, tree.left[node] if row[f] <= tree.cut[node] else tree.right[node])
        l, r = tree.left[node], tree.right[node]
        return (tree.rows[l] * known(tree, row, chosen, l) + tree.rows[r] * known(tree, row, chosen, r)) / tree.rows[node]

    for record in data[:12]:
        row = record[1:4]
        for f in range(n):
            others, want = [c for c in range(n) if c != f], 0.0
            for size in range(n):
                for chosen in itertools.combinations(others, size):
                    weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
                    want += weight * sum(known(t, row, {*chosen, f}) - known(t, row, set(chosen)) for t in trees)
            assert told[record[0]][COLS[f]] == pytest.approx(want, abs=1e-9)


def test_run_boosted_measures_as_run_trials(spark, frame):
    trials = tune.sample_space(spark, 2, seed=5, space={"learning_rate": ("lognormal", 0.0, 1.0), "n_estimators": 3,
                                                        "num_leaves": ("integer", 3, 9)})
    together = tune.run_boosted(frame, frame, trials, PLAN, "y")
    apart = tune.run_trials(frame, frame, trials, lambda t, p: boost.fit_boosted(
        t, PLAN, "y", **{k: v for k, v in p.items() if k != "run_id"}), "y")
    assert together.columns == apart.columns
    assert sorted(map(tuple, together.collect())) == sorted(map(tuple, apart.collect()))


# --- Parzen search ---------------------------------------------------------------------------

SPACE = {"x": ("uniform", -4.0, 6.0), "k": ("integer", 0, 30), "r": ("lognormal", 0.0, 1.0), "same": 3}


def test_densities_add_up_to_one():
    for name, grid in (("x", np.linspace(-4, 6, 40_001)), ("r", np.linspace(-12, 12, 40_001))):
        mixture = tune.parzen(SPACE[name], [1.5, 2.0, 2.1, 0.3])
        at = np.exp(grid) if name == "r" else grid
        assert np.exp(tune.log_density(SPACE[name], mixture, at)).sum() * (grid[1] - grid[0]) == pytest.approx(1, abs=1e-3)


def test_proposals_have_the_best_ratio_by_brute_force(spark):
    rnd = random.Random(1)
    data = [(i, rnd.uniform(-4, 6), rnd.randrange(30), math.exp(rnd.gauss(0, 1)), 3) for i in range(16)]
    runs = spark.createDataFrame([(*r, -abs(r[1] - 2) - abs(r[2] - 20) / 10) for r in data] + [(99, 0.0, 1, 1.0, 3, None)],
                                 "run_id long, x double, k int, r double, same int, f1score double")
    got = tune.suggest(runs, 6, SPACE, seed=3)
    assert [r.run_id for r in got.collect()] == list(range(100, 106)) and {r.same for r in got.collect()} == {3}
    assert got.collect() == tune.suggest(runs.orderBy(F.rand(1)), 6, SPACE, seed=3).collect()
    ordered = sorted(data, key=lambda r: (abs(r[1] - 2) + abs(r[2] - 20) / 10, r[0]))
    good, bad = [r[1] for r in ordered[:3]], [r[1] for r in ordered[3:]]

    def density(mixture, x):  # cut normals, one by one
        total = 0.0
        for c, w in mixture:
            def upto(z):
                return 0.5 * (1 + math.erf((z - c) / w / math.sqrt(2)))
            total += math.exp(-0.5 * ((x - c) / w) ** 2) / w / math.sqrt(2 * math.pi) / (upto(6.0) - upto(-4.0))
        return total / len(mixture)

    above, rng = tune.parzen(SPACE["x"], good), np.random.default_rng([3, 16, 0])
    for r in got.orderBy("run_id").collect():
        drawn, below = tune._drawn(SPACE["x"], above, 8, rng), tune.parzen(SPACE["x"], bad)
        assert r.x == max(drawn, key=lambda x: density(above, x) / density(below, x))
        bad.append(r.x)


def test_fewer_runs_than_needed_are_random_draws(spark, rows):
    runs = spark.createDataFrame([], "run_id long, x double, k int, r double, same int, f1score double")
    assert rows(tune.suggest(runs, 4, SPACE, seed=2)) == rows(tune.sample_space(spark, 4, seed=2, space=SPACE))


def test_search_beats_random_draws_over_seeds():
    space, wins, best = {"x": SPACE["x"], "r": SPACE["r"]}, 0, []

    def run(i, x, r):
        return {"run_id": i, "x": x, "r": r, "f1score": -((x - 2.3) ** 2) - (math.log(r) - 0.5) ** 2}

    for seed in range(20):
        rng = np.random.default_rng(seed)
        drawn = [run(i, rng.uniform(-4, 6), math.exp(rng.normal())) for i in range(60)]
        seen = drawn[:12]
        while len(seen) < 60:
            new = tune.proposals(seen, 6, space, seed, "f1score", 0.15, 8)
            seen = seen + [run(len(seen) + i, x, r) for i, (x, r) in enumerate(zip(new["x"], new["r"]))]
        best.append([max(r["f1score"] for r in runs) for runs in (seen, drawn)])
        wins += best[-1][0] > best[-1][1]
    assert wins > 12 and np.median([b[0] for b in best]) > np.median([b[1] for b in best])


def test_explained_cells_equal_explained_rows():
    rng = np.random.default_rng(4)
    columns = np.round(rng.uniform(0, 6, (3, 500)), 1)
    columns[0, :9] = np.nan
    tree = boost.Tree(feature=[0, 1, 0, 2, -1, -1, -1, -1, -1], cut=[3.0, 2.0, 4.5, 1.0, 0, 0, 0, 0, 0],
                      left=[1, 3, 5, 7, -1, -1, -1, -1, -1], right=[2, 4, 6, 8, -1, -1, -1, -1, -1],
                      value=[0, 0, 0, 0, 0.5, -1.0, 2.0, 0.25, -0.75], gain=[1.0] * 4 + [0.0] * 5,
                      rows=[100.0, 60.0, 40.0, 25.0, 35.0, 10.0, 30.0, 20.0, 5.0])
    columns[1, 20:40], columns[2, 40:60], columns[0, 60:80] = 2.0, 1.0, 4.5
    want = boost.shapley(columns, tree)
    assert (boost.explainer(tree, 3)(columns) == want).all() and np.abs(want).max() > 0.1
    for i in range(0, 500, 25):  # a row alone, so that its kinds are its own
        assert boost.shapley(columns[:, i:i + 1], tree)[:, 0] == pytest.approx(want[:, i])


def test_few_bytes_are_grown_within_tasks_and_blocks_add_up(spark, frame, data, monkeypatch):
    trials = [SPACE_LIKE, {**SPACE_LIKE, "n_estimators": 2, "subsample": 0.6}]
    want = [margins(m, frame) for m in boost.fit_boosted_many(frame, PLAN, "y", trials)]
    # in small blocks, but few bytes: still grown within tasks, without a job for each step
    monkeypatch.setattr(boost, "TASK_ROWS", 100)
    monkeypatch.setattr(boost, "_grown_by_passes", None)
    for one, other in zip(boost.fit_boosted_many(frame, PLAN, "y", trials), want):
        assert margins(one, frame) == pytest.approx(other, abs=1e-9)
    monkeypatch.undo()
    # in passes over several tasks of several blocks, where the bytes are too many for one
    monkeypatch.setattr(boost, "TASK_ROWS", 100)
    monkeypatch.setattr(boost, "ALONE_BYTES", 0)
    monkeypatch.setattr(boost, "REBASE", 2)
    for one, other in zip(boost.fit_boosted_many(frame, PLAN, "y", trials), want):
        assert margins(one, frame) == pytest.approx(other, abs=1e-9)


@pytest.mark.parametrize("joint", [1, 1 << 13])
def test_many_rows_of_few_cells_are_grown_within_tasks(frame, monkeypatch, joint):
    plan = Prep(["a", "b"], remainder="pass", scale=False)
    trials = [SPACE_LIKE, {**SPACE_LIKE, "n_estimators": 7, "subsample": 0.6, "colsample_bytree": 0.5}]
    want = [margins(m, frame) for m in boost.fit_boosted_many(frame, plan, "y", trials)]
    # rows in tasks by their bins, at most 84 cells of 23 bytes; counts of two rounds at once
    monkeypatch.setattr(boost, "TASK_ROWS", 100)
    monkeypatch.setattr(boost, "ALONE_BYTES", 84 * 23)
    monkeypatch.setattr(boost, "DRAWN_BYTES", 2 * 2 * 84)
    monkeypatch.setattr(boost, "JOINT", joint)
    monkeypatch.setattr(boost, "_grown_by_passes", None)
    for one, other in zip(boost.fit_boosted_many(frame, plan, "y", trials), want):
        assert margins(one, frame) == pytest.approx(other, abs=1e-9)


def test_rows_of_the_same_bins_go_to_the_same_task_unless_they_are_too_many():
    rng = np.random.default_rng(5)
    bins, key = rng.integers(0, 9, (3, 4000)).astype(np.uint8), rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    bins[:, :2000] = 4
    place = boost._places(bins, key, 4)
    assert np.bincount(place, minlength=4).min() > 700
    rare = np.flatnonzero((bins != 4).any(axis=0))
    assert len({(*c, p) for *c, p in zip(*bins[:, rare], place[rare])}) == len({tuple(c) for c in bins[:, rare].T})


def test_counts_of_a_round_are_those_that_passes_draw():
    rng = np.random.default_rng(6)
    bins, y = rng.integers(0, 3, (2, 3000)).astype(np.uint8), rng.integers(0, 2, 3000).astype(np.int8)
    key, fold = rng.integers(0, 1 << 63, 3000).astype(np.uint64), rng.integers(0, 3, 3000).astype(np.int32)
    block = boost._cells((bins, y, key, fold))
    for p, without in ((boost.BoostParams(subsample=0.6, random_state=5), None), (boost.BoostParams(), 1)):
        *_, counts, ones = boost._drawn({0: p}, 2, [without])((*block, np.zeros((1, 9))))
        got = boost._counted(block, p, 2, without)
        assert (got[0] == counts[0]).all() and (got[1] == ones[0]).all()


def _a_tree(rng, n, leaves):
    """A tree of random cuts, values and rows."""
    tree, open_ = boost.Tree(), [0]
    tree.add(0.0, 1000.0)
    while len(open_) < leaves:
        node = open_.pop(int(rng.integers(len(open_))))
        tree.feature[node], tree.cut[node], tree.gain[node] = int(rng.integers(n)), round(float(rng.uniform(0, 6)), 1), 1.0
        left = tree.rows[node] * rng.uniform(0.2, 0.8)
        tree.left[node], tree.right[node] = tree.add(float(rng.normal()), left), tree.add(float(rng.normal()), tree.rows[node] - left)
        open_ += [tree.left[node], tree.right[node]]
    return tree


@pytest.mark.parametrize("n,leaves", [(4, 90), (2, 12), (1, 40), (5, 3)])
def test_cells_between_cuts_are_told_as_rows(n, leaves):
    rng = np.random.default_rng(n)
    trees = [_a_tree(rng, n, leaves) for _ in range(3)]
    columns = np.round(rng.uniform(-1, 7, (n, 3000)), 1)
    columns[0, :9] = np.nan
    want = np.full(3000, 0.3)
    for t in trees:
        want += np.array(t.value).take(boost.walk(columns, t.arrays()))
    assert (boost._leaf_values(trees, n)(columns, 0.3) == want).all()
    finer = boost._cuts(trees, n)
    for t in trees:
        told = boost.shapley(columns, t)
        assert boost.explainer(t, n)(columns) == pytest.approx(told, abs=1e-12)
        assert boost.explainer(t, n, 3000)(columns, boost._coded(columns, finer), finer) == pytest.approx(told, abs=1e-12)


def test_trees_of_too_many_cells_are_walked_and_told_by_rows(monkeypatch):
    rng = np.random.default_rng(9)
    trees, columns = [_a_tree(rng, 3, 30) for _ in range(3)], np.round(rng.uniform(-1, 7, (3, 500)), 1)
    few, told = boost._leaf_values(trees, 3)(columns, 0.0), boost.explainer(trees[0], 3)(columns)
    monkeypatch.setattr(boost, "walk", lambda *a, real=boost.walk: walked.append(1) or real(*a))
    walked = []
    monkeypatch.setattr(boost, "LEAF_CELLS", math.prod(len(c) + 1 for c in boost._cuts(trees[:1], 3)))
    assert (boost._leaf_values(trees, 3)(columns, 0.0) == few).all() and len(walked) == 2
    monkeypatch.setattr(boost, "CELLS", 1)
    assert boost.explainer(trees[0], 3)(columns) == pytest.approx(told, abs=1e-12)
