"""Leaf-wise boosted trees on histograms: binned columns, best-first growth, many models in one pass over the rows.

Columns are binned once, by quantiles of a sketch, and stored as small integers in blocks of rows.  A growth step is
one pass: each task adds up gradients and hessians by (model, leaf, column, bin) over its blocks, and only these sums
travel.  Several models, trials or folds, share every pass.  Steps are many and short, so they run on cached blocks;
rows and scores never leave the executors.  Rows with the same bins go to the same task and are one cell: they have the
same score and leaf, so a round counts the rows that it draws of each cell once, and its steps run over the cells.  Where
the cells of all tasks are few, tasks only count what rounds draw, and each model grows in a task over these counts.  A
table of few rows grows each model in a task over its rows.
"""

import functools
import heapq
import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.operators.prep import Prep
from tabulon.plans.shared import materialise

# Rows of a task at least, so that small tables do not pay for tasks; also of a block, so that its arrays stay in cache.
TASK_ROWS = 1 << 16
# Rows of a block whose rows are put together in cells; some 50 bytes each while they are sorted.
CELL_ROWS = 1 << 22
# Cells of at most so many bytes are grown within tasks, one for each model, as a job for every step costs more than the
# step; such a task holds some six times as much.
ALONE_BYTES = 1 << 26
# Bytes of drawn counts that such a task gets at once, as many rounds as have them.
DRAWN_BYTES = 1 << 26
# Columns whose bins have at most so many combinations are added up together.
JOINT = 1 << 13
# After so many rounds scores are made anew from the stored rows, so that lost executors cost few rounds.
REBASE = 25
# Sums of more tasks than this are added up on the executors first.
FLAT_TASKS = 16
# Numbers that splits are sought in at once.
_SOUGHT = 1 << 18
# Cells between the cuts of a tree that are told once for all rows, at most; so many of them as rows are told one by one.
CELLS = 1 << 19
FEW_CELLS = 1 << 8
# Cells of all trees of an ensemble whose leaves a task keeps, a byte or two each; rows of other trees walk.
LEAF_CELLS = 1 << 26
# Rows that are explained at once, so that a tree's cells are told once for them.
EXPLAINED_ROWS = 1 << 19
_LEAST_HESSIAN = 1e-3


@dataclass
class BoostParams:
    """Parameters of one model; names and meaning as usual for leaf-wise boosting."""

    n_estimators: int = 100
    learning_rate: float = 0.1
    num_leaves: int = 31
    max_depth: int = -1
    min_child_samples: int = 20
    lambda_l1: float = 0.0
    lambda_l2: float = 0.0
    path_smooth: float = 0.0
    colsample_bytree: float = 1.0
    subsample: float = 1.0
    max_bin: int = 255
    random_state: int = 0

    @classmethod
    def of(cls, trial: dict) -> "BoostParams":
        """From a trial's columns; ``run_id`` and the like are left out."""
        return cls(**{k: v for k, v in trial.items() if k in cls.__dataclass_fields__})

    def output(self, g, h, n, parent):
        """Leaf value of gradient and hessian sums, shrunk by L1 and L2 and drawn to the parent's by ``path_smooth``."""
        raw = -np.sign(g) * np.maximum(np.abs(g) - self.lambda_l1, 0.0) / (h + self.lambda_l2)
        if self.path_smooth <= 0:
            return raw
        weight = n / self.path_smooth
        return raw * weight / (weight + 1) + parent / (weight + 1)

    def gain(self, g, h, out):
        """Twice the loss that a leaf of this value takes away, to second order."""
        g = np.sign(g) * np.maximum(np.abs(g) - self.lambda_l1, 0.0)
        return -(2 * g * out + (h + self.lambda_l2) * out * out)


@dataclass
class Tree:
    """Nodes as parallel lists; a leaf has feature -1.  Growth adds nodes that the finished tree may leave out."""

    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    rows: list[float] = field(default_factory=list)

    def add(self, value: float, rows: float) -> int:
        for column, x in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.value, value),
                          (self.gain, 0.0), (self.rows, rows)):
            column.append(x)
        return len(self.feature) - 1

    def arrays(self):
        return (np.array(self.feature, np.int64), np.array(self.cut), np.array(self.left, np.int64),
                np.array(self.right, np.int64))


def walk(columns: np.ndarray, tree) -> np.ndarray:
    """The leaf of each row; ``columns`` is features x rows, and a row goes left where its value is at most the cut."""
    feature, cut, left, right = tree
    n = columns.shape[1]
    flat, base = columns.ravel(), np.maximum(feature, 0) * n
    at, rows = np.zeros(n, np.int64), np.arange(n)
    node = at
    while True:
        inner = feature.take(node) >= 0
        rows, node = rows[inner], node[inner]
        if not len(rows):
            return at
        node = np.where(flat.take(base.take(node) + rows) <= cut.take(node), left.take(node), right.take(node))
        at[rows] = node


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _in_bag(key: np.ndarray, p: BoostParams, number: int) -> np.ndarray | None:
    """Rows of this round's share, drawn by the hash of a row, whatever its place; None for all."""
    if p.subsample >= 1.0:
        return None
    seed = np.uint64((p.random_state * 0x9E3779B97F4A7C15 + number * 0xD6E8FEB86659FD93) % (1 << 64))
    return _spread(key ^ seed) < np.uint64(int(p.subsample * (1 << 63)) * 2)


def _columns_of(p: BoostParams, number: int, n: int) -> np.ndarray:
    """Columns of this round's share, at least one."""
    take = min(n, max(1, round(p.colsample_bytree * n)))
    return np.sort(np.random.default_rng([p.random_state % (1 << 32), number]).permutation(n)[:take])


# --- rows ------------------------------------------------------------------------------------


def _sketch_edges(rows: DataFrame, n: int, bins: int) -> list[list[float]]:
    """Quantiles of each column at i / bins, from one pass over a sketch."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    found = rows.agg(*[F.percentile_approx(F.get("x", F.lit(i)), shares, 20_000).alias(f"q{i}") for i in range(n)]).first()
    return [list(found[f"q{i}"] or []) for i in range(n)]


def _allowed(quantiles: list[float], edges: np.ndarray, bins: int, of: int) -> np.ndarray:
    """Edges that a model of ``bins`` bins may cut at, out of those of the finest model, ``of``."""
    if bins >= of or not quantiles:
        return np.ones(len(edges), bool)
    chosen = {quantiles[max(1, round(j * of / bins)) - 1] for j in range(1, bins)}
    return np.isin(edges, list(chosen))


def _own(number: int) -> int:
    return number


def _places(bins: np.ndarray, key: np.ndarray, tasks: int) -> np.ndarray:
    """The task of each row: by its bins, or by its key where so many rows share them that one task would have too many."""
    mixed = np.zeros(bins.shape[1], np.uint64)
    for column in bins:
        mixed = _spread(mixed ^ (column.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    _, kind, rows = np.unique(mixed, return_inverse=True, return_counts=True)
    return (np.where(rows.take(kind) * tasks > len(key), _spread(key), mixed) % np.uint64(tasks)).astype(np.int64)


def _blocks(rows: DataFrame, edges: list[np.ndarray], count: int, alone: bool):
    """Blocks (bins, label, key, fold) of each task, one task if ``alone``; stored first, so a lost one is read again."""
    kind = np.uint8 if max(len(e) for e in edges) < 256 else np.uint16
    cores = rows.sparkSession.sparkContext.defaultParallelism
    # as many as there are cores, or a multiple, so that a task's rows are a block
    tasks = 1 if alone else min(cores * -(-count // (cores * CELL_ROWS)), -(-count // TASK_ROWS))

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(edges))
                binned = np.stack([np.searchsorted(e, x[:, i]).astype(kind) for i, e in enumerate(edges)])
                cells = [binned, *[b.column(i).to_numpy(zero_copy_only=False).astype(t) for i, t in (
                    (1, np.int8), (2, np.int64), (3, np.int32))]]
                if tasks > 1:
                    place = _places(binned, cells[2].view(np.uint64), tasks)
                    order = np.argsort(place, kind="stable")
                    ends = np.cumsum(np.bincount(place, minlength=tasks))
                    cells = [np.split(c.take(order, axis=-1), ends[:-1], axis=-1) for c in cells]
                    some = [i for i in range(tasks) if cells[1][i].size]
                else:
                    cells, some = [[c] for c in cells], [0]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *[
                    pa.array([c[i].tobytes() for i in some], pa.binary()) for c in cells]], names=list("pbykf"))

    stored = materialise(rows.select("x", "y", "k", "f").mapInArrow(
        run, "p int, b binary, y binary, k binary, f binary"), "binned")
    if alone:
        held = stored.select(*"bykf").coalesce(1).rdd
    else:
        held = stored.rdd.map(lambda r: (r[0], tuple(r[1:]))).partitionBy(tasks, _own).values()

    def one(some):
        cells = [[np.frombuffer(r[i], t) for r in some] for i, t in enumerate((kind, np.int8, np.uint64, np.int32))]
        return (np.concatenate([b.reshape(len(edges), -1) for b in cells[0]], axis=1), *[np.concatenate(c) for c in cells[1:]])

    def read(part):
        some, size = [], 0
        for r in part:
            some.append(r)
            size += len(r[1])
            if size >= (TASK_ROWS if alone else CELL_ROWS):
                yield one(some)
                some, size = [], 0
        if some:
            yield one(some)

    return held.mapPartitions(read)


# --- growth ----------------------------------------------------------------------------------


class _Grower:
    """One model's tree of one round: which nodes await sums, and which splits best-first growth takes."""

    def __init__(self, p: BoostParams, allowed: list[np.ndarray], number: int):
        self.p, self.number = p, number
        self.columns = _columns_of(p, number, len(allowed))
        self.bins = [len(allowed[c]) + 1 for c in self.columns]
        self.allowed = np.zeros((len(self.columns), max(self.bins)), bool)
        for i, c in enumerate(self.columns):
            self.allowed[i, :len(allowed[c])] = allowed[c]
        self.tree = Tree()
        self.depth: list[int] = []
        self.known: dict[int, tuple | None] = {}
        self.awaiting = [self._add(0.0, 0.0, 0)]

    def _add(self, value, rows, depth):
        self.depth.append(depth)
        return self.tree.add(value, rows)

    def told(self, sums: np.ndarray) -> None:
        """Sums (node, bins of all columns in a row, [rows, g, h]) of the awaiting nodes; then the next ones await theirs."""
        ends, step = np.cumsum(self.bins), max(1, _SOUGHT // self.allowed.size)
        for at in range(0, len(self.awaiting), step):
            nodes = self.awaiting[at:at + step]
            wide = np.zeros((len(nodes), *self.allowed.shape, 3))
            for i, (end, bins) in enumerate(zip(ends, self.bins)):
                wide[:, i, :bins] = sums[at:at + step, end - bins:end]
            self.known.update(zip(nodes, self._best(nodes, wide)))
        self.awaiting = []
        while True:
            done, widen = self._best_first()
            for node in widen:
                self._split(node)
            self.awaiting = [c for n in widen for c in (self.tree.left[n], self.tree.right[n]) if self._may_split(c)]
            for n in widen:
                for c in (self.tree.left[n], self.tree.right[n]):
                    if not self._may_split(c):
                        self.known[c] = None
            if done or self.awaiting:
                return

    def _may_split(self, node):
        return (self.p.max_depth <= 0 or self.depth[node] < self.p.max_depth) and (
            self.tree.rows[node] >= 2 * self.p.min_child_samples)

    def _best(self, nodes, sums):
        """The best split (gain, column, bin, left and right value and rows) of each node, or None."""
        p = self.p
        with np.errstate(all="ignore"):
            left = np.cumsum(sums, axis=2)
            whole = left[:, :, -1:, :]
            right = whole - left
            if nodes[0] == 0:
                n, g, h = whole[0, 0, 0]
                self.tree.rows[0], self.tree.value[0] = float(n), float(p.output(g, h, n, 0.0)) if h > 0 else 0.0
            parent = np.array([self.tree.value[node] for node in nodes])[:, None, None]
            outs = [p.output(s[..., 1], s[..., 2], s[..., 0], parent) for s in (left, right)]
            gain = sum(p.gain(s[..., 1], s[..., 2], o) for s, o in zip((left, right), outs)) - p.gain(
                whole[..., 1], whole[..., 2], parent)
            fits = self.allowed & np.isfinite(gain)
            for s in (left, right):
                fits &= (s[..., 0] >= max(1, p.min_child_samples)) & (s[..., 2] >= _LEAST_HESSIAN)
        gain = np.where(fits, gain, -np.inf)
        for at, top in enumerate(gain.reshape(len(nodes), -1).argmax(axis=1)):
            i, b = np.unravel_index(int(top), self.allowed.shape)
            where = at, i, b
            yield None if not gain[where] > 0 else (
                float(gain[where]), int(self.columns[i]), int(b), float(outs[0][where]), float(outs[1][where]),
                float(left[where][0]), float(right[where][0]))

    def _split(self, node):
        gain, column, b, left, right, n, m = self.known[node]
        t = self.tree
        t.feature[node], t.cut[node], t.gain[node] = column, b, gain
        t.left[node], t.right[node] = self._add(left, n, self.depth[node] + 1), self._add(right, m, self.depth[node] + 1)

    def _best_first(self):
        """(finished, nodes to widen): always the leaf of the largest gain splits next, until there are enough leaves.

        A node whose children's gains are not known yet is widened; the others that would follow if these had none
        are widened along with it, so a step goes down all of the tree.  What the true order leaves out is dropped.
        """
        self.taken, widen, leaves = [], [], 1
        queue = [(-self.known[0][0], 0)] if self.known.get(0) else []
        while queue and leaves < self.p.num_leaves:
            _, node = heapq.heappop(queue)
            self.taken.append(node)
            leaves += 1
            if self.tree.feature[node] < 0:
                widen.append(node)
                continue
            for c in (self.tree.left[node], self.tree.right[node]):
                if self.known.get(c):
                    heapq.heappush(queue, (-self.known[c][0], c))
        if widen == self.taken[-1:] and leaves == self.p.num_leaves:
            self._split(widen[0])
            widen = []
        return not widen, widen

    def finished(self) -> Tree:
        """The nodes that growth took, numbered anew; leaf values carry the step size."""
        out, taken, t = Tree(), set(self.taken), self.tree

        def copy(node):
            at = out.add(t.value[node] * self.p.learning_rate, t.rows[node])
            if node in taken:
                out.feature[at], out.cut[at], out.gain[at] = t.feature[node], t.cut[node], t.gain[node]
                out.left[at] = copy(t.left[node])
                out.right[at] = copy(t.right[node])
            return at

        copy(0)
        return out


def _cells(block):
    """(bins of each cell, its first row, label, key, fold) of a block (bins, label, key, fold); rows sorted by their bins."""
    bins, *row = block
    order = np.lexsort(bins)
    bins = bins.take(order, axis=1)
    starts = np.flatnonzero(np.append(True, (bins[:, 1:] != bins[:, :-1]).any(axis=0)))
    return bins.take(starts, axis=1), starts, *[r.take(order) for r in row]


def _drawn(params: dict[int, BoostParams], number: int, without):
    """Blocks (bins, scores, rows and labels that each model draws in this round) of cells, from blocks with scores."""
    def run(block):
        bins, starts, y, key, fold, scores = block
        counts, ones = np.zeros((2, *scores.shape), np.int32)
        for model, p in params.items():
            bag = _in_bag(key, p, number)
            keep = np.full(len(y), True) if without[model] is None else fold != without[model]
            keep = keep if bag is None else keep & bag
            counts[model] = np.add.reduceat(keep, starts, dtype=np.int32)
            ones[model] = np.add.reduceat(np.where(keep, y, 0), starts, dtype=np.int32)
        return bins, scores, counts, ones

    return run


def _sums(block, asked) -> list[np.ndarray]:
    """Sums of a block of drawn cells for each asked (model, columns, bins, tree, nodes)."""
    bins, scores, counts, ones = block
    out = []
    for model, columns, widths, tree, nodes in asked:
        slot = np.full(len(tree[0]), -1)
        slot[nodes] = np.arange(len(nodes))
        at = slot.take(walk(bins, tree))
        cells = np.flatnonzero((at >= 0) & (counts[model] > 0))
        with np.errstate(over="ignore"):
            prob = 1.0 / (1.0 + np.exp(-scores[model, cells]))
        n, at = counts[model, cells].astype(float), at[cells]
        g, h = n * prob - ones[model, cells], n * prob * (1.0 - prob)
        one = np.empty((len(nodes), sum(widths), 3))
        first = 0
        for c, width in zip(columns, widths):
            cell, size, to = at * width + bins[c, cells], len(nodes) * width, slice(first, first + width)
            for i, weight in enumerate((n, g, h)):
                one[:, to, i] = np.bincount(cell, weight, size).reshape(-1, width)
            first += width
        out.append(one)
    return out


def _step(asked):
    """Pass over the blocks of a task."""
    def run(part):
        total = None
        for block in part:
            sums = _sums(block, asked)
            total = sums if total is None else [a + b for a, b in zip(total, sums)]
        if total is not None:
            yield total

    return run


def _asked(growers: dict[int, _Grower]) -> list[tuple]:
    return [(i, g.columns, g.bins, g.tree.arrays(), g.awaiting) for i, g in growers.items() if g.awaiting]


class _Held:
    """A task's rows of one model's round: their gradients, and how far down the growing tree each has come."""

    def __init__(self, block, scores, p: BoostParams, number: int, without):
        bins, y, key, fold = block
        keep, bag = np.full(len(y), True) if without is None else fold != without, _in_bag(key, p, number)
        rows = np.flatnonzero(keep if bag is None else keep & bag)
        with np.errstate(over="ignore"):
            prob = 1.0 / (1.0 + np.exp(-scores[rows]))
        self.g, self.h = prob - y[rows], prob * (1.0 - prob)
        self.bins, self.node = bins.take(rows, axis=1), np.zeros(len(rows), np.int64)

    def sums(self, grower: _Grower) -> np.ndarray:
        """Sums (node, bins of all columns in a row, [rows, g, h]) of the awaiting nodes, as ``_sums``."""
        feature, cut, left, _ = grower.tree.arrays()  # the right child's number is the next one
        flat, n, nodes = self.bins.ravel(), len(self.node), grower.awaiting
        goes = feature.take(self.node)
        rows = moved = np.flatnonzero(goes >= 0) if len(feature) > 1 else np.arange(n)
        goes = goes.take(rows)
        while len(feature) > 1 and len(rows):
            node = self.node.take(rows)
            node = left.take(node) + (flat.take(goes * n + rows) > cut.take(node))
            self.node[rows] = node
            goes = feature.take(node)
            inner = np.flatnonzero(goes >= 0)
            rows, goes = rows.take(inner), goes.take(inner)
        # the awaiting nodes have just been made, so only rows that moved are in them
        slot = np.full(len(feature), -1)
        slot[nodes] = np.arange(len(nodes))
        at = slot.take(self.node.take(moved))
        inner = np.flatnonzero(at >= 0)
        at, rows = at.take(inner), moved.take(inner)
        g, h = self.g.take(rows), self.h.take(rows)
        one, first = np.empty((len(nodes), sum(grower.bins), 3)), 0
        for c, width in zip(grower.columns, grower.bins):
            cell, size, to = at * width + self.bins[c].take(rows), len(nodes) * width, slice(first, first + width)
            one[:, to, 0] = np.bincount(cell, minlength=size).reshape(-1, width)
            one[:, to, 1] = np.bincount(cell, g, size).reshape(-1, width)
            one[:, to, 2] = np.bincount(cell, h, size).reshape(-1, width)
            first += width
        return one


def _grown(blocks, p: BoostParams, allowed, without) -> list[Tree]:
    """All trees of one model from the blocks (bins, label, key, fold, scores) of the only task there is."""
    rows, scores, trees = [b[:4] for b in blocks], [b[4] for b in blocks], []
    for number in range(p.n_estimators):
        grower = _Grower(p, allowed, number)
        held = [_Held(r, s, p, number, without) for r, s in zip(rows, scores)]
        while grower.awaiting:
            grower.told(functools.reduce(np.add, (h.sums(grower) for h in held)))
        tree = grower.finished()
        if tree.feature[0] >= 0:
            trees.append(tree)
            value, arrays = np.array(tree.value), tree.arrays()
            scores = [s + value.take(walk(r[0], arrays)) for r, s in zip(rows, scores)]
    return trees


def _counted(block, p: BoostParams, number: int, without) -> tuple[np.ndarray, np.ndarray]:
    """Rows and labels that a model draws of each cell of a block (bins, starts, label, key, fold) in a round."""
    _, starts, y, key, fold = block
    upto, ends = np.zeros((2, len(y) + 1), np.int32), np.append(starts[1:], len(y))
    for at in range(0, len(y), TASK_ROWS):  # so that what comes in between stays in cache
        to = slice(at, at + TASK_ROWS)
        bag, keep = _in_bag(key[to], p, number), np.full(len(y[to]), True) if without is None else fold[to] != without
        keep = keep if bag is None else keep & bag
        for sums, x in zip(upto, (keep, keep * y[to])):
            np.cumsum(x, dtype=np.int32, out=sums[at + 1:at + 1 + len(x)])
            sums[at + 1:at + 1 + len(x)] += sums[at]
    return tuple(sums.take(ends) - sums.take(starts) for sums in upto)


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.result_type(np.min_scalar_type(x.min()), np.min_scalar_type(x.max()))) if x.size else x


class _Parted:
    """All cells of a model's round, each node's in one slice of their order; sums by node and bin.

    Of two children only the one of fewer cells is added up, the other one has what is left of the parent's sums.
    """

    def __init__(self, bins, groups, counts, ones, scores, grower: _Grower):
        with np.errstate(over="ignore"):
            prob = 1.0 / (1.0 + np.exp(-scores))
        n = counts.astype(float)
        self.weights = n, n * prob - ones, n * prob * (1.0 - prob)
        self.bins, self.order, self.at = bins, np.arange(len(n)), {0: (0, len(n))}
        ends = np.cumsum(grower.bins)
        to = {int(c): slice(e - w, e) for c, e, w in zip(grower.columns, ends, grower.bins)}
        self.size, self.known, self.parents = ends[-1], {}, 0
        # (combinations, widths, codes of the combinations, [(axis, column, its place in the sums)]) of the drawn columns
        self.groups = [(math.prod(widths), widths, codes, drawn) for columns, widths, codes in groups if (
            drawn := [(i, c, to[c]) for i, c in enumerate(columns) if c in to])]

    def split(self, tree: Tree, node: int) -> None:
        """Part the node's slice between its children."""
        if tree.left[node] not in self.at:
            first, end = self.at[node]
            some = self.order[first:end]
            right = self.bins[tree.feature[node]].take(some) > tree.cut[node]
            some = some[~right], some[right]
            middle = first + len(some[0])
            self.order[first:middle], self.order[middle:end] = some
            self.at[tree.left[node]], self.at[tree.right[node]] = (first, middle), (middle, end)

    def _added(self, node: int) -> np.ndarray:
        some = self.order[slice(*self.at[node])]
        weights = self.weights if node == 0 else [w.take(some) for w in self.weights]
        out = np.empty((self.size, 3))
        for size, widths, codes, drawn in self.groups:
            if len(some) >= size and len(drawn) > 1:
                code = codes if node == 0 else codes.take(some)
                for k, w in enumerate(weights):
                    joint = np.bincount(code, w, size).reshape(widths)
                    for i, _, to in drawn:
                        out[to, k] = joint.sum(axis=tuple(j for j in range(len(widths)) if j != i))
            else:
                for i, c, to in drawn:
                    code = self.bins[c].take(some).astype(np.int64)
                    for k, w in enumerate(weights):
                        out[to, k] = np.bincount(code, w, widths[i])
        return out

    def sums(self, grower: _Grower) -> np.ndarray:
        """Sums (node, bins of all columns in a row, [rows, g, h]) of the awaiting nodes, as ``_sums``."""
        tree, awaiting = grower.tree, set(grower.awaiting)
        if 0 in awaiting:
            self.known[0] = self._added(0)
        for node in [n for n in self.known if tree.feature[n] >= 0]:
            children = tree.left[node], tree.right[node]
            whole = self.known.pop(node)
            if not awaiting.intersection(children):
                continue
            self.split(tree, node)
            less, more = sorted(children, key=lambda c: self.at[c][1] - self.at[c][0])
            sums = {less: self._added(less)}
            if more in awaiting:
                sums[more] = whole - sums[less]
                sums[more][sums[more][:, 0] == 0] = 0.0
            self.known.update((c, s) for c, s in sums.items() if c in awaiting)
        return np.stack([self.known[n] for n in grower.awaiting])

    def leaves(self, grower: _Grower) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, its cells) of the finished tree, leaves by their number in the growing one."""
        taken, stack = set(grower.taken), [0]
        while stack:
            node = stack.pop()
            if node in taken:
                self.split(grower.tree, node)
                stack += [grower.tree.right[node], grower.tree.left[node]]
            else:
                yield node, self.order[slice(*self.at[node])]


def _grouped(bins: np.ndarray, widths: list[int]) -> list[tuple]:
    """(columns, widths, codes) of columns put together while their bins have at most ``JOINT`` combinations."""
    groups: list[list[int]] = []
    for c in np.argsort(widths, kind="stable").tolist():
        if groups and math.prod(widths[i] for i in groups[-1]) * widths[c] <= JOINT:
            groups[-1].append(c)
        else:
            groups.append([c])
    out = []
    for columns in groups:
        shape = [widths[c] for c in columns]
        codes = np.ravel_multi_index([bins[c].astype(np.int64) for c in columns], shape) if len(columns) > 1 else None
        out.append((columns, shape, codes))
    return out


def _grown_further(bins, scores, draws, p: BoostParams, allowed, numbers) -> list[Tree]:
    """The trees of these rounds of one model over all cells, from what each round draws; adds them to the scores."""
    groups, trees = _grouped(bins, [len(a) + 1 for a in allowed]), []
    for number, (counts, ones) in zip(numbers, draws):
        grower = _Grower(p, allowed, number)
        cells = _Parted(bins, groups, counts, ones, scores, grower)
        while grower.awaiting:
            grower.told(cells.sums(grower))
        tree = grower.finished()
        if tree.feature[0] >= 0:
            trees.append(tree)
            for leaf, some in cells.leaves(grower):
                scores[some] += grower.tree.value[leaf] * p.learning_rate
    return trees


def _grown_by_cells(base, params, allowed, without, start, cells: int, most: int) -> list[list[Tree]]:
    """All trees of all models from blocks of few cells: tasks count what rounds draw, a task grows a model from counts."""
    made: list[list[Tree]] = [[] for _ in params]
    many, rounds = len(params), max(p.n_estimators for p in params)
    step = max(1, DRAWN_BYTES // (2 * cells * np.min_scalar_type(most).itemsize))

    def counting(numbers):
        def run(place, part):
            for i, block in enumerate(part):
                found = {}  # models that draw the same rows share their counts
                for model, p in enumerate(params):
                    some = [n for n in numbers if n < p.n_estimators]
                    key = p.subsample, p.random_state, without[model], len(some)
                    if some:
                        if key not in found:
                            drawn = zip(*[_counted(block, p, n, without[model]) for n in some])
                            found[key] = [_narrow(np.stack(x)) for x in drawn]
                        yield model, (place, i, found[key])
                        yield model, (place, i, block[0])

        return run

    def growing(numbers):
        def run(part):
            held: dict[int, list] = {}
            for model, x in part:
                held.setdefault(model, []).append(x)
            for model, got in held.items():
                scores = next((x[1] for x in got if x[0] < 0), None)
                got = sorted((x for x in got if x[0] >= 0), key=lambda x: x[:2])
                if not got:  # it has had its rounds
                    continue
                bins = np.concatenate([x[2] for x in got if not isinstance(x[2], list)], axis=1)
                drawn = [x[2] for x in got if isinstance(x[2], list)]
                scores = np.full(bins.shape[1], start[model]) if scores is None else scores.copy()
                draws = (tuple(np.concatenate([d[k][i] for d in drawn]) for k in (0, 1)) for i in range(len(drawn[0][0])))
                trees = _grown_further(bins, scores, draws, params[model], allowed[model], numbers)
                yield model, (trees, scores)

        return run

    older = None
    try:
        for first in range(0, rounds, step):
            numbers = range(first, min(rounds, first + step))
            found = base.mapPartitionsWithIndex(counting(numbers))
            if older is not None:
                found = found.union(older.map(lambda x: (x[0], (-1, x[1][1]))))
            grown = found.partitionBy(many, _own).mapPartitions(growing(numbers)).persist(StorageLevel.MEMORY_AND_DISK)
            for model, trees in grown.map(lambda x: (x[0], x[1][0])).collect():
                made[model] += trees
            if older is not None:
                older.unpersist()
            older = grown
    finally:
        for held in (older, base):
            if held is not None:
                held.unpersist()
    return made


def _added(state, run):
    """The sums of all tasks, added up in a tree where there are many."""
    found = state.mapPartitions(run)
    if state.getNumPartitions() <= FLAT_TASKS:
        parts = found.collect()
        return [sum(p[1:], p[0]) for p in zip(*parts)]
    return found.treeReduce(lambda a, b: [x + y for x, y in zip(a, b)], depth=2)


def _scored(trees):
    """Blocks with the values of new trees, one list for each model, added to their scores."""
    walked = [[(t.arrays(), np.array(t.value)) for t in grown] for grown in trees]

    def run(block):
        bins, *rows, scores = block
        scores = scores.copy()
        for model, grown in enumerate(walked):
            for tree, value in grown:
                scores[model] += value.take(walk(bins, tree))
        return bins, *rows, scores

    return run


def _grown_by_passes(base, params, allowed, without) -> list[list[Tree]]:
    """All trees of all models from blocks of cells; each growth step is one pass over the cells that the round drew."""
    state = base
    made: list[list[Tree]] = [[] for _ in params]
    older = []
    try:
        for number in range(max(p.n_estimators for p in params)):
            growers = {i: _Grower(p, allowed[i], number) for i, p in enumerate(params) if number < p.n_estimators}
            drawn = state.map(_drawn({i: g.p for i, g in growers.items()}, number, without)).persist(
                StorageLevel.MEMORY_AND_DISK)
            older.append(drawn)
            while asked := _asked(growers):
                for (i, *_), sums in zip(asked, _added(drawn, _step(asked))):
                    growers[i].told(sums)
                for held in [h for h in older if h is not drawn]:
                    held.unpersist()
                older = [drawn]
            new = [[] for _ in params]
            for i, g in growers.items():
                tree = g.finished()
                if tree.feature[0] >= 0:
                    made[i].append(tree)
                    new[i] = [tree]
            older.append(state)
            remade = (number + 1) % REBASE == 0
            state = (base if remade else state).map(_scored(made if remade else new)).persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        for held in [*older, state, base]:
            held.unpersist()
    return made


def fit_trees(rows: DataFrame, n: int, params: list[BoostParams], without: list[int | None] | None = None):
    """Ensembles (start, trees with cuts as values, edges) of every parameter set from rows (x, y, k, f).

    ``x`` holds n doubles, ``y`` 0 or 1, ``k`` a hash that draws the row shares, ``f`` a fold; model i learns from
    the rows whose fold is not ``without[i]``.
    """
    without = without or [None] * len(params)
    finest = max(p.max_bin for p in params)
    counts = {r["f"]: (r["n"], r["s"]) for r in rows.groupBy("f").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")).collect()}  # one row for each fold
    quantiles = _sketch_edges(rows, n, finest)
    edges = [np.unique(np.array(q, float)) for q in quantiles]
    allowed = [[_allowed(q, e, p.max_bin, finest) for q, e in zip(quantiles, edges)] for p in params]
    count = sum(c for c, _ in counts.values())
    alone = count <= TASK_ROWS
    stored = _blocks(rows, edges, count, alone)
    start = []
    for w in without:
        size, ones = (sum(c[i] for f, c in counts.items() if f != w) for i in (0, 1))
        share = min(1 - 1e-12, max(1e-12, ones / size)) if size else 0.5
        start.append(float(np.log(share / (1 - share))))
    first = np.array(start)[:, None]
    if alone:
        base = stored.map(lambda b: (*b, np.repeat(first, len(b[1]), axis=1)))
        each = base.mapPartitions(lambda part: [(i, [(*r, s[i]) for *r, s in blocks]) for blocks in [list(part)] if blocks
                                                for i in range(len(params))]).partitionBy(len(params), lambda i: i)
        grown = dict(each.map(lambda ib: (ib[0], _grown(ib[1], params[ib[0]], allowed[ib[0]], without[ib[0]]))).collect())
        made = [grown.get(i, []) for i in range(len(params))]
    else:
        base = stored.map(_cells).persist(StorageLevel.MEMORY_AND_DISK)
        cells, most = base.map(lambda b: (len(b[1]), int(np.diff(b[1], append=len(b[2])).max()))).reduce(
            lambda a, b: (a[0] + b[0], max(a[1], b[1])))
        # of a cell: bins, score, rows and labels drawn, and places in slices
        if cells * (n * (1 if finest <= 256 else 2) + 21) <= ALONE_BYTES:
            made = _grown_by_cells(base, params, allowed, without, start, cells, most)
        else:
            scored = base.map(lambda b: (*b, np.repeat(first, len(b[1]), axis=1))).persist(StorageLevel.MEMORY_AND_DISK)
            made = _grown_by_passes(scored, params, allowed, without)
            base.unpersist()
    for trees in made:
        for t in trees:
            t.cut = [float(edges[f][int(c)]) if f >= 0 else 0.0 for f, c in zip(t.feature, t.cut)]
    return [(s, t) for s, t in zip(start, made)]


# --- models ----------------------------------------------------------------------------------


def _cuts(trees: list[Tree], n: int) -> list[np.ndarray]:
    """The cuts of the trees in each column."""
    return [np.unique([c for t in trees for g, c in zip(t.feature, t.cut) if g == f]) for f in range(n)]


def _coded(columns: np.ndarray, cuts: list[np.ndarray]) -> list[np.ndarray]:
    """Between which cuts the rows are in each column; a cell has its upper cut, the last one what is at most no cut."""
    return [np.searchsorted(c, x) for x, c in zip(columns, cuts)]


def _steps(cuts: list[np.ndarray], finer: list[np.ndarray]) -> list[np.ndarray]:
    """For each column, what a code between the finer cuts adds to the number of the cell between the cuts."""
    sizes = [len(c) + 1 for c in cuts]
    return [np.searchsorted(c, np.append(f, np.nan)) * math.prod(sizes[i + 1:]) for i, (c, f) in enumerate(zip(cuts, finer))]


def _placed(codes: list[np.ndarray], steps: list[np.ndarray]) -> np.ndarray:
    at = steps[0].take(codes[0])
    for code, step in zip(codes[1:], steps[1:]):
        if len(step) > 1:
            at += step.take(code)
    return at


def _within(path: dict, f: int, cuts: np.ndarray) -> slice:
    """The codes of column f that a leaf's path allows."""
    low, high, _ = path.get(f, (-np.inf, np.inf, 1.0))
    return slice(0 if low == -np.inf else int(np.searchsorted(cuts, low)) + 1,
                 len(cuts) + 1 if high == np.inf else int(np.searchsorted(cuts, high)) + 1)


def _leaf_values(trees: list[Tree], n: int):
    """A function columns -> the sum of the trees' values, tree by tree in their order.

    Of a tree of few enough cells between its cuts a table tells the leaf of each cell, and rows look up theirs.
    """
    finer, left, told = _cuts(trees, n), LEAF_CELLS, []
    for tree in trees:
        cuts = _cuts([tree], n)
        shape = [len(c) + 1 for c in cuts]
        if math.prod(shape) > min(left, CELLS):
            told.append((None, tree.arrays(), np.array(tree.value)))
            continue
        left -= math.prod(shape)
        paths = list(_leaf_paths(tree))
        leaf = np.zeros(shape, np.min_scalar_type(len(paths)))
        for i, (_, path) in enumerate(paths):
            leaf[tuple(_within(path, f, c) for f, c in enumerate(cuts))] = i
        told.append((_steps(cuts, finer), leaf.ravel(), np.array([v for v, _ in paths])))

    def values(columns, start):
        out, codes = np.full(columns.shape[1], start), _coded(columns, finer)
        for steps, leaf, value in told:
            out += value.take(walk(columns, leaf) if steps is None else leaf.take(_placed(codes, steps)))
        return out

    return values


def _leaf_paths(tree: Tree):
    """(value, {column: (above, at most, share)}) of each leaf: the interval that its path asks of a column, and the
    share of the rows that follow the path where it asks for that column."""
    stack = [(0, {})]
    while stack:
        node, path = stack.pop()
        f = tree.feature[node]
        if f < 0:
            yield tree.value[node], path
            continue
        low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
        for child, interval in ((tree.left[node], (low, min(high, tree.cut[node]))),
                                (tree.right[node], (max(low, tree.cut[node]), high))):
            stack.append((child, {**path, f: (*interval, share * tree.rows[child] / tree.rows[node])}))


_gauss = functools.lru_cache(maxsize=64)(np.polynomial.legendre.leggauss)


def _worth(value: float, share: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """What a leaf gives to each column of its path (kinds x columns), for rows inside in the columns of a kind's bits."""
    points, weights = _gauss(len(share) // 2 + 1)
    t, w = (points + 1) / 2, weights / 2
    held = (kinds[:, None] >> np.arange(len(share)) & 1).astype(float)
    mixed = held[:, :, None] * t + (share[:, None] * (1 - t))[None]
    rest = (mixed.prod(axis=1, keepdims=True) / mixed) @ w
    return value * (held - share) * rest


def shapley(columns: np.ndarray, tree: Tree) -> np.ndarray:
    """Each row's Shapley values of a tree's margin (features x rows), over the shares of rows below each node.

    A leaf gives its value times the product over its columns of "is inside" if a column is known, and of the share if
    not.  With each column known with chance t, the value of a column is the integral over t of what it changes; the
    integrand is a polynomial, so a few points give it exactly.  Rows are told apart only by which columns are inside.
    """
    out = np.zeros_like(columns)
    for value, path in _leaf_paths(tree):
        names = list(path)
        if not names or not value:
            continue
        inside = np.zeros(columns.shape[1], np.int64)
        for i, f in enumerate(names):
            # the comparison of ``walk``: what is not at most the cut goes right
            inside |= (~(columns[f] <= path[f][0]) & ((columns[f] <= path[f][1]) | (path[f][1] == np.inf))).astype(np.int64) << i
        # few columns: every kind of row there can be, without a sort of the rows
        kinds, row = (np.arange(1 << len(names)), inside) if len(names) <= 6 else np.unique(inside, return_inverse=True)
        gives = _worth(value, np.array([path[f][2] for f in names]), kinds)
        for i, f in enumerate(names):
            out[f] += gives[row, i]
    return out


def _told_cells(tree: Tree, n: int, cuts: list[np.ndarray]) -> np.ndarray:
    """``shapley`` of all cells between the tree's cuts (cells x columns).

    A leaf gives by which columns are inside, so its values are one row for the inside and one for the outside of the
    column of the most cuts, over the cells of the others; one matrix product adds up the rows of all leaves.
    """
    shape = [len(c) + 1 for c in cuts]
    if math.prod(shape) <= FEW_CELLS:
        corners = np.meshgrid(*[np.append(c, np.nan) for c in cuts], indexing="ij")
        return np.ascontiguousarray(shapley(np.stack([c.ravel() for c in corners]), tree).T)
    main = int(np.argmax(shape))
    others = [f for f in range(n) if f != main]
    rows, given = [], []
    for value, path in _leaf_paths(tree):
        names = list(path)
        if not names or not value:
            continue
        gives = _worth(value, np.array([path[f][2] for f in names]), np.arange(1 << len(names)))
        kind, bits, inside = np.zeros([shape[f] for f in others], np.int64), [0], np.zeros(shape[main], bool)
        for i, f in enumerate(names):
            if f == main:
                inside[_within(path, f, cuts[f])] = True
                bits.append(1 << i)
            else:
                one = np.zeros(shape[f], np.int64)
                one[_within(path, f, cuts[f])] = 1 << i
                kind += one.reshape([-1 if g == f else 1 for g in others])
        for bit in bits:
            rows.append(inside if bit else ~inside)
            part = np.zeros((kind.size, n))
            part[:, names] = gives.take(kind.ravel() | bit, axis=0)
            given.append(part.ravel())
    if not rows:
        return np.zeros((math.prod(shape), n))
    told = np.stack(rows, axis=1).astype(float) @ np.stack(given)
    return np.ascontiguousarray(np.moveaxis(told.reshape(shape[main], *[shape[f] for f in others], n), 0, main)).reshape(-1, n)


def explainer(tree: Tree, n: int, rows: int | None = None):
    """``shapley`` of a tree over n columns: (columns, their codes between finer cuts, these cuts) -> values.

    Rows between the same cuts in every column have the same values, so a tree of few such cells tells each cell's once
    and rows only look up theirs; a tree of more, or of many more than ``rows``, is told row by row.
    """
    cuts = _cuts([tree], n)
    size = math.prod(len(c) + 1 for c in cuts)
    if size > CELLS or sum(len(c) > 0 for c in cuts) > 6 or rows is not None and size > 32 * rows:
        return lambda columns, codes=None, finer=None: shapley(columns, tree)
    told = _told_cells(tree, n, cuts)

    def values(columns, codes=None, finer=None):
        at = _placed(_coded(columns, cuts) if codes is None else codes, _steps(cuts, cuts if finer is None else finer))
        return told.take(at, axis=0).T

    return values


def mean_value(tree: Tree) -> float:
    """The tree's margin over the rows it was grown on."""
    return sum(v * r for v, r, f in zip(tree.value, tree.rows, tree.feature) if f < 0) / tree.rows[0]


def _many(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    """Columns (features x rows) of many batches at once."""
    some, rows = [], 0
    for x in batches:
        some.append(x.to_numpy(dtype=float).T)
        rows += len(x)
        if rows >= EXPLAINED_ROWS:
            yield np.concatenate(some, axis=1)
            some, rows = [], 0
    if some:
        yield np.concatenate(some, axis=1)


class BoostedTreesModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted ensemble: adds ``probability`` and ``prediction``; saved and loaded with its pipeline."""

    features = Param(Params._dummy(), "features", "vector column", TypeConverters.toString)
    ensemble = Param(Params._dummy(), "ensemble", "start value and trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, features: str = "features", ensemble: str = '{"start": 0, "n": 1, "trees": []}'):
        super().__init__()
        self._set(features=features, ensemble=ensemble)

    @staticmethod
    def of(start: float, trees: list[Tree], n: int, features: str) -> "BoostedTreesModel":
        told = {"start": start, "n": n, "trees": [vars(t) for t in trees]}
        return BoostedTreesModel(features=features, ensemble=json.dumps(told))

    def parts(self) -> tuple[float, int, list[Tree]]:
        told = json.loads(self.getOrDefault(self.ensemble))
        return told["start"], told["n"], [Tree(**t) for t in told["trees"]]

    @property
    def featureImportances(self):
        """Gains by column, as shares."""
        _, n, trees = self.parts()
        total = np.zeros(n)
        for t in trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    total[f] += g
        return Vectors.dense(total / total.sum() if total.sum() > 0 else total)

    def explain(self, df: DataFrame, name: str = "explanation") -> DataFrame:
        """Add an array: each column's Shapley value of the margin, then the base value; they add up to the margin.

        ``df`` has the prepared vector column; rows are explained in Arrow batches.
        """
        start, n, trees = self.parts()
        base = start + sum(map(mean_value, trees))

        @F.pandas_udf(", ".join(f"e{i} double" for i in range(n + 1)))
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            finer = _cuts(trees, n)
            for columns in _many(batches):
                rows = columns.shape[1]
                codes, out = _coded(columns, finer), np.zeros((rows, n))
                for t in trees:
                    out += explainer(t, n, rows)(columns, codes, finer).T
                yield pd.DataFrame({f"e{i}": c for i, c in enumerate([*out.T, np.full(rows, base)])})

        told = df.withColumn(name, run(self._values(F.col(self.getOrDefault(self.features)), n)))
        return told.withColumn(name, F.array(*[F.col(f"`{name}`.e{i}") for i in range(n + 1)]))

    @staticmethod
    def _values(features, n: int):
        x = vector_to_array(features)
        return F.struct(*[F.get(x, F.lit(i)).alias(f"x{i}") for i in range(n)])

    def margin(self, features):
        """The margin of the rows, as a column of the vector column ``features``, in Arrow batches."""
        start, n, trees = self.parts()

        @F.pandas_udf("double")
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            values = _leaf_values(trees, n)
            for x in batches:
                yield pd.Series(values(np.ascontiguousarray(x.to_numpy(dtype=float).T), start))

        return run(self._values(features, n))

    def _transform(self, df: DataFrame) -> DataFrame:
        p = 1.0 / (1.0 + F.exp(-self.margin(F.col(self.getOrDefault(self.features)))))
        out = df.withColumn("probability", p)
        return out.withColumns({"probability": array_to_vector(F.array(1.0 - F.col("probability"), "probability")),
                                "prediction": (F.col("probability") > 0.5).cast("double")})


def _rows(prepared: PipelineModel, prep: Prep, df: DataFrame, label: str, fold: str | None) -> DataFrame:
    x = vector_to_array(F.col(prep.output))
    y = F.col(label).cast("int")
    return prepared.transform(df).filter(F.col(label).isNotNull()).select(
        x.alias("x"), y.alias("y"), F.xxhash64(x, y).alias("k"), (F.col(fold) if fold else F.lit(0)).cast("int").alias("f"))


def fit_boosted_many(df: DataFrame, prep: Prep, label: str, trials: list[dict], fold: str | None = None,
                     without: list[int | None] | None = None) -> list[PipelineModel]:
    """A model of each trial's parameters (``BoostParams``), all grown in the same passes over the rows.

    With ``fold``, model i learns from the rows whose fold is not ``without[i]``; fill values and scales are then
    those of all rows.  The models equal those of separate fits on the same bins.  Rows without a label are left out.
    """
    prepared = prep.fit(df)
    n = len(prep.used())
    found = fit_trees(_rows(prepared, prep, df, label, fold), n, [BoostParams.of(t) for t in trials], without)
    return [PipelineModel([*prepared.stages, BoostedTreesModel.of(s, trees, n, prep.output)]) for s, trees in found]


def explain(df: DataFrame, model: PipelineModel, names: list[str], name: str = "explanation") -> DataFrame:
    """Add a struct of each named column's Shapley value and ``base_value`` by a fitted ensemble; other columns stay."""
    out = model.stages[-1].explain(PipelineModel(model.stages[:-1]).transform(df), "_told")
    cells = [F.get("_told", F.lit(i)).alias(c) for i, c in enumerate([*names, "base_value"])]
    return out.select(*df.columns, F.struct(*cells).alias(name))


def fit_boosted(df: DataFrame, prep: Prep, label: str, **params) -> PipelineModel:
    """Leaf-wise boosted trees behind a preparation; parameters as in ``BoostParams``."""
    return fit_boosted_many(df, prep, label, [params])[0]
