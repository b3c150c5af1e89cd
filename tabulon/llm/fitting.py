"""Small optimisers for models of a bounded number of weights; the loss may be a Spark job."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.plans.shared import materialise


def minimise(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, rounds: int = 40,
             memory: int = 8, tolerance: float = 1e-5) -> np.ndarray:
    """L-BFGS with step halving; ``loss`` gives value and gradient."""
    x, (value, slope) = start.astype(float), loss(start)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        way, back = slope.copy(), []
        for s, y in reversed(steps):
            a = s @ way / (s @ y)
            way -= a * y
            back.append(a)
        if steps:
            s, y = steps[-1]
            way *= (s @ y) / (y @ y)
        else:
            way /= max(1.0, np.abs(way).sum())
        for (s, y), a in zip(steps, reversed(back)):
            way += s * (a - y @ way / (s @ y))
        size = 1.0
        for _ in range(12):
            at = x - size * way
            found, turned = loss(at)
            if found <= value - 1e-4 * size * (way @ slope):
                break
            size /= 2
        else:
            break
        s, y = at - x, turned - slope
        gain, x, value, slope = value - found, at, found, turned
        if s @ y > 1e-12:
            steps = [*steps, (s, y)][-memory:]
        if gain < tolerance * max(1.0, abs(value)):
            break
    return x


def sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(z, float)))


def drawn(labelled: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` of the rows of a frame with one row per doc_id, by the least hashes of the id.

    The count sets a threshold of the hash that leaves a little more than are wanted, and these few are ordered; so no
    partition sends more than its share.
    """
    stored = materialise(labelled, "labelled")
    share = 1.1 * rows / max(1, stored.count()) + 1e-9
    few = stored if share >= 1 else stored.filter(F.xxhash64("doc_id") < F.lit(int((share - 0.5) * 2.0 ** 64)))
    return few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
