"""Quality rules: text statistics and a decision list learned from labelled documents by sequential covering."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.fitting import drawn
from tabulon.llm.words import Codes, Rolling, per_batch, shared_codes
from tabulon.plans.shared import materialise

WINDOW = 5
# Labelled rows that the list is learned from at most, drawn by a hash of the id.
FIT_ROWS = 20_000
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_adjacent",
          "n_digits", "n_upper", "n_marks"]
# What rules may test: each is a ratio of two counts, so that the length of a text does not decide alone.
RATIOS = {"symbols": ("n_symbols", "word_chars"), "repeats": ("n_repeat_words", "n_words"),
          "dup_lines": ("n_dup_lines", "n_lines"), "distinct": ("n_distinct", "n_words"),
          "adjacent": ("n_adjacent", "n_words"), "digits": ("n_digits", "word_chars"),
          "upper": ("n_upper", "word_chars"), "marks": ("n_marks", "n_words"),
          "word_length": ("word_chars", "n_words"), "line_words": ("n_words", "n_lines")}
_SYMBOLS, _DIGITS, _CAPITALS = b"#*$%&|<>", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = b".,;:!?"


def _counts(text: bytes, codes: Codes) -> tuple[int, ...]:
    found = text.split()
    n = len(found)
    without = len(text) - len(text.translate(None, b" \t\n\r\x0b\x0c"))
    seen, dup, lines = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\n\r\x0b\x0c"):
            lines += 1
            dup += line in seen
            seen.add(line)
    words = codes.of(found)
    repeated = 0
    if n > WINDOW:
        _, which, times = np.unique(Rolling(words).every(WINDOW), return_inverse=True, return_counts=True)
        if len(times) <= n - WINDOW:
            depth = np.zeros(n + 1, np.int64)
            start = np.flatnonzero(times[which] > 1)
            depth[start] += 1
            depth[start + WINDOW] -= 1
            repeated = int((np.cumsum(depth) > 0).sum())
    drop = [len(text) - len(text.translate(None, x)) for x in (_SYMBOLS, _DIGITS, _CAPITALS)]
    return (n, len(text.decode("utf-8", "replace")) - without, drop[0], dup, repeated, lines, len(set(found)),
            int((words[1:] == words[:-1]).sum()), drop[1], drop[2], sum(w[-1] in _MARKS for w in found))


def statistics(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the counts of each text; null counts as empty.

    n_dup_lines are lines with a word that equal an earlier line; n_repeat_words are words inside 5-word windows
    that the text holds twice or more; n_adjacent are words equal to the word before.
    """

    def run(kept, texts):
        codes = shared_codes()
        rows = np.array([_counts(t or b"", codes) for t in texts], np.int64).reshape(-1, len(COUNTS))
        return {"doc_id": kept[0], **{c: pa.array(rows[:, i]) for i, c in enumerate(COUNTS)}}

    return per_batch(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")),
                     "text", ["doc_id"], run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def ratios() -> dict[str, Column]:
    """The columns that rules test, 0 where the divisor is 0."""
    return {name: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0)) for name, (a, b) in RATIOS.items()}


@dataclass
class DecisionList:
    """Rules in order; each is a list of (ratio, sign, threshold), sign 1 for >= and -1 for <=."""

    rules: list[list[tuple[str, int, float]]] = field(default_factory=list)

    def number(self) -> Column:
        """The number of the first rule that a row meets, from 1; null when it meets none."""
        tests, out = ratios(), F.lit(None).cast("int")
        for i in reversed(range(len(self.rules))):
            met = F.lit(True)
            for name, sign, limit in self.rules[i]:
                met = met & ((tests[name] >= limit) if sign > 0 else (tests[name] <= limit))
            out = F.when(met, F.lit(i + 1)).otherwise(out)
        return out

    def describe(self) -> list[str]:
        return [" and ".join(f"{n} {'>=' if s > 0 else '<='} {t:.6g}" for n, s, t in r) for r in self.rules]


def _met(x: np.ndarray, rule, names) -> np.ndarray:
    out = np.ones(len(x), bool)
    for name, sign, limit in rule:
        out &= sign * x[:, names.index(name)] >= sign * limit
    return out


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str], most: int, steps: int) -> list:
    """Add the condition of most information gain until only bad rows are covered."""
    rule, inside = [], np.ones(len(x), bool)
    while len(rule) < most and (inside & ~bad).any():
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        best = (1e-9, None)
        for i, name in enumerate(names):
            values = x[inside, i]
            order = np.argsort(values, kind="stable")
            value, hit = values[order], np.concatenate([[0], np.cumsum(bad[inside][order])])
            cuts = np.flatnonzero(np.diff(value) > 0) + 1
            if len(cuts) > steps:
                cuts = cuts[np.linspace(0, len(cuts) - 1, steps).astype(int)]
            for sign in (1, -1):
                size = (len(value) - cuts) if sign > 0 else cuts
                good = (p - hit[cuts]) if sign > 0 else hit[cuts]
                gain = good * (np.log2(np.maximum(good, 1e-9) / np.maximum(size, 1)) - np.log2(p / (p + n)))
                if len(gain) and gain.max() > best[0]:
                    at = int(gain.argmax())
                    best = (gain[at], (name, sign, float((value[cuts[at]] + value[cuts[at] - 1]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside = _met(x, rule, names)
    return rule


def _simple(rule: list) -> list:
    """One bound of a kind for each ratio, the tightest, where the first of them stood."""
    tight: dict = {}
    for name, sign, limit in rule:
        tight[name, sign] = limit if (name, sign) not in tight else sign * max(sign * limit, sign * tight[name, sign])
    return [(name, sign, limit) for (name, sign), limit in tight.items()]


def _pruned(rule: list, worth) -> list[list]:
    """The rule, and what is left of it as the conditions that serve least are taken out one by one."""
    found = [rule]
    while len(found[-1]) > 1:
        shorter = [found[-1][:i] + found[-1][i + 1:] for i in range(len(found[-1]))]
        found.append(max(shorter, key=lambda r: (worth(r)[0] / max(worth(r)[1], 1), worth(r)[0])))
    return found


def learn(x: np.ndarray, bad: np.ndarray, names: list[str], seed: int = 7, precision: float = 0.95, support: int = 5,
          rules: int = 16, conditions: int = 4, steps: int = 256) -> DecisionList:
    """Sequential covering: grow a conjunction on two thirds of the rows, take out conditions as serves the other
    third best, keep it if it is precise there, take out what it covers, and go on.

    A rule that is not precise is set aside with the bad rows that it covers, and the next one is grown from the
    others.  ``rules``, ``conditions`` and ``steps`` bound the size of the list, of a rule, and the cuts tried for a
    ratio: rows that only more of them would tell apart are kept.
    """
    found, left = DecisionList(), np.ones(len(x), bool)
    part = np.random.default_rng(seed).permutation(len(x)) % 3 > 0
    aside = np.zeros(len(x), bool)
    while len(found.rules) < rules and (left & bad & part & ~aside).sum() >= support:
        seen = left & part & ~aside
        rule = _simple(_grow(x[seen], bad[seen], names, conditions, steps))
        if not rule:
            break

        def worth(r):
            met = _met(x, r, names) & left & ~part
            return (met & bad).sum(), met.sum()

        options = [(r, *worth(r)) for r in _pruned(rule, worth)]
        options = [(g / max(n, 1), g, r) for r, g, n in options if g >= support / 2 and g >= precision * n]
        if not options:
            covered = _met(x, rule, names) & seen & bad
            if not covered.any():
                break
            aside |= covered
            continue
        rule = max(options, key=lambda o: (round(o[0], 3), o[1], -len(o[2])))[2]
        found.rules.append(rule)
        left &= ~_met(x, rule, names)
    return found


def fit_rules(stats: DataFrame, labels: DataFrame, good: str = "quality", rows: int = FIT_ROWS) -> DecisionList:
    """A list of rules for labels of 0, from at most ``rows`` labelled rows; without both labels it is empty."""
    wanted = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{good}`").alias("good")).filter(
        "good is not null and doc_id is not null").groupBy("doc_id").agg(F.min("good").alias("good"))
    # of several texts of an id the least by its counts
    single = stats.join(drawn(wanted, rows), "doc_id").groupBy("doc_id").agg(F.min("good").alias("good"),
                                                                             F.min(F.struct(*COUNTS)).alias("c"))
    sample = single.select("doc_id", "good", "c.*").select("doc_id", "good", *[c.alias(n) for n, c in ratios().items()])
    got = sample.orderBy("doc_id").collect()  # at most ``rows``
    names = list(RATIOS)
    x = np.array([[r[n] for n in names] for r in got], float).reshape(-1, len(names))
    bad = np.array([r.good == 0 for r in got], bool)
    return learn(x, bad, names) if bad.any() and not bad.all() else DecisionList()


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, counts, base_failed, rule, kept): the verdict on each text.

    base_failed: fewer than 10 words, or more than a fifth of them inside repeated 5-word windows.  kept: not
    base_failed, and none of the learned rules is met; ``rule`` is the number of the first that is.

    Null and empty texts have no words and fail.  Repeated rows each get their result; labels without an id or a
    value are not used, and of several labels of an id the lowest is.  Other columns are not read.
    """
    stats = materialise(statistics(docs, id_col, text), "statistics")
    rules = fit_rules(stats, labels)
    failed = F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")
    out = stats.withColumn("base_failed", failed).withColumn("rule", rules.number())
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
