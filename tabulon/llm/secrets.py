"""Secret scans: fixed formats, and automata inferred from the credentials those find."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulon.llm.words import per_batch
from tabulon.plans.shared import materialise

KINDS = ("assign", "access", "hex")
# Credentials of a kind, and other long strings, that an automaton is inferred from at most, drawn by hash.
FIT_STRINGS = 1_500
# Strings beyond this length are scored like others, but teach no automaton: cut short they would teach a false stop.
TAUGHT_LENGTH = 256
# States that an automaton may keep apart; what would be one more joins the state it hangs on, so that a tree of strings
# without a pattern, each a state for every character, stays small.
MOST_STATES = 400
# fixed patterns
_ASSIGN = re.compile(r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|"
                     r"[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")


def base_spans(text: str) -> list[tuple[int, str, int, str]]:
    """(start, kind, end, secret), leftmost and non-overlapping in each kind, by start and kind."""
    out = []
    if ":" in text or "=" in text:
        out += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    for run in _LONG.finditer(text):  # 24 hexadecimal digits always lie in such a run
        out += [(m.start() + run.start(), 2, m.end() + run.start(), m[0]) for m in _HEX.finditer(run[0])
                if len(m[0]) >= 24]
    return [(s, KINDS[k], e, x) for s, k, e, x in sorted(out)]


_SYMBOL = {**{c: "0" for c in "0123456789"}, **{c: "a" for c in "abcdef"}, **{c: "g" for c in "ghijklmnopqrstuvwxyz"},
           **{c: "A" for c in "ABCDEF"}, **{c: "G" for c in "GHIJKLMNOPQRSTUVWXYZ"}}


class Grammar:
    """A probabilistic automaton merged out of the prefix tree of example strings.

    States in the order of the tree either join an earlier state, if their chances of stopping and of each next
    symbol agree within a Hoeffding bound all the way down, or stay, up to ``most`` of them.  Symbols are classes of
    characters.
    """

    def __init__(self, examples: list[str], alpha: float = 0.05, most: int = MOST_STATES):
        self.next: list[dict[str, int]] = [{}]
        self.stop, self.seen, self.used = Counter(), Counter(), defaultdict(Counter)
        self.alpha = alpha
        for x in examples:
            at = 0
            for c in x:
                c = _SYMBOL.get(c, c)
                self.seen[at] += 1
                self.used[at][c] += 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                at = self.next[at][c]
            self.seen[at] += 1
            self.stop[at] += 1
        self._merge(most)

    def _differ(self, f1, n1, f2, n2) -> bool:
        return abs(f1 / n1 - f2 / n2) > math.sqrt(0.5 * math.log(2 / self.alpha)) * (n1 ** -0.5 + n2 ** -0.5)

    def _compatible(self, one: int, two: int) -> bool:
        todo = [(one, two)]
        while todo:
            a, b = todo.pop()
            n, m = self.seen[a], self.seen[b]
            if not n or not m:
                continue
            if self._differ(self.stop[a], n, self.stop[b], m):
                return False
            for c in self.next[a].keys() | self.next[b].keys():
                if self._differ(self.used[a][c], n, self.used[b][c], m):
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        todo = [(into, tree)]
        while todo:
            a, b = todo.pop()
            self.seen[a] += self.seen[b]
            self.stop[a] += self.stop[b]
            for c, n in self.used[b].items():
                self.used[a][c] += n
            for c, child in self.next[b].items():
                if c in self.next[a]:
                    todo.append((self.next[a][c], child))
                else:
                    self.next[a][c] = child

    def _merge(self, most: int) -> None:
        red = [0]
        while True:
            blue = [(p, c, q) for p in red for c, q in sorted(self.next[p].items()) if q not in red]
            if not blue:
                return
            parent, symbol, state = max(blue, key=lambda x: (self.seen[x[2]], -x[2]))
            into = next((r for r in red if self._compatible(r, state)), None)
            if into is None and len(red) >= most:  # the tree's thin ends all join the state they hang on
                into = parent
            if into is None:
                red.append(state)
            else:
                self.next[parent][symbol] = into
                self._fold(into, state)

    def per_symbol(self, text: str) -> float:
        """Mean log-likelihood of the symbols and the stop, with one count of doubt in each state."""
        at, total = 0, 0.0
        for c in text:
            c = _SYMBOL.get(c, c)
            n = self.seen[at] if at is not None else 0
            total += math.log((self.used[at][c] + 0.02 if n else 0.02) / (n + 1))
            at = self.next[at].get(c) if at is not None else None
        n = self.seen[at] if at is not None else 0
        return (total + math.log(((self.stop[at] if n else 0) + 0.02) / (n + 1))) / (len(text) + 1)


class Formats:
    """An automaton for each kind of credential, one for other long strings, and the score that sets them apart."""

    def __init__(self, examples: dict[str, list[str]], others: list[str]):
        examples = {k: sorted(x) for k, x in sorted(examples.items()) if len(x) >= 20}
        self.kinds = [Grammar(x[::2]) for x in examples.values()]
        # strings as likely as credentials under a kind's automaton may be some, and do not teach the other one
        tests = [x for xs in examples.values() for x in xs[1::2]]
        usual = sorted(self._best(x) for x in tests)
        others = [x for x in sorted(others) if usual and self._best(x) < usual[len(usual) // 20]]
        self.others = Grammar(others) if others else None
        held = sorted(self.score(x) for x in tests)
        self.least = max(0.2, held[len(held) // 20]) if held else math.inf

    def _best(self, text: str) -> float:
        return max(g.per_symbol(text) for g in self.kinds)

    def score(self, text: str) -> float:
        """By how much the best kind's mean log-likelihood is above that of other strings."""
        return self._best(text) - (self.others.per_symbol(text) if self.others else -3.0)


def _free(text: str, base) -> list[tuple[int, int]]:
    """Long strings with a digit and a letter that touch no base span."""
    out = []
    for m in _LONG.finditer(text):
        s, e = m.span()
        while e > s and text[e - 1] in ".=-_/+":
            e -= 1
        x = text[s:e]
        if len(x) >= 16 and any(c.isdigit() for c in x) and any(c.isalpha() for c in x) and not any(
                s < b[2] and b[0] < e for b in base):
            out.append((s, e))
    return out


def infer(docs: DataFrame, strings: int = FIT_STRINGS) -> Formats:
    """Automata from the credentials that the fixed patterns label, at most ``strings`` distinct ones a kind.

    The texts are read once; strings longer than TAUGHT_LENGTH teach nothing.
    """

    def run(kept, texts):
        rows = set()
        for t in texts:
            text = (t or b"").decode("utf-8", "replace")
            base = base_spans(text)
            rows.update((kind, x) for _, kind, _, x in base if len(x) <= TAUGHT_LENGTH)
            rows.update(("other", text[s:e]) for s, e in _free(text, base) if e - s <= TAUGHT_LENGTH)
        cols = list(zip(*sorted(rows))) or [(), ()]
        return {"kind": pa.array(cols[0], pa.string()), "x": pa.array(cols[1], pa.string())}

    found = materialise(per_batch(docs, "text", [], run, "kind string, x string").distinct(), "strings")
    got = defaultdict(list)
    for kind in (*KINDS, "other"):
        rows = found.filter(F.col("kind") == kind).orderBy(F.xxhash64("x"), "x").limit(strings)
        got[kind] = [r.x for r in rows.collect()]
    others = got.pop("other")
    return Formats(got, others)


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base, spans): the secrets of every whole text.

    ``base`` and ``spans`` list (kind, start, end) in code points, end exclusive, by start and kind; ``base`` has
    those of the fixed patterns, ``spans`` also other long strings, kind ``model``, whose format is likelier under
    an automaton inferred from the corpus's own credentials than under that of its other strings, by as much as
    it is for 19 of 20 credentials that the automata were not built from.

    Null and empty texts have none; corpora with fewer than 20 distinct credentials of each kind get no ``model``
    spans.  Repeated rows each get their result; a null doc_id stays null.  Other columns are not read.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    formats = infer(docs)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(kept, texts):
        base, every = [], []
        for t in texts:
            text = (t or b"").decode("utf-8", "replace")
            found = base_spans(text)
            rows = [{"kind": k, "start": s, "end": e} for s, k, e, _ in found]
            more = [{"kind": "model", "start": s, "end": e} for s, e in _free(text, found)
                    if formats.kinds and formats.score(text[s:e]) > formats.least]
            base.append(rows)
            order = {k: i for i, k in enumerate((*KINDS, "model"))}
            every.append(sorted(rows + more, key=lambda r: (r["start"], order[r["kind"]])))
        counts = {f"n_{k}": pa.array([sum(r["kind"] == k for r in b) for b in base], pa.int64()) for k in KINDS}
        return {"doc_id": kept[0], **counts, "base": pa.array(base, span), "spans": pa.array(every, span)}

    kind = "array<struct<kind:string,start:bigint,end:bigint>>"
    return per_batch(docs, "text", ["doc_id"], run,
                     f"doc_id long, n_assign long, n_access long, n_hex long, base {kind}, spans {kind}")


def joined(spans: str):
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")
