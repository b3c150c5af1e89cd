"""Words, word codes and rolling window hashes inside Arrow batches."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Two odd bases of polynomial hashes modulo 2**64; together they name a window by 128 bits.
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
# Words that a table of codes holds at most, some 180 bytes each.
_REMEMBERED = 1 << 17
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def words(text: bytes | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text; null has none."""
    return text.split() if text else []


class Codes(dict):
    """64-bit code of a word, remembered for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


@functools.lru_cache(maxsize=1)
def shared_codes() -> Codes:
    """One table of word codes for all tasks of a worker process."""
    return Codes()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 14, 1 << n.bit_length())
        back = pow(base, -1, 1 << 64)
        have = _POWERS[base] = tuple(
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64), dtype=np.uint64)])
            for b in (base, back))
    return have


class Rolling:
    """Hashes of any word windows of one document from running sums."""

    def __init__(self, codes: np.ndarray, base: int = BASES[0]):
        n = len(codes)
        up, self.back = _powers(base, n + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * up[:n], dtype=np.uint64)])

    def windows(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each window [start, end); its length goes into the hash."""
        raw = (self.sums[end] - self.sums[start]) * self.back[start]
        return mix(raw + (end - start).astype(np.uint64))

    def every(self, k: int) -> np.ndarray:
        """Hashes of all windows of ``k`` words."""
        raw = (self.sums[k:] - self.sums[:-k]) * self.back[:len(self.sums) - k]
        return mix(raw + np.uint64(k))


def free_name(name: str, taken: list[str]) -> str:
    """``name``, made longer until no column has it, whatever the case."""
    taken = {t.lower() for t in taken}
    while name.lower() in taken:
        name += "_"
    return name


def per_batch(df: DataFrame, text: str, keep: list[str], fn: Callable[[list, list], dict], schema: str) -> DataFrame:
    """Run ``fn(kept columns as lists, texts as UTF-8 bytes) -> columns`` over Arrow batches.

    Only ``keep`` and the text reach Python; the names inside are positional, so that extra columns of the
    frame cannot clash.
    """
    narrow = df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)],
                       F.col(f"`{text}`").cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                cols = fn([part.column(i) for i in range(len(keep))], part.column(len(keep)).to_pylist())
                types = types or {k: getattr(v, "type", None) for k, v in cols.items()}
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array(v) for v in cols.values()],
                    names=list(cols))

    return narrow.mapInArrow(run, schema)


def long_lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """Arrow lists of 64-bit integers from flat values and the length of each list."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.uint64).view(np.int64)))
