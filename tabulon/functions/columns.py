"""Column expressions shared by the operators; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(name: str) -> Column:
    """The column as a double, NaN taken as missing."""
    c = F.col(name).cast("double")
    return F.when(~F.isnan(c), c)


def hash_text(*parts) -> Column:
    """md5 of the parts joined by '|': the same text in every SQL engine."""
    return F.md5(F.concat_ws("|", *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts]).cast("binary"))


def hash_int(digest: Column, digits: int = 8) -> Column:
    """The first hex digits of a digest as a long."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def hash_uniform(*parts) -> Column:
    """Uniform number in [0, 1) from a hash of the parts."""
    return hash_int(hash_text(*parts)) / F.lit(float(1 << 32))


def pick(words: list[str], *parts) -> Column:
    """One of the words, chosen by a hash of the parts."""
    index = F.pmod(hash_int(hash_text(*parts)), F.lit(len(words))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(w) for w in words]), index)


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, NULL when the bottom is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))
