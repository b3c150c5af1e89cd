"""Order-dependent results without a one-partition window.

A frame is range-partitioned on (group, order), sorted and written out once, so every
later job sees the same slices.  Row numbers are slice offset + position in the slice;
running values are a window inside (slice, group) plus a carry from earlier slices.
A carry exists only for the first group of a slice, so there is at most one per slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulon.plans.shared import materialise

SLICE, ROW, _TIE = "_slice", "_row", "_tie"
# Groups known to be at most this long may be handled by one ordinary window.
WINDOW_ROWS = 4_000


def _named(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def sorted_slices(df: DataFrame, order, by=()) -> DataFrame:
    """The frame in global (by, order) order with ``_slice`` and ``_row``.

    The trailing tie-breaker lets the range partitioner cut inside a run of equal keys,
    so one value holding a large share of the rows is spread over several slices.
    """
    keys = [F.col(b) for b in by] + _named(order)
    laid_out = (
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(*keys, _TIE)
        .sortWithinPartitions(*keys, _TIE)
        .drop(_TIE)
    )
    # Numbered in the writing job and stored: later jobs read the numbers, whatever way they split the files.
    return materialise(laid_out.select(
        "*",
        F.spark_partition_id().alias(SLICE),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias(ROW),
    ), "sorted")


def dense_ids(df: DataFrame, order, name: str, start: int = 0) -> DataFrame:
    """Consecutive ids in the given order; one range shuffle, no window over the rows."""
    slices = sorted_slices(df, order)
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slices.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_n"))  # one row per slice
        .select(F.col(SLICE), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    numbered = slices.join(F.broadcast(offsets), SLICE)
    id_ = (F.col("_offset") + F.col(ROW) + F.lit(start)).cast("long")
    return numbered.select(*df.columns, id_.alias(name))


def running(df: DataFrame, order, by=(), sums=None, lasts=None, longest: int | None = None) -> DataFrame:
    """Add running sums and running last-non-null values per group.

    ``sums`` / ``lasts`` map a new column name to the column it runs over; the current row
    is included.  ``longest`` is a proven bound of the group length: up to ``WINDOW_ROWS``
    an ordinary window per group is enough.
    """
    sums, lasts, by = dict(sums or {}), dict(lasts or {}), list(by)
    if longest is not None and longest <= WINDOW_ROWS and by:
        w = Window.partitionBy(*by).orderBy(*_named(order)).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        return df.select(
            "*",
            *[F.sum(c).over(w).alias(n) for n, c in sums.items()],
            *[F.last(c, ignorenulls=True).over(w).alias(n) for n, c in lasts.items()],
        )

    slices = sorted_slices(df, order, by)
    spanning = slices
    if by:
        # Only groups that open a slice can have begun in an earlier one: one per slice.
        heads = slices.filter(F.col(ROW) == 0).select(*[F.col(b).alias(f"_h_{b}") for b in by]).distinct()
        cond = F.lit(True)
        for b in by:
            cond = cond & F.col(b).eqNullSafe(F.col(f"_h_{b}"))
        spanning = slices.join(F.broadcast(heads), cond, "left_semi")
    pieces = spanning.groupBy(SLICE, *by).agg(
        *[F.sum(c).alias(f"_p_{n}") for n, c in sums.items()],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ROW))).alias(f"_p_{n}") for n, c in lasts.items()],
    )
    before = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carries = pieces.select(
        F.col(SLICE).alias("_c_slice"),
        *[F.col(b).alias(f"_c_{b}") for b in by],
        *[F.sum(f"_p_{n}").over(before).alias(f"_c_{n}") for n in sums],
        *[F.last(f"_p_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in lasts],
    )
    has_carry = F.lit(False)
    for n in [*sums, *lasts]:
        has_carry = has_carry | F.col(f"_c_{n}").isNotNull()
    carries = carries.filter(has_carry)

    inside = Window.partitionBy(SLICE, *by).orderBy(ROW).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = slices.select(
        "*",
        *[F.sum(c).over(inside).alias(f"_l_{n}") for n, c in sums.items()],
        *[F.last(c, ignorenulls=True).over(inside).alias(f"_l_{n}") for n, c in lasts.items()],
    )
    cond = F.col(SLICE) == F.col("_c_slice")
    for b in by:
        cond = cond & F.col(b).eqNullSafe(F.col(f"_c_{b}"))
    joined = local.join(F.broadcast(carries), cond, "left")
    return joined.select(
        *df.columns,
        # a sum is NULL only while it has seen nothing but NULLs
        *[F.when(F.col(f"_l_{n}").isNull(), F.col(f"_c_{n}"))
          .otherwise(F.col(f"_l_{n}") + F.coalesce(F.col(f"_c_{n}"), F.lit(0))).alias(n) for n in sums],
        *[F.coalesce(f"_l_{n}", f"_c_{n}").alias(n) for n in lasts],
    )
