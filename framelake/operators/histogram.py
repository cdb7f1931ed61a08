"""Exact ranks and distances of distributions from histograms, without sorting all values.

Values are counted into fixed bins of each column's range. A bin's count tells which ranks it holds and bounds how far two distributions
can part inside it, so only the few bins that hold a wanted rank, or could hold the largest distance, are opened: their
values alone are read again and put in order. ``value counts`` are rows ``(window_start, column_name, value, c, cb)``: how often
a value occurs in the window, and how many of these occurrences lie in the baseline.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.operators.sequence import fits_one_task, running_totals
from framelake.session import staged

BY = ["window_start", "column_name"]
#: Bins over a column's finite range. Below and above them lie -inf, inf and NaN, in this order.
BINS = 1024


def column_ranges(counts: DataFrame) -> DataFrame:
    """``(column_name, lo, hi, middle)``: the finite range of each column, and the middle of that without the baseline; one row per column name."""
    v = F.col("value")
    finite = F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)
    here = F.when(F.col("c") > 0, finite)
    return counts.groupBy("column_name").agg(
        F.min(finite).alias("lo"), F.max(finite).alias("hi"), (F.min(here) / 2 + F.max(here) / 2).alias("middle"))


def with_bins(counts: DataFrame, bins: int = BINS) -> DataFrame:
    """``counts`` with the ``bin`` of each value (null for null) and ``middle``, that of the range of its column's windows.

    A larger value never has a smaller bin: every step of the computation keeps the order, rounding included.
    """
    v, lo, hi = F.col("value"), F.col("lo"), F.col("hi")
    share = F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2)
    inner = F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1))
    place = (F.when(v.isNull(), F.lit(None)).when(F.isnan(v), bins + 1).when(v == float("inf"), bins).when(v == float("-inf"), -1)
             .otherwise(inner)).cast("int")
    # One row per monitored column: the column list bounds this broadcast.
    ranged = counts.join(F.broadcast(column_ranges(counts)), "column_name")
    return ranged.withColumn("bin", place).drop("lo", "hi")


def cells(binned: DataFrame) -> DataFrame:
    """Counts and extremes of both sides per window, column and bin: no more rows than bins in each window."""
    c, cb, v = F.col("c"), F.col("cb"), F.col("value")
    here, base = F.when(c > 0, v), F.when(cb > 0, v)
    return binned.where(v.isNotNull()).groupBy(*BY, "bin").agg(
        F.sum(c).alias("c"), F.sum(cb).alias("cb"), F.min(here).alias("least"), F.max(here).alias("most"),
        F.min(base).alias("base_least"), F.max(base).alias("base_most"))


def _within(at: Column, to: Column, size: Column) -> Column:
    return (to - size <= at) & (at < to)


@dataclass(frozen=True)
class Histogram:
    """Value counts with their bins, and their cells: two written tables, each read several times."""

    binned: DataFrame
    cell: DataFrame
    small: bool

    @staticmethod
    def of(counts: DataFrame) -> Histogram:
        """``counts`` is read several times: give a written table. The bins are written with the values, so that no reader looks for the
        columns' ranges again."""
        binned = staged(with_bins(counts), "binned")
        return Histogram(binned, staged(cells(binned), "cells"), fits_one_task(counts))

    def running(self, rows: DataFrame, by: list[str], totals: dict[str, Column]) -> DataFrame:
        """Running totals over the values of opened bins. A bin holds each value of the counts once at most, so where the counts fit
        one task no bin needs cutting; else the opened rows are written, for the sample that finds hot bins and for the window."""
        if self.small:
            return running_totals(rows, by, ["value"], totals, partitions=1)
        return running_totals(staged(rows, "opened"), by, ["value"], totals)


def values_at(hist: Histogram, by: Sequence[str], amount: str, at: dict[str, Column]) -> DataFrame:
    """``(by, <name> ...)``: the values that stand at zero-based positions of the ``amount`` copies of values, per group.

    ``at`` gives each position as an expression of ``_n``, the group's number of rows. Only rows of bins that
    hold a wanted position are read; they alone are ranked.
    """
    by, size = list(by), F.col(amount)
    known = hist.cell.where(size > 0).groupBy(*by, "bin").agg(F.sum(size).alias("_c"))
    mine = Window.partitionBy(*by)  # a group has a row per bin at most
    placed = known.select(*by, "bin", "_c", F.sum("_c").over(mine).alias("_n"),
                          F.sum("_c").over(mine.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)).alias("_to"))
    placed = placed.withColumns({f"_at_{k}": pos.cast("long") for k, pos in at.items()})
    held = reduce(lambda a, b: a | b, [_within(F.col(f"_at_{k}"), F.col("_to"), F.col("_c")) for k in at])
    wanted = placed.where(held).select(*by, "bin", (F.col("_to") - F.col("_c")).alias("_below"), *[f"_at_{k}" for k in at])
    rows = hist.binned.where(size > 0).select(*by, "bin", "value", size.alias("_a")).join(wanted, [*by, "bin"])
    rows = rows.groupBy(*by, "bin", "value", "_below", *[f"_at_{k}" for k in at]).agg(F.sum("_a").alias("_a"))
    ranked = hist.running(rows, [*by, "bin"], {"_r": F.col("_a")})
    to = F.col("_below") + F.col("_r")
    return ranked.groupBy(*by).agg(*[F.max(F.when(_within(F.col(f"_at_{k}"), to, F.col("_a")), F.col("value"))).alias(k) for k in at])


def _apart(here: Column, n: Column, base: Column, base_n: Column) -> Column:
    return F.try_divide(here, n) - F.try_divide(base, base_n)


def bounded_distances(cell: DataFrame, bins: int = BINS) -> DataFrame:
    """``(BY, bin, ..., low, high)``: what the counts alone tell of the distance of window and baseline in each bin.

    At a bin's ends both distribution functions are known: ``found`` is the larger distance there, and no place inside the bin
    can exceed ``high``. ``best`` is the window's largest ``found``. A bin of a single value has no inside.
    """
    base = cell.groupBy("column_name", "bin").agg(
        F.sum("cb").alias("b"), F.min("base_least").alias("b_least"), F.max("base_most").alias("b_most"))
    every = cell.groupBy("column_name").agg(F.sequence(F.lit(-1), F.lit(bins + 1)).alias("bins")).select("column_name", F.explode("bins").alias("bin"))
    upward = Window.partitionBy("column_name").orderBy("bin")
    whole = Window.partitionBy("column_name")
    # bins + 3 rows per monitored column.
    grid = every.join(base, ["column_name", "bin"], "left").select(
        "column_name", "bin", F.coalesce("b", F.lit(0)).alias("b"), "b_least", "b_most",
        F.coalesce(F.sum("b").over(upward.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)).alias("b_to"),
        F.coalesce(F.sum("b").over(whole), F.lit(0)).alias("b_n"))
    mine = Window.partitionBy(*BY)
    here = cell.where("c > 0").select(
        *BY, "bin", "c", "least", "most", F.sum("c").over(mine.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)).alias("to"),
        F.sum("c").over(mine).alias("n"))
    both = here.join(F.broadcast(grid), ["column_name", "bin"])
    c, b, to, b_to, n, b_n = (F.col(x) for x in ("c", "b", "to", "b_to", "n", "b_n"))
    ends = F.greatest(F.abs(_apart(to - c, n, b_to - b, b_n)), F.abs(_apart(to, n, b_to, b_n)))
    high = F.greatest(_apart(to, n, b_to - b, b_n), -_apart(to - c, n, b_to, b_n))
    single = F.least("least", "b_least") == F.greatest("most", "b_most")
    both = both.withColumns({"found": ends, "high": F.when((b > 0) & ~single, high)})
    return both.withColumn("best", F.max("found").over(mine))


def largest_distances(hist: Histogram) -> DataFrame:
    """``(BY, ks)``: the exact Kolmogorov-Smirnov distance of each window and column from the baseline.

    Branch and bound: bins whose bound does not exceed the best distance found at bin ends stay closed.
    """
    # Written, as both the best ends and the opened bins are taken from them: a row per window, column and bin at most.
    bounds = staged(bounded_distances(hist.cell), "bounds")
    best = bounds.groupBy(*BY).agg(F.max("best").alias("best"))
    opened = bounds.where(F.col("high") > F.col("best")).select(
        *BY, "bin", (F.col("to") - F.col("c")).alias("w0"), (F.col("b_to") - F.col("b")).alias("b0"), "n", "b_n")
    more = ["w0", "b0", "n", "b_n"]
    here = hist.binned.where("c > 0").select(*BY, "bin", "value", "c", F.lit(0).cast("long").alias("cb")).join(opened, [*BY, "bin"])
    base = hist.binned.where("cb > 0").select("column_name", "bin", "value", F.lit(0).cast("long").alias("c"), "cb").join(opened, ["column_name", "bin"])
    rows = here.unionByName(base).groupBy(*BY, "bin", "value", *more).agg(F.sum("c").alias("c"), F.sum("cb").alias("cb"))
    total = hist.running(rows, [*BY, "bin"], {"rw": F.col("c"), "rb": F.col("cb")})
    inside = total.groupBy(*BY).agg(F.max(F.abs(_apart(F.col("w0") + F.col("rw"), F.col("n"), F.col("b0") + F.col("rb"), F.col("b_n")))).alias("inside"))
    return best.join(inside, BY, "left").select(*BY, F.greatest("best", "inside").alias("ks"))
