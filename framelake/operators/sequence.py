"""Skew-safe numbering and running totals inside groups: one exchange, an ordinary window.

``row_number() OVER (PARTITION BY g ORDER BY o)`` puts every row of a group into one task; a video holding a third of all frames would
then be one task holding a third of the data. Here a sample finds the groups that exceed a task's fair share and, for these
only, rows of the order that cut them into slices. The cuts are fixed values before the query runs, so a row's slice is a
function of the row: rows are exchanged once, on ``(group, slice)``, and an ordinary window numbers each slice. What earlier slices of its
group hold is added from a correction table, which is counted from the hot groups' rows alone and has a row per slice: fewer
than there are partitions, the proven bound behind its broadcast. Groups that are not hot need neither.

Slices only steer the work. Whatever the sample shows, the numbers are exact, also if a task or the whole plan runs again.
Rows never leave the JVM, so every column keeps its type and value. Keys compare NULL-safely, and NaN equals NaN.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AMOUNT, _SUM, _CUTS, _SLICE, _OFF, _FIRST = "_fl_amount", "_fl_sum", "_fl_cuts", "_fl_slice", "_fl_off", "_fl_first"
#: Sampled rows a slice, so that a slice's size is within a few tenths of the fair share.
SAMPLE_PER_SLICE = 50
SAMPLE_LEAST = 2000


@dataclass(frozen=True)
class Key:
    """One column of the order."""

    name: str
    desc: bool
    nulls_first: bool

    @staticmethod
    def of(order: Column | str) -> Key:
        """From ``"name [asc|desc] [nulls first|last]"`` or a sorted column such as ``F.col("name").desc()``."""
        text = order if isinstance(order, str) else str(order)[len("Column<'"):-len("'>")]
        name, way, nulls = re.fullmatch(r"(.+?)(?:\s+(asc|desc))?(?:\s+nulls\s+(first|last))?", text, re.I).groups()
        desc = (way or "asc").lower() == "desc"
        return Key(name, desc, (nulls or ("last" if desc else "first")).lower() == "first")

    def sort(self) -> Column:
        c = F.col(self.name)
        if self.desc:
            return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()

    def before(self, a: Column, b: Column) -> Column:
        """Whether ``a`` stands strictly before ``b``."""
        less = F.coalesce(a > b if self.desc else a < b, F.lit(False))
        return less | (a.isNull() & b.isNotNull() if self.nulls_first else a.isNotNull() & b.isNull())


def _before(keys: list[Key], row: list[Column], cut: Column) -> Column:
    """Whether a row stands strictly before a cut (a struct of the keys)."""
    out = F.lit(False)
    for i, k in reversed(list(enumerate(keys))):
        out = k.before(row[i], cut[f"k{i}"]) | (row[i].eqNullSafe(cut[f"k{i}"]) & out)
    return out


def _bytes(text: str) -> int:
    n, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", text.strip().lower()).groups()
    return int(n) << (10 * " kmgtp".index(unit or " "))


def fits_one_task(df: DataFrame) -> bool:
    """Whether the planner expects the whole table to be no larger than one shuffle partition should be."""
    target = _bytes(df.sparkSession.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB"))
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= target


def _find_cuts(df: DataFrame, by: list[str], keys: list[Key], p: int) -> DataFrame | None:
    """``(by, cuts)`` for each group with over twice the fair share of a bounded sample; None if there is no such group.

    The sample has about ``SAMPLE_PER_SLICE`` rows a partition; it is ranked by Spark, and only the cut rows, fewer
    than two a partition, come to the driver.
    """
    spark = df.sparkSession
    rows = df.select(*by, *[F.col(k.name).alias(f"_k{i}") for i, k in enumerate(keys)])
    n = rows.count()
    if n == 0:
        return None
    want = SAMPLE_LEAST + SAMPLE_PER_SLICE * p
    sample = rows if n <= want else rows.sample(fraction=want / n, seed=17)
    fair = min(n, want) / p
    mine = Window.partitionBy(*by)
    sort = [Key(f"_k{i}", k.desc, k.nulls_first).sort() for i, k in enumerate(keys)]
    c, r = F.count(F.lit(1)).over(mine), F.row_number().over(mine.orderBy(*sort))
    ranked = sample.select("*", c.alias("_c"), r.alias("_r")).where(F.col("_c") > max(2 * fair, 1))
    parts = F.ceil(F.col("_c") / fair)
    at = F.floor((F.col("_r") - 1) * parts / F.col("_c"))
    before = F.floor((F.col("_r") - 2) * parts / F.col("_c"))
    found = ranked.where((F.col("_r") > 1) & (at > before)).orderBy("_r")
    cut = F.struct(*[F.col(f"_k{i}").alias(f"k{i}") for i in range(len(keys))])
    cuts = found.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("_r", cut.alias("cut")))).alias("_s")).select(
        *by, F.col("_s.cut").alias(_CUTS))
    got = cuts.collect()
    return spark.createDataFrame(got, cuts.schema) if got else None


def _slice_of(keys: list[Key], most: int) -> Column:
    """How many of the group's cuts a row does not stand before: binary search in its cuts."""
    row = [F.col(k.name) for k in keys]
    steps = [1 << b for b in reversed(range(most.bit_length()))]
    cuts = F.col(_CUTS)

    def step(at: Column, width: Column) -> Column:
        to = at + width
        # Past the end, get() is null: the row stands before the missing cut only if told so.
        return F.when((to <= F.size(cuts)) & ~_before(keys, row, F.get(cuts, to - 1)), to).otherwise(at)

    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)
    return F.when(cuts.isNull(), F.lit(0)).otherwise(found)


def _same(by: list[str], prefix: str) -> Column:
    return reduce(lambda a, c: a & F.col(c).eqNullSafe(F.col(prefix + c)), by, F.lit(True))


def _windowed(df: DataFrame, by: list[str], keys: list[Key], amounts: list[Column | None], first: list[str]) -> DataFrame:
    """The ordinary window: totals to the current row, and the first row's values."""
    w = Window.partitionBy(*by).orderBy(*[k.sort() for k in keys])
    to_here = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = df.withColumns({f"{_SUM}{i}": F.row_number().over(w).cast("long") if a is None else F.sum(a.cast("long")).over(to_here)
                          for i, a in enumerate(amounts)})
    return out.withColumn(_FIRST, F.first(F.struct(*[F.col(c) for c in first])).over(to_here)) if first else out


def running_totals(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column | str],
    totals: dict[str, Column | None],
    first: Sequence[str] = (),
    partitions: int | None = None,
    at_most: int | None = None,
) -> DataFrame:
    """``sum(amount) over (partition by by order by order rows to current)`` without hot-group skew.

    ``totals`` gives for each new column an amount, a whole number, zero or more; None counts rows. ``order`` must make the order total inside a group
    for a deterministic result; its items are column names, with ``desc`` and ``nulls first`` or ``last`` behind them if need be, or
    sorted columns. ``first`` names columns whose value on the group's first row is added as ``first_<name>``. ``at_most`` keeps rows
    with a first total of no more. ``partitions`` is how many slices the whole table is worth, by default ``spark.sql.shuffle.partitions``; where it is not
    given and the planner expects the table to fit one shuffle partition, no group can be too large and none is looked for.
    """
    by, first, keys = list(by), list(first), [Key.of(o) for o in order]
    spark = df.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = None if p < 2 or (partitions is None and fits_one_task(df)) else _find_cuts(df, by, keys, p)
    firsts = [F.col(_FIRST)[c].alias(f"first_{c}") for c in first]
    amounts = list(totals.values())
    if cuts is None:
        plain = _windowed(df, by, keys, amounts, first)
        plain = plain if at_most is None else plain.where(F.col(f"{_SUM}0") <= at_most)
        return plain.select(*[F.col(c) for c in df.columns], *[F.col(f"{_SUM}{i}").alias(out) for i, out in enumerate(totals)], *firsts)

    most = cuts.agg(F.max(F.size(_CUTS))).first()[0]
    if by:
        table = F.broadcast(cuts.select(*[F.col(c).alias("_fl_g_" + c) for c in by], _CUTS))  # less than a row a partition
        keyed = df.join(table, _same(by, "_fl_g_"), "left")
    else:
        keyed = df.withColumn(_CUTS, cuts.select(_CUTS).scalar())
    keyed = keyed.withColumn(_SLICE, _slice_of(keys, most))
    hot = keyed.where(F.col(_CUTS).isNotNull())
    local = _windowed(keyed.select(*df.columns, _SLICE), [*by, _SLICE], keys, amounts, first)
    if at_most is not None:
        local = local.where(F.col(f"{_SUM}0") <= at_most)

    # Correction: what the earlier slices of each hot group add up to; a row per slice.
    sizes = [(F.count(F.lit(1)) if a is None else F.sum(a.cast("long"))).alias(f"_fl_n{i}") for i, a in enumerate(amounts)]
    earlier = Window.partitionBy(*by).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = [F.sum(f"_fl_n{i}").over(earlier).alias(f"{_OFF}{i}") for i in range(len(amounts))]
    corr = hot.groupBy(*by, _SLICE).agg(*sizes).select(*by, _SLICE, *offsets).where(F.col(_SLICE) > 0)
    if first:
        ahead = Window.partitionBy(*by).orderBy(_SLICE, *[k.sort() for k in keys])
        head = hot.select(*by, _SLICE, *{k.name for k in keys} - set(by), F.struct(*[F.col(c) for c in first]).alias("_fl_head"),
                          F.row_number().over(ahead).alias("_fl_r")).where("_fl_r = 1")
        head = head.select(*[F.col(c).alias("_fl_h_" + c) for c in by], "_fl_head")
        corr = corr.join(F.broadcast(head), _same(by, "_fl_h_")) if by else corr.withColumn("_fl_head", head.select("_fl_head").scalar())
    corr = corr.select(*[F.col(c).alias("_fl_c_" + c) for c in by], F.col(_SLICE).alias("_fl_c_slice"),
                       *[f"{_OFF}{i}" for i in range(len(amounts))], *(["_fl_head"] if first else []))
    joined = local.join(F.broadcast(corr), _same(by, "_fl_c_") & (F.col(_SLICE) == F.col("_fl_c_slice")), "left")
    total = [F.col(f"{_SUM}{i}") + F.coalesce(F.col(f"{_OFF}{i}"), F.lit(0)) for i in range(len(amounts))]
    if at_most is not None:
        joined = joined.where(total[0] <= at_most)
    if first:
        firsts = [F.when(F.col("_fl_head").isNotNull(), F.col("_fl_head")[c]).otherwise(F.col(_FIRST)[c]).alias(f"first_{c}") for c in first]
    return joined.select(*[F.col(c) for c in df.columns], *[t.alias(out) for t, out in zip(total, totals)], *firsts)


def running_total(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], amount: Column | None, out: str,
                  first: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """One running total; see :func:`running_totals`."""
    return running_totals(df, by, order, {out: amount}, first, partitions)


def number_within(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column | str],
    out: str = "rn",
    first: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """``row_number() over (partition by by order by order)``, as a running count."""
    return running_total(df, by, order, None, out, first, partitions)


def cap_within(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column | str],
    k: int,
    partitions: int | None = None,
) -> DataFrame:
    """Rows ranked ``<= k`` inside each group (ties broken by ``order``), skew-safe; a task passes on no more than ``k`` of a slice."""
    return running_totals(df, by, order, {"_fl_k": None}, partitions=partitions, at_most=k).drop("_fl_k")
