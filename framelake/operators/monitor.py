"""Per-frame quality metrics, baseline, daily profile, drift and flags (PRJ-5, MON-1..5).

The reference hands profiling and drift to a hosted monitor; here they are plain
DataFrame plans: one aggregate counts the values per window, and every statistic is exact,
computed from those counts and their histograms.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.functions import boxes as bx
from framelake.operators import histogram as hg
from framelake.schemas import BASELINE_DAYS, MONITOR_GRANULARITY
from framelake.session import materialize, staged

# --- fixed values of the drift statistics ------------------------------------
# Quantiles of the baseline that cut the PSI bins.
BIN_QUANTILES = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
SHARE_FLOOR = 1e-6
PSI_FLAG = 0.2
QUANTILES = (0.25, 0.5, 0.75)
MONITORED = ("n_detections", "avg_conf")
# -----------------------------------------------------------------------------

BY = hg.BY


def detections_metrics(detections: DataFrame) -> DataFrame:
    """PRJ-5 / ARR-1 / ARR-2: one row per frame with scalar quality signals."""
    return detections.select(
        "frame_id",
        "video_id",
        "inferred_at",
        bx.n_detections("boxes").alias("n_detections"),
        bx.avg_conf("boxes").alias("avg_conf"),
    )


def detections_summary(detections: DataFrame, digits: int = 3) -> DataFrame:
    """ARR-3 / SCL-9 / ORD-1: summary with the rounded mean, NULL for empty frames."""
    return detections.select(
        "frame_id",
        F.array_size("boxes").alias("n_detections"),
        bx.avg_conf_or_null("boxes", digits).alias("avg_conf"),
    ).orderBy("frame_id")


def baseline(metrics: DataFrame, days: int = BASELINE_DAYS, ts: str = "inferred_at") -> DataFrame:
    """MON-1 / AGG-2 / FLT-4: rows in [min(ts), min(ts) + days); NULL ts drops out.

    The minimum stays in the plan as a scalar subquery (one value, computed once
    before the scan, no join). Empty input -> NULL minimum -> empty baseline.
    """
    return metrics.filter(F.col(ts) < baseline_end(metrics, days, ts))


def baseline_cutoff(metrics: DataFrame, days: int = BASELINE_DAYS, ts: str = "inferred_at"):
    """MON-1 return value: the cutoff timestamp, or None when there is no data."""
    row = metrics.agg(F.min(ts).alias("m")).first()
    return None if row is None or row["m"] is None else row["m"] + timedelta(days=days)


def baseline_pushdown(metrics: DataFrame, days: int = BASELINE_DAYS, ts: str = "inferred_at") -> DataFrame:
    """MON-1, two-step form: the cutoff becomes a literal, so the Parquet scan can skip
    row groups (one scalar travels to the driver)."""
    cutoff = baseline_cutoff(metrics, days, ts)
    if cutoff is None:
        return metrics.limit(0)
    return metrics.filter(F.col(ts) < F.lit(cutoff))


def value_counts(
    metrics: DataFrame,
    cols: Sequence[str] = MONITORED,
    granularity: str = MONITOR_GRANULARITY,
    ts: str = "inferred_at",
    baseline_until: Column | None = None,
) -> DataFrame:
    """``(window_start, column_name, value, c, cb)``: rows of each value per window, and how many lie in the baseline.

    The one pass over the metrics that profile and drift need: a hot value (most frames may share one)
    collapses in the partial aggregate. ``baseline_until`` is the baseline's end; without it ``cb`` is 0.
    """
    inside = F.lit(False) if baseline_until is None else F.col(ts) < baseline_until
    long = _values(metrics, cols, granularity, ts, inside=inside)
    return long.groupBy(*BY, "value").agg(F.count(F.lit(1)).alias("c"), F.count_if("inside").alias("cb"))


def _values(metrics: DataFrame, cols: Sequence[str], granularity: str, ts: str, **more: Column) -> DataFrame:
    """``(window_start, *more, column_name, value)``: a row per row and monitored column; a NULL ``ts`` drops out."""
    cols = list(cols)
    typed = metrics.filter(F.col(ts).isNotNull()).select(
        F.window(ts, granularity).start.alias("window_start"), *[c.alias(name) for name, c in more.items()],
        *[F.col(c).cast("double").alias(c) for c in cols])
    return typed.unpivot(["window_start", *more], cols, "column_name", "value")


def compared_counts(
    metrics: DataFrame,
    baseline_df: DataFrame,
    cols: Sequence[str] = MONITORED,
    granularity: str = MONITOR_GRANULARITY,
    ts: str = "inferred_at",
) -> DataFrame:
    """:func:`value_counts` of ``metrics`` in ``c`` and of ``baseline_df`` in ``cb``: both sides meet in one aggregate."""
    here = _values(metrics, cols, granularity, ts, c=F.lit(1), cb=F.lit(0))
    base = _values(baseline_df, cols, granularity, ts, c=F.lit(0), cb=F.lit(1))
    return here.unionByName(base).groupBy(*BY, "value").agg(F.sum("c").alias("c"), F.sum("cb").alias("cb"))


def baseline_end(metrics: DataFrame, days: int = BASELINE_DAYS, ts: str = "inferred_at") -> Column:
    """MON-1: the end of the baseline window, as a scalar subquery."""
    return metrics.agg(F.min(ts)).scalar() + F.expr(f"INTERVAL {int(days)} DAYS")


def _at(q: float, n: str = "_n") -> Column:
    """Zero-based position of a quantile among ``n`` sorted rows."""
    return (F.col(n) - 1) * F.lit(q)


def profile_counts(counts: DataFrame, qs: Sequence[float] = QUANTILES) -> DataFrame:
    """MON-2 from value counts (a written table: it is read several times): see :func:`profile`."""
    return profile_histogram(hg.Histogram.of(counts), qs)


def profile_histogram(hist: hg.Histogram, qs: Sequence[float] = QUANTILES) -> DataFrame:
    """MON-2 from the histogram of the value counts; values that only the baseline has (``c`` of 0) are no part of it."""
    c, v = F.col("c"), F.col("value")
    off = v - F.col("middle")  # from the middle of the column's range, so that the squares do not cancel each other out
    n = F.sum(F.when(v.isNotNull(), c))
    squares = F.sum(off * off * c) - F.sum(off * c) / n * F.sum(off * c)
    stats = hist.binned.where(c > 0).groupBy(*BY).agg(
        F.sum("c").alias("n"),
        F.coalesce(F.sum(F.when(v.isNull(), c)), F.lit(0)).alias("n_null"),
        n.alias("_n"),
        (F.sum(v * c) / n).alias("mean"),
        F.when(n > 1, F.sqrt(F.greatest(squares / (n - 1), F.lit(0.0)))).alias("stddev"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count("value").alias("n_distinct"),
    )
    at = {f"_{end}{i}": edge(_at(q)) for i, q in enumerate(qs) for end, edge in (("lo", F.floor), ("hi", F.ceil))}
    joined = stats.join(hg.values_at(hist, BY, "c", at), BY, "left")

    def quantile(i: int, q: float) -> Column:
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        return F.when(lo == hi, lo).otherwise(lo + (_at(q) - F.floor(_at(q))) * (hi - lo)).alias(f"p{round(q * 100):02d}")

    return joined.select(*stats.drop("_n", "stddev").columns, "stddev", *[quantile(i, q) for i, q in enumerate(qs)])


def profile(
    metrics: DataFrame,
    cols: Sequence[str] = MONITORED,
    granularity: str = MONITOR_GRANULARITY,
    ts: str = "inferred_at",
) -> DataFrame:
    """MON-2: time-series profile per window and column.

    count, nulls, mean, sample stddev, min, max, exact distinct count and exact
    interpolated quartiles, keyed by (window_start, column_name), all from one written table of value counts.
    Quartiles come from the histogram bins that hold them (:mod:`framelake.operators.histogram`).
    """
    return profile_counts(staged(value_counts(metrics, cols, granularity, ts), "counts"))


def drift_counts(counts: DataFrame, qs: Sequence[float] = BIN_QUANTILES) -> DataFrame:
    """MON-3 from value counts (``c`` of the window, ``cb`` of the baseline; a written table, read several times): see :func:`drift`."""
    return drift_histogram(hg.Histogram.of(counts.filter(F.col("value").isNotNull())), qs)


def drift_histogram(hist: hg.Histogram, qs: Sequence[float] = BIN_QUANTILES) -> DataFrame:
    """MON-3 from the histogram of the value counts of both sides; NULL values are no part of it."""
    known = hist.binned.where(F.col("value").isNotNull())
    c, cb, v = F.col("c"), F.col("cb"), F.col("value")
    cuts = [f"_q{i}" for i in range(len(qs))]
    edges = hg.values_at(hist, ["column_name"], "cb", {name: F.floor(_at(q)) for name, q in zip(cuts, qs)})
    # Written, as both sides read them: a row per monitored column.
    edges = materialize(hist.cell.select("column_name").distinct().join(edges, "column_name", "left").select(
        "column_name", F.array_sort(F.array_distinct(F.array_compact(F.array(*cuts)))).alias("edges")))
    # One row per monitored column: the column list bounds this broadcast and the next.
    place = F.aggregate("edges", F.lit(0), lambda acc, e: acc + (e < v).cast("int") + (e <= v).cast("int"))
    placed = known.join(F.broadcast(edges), "column_name").withColumn("bin", place)

    def shares(size: Column, name: str) -> list[Column]:
        """Size, mean and the counts of every bin the edges can make (two per edge and one)."""
        bins = F.array(*[F.coalesce(F.sum(F.when(F.col("bin") == i, size)), F.lit(0)) for i in range(2 * len(qs) + 1)])
        return [F.sum(size).alias(f"{name}n"), F.try_divide(F.sum(v * size), F.sum(size)).alias(f"{name}mean"), bins.alias(f"{name}bins")]

    base = placed.groupBy("column_name").agg(*shares(cb, "baseline_"), F.first("edges").alias("edges"))
    stats = placed.filter(c > 0).groupBy(*BY).agg(*shares(c, "")).join(F.broadcast(base), "column_name")

    def term(acc: Column, i: Column) -> Column:
        p = F.greatest(F.get("bins", i) / F.col("n"), F.lit(SHARE_FLOOR))
        q = F.greatest(F.try_divide(F.get("baseline_bins", i), F.col("baseline_n")), F.lit(SHARE_FLOOR))
        return acc + (p - q) * F.ln(p / q)

    psi = F.when(F.col("baseline_n") > 0, F.aggregate(F.sequence(F.lit(0), F.size("edges") * 2), F.lit(0.0), term))
    return stats.join(hg.largest_distances(hist), BY).select(
        *BY, "n", "baseline_n", "mean", "baseline_mean", (F.col("mean") - F.col("baseline_mean")).alias("mean_delta"), psi.alias("psi"), "ks")


def drift(
    metrics: DataFrame,
    baseline_df: DataFrame,
    cols: Sequence[str] = MONITORED,
    granularity: str = MONITOR_GRANULARITY,
    ts: str = "inferred_at",
) -> DataFrame:
    """MON-3: per window and column, drift against the baseline distribution.

    mean delta; KS, the largest distance of the two exact distribution functions; PSI = sum((p - q) * ln(p / q))
    over open-ended bins cut at the baseline's deciles, where each cut value is a bin of its own
    (so a shift away from a hot value shows), with both shares floored at 1e-6. PSI and KS are NULL without a baseline.
    """
    return drift_counts(staged(compared_counts(metrics, baseline_df, cols, granularity, ts), "counts"))


def flags(drift_df: DataFrame, aliases: DataFrame, name: str, alias: str, threshold: float = PSI_FLAG) -> DataFrame:
    """MON-5: windows whose PSI exceeds the threshold flag the active alias for review.

    The alias is one key of the alias table: its version enters as a scalar
    subquery (Spark fails the query if that key ever held two rows).
    """
    version = aliases.filter((F.col("name") == name) & (F.col("alias") == alias)).select("version").scalar()
    hot = drift_df.filter(F.col("psi") > threshold).select(
        "window_start", "column_name", "psi", F.lit(name).alias("name"), F.lit(alias).alias("alias"),
        version.alias("flagged_version"),
    )
    return hot.filter(F.col("flagged_version").isNotNull())


def top_frame(metrics: DataFrame, frames: DataFrame) -> DataFrame:
    """AGG-7 / JOI-7: the frame with the most detections (ties: smallest frame_id),
    with its path (NULL when the frame is not in ``frames``).

    The winner is a one-row global aggregate; it is the broadcast build side of an
    inner join that streams ``frames`` (no shuffle of the big side), and the path
    comes back as a scalar.
    """
    best = metrics.agg(
        F.min_by("frame_id", F.struct(-F.col("n_detections"), F.col("frame_id"))).alias("frame_id"),
        F.max("n_detections").alias("n_detections"),
    )
    path = frames.join(F.broadcast(best.select("frame_id")), "frame_id").agg(F.max("frame_path")).scalar()
    return best.select("frame_id", "n_detections", path.alias("frame_path"))


def refresh_monitor(spark, metrics: DataFrame, baseline_df: DataFrame, out_path: str) -> dict[str, str]:
    """MON-4: (re)compute profile and drift and upsert them by (window_start, column_name).

    Re-running converges to one row per key, so an existing monitor is simply
    refreshed, never duplicated. Profile and drift are taken from one histogram of the value counts of both sides, written once a refresh.
    """
    from framelake.sinks.store import upsert

    hist = hg.Histogram.of(staged(compared_counts(metrics, baseline_df), "counts"))
    keys = ["window_start", "column_name"]
    return {
        "profile": upsert(spark, f"{out_path.rstrip('/')}/profile", profile_histogram(hist), keys),
        "drift": upsert(spark, f"{out_path.rstrip('/')}/drift", drift_histogram(hist), keys),
        "drift_path": f"{out_path.rstrip('/')}/drift",
    }
