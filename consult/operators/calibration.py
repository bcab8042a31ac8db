"""Are scores probabilities: calibration curve, Brier score and its parts.

Input is a long table (group columns..., label 0/1, score). Rows first reduce to
counts per (group, distinct score); equal-mass bins need a row's place in the
global score order, which comes from the same prefix sums as the ROC curve.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consult.functions.exprs import r6
from consult.operators.metrics import running_counts, score_counts

N_BINS = 10


def _bin_rows(binned: DataFrame, groups: list[str]) -> DataFrame:
    n = F.col("pos") + F.col("neg")
    return binned.groupBy(*groups, "bin").agg(
        F.sum(n).alias("n_rows"), F.sum("pos").alias("n_positive"), F.sum(n * F.col("score")).alias("__s"),
        F.min("score").alias("min_score"), F.max("score").alias("max_score")).select(
        *groups, "bin", "n_rows", "n_positive", r6(F.col("__s") / F.col("n_rows")).alias("mean_score"),
        r6(F.col("n_positive") / F.col("n_rows")).alias("observed_rate"), r6(F.col("min_score")).alias("min_score"), r6(F.col("max_score")).alias("max_score"))


def _with_bins(df: DataFrame, groups: list[str], n_bins: int, strategy: str, **kw) -> DataFrame:
    """Counts per (group, score) with ``bin`` from 0 to n_bins - 1."""
    counts = score_counts(df, groups, **kw)
    if strategy == "uniform":
        return counts.withColumn("bin", F.greatest(F.least(F.floor(F.col("score") * n_bins), F.lit(n_bins - 1)), F.lit(0)).cast("int"))
    if strategy != "quantile":
        raise ValueError(f"unknown strategy {strategy}")
    rc = running_counts(counts, groups)
    # Rows with a smaller score: all but those with this score or a larger one.
    total = F.col("P") + F.col("N")
    below = total - F.col("cum_pos") - F.col("cum_neg")
    return rc.select(*groups, "score", "pos", "neg", F.floor(below * n_bins / total).cast("int").alias("bin"))


def calibration_curve(df: DataFrame, groups: list[str] | None = None, n_bins: int = N_BINS,
                      strategy: str = "uniform", **kw) -> DataFrame:
    """Per bin: rows, positives, mean score, observed rate, least and greatest score.

    ``uniform``: bins of equal width over 0..1 (1 belongs to the last).
    ``quantile``: a score's bin is the share of rows with a smaller score, times
    ``n_bins``: bins of about equal mass in which equal scores are never parted.
    Bins without rows have no row."""
    groups = groups or []
    return _bin_rows(_with_bins(df, groups, n_bins, strategy, **kw), groups)


def _safe(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def brier_score(df: DataFrame, groups: list[str] | None = None, n_bins: int = N_BINS, **kw) -> DataFrame:
    """Mean squared error of the scores, Murphy's parts of it (reliability -
    resolution + uncertainty, over distinct scores, so that they add up exactly)
    and the expected calibration error over ``n_bins`` bins of equal width."""
    groups = groups or []
    counts = _with_bins(df, groups, n_bins, "uniform", **kw)
    n, pos, s = F.col("pos") + F.col("neg"), F.col("pos"), F.col("score")
    rate = pos / n
    # One row per bin first, then one per group; the parts of the score come along as sums.
    bins = counts.groupBy(*groups, "bin").agg(
        F.sum(n).alias("n"), F.sum("pos").alias("p"), F.sum(n * s).alias("s"),
        F.sum(pos * (1 - s) * (1 - s) + F.col("neg") * s * s).alias("sq"),
        F.sum(n * (s - rate) * (s - rate)).alias("rel"), F.sum(n * rate * rate).alias("rr"))
    g = bins.groupBy(*groups).agg(
        F.sum("n").alias("n_rows"), F.sum("p").alias("p"), F.sum("sq").alias("sq"), F.sum("rel").alias("rel"), F.sum("rr").alias("rr"),
        F.sum(F.abs(F.col("s") - F.col("p"))).alias("gap"))
    base = _safe(F.col("p"), F.col("n_rows"))
    return g.select(*groups, "n_rows", r6(base).alias("base_rate"), r6(_safe(F.col("sq"), F.col("n_rows"))).alias("brier_score"),
                    r6(_safe(F.col("rel"), F.col("n_rows"))).alias("reliability"),
                    r6(_safe(F.col("rr"), F.col("n_rows")) - base * base).alias("resolution"),
                    r6(base * (1 - base)).alias("uncertainty"), r6(_safe(F.col("gap"), F.col("n_rows"))).alias("expected_calibration_error"))
