"""Exact ranking and threshold metrics as distributed aggregations.

Input is a long table of (group columns..., label 0/1, score = P(label=1)).
Curve metrics first reduce to one row per (group, distinct score) with
positive / negative counts, then take running sums in falling score order
with the global prefix primitive (no single-task window), and subtract each
group's starting offset, so one model with all the rows is still split over
many tasks. All metrics of all groups come out of one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from consult import schema as S
from consult.functions.exprs import r6
from consult.functions.prefix import prefix_sums


def _zero_div(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0 (reference convention)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def _scored(df: DataFrame, score: str) -> DataFrame:
    # A row that could not be scored (a missing feature) has no part in a metric.
    return df.where(F.col(score).isNotNull())


def confusion_counts(df: DataFrame, groups: list[str] | None = None, label: str = "label",
                     score: str = "score", threshold: float = S.DECISION_THRESHOLD) -> DataFrame:
    """tn, fp, fn, tp with 'predicted yes' = score > threshold (strict)."""
    groups = groups or []
    pred = F.col(score) > threshold
    y = F.col(label) == 1
    return _scored(df, score).groupBy(*groups).agg(
        F.count_if(~y & ~pred).alias("tn"), F.count_if(~y & pred).alias("fp"),
        F.count_if(y & ~pred).alias("fn"), F.count_if(y & pred).alias("tp"))


def confusion_matrix(df: DataFrame, groups: list[str] | None = None, **kw) -> DataFrame:
    return confusion_counts(df, groups, **kw)


def _threshold_cols() -> list[Column]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision = _zero_div(tp, tp + fp)
    recall = _zero_div(tp, tp + fn)
    return [
        r6(_zero_div(tp + tn, tp + tn + fp + fn)).alias("accuracy"),
        r6(precision).alias("precision"),
        r6(recall).alias("recall"),
        r6(_zero_div(2 * precision * recall, precision + recall)).alias("f1"),
        r6(_zero_div(tn, tn + fp)).alias("specificity"),
        r6(recall).alias("sensitivity"),
        r6(_zero_div(fp, fp + tn)).alias("false_positive_rate"),
        r6(_zero_div(fn, fn + tp)).alias("false_negative_rate"),
    ]


def threshold_metrics(df: DataFrame, groups: list[str] | None = None, **kw) -> DataFrame:
    """Accuracy, precision, recall, F1, specificity, sensitivity, FPR, FNR
    (0 when a denominator is 0)."""
    groups = groups or []
    cm = confusion_counts(df, groups, **kw)
    return cm.select(*groups, *_threshold_cols())


def log_loss(df: DataFrame, groups: list[str] | None = None, label: str = "label",
             score: str = "score", eps: float = S.LOG_LOSS_EPS) -> DataFrame:
    """Mean cross-entropy with the score clipped to [eps, 1 - eps]."""
    groups = groups or []
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    ll = F.when(F.col(label) == 1, -F.log(p)).otherwise(-F.log(F.lit(1.0) - p))
    return _scored(df, score).groupBy(*groups).agg(r6(F.avg(ll)).alias("log_loss"))


# ---------------------------------------------------------------------------
# Curves
# ---------------------------------------------------------------------------

def score_counts(df: DataFrame, groups: list[str] | None = None, label: str = "label",
                 score: str = "score", weight: str | None = None) -> DataFrame:
    """One row per (group, distinct score): positives and negatives. ``weight``
    names a column that says for how many rows a row stands."""
    groups = groups or []
    n = F.lit(1) if weight is None else F.col(weight)
    y = F.col(label) == 1
    return _scored(df, score).groupBy(*groups, F.col(score).cast("double").alias("score")).agg(
        F.sum(F.when(y, n).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col(label) != 1, n).otherwise(0)).cast("bigint").alias("neg"))


def running_counts(counts: DataFrame, groups: list[str] | None = None, **prefix_kw) -> DataFrame:
    """Add cum_pos / cum_neg (inclusive, falling score) and P / N per group.

    Running sums run across groups in group order, so a group's base is what
    stands before its first score: the least of running sum minus own count."""
    groups = groups or []
    order = [*[F.col(g).asc() for g in groups], F.col("score").desc()]
    c = prefix_sums(counts, order, {"g_pos": F.col("pos"), "g_neg": F.col("neg")}, **prefix_kw)
    tot = c.groupBy(*groups).agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
        F.min(F.col("g_pos") - F.col("pos")).alias("__bp"), F.min(F.col("g_neg") - F.col("neg")).alias("__bn"))
    if groups:
        named = tot.select(*[F.col(g).alias(f"__{g}") for g in groups], "P", "N", "__bp", "__bn")
        c = c.join(named, [c[g].eqNullSafe(named[f"__{g}"]) for g in groups], "inner")
        return c.select(*groups, "score", "pos", "neg",
                        (F.col("g_pos") - F.col("__bp")).alias("cum_pos"),
                        (F.col("g_neg") - F.col("__bn")).alias("cum_neg"), "P", "N")
    P = tot.select("P").scalar()
    N = tot.select("N").scalar()
    return c.select("score", "pos", "neg", F.col("g_pos").alias("cum_pos"),
                    F.col("g_neg").alias("cum_neg"), P.alias("P"), N.alias("N"))


def roc_curve(df: DataFrame, groups: list[str] | None = None, **kw) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, falling."""
    groups = groups or []
    rc = running_counts(score_counts(df, groups, **kw), groups)
    return rc.select(*groups, F.col("score").alias("threshold"),
                     r6(_zero_div(F.col("cum_neg"), F.col("N"))).alias("fpr"),
                     r6(_zero_div(F.col("cum_pos"), F.col("P"))).alias("tpr"))


def pr_curve(df: DataFrame, groups: list[str] | None = None, **kw) -> DataFrame:
    """(threshold, precision, recall) for every distinct score, plus the
    end point (precision 1, recall 0, no threshold)."""
    groups = groups or []
    counts = score_counts(df, groups, **kw)
    rc = running_counts(counts, groups)
    pts = rc.select(*groups, F.col("score").alias("threshold"),
                    r6(_zero_div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                    r6(_zero_div(F.col("cum_pos"), F.col("P"))).alias("recall"))
    end = counts.select(*groups).distinct() if groups else df.sparkSession.range(1).select()
    end = end.select(*groups, F.lit(None).cast("double").alias("threshold"),
                     F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def _curve_aggs(rc: DataFrame, groups: list[str]) -> DataFrame:
    # AUC with ties counted one half: sum over scores of
    # neg(s) * (positives above s + pos(s) / 2), over P * N.
    auc_num = F.sum(F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / F.lit(2.0)))
    ap = F.sum(_zero_div(F.col("pos"), F.col("P")) *
               _zero_div(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")))
    return rc.groupBy(*groups).agg(
        r6(F.try_divide(auc_num, F.first("P").cast("double") * F.first("N").cast("double"))).alias("auc_roc"),
        r6(ap).alias("average_precision"))


def auc_roc(df: DataFrame, groups: list[str] | None = None, **kw) -> DataFrame:
    groups = groups or []
    rc = running_counts(score_counts(df, groups, **kw), groups)
    return _curve_aggs(rc, groups).select(*groups, "auc_roc")


def average_precision(df: DataFrame, groups: list[str] | None = None, **kw) -> DataFrame:
    """Step sum of precision times recall gain (not the trapezoid)."""
    groups = groups or []
    rc = running_counts(score_counts(df, groups, **kw), groups)
    return _curve_aggs(rc, groups).select(*groups, "average_precision")


def evaluate_all(df: DataFrame, groups: list[str] = ("model", "feature_set"), label: str = "label",
                 score: str = "score") -> DataFrame:
    """Every metric for every (model, feature set) from one long table; rows
    without a score are left out, so ``n_rows`` counts the scored ones."""
    groups = list(groups)
    y = F.col(label) == 1
    pred = F.col(score) > S.DECISION_THRESHOLD
    eps = S.LOG_LOSS_EPS
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    rowwise = _scored(df, score).groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~y & ~pred).alias("tn"), F.count_if(~y & pred).alias("fp"),
        F.count_if(y & ~pred).alias("fn"), F.count_if(y & pred).alias("tp"),
        r6(F.avg(F.when(y, -F.log(p)).otherwise(-F.log(F.lit(1.0) - p)))).alias("log_loss"))
    curves = _curve_aggs(running_counts(score_counts(df, groups, label, score), groups), groups)
    # Null-safe: rows without a model or set name are a group like the others.
    named = curves.select(*[F.col(g).alias(f"__{g}") for g in groups], "auc_roc", "average_precision")
    j = rowwise.join(named, [rowwise[g].eqNullSafe(named[f"__{g}"]) for g in groups], "inner")
    return j.select(*groups, "n_rows", "tn", "fp", "fn", "tp", *_threshold_cols(),
                    "auc_roc", "average_precision", "log_loss")


def compare_models(metrics: DataFrame, model: str = "model", feature_set: str = "feature_set",
                   baseline: str = "baseline", enhanced: str = "enhanced") -> DataFrame:
    """Per model: AUC on both sets, absolute and % gain; best model per set
    (highest AUC, ties to the first model name); average AUCs and the
    recommendation from the gain of the best enhanced over the best baseline."""
    m = metrics.select(model, feature_set, "auc_roc")
    piv = m.groupBy(model).agg(
        F.max(F.when(F.col(feature_set) == baseline, F.col("auc_roc"))).alias("baseline_auc"),
        F.max(F.when(F.col(feature_set) == enhanced, F.col("auc_roc"))).alias("enhanced_auc"))
    w_rank = Window.partitionBy(feature_set).orderBy(F.col("auc_roc").desc(), F.col(model).asc())
    ranked = m.select("*", F.row_number().over(w_rank).alias("__r")).where(F.col("__r") == 1)
    bb = ranked.where(F.col(feature_set) == baseline).agg(F.first(model).alias("m"), F.first("auc_roc").alias("a"))
    be = ranked.where(F.col(feature_set) == enhanced).agg(F.first(model).alias("m"), F.first("auc_roc").alias("a"))
    bb_m, bb_a = bb.select("m").scalar(), bb.select("a").scalar()
    be_m, be_a = be.select("m").scalar(), be.select("a").scalar()
    avg = m.groupBy().agg(
        F.avg(F.when(F.col(feature_set) == baseline, F.col("auc_roc"))).alias("b"),
        F.avg(F.when(F.col(feature_set) == enhanced, F.col("auc_roc"))).alias("e"))
    avg_b, avg_e = avg.select("b").scalar(), avg.select("e").scalar()
    rec = (F.when(be_a > bb_a + F.lit(0.02),
                  F.lit("Use enhanced model for production - significant improvement detected"))
           .when(be_a > bb_a, F.lit("Enhanced model shows improvement but consider complexity trade-off"))
           .otherwise(F.lit("Baseline model sufficient - enhanced features may not add value")))
    gain = F.col("enhanced_auc") - F.col("baseline_auc")
    return piv.select(
        model, "baseline_auc", "enhanced_auc", r6(gain).alias("auc_improvement"),
        r6(F.when(F.col("baseline_auc") > 0, gain / F.col("baseline_auc") * 100).otherwise(F.lit(0.0)))
        .alias("improvement_pct"),
        (F.col(model) == bb_m).alias("best_baseline"), (F.col(model) == be_m).alias("best_enhanced"),
        r6(avg_b).alias("average_baseline_auc"), r6(avg_e).alias("average_enhanced_auc"),
        r6(avg_e - avg_b).alias("average_improvement"), rec.alias("recommendation"))
