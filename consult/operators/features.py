"""Feature operators (F1-F8, P8, P9): scalar expressions and in-patient windows.

The same ``add_interactions`` / ``fill_defaults`` functions serve training
and scoring, so the two can not drift apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consult import schema as S
from consult.functions.exprs import clamp_negative, days_since, flag, r6
from consult.functions.grouprank import rank_within


class FeatureSetError(ValueError):
    pass


# ---------------------------------------------------------------------------
# F1 days since accident
# ---------------------------------------------------------------------------

def add_days_since_accident(df: DataFrame, clamp: bool = True,
                            default: int = S.TRAINING_DEFAULTS["days_since_accident"]) -> DataFrame:
    """Whole days from accident to contact; negatives become 0, missing stays
    missing. Without both date columns every row gets ``default``."""
    if S.ACCIDENT_DATE in df.columns and S.CONTACT_DATE in df.columns:
        d = days_since(df)
        d = clamp_negative(d) if clamp else d
    else:
        d = F.lit(default)
    return df.withColumn("days_since_accident", d.cast("int"))


def days_stats(df: DataFrame) -> DataFrame:
    """Negative raw gaps (clamped rows), min and max after the clamp."""
    raw = days_since(df)
    return df.agg(F.count_if(raw < 0).alias("n_negative"),
                  F.min(clamp_negative(raw)).cast("int").alias("min_days"),
                  F.max(clamp_negative(raw)).cast("int").alias("max_days"))


# ---------------------------------------------------------------------------
# F2-F5 consultation sequence
# ---------------------------------------------------------------------------

def add_consultation_sequence(df: DataFrame, key: str = S.PSEUDO_ID,
                              num_partitions: int | None = None) -> DataFrame:
    """consultation_number (1-based by contact date, ties broken by every
    other column, nulls last), is_first_consultation, is_follow_up and
    total_consultations_for_patient. Rows are range-partitioned by the full
    order, so a patient of any size, or the null patient, is split (see
    ``grouprank``); the numbers are BIGINT."""
    date = [S.CONTACT_DATE] if S.CONTACT_DATE in df.columns else []
    rest = [c for c in df.columns if c != key and c not in date]
    out = rank_within(df, [key], date + rest, out="consultation_number",
                      total_out="total_consultations_for_patient", num_partitions=num_partitions)
    return out.select(*df.columns, *sequence_columns(F.col("consultation_number"), F.col("total_consultations_for_patient")))


def sequence_columns(number: Column, total: Column) -> list[Column]:
    """The four sequence columns of a row's position and its patient's rows."""
    return [number.alias("consultation_number"), (number == 1).cast("int").alias("is_first_consultation"),
            (number > 1).cast("int").alias("is_follow_up"), total.alias("total_consultations_for_patient")]


def sequence_stats(df: DataFrame, key: str = S.PSEUDO_ID) -> DataFrame:
    """Longest sequence, single / multiple-visit patients, mean visits."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n").cast("int").alias("max_consultation_number"),
                     F.count_if(F.col("n") == 1).alias("patients_with_single_consultation"),
                     F.count_if(F.col("n") > 1).alias("patients_with_multiple_consultations"),
                     r6(F.avg("n")).alias("mean_consultations_per_patient"))


# ---------------------------------------------------------------------------
# F6-F7 interactions
# ---------------------------------------------------------------------------

INTERACTIONS = ["p_score_fl_score_interaction", "severity_index", "p_status_fl_status_interaction",
                "both_improving", "both_worsening", "high_severity", "no_symptoms"]
SCORING_INTERACTIONS = ["p_score_fl_score_interaction", "severity_index", "both_improving", "high_severity"]


def interaction_columns(names: list[str] = INTERACTIONS) -> list:
    p, fl = F.col("p_score"), F.col("fl_score")
    ps, fs = F.col("p_status"), F.col("fl_status")
    defs = {
        "p_score_fl_score_interaction": p * fl,
        "severity_index": (p + fl) / F.lit(2.0),
        "p_status_fl_status_interaction": ps * fs,
        "both_improving": flag((ps == 2) & (fs == 2)),
        "both_worsening": flag((ps == 0) & (fs == 0)),
        "high_severity": flag((p >= 3) & (fl >= 3)),
        "no_symptoms": flag((p == 0) & (fl == 0)),
    }
    return [defs[n].alias(n) for n in names]


def add_interactions(df: DataFrame, names: list[str] = INTERACTIONS) -> DataFrame:
    """Products, mean severity and 0/1 flags (a null comparison gives 0)."""
    return df.select(*[c for c in df.columns if c not in names], *interaction_columns(names))


def interaction_stats(df: DataFrame) -> DataFrame:
    return df.agg(r6(F.max("severity_index")).alias("max_severity_index"),
                  F.sum("both_improving").cast("bigint").alias("patients_both_improving"),
                  F.sum("both_worsening").cast("bigint").alias("patients_both_worsening"),
                  F.sum("high_severity").cast("bigint").alias("high_severity_cases"),
                  F.sum("no_symptoms").cast("bigint").alias("no_symptoms_cases"))


# ---------------------------------------------------------------------------
# F8 patient label, P8 feature sets, P9 defaults
# ---------------------------------------------------------------------------

def patient_label(df: DataFrame, key: str = S.PSEUDO_ID, label: str = S.LABEL) -> DataFrame:
    """Most frequent label per patient, smallest on ties (map-side partial
    aggregation keeps one small count map per patient)."""
    return df.groupBy(key).agg(F.mode(F.col(label), deterministic=True).alias("patient_label"))


def select_baseline(df: DataFrame, key: str = S.PSEUDO_ID, label: str = S.LABEL) -> DataFrame:
    """4 core features, label, id; error when one is missing."""
    need = S.BASELINE_FEATURES + [label, key]
    missing = [c for c in need if c not in df.columns]
    if missing:
        raise FeatureSetError(f"Missing required columns for baseline features: {missing}")
    return df.select(*need)


def select_enhanced(df: DataFrame, key: str = S.PSEUDO_ID, label: str = S.LABEL,
                    defaults: dict = S.TRAINING_DEFAULTS) -> DataFrame:
    """6 features, label, id, then the 4 model interactions; absent temporal
    columns get ``defaults``."""
    for c, v in defaults.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(v).cast("int"))
    if not all(c in df.columns for c in SCORING_INTERACTIONS):
        df = add_interactions(df, [c for c in SCORING_INTERACTIONS if c not in df.columns])
    order = [c for c in S.ENHANCED_TABLE_ORDER if c != S.PSEUDO_ID] if key not in df.columns else \
        [key if c == S.PSEUDO_ID else c for c in S.ENHANCED_TABLE_ORDER]
    missing = [c for c in order if c not in df.columns]
    if missing:
        raise FeatureSetError(f"Missing required columns for enhanced features: {missing}")
    return df.select(*order)


def fill_defaults(df: DataFrame, defaults: dict = S.SCORING_DEFAULTS) -> DataFrame:
    """Absent or null optional inputs get their default."""
    out = df
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)).cast("int") if c in out.columns
                             else F.lit(v).cast("int"))
    return out
