"""Cleaning pipeline.

Order as in the reference: column check, type coercion, label filter, range
report (rows are kept), drop rows missing a critical value, exact dedup.
Everything is one lazy plan; the per-stage statistics of ``cleaning_summary``
come from one scan and one shuffle (rows identical in every column share
every stage flag, so grouping by all columns gives all counts at once).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from consult import schema as S
from consult.functions.exprs import pct, r6

DATE_COLUMNS = [S.ACCIDENT_DATE, S.CONTACT_DATE]
NUMERIC_COLUMNS = ["p_score", "p_status", "fl_score", "fl_status", S.LABEL]


class MissingColumnsError(ValueError):
    pass


def check_columns(df: DataFrame, required: list[str] = S.STEP2_REQUIRED) -> None:
    """Raise when a required column is absent (schema only, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"Required columns missing: {missing}")


def _to_number(c: str) -> Column:
    # Text to number; bad text becomes null (T14). A fraction stays as it is.
    return F.expr(f"try_cast(trim(cast(`{c}` AS string)) AS double)")


def _to_time(c: str) -> Column:
    # Per-value parse with reject to null (instead of all-or-nothing, T15).
    return F.expr(f"try_cast(trim(cast(`{c}` AS string)) AS timestamp)")


def coerce_types(df: DataFrame) -> DataFrame:
    """Text columns to TIMESTAMP / DOUBLE; unparseable values become null.

    The time of day and fractions are kept: day counts floor over 24 hours,
    and a fractional score is a value to report, not a missing one. Columns
    that are dates, timestamps or whole numbers already keep their kind."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        t = types[c]
        if c in DATE_COLUMNS:
            known = isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType))
            out.append(F.col(c) if known else _to_time(c).alias(c))
        elif c in NUMERIC_COLUMNS:
            out.append(F.col(c).cast("int").alias(c) if isinstance(t, T.IntegralType)
                       else _to_number(c).alias(c))
        elif c == S.ID:
            out.append(F.col(c).cast("string").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def coerce_rejects(raw: DataFrame) -> DataFrame:
    """Per coerced column: values present before, values rejected to null."""
    cols = [c for c in DATE_COLUMNS + NUMERIC_COLUMNS if c in raw.columns]
    exprs = []
    for c in cols:
        tc = _to_time(c) if c in DATE_COLUMNS else _to_number(c)
        exprs += [F.count(F.col(c)).alias(f"{c}__n"),
                  F.count_if(F.col(c).isNotNull() & tc.isNull()).alias(f"{c}__rej")]
    one = raw.agg(*exprs)
    parts = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__n").alias("n_values"),
                      F.col(f"{c}__rej").alias("n_rejected")) for c in cols]
    return one.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def binary_label_filter(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Keep rows labelled 0 or 1 (drops 2 = no information and missing)."""
    return df.where(F.col(label).isin(0, 1))


def drop_missing_critical(df: DataFrame, critical: list[str] = S.CRITICAL_COLUMNS) -> DataFrame:
    """Drop rows with a null in any critical column; other nulls stay."""
    return df.dropna(subset=[c for c in critical if c in df.columns])


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Full-row dedup (map-side partial aggregation before the shuffle)."""
    return df.dropDuplicates()


def drop_out_of_range(df: DataFrame, ranges: dict = S.FEATURE_RANGES) -> DataFrame:
    cond = F.lit(True)
    for c, (lo, hi) in ranges.items():
        if c in df.columns:
            cond = cond & (F.col(c).isNull() | F.col(c).between(lo, hi))
    return df.where(cond)


def clean(df: DataFrame, drop_invalid_range: bool = False) -> DataFrame:
    """Columns check, coerce, label filter, drop missing critical, dedup.
    Out-of-range rows are reported but kept unless ``drop_invalid_range``."""
    check_columns(df)
    out = binary_label_filter(coerce_types(df))
    out = drop_missing_critical(out)
    if drop_invalid_range:
        out = drop_out_of_range(out)
    return drop_exact_duplicates(out)


# ---------------------------------------------------------------------------
# Stage statistics
# ---------------------------------------------------------------------------

def label_filter_stats(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Before / removed / after, removal %, class shares after the filter."""
    keep = F.col(label).isin(0, 1)
    one = df.agg(F.count(F.lit(1)).alias("original_records"),
                 F.count_if(keep).alias("final_records"),
                 F.count_if(F.col(label) == 0).alias("__no"),
                 F.count_if(F.col(label) == 1).alias("__yes"))
    return one.select(
        "original_records", "final_records",
        (F.col("original_records") - F.col("final_records")).alias("removed_records"),
        r6(pct(F.col("original_records") - F.col("final_records"), F.col("original_records"))).alias("removal_pct"),
        r6(pct(F.col("__no"), F.col("final_records"))).alias("nbe_no_pct"),
        r6(pct(F.col("__yes"), F.col("final_records"))).alias("nbe_yes_pct"))


def _null_cells(cols: list[str]) -> Column:
    return sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))


def missing_removal_stats(df: DataFrame, critical: list[str] = S.CRITICAL_COLUMNS) -> DataFrame:
    """Null cells before, rows removed for a missing critical value, null
    cells left in the kept rows."""
    crit = [c for c in critical if c in df.columns]
    complete = F.lit(True)
    for c in crit:
        complete = complete & F.col(c).isNotNull()
    cells = _null_cells(df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("original_records"),
        F.sum(cells).cast("bigint").alias("missing_cells_before"),
        F.count_if(~complete).alias("records_removed"),
        F.coalesce(F.sum(F.when(complete, cells)), F.lit(0)).cast("bigint").alias("missing_cells_after"))


def dedup_stats(df: DataFrame, key: str = S.ID, date: str = S.CONTACT_DATE) -> DataFrame:
    """Exact duplicates, (patient, contact date) repeats, rows removed."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    exact = g.agg(F.sum("__n").cast("bigint").alias("original_records"),
                  F.count(F.lit(1)).alias("final_records"),
                  F.sum(F.col("__n") - 1).cast("bigint").alias("exact_duplicates"))
    pdd = (df.groupBy(key, date).agg(F.count(F.lit(1)).alias("__n"))
           .agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint")).scalar())
    return exact.select("original_records", "exact_duplicates",
                        pdd.alias("patient_date_duplicates"), "final_records",
                        (F.col("original_records") - F.col("final_records")).alias("records_removed"))


def cleaning_summary(raw: DataFrame, key: str = S.ID, label: str = S.LABEL,
                     critical: list[str] = S.CRITICAL_COLUMNS) -> DataFrame:
    """Per-stage row flow, retention %, nulls left, patients and date range
    of the cleaned table (true counts after each stage)."""
    typed = coerce_types(raw)
    crit = [c for c in critical if c in typed.columns]
    complete = F.lit(True)
    for c in crit:
        complete = complete & F.col(c).isNotNull()
    g = typed.groupBy(*typed.columns).agg(F.count(F.lit(1)).alias("__n"))
    lab = F.col(label).isin(0, 1)
    final = F.coalesce(lab & complete, F.lit(False))
    cells = _null_cells(typed.columns)
    one = g.agg(
        F.sum("__n").cast("bigint").alias("original_records"),
        F.coalesce(F.sum(F.when(lab, F.col("__n"))), F.lit(0)).cast("bigint").alias("after_label_filter"),
        F.coalesce(F.sum(F.when(final, F.col("__n"))), F.lit(0)).cast("bigint").alias("after_missing_removal"),
        F.count_if(final).alias("after_dedup"),
        F.coalesce(F.sum(F.when(final, cells)), F.lit(0)).cast("bigint").alias("final_missing_values"),
        F.count_distinct(F.when(final, F.col(key))).alias("unique_patients"),
        F.min(F.when(final, F.col(S.ACCIDENT_DATE))).alias("earliest_accident"),
        F.max(F.when(final, F.col(S.CONTACT_DATE))).alias("latest_contact"))
    return one.select(
        "original_records", "after_label_filter", "after_missing_removal", "after_dedup",
        F.col("after_dedup").alias("final_records"),
        (F.col("original_records") - F.col("after_dedup")).alias("total_removed"),
        r6(pct(F.col("after_dedup"), F.col("original_records"))).alias("retention_pct"),
        "final_missing_values", "unique_patients", "earliest_accident", "latest_contact")
