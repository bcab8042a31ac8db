"""Registered queries: one per operator of the inventory, each with its
DuckDB oracle where the answer is expressible in SQL.

Every query reads the driver's tables at ``sf_dir`` (through the fixture
builders) and runs the library operator on the whole input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from consult import schema as S
from consult.operators import cleaning as C
from consult.operators import features as FT
from consult.operators import metrics as X
from consult.operators import pseudonym as A
from consult.operators import quality as Q
from consult.operators import rules as V
from consult.operators import split as SP
from consult.plans import sqlparts as P
from consult.sources import fixtures as FX
from consult.sources import io as IO

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- shared inputs -----------------------------------------------------------

def raw(spark, d):
    return FX.consultations_raw(spark, d)


def typed(spark, d):
    return C.coerce_types(raw(spark, d))


def cleaned(spark, d):
    return C.clean(FX.consultations(spark, d))


def anon(spark, d):
    return A.pseudonymize(cleaned(spark, d))[0]


def feats(spark, d):
    from consult.plans.prepare import feature_table
    return feature_table(cleaned(spark, d))[0]


ANON_CTES = ["cleaned", P.id_map("cleaned"), P.anon("cleaned")]
FEAT_CTES = ANON_CTES + [P.feats("anon")]
TYPED = (["consultations_raw"], ["typed_raw"])


def tq(body: str) -> str:
    return P.q(*TYPED, body)


def fq(body: str, extra: list[str] | None = None) -> str:
    return P.q(["consultations"], FEAT_CTES + (extra or []), body)


# =============================================================================
# Sources (S1, S3)
# =============================================================================

@register("src_consultations", P.q(["consultations"], [], "SELECT * FROM consultations"))
def q_src_consultations(spark, d):
    return IO.conform(FX.consultations(spark, d), S.CONSULTATION_SCHEMA)


@register("latest_snapshot", P.q(["consultations"], [], """
SELECT accident_number, accident_date, contact_date, fl_score, fl_status, p_score, p_status, nbe, run_id FROM (
  SELECT *, '20250101' AS run_id FROM consultations
  UNION ALL SELECT *, '20250612' AS run_id FROM consultations WHERE nbe IN (0, 1)) u
WHERE run_id = (SELECT max(run_id) FROM (
  SELECT '20250101' AS run_id FROM consultations
  UNION ALL SELECT '20250612' AS run_id FROM consultations WHERE nbe IN (0, 1)) r)"""))
def q_latest_snapshot(spark, d):
    """Two runs of a stage written as partitions; the newest is read back."""
    import uuid

    from consult.session import scratch_path
    c = FX.consultations(spark, d)
    path = scratch_path(spark, f"stage-{uuid.uuid4().hex}")
    IO.write_stage(c, path, "20250101")
    IO.write_stage(C.binary_label_filter(c), path, "20250612")
    return IO.read_stage(spark, path)


@register("stage_reread", P.q(["consultations"], [], """
SELECT f.fmt, c.* FROM consultations c, (VALUES ('csv'), ('json')) AS f(fmt)"""))
def q_stage_reread(spark, d):
    """A stage written as CSV and as JSON, each read back with its types."""
    import uuid

    from consult.session import scratch_path
    c, out = FX.consultations(spark, d), None
    for fmt in ("csv", "json"):
        path = scratch_path(spark, f"stage-{fmt}-{uuid.uuid4().hex}")
        IO.write_stage(c, path, "20250612", fmt=fmt)
        back = IO.read_stage(spark, path, fmt=fmt).drop("run_id").select(F.lit(fmt).alias("fmt"), *c.columns)
        out = back if out is None else out.unionByName(back)
    return out


@register("csv_rejects", P.q(["consultations_raw"], [], f"""
SELECT 'row' AS kind, nbe, count(*) AS n_lines FROM consultations_raw WHERE p_score IS DISTINCT FROM '9' GROUP BY nbe
UNION ALL SELECT 'reject', NULL, count(*) FROM consultations_raw WHERE p_score = '9'"""))
def q_csv_rejects(spark, d):
    """A raw CSV drop read with its schema: rows by label, and the lines that do not fit it, counted."""
    import uuid

    from consult.session import scratch_path
    path = scratch_path(spark, f"drop-{uuid.uuid4().hex}")
    FX.csv_lines(spark, d).write.text(path)
    rows, rejects = IO.read_with_rejects(spark, path, "csv", header="false")
    n = F.count(F.lit(1)).alias("n_lines")
    bad = rejects.groupBy("file_path").agg(F.count("line").alias("n")).agg(F.sum("n").alias("n_lines"))
    return rows.groupBy(F.lit("row").alias("kind"), "nbe").agg(n).unionByName(
        bad.select(F.lit("reject").alias("kind"), F.lit(None).cast("string").alias("nbe"), "n_lines"))


# =============================================================================
# Projections, predicates, coercion
# =============================================================================

def _schema_check_sql() -> str:
    rows = []
    for c in S.STEP1_REQUIRED:
        exp = ",".join(S.ACCEPTED_TYPES[c])
        rows.append(f"SELECT '{c}' AS column_name, 'present' AS status, 'string' AS actual_type, "
                    f"'{exp}' AS expected_types, {'true' if 'string' in S.ACCEPTED_TYPES[c] else 'false'} AS type_ok, "
                    f"count({c}) AS non_null FROM consultations_raw")
    for c in P.RAW_COLS:
        if c not in S.STEP1_REQUIRED:
            rows.append(f"SELECT '{c}', 'extra', 'string', NULL, NULL, count({c}) FROM consultations_raw")
    return P.q(["consultations_raw"], [], "\nUNION ALL\n".join(rows))


@register("schema_check", _schema_check_sql())
def q_schema_check(spark, d):
    return Q.schema_check(raw(spark, d))


def _type_conv_sql() -> str:
    rows = []
    for c in S.STEP1_REQUIRED:
        numeric = c != S.ID
        rows.append(f"SELECT '{c}' AS column_name, count({c}) AS n_values, "
                    f"count(try_cast(trim({c}) AS DOUBLE)) AS n_numeric, "
                    f"{'true' if numeric else 'false'} AND count({c}) = count(try_cast(trim({c}) AS DOUBLE)) "
                    f"AS can_convert FROM consultations_raw")
    return P.q(["consultations_raw"], [], "\nUNION ALL\n".join(rows))


@register("type_convertibility", _type_conv_sql())
def q_type_convertibility(spark, d):
    return Q.type_convertibility(raw(spark, d))


@register("coerce_types", tq("SELECT * FROM typed_raw"))
def q_coerce_types(spark, d):
    return typed(spark, d)


def _rejects_sql() -> str:
    rows = []
    for c in ["accident_date", "contact_date", "fl_score", "fl_status", "p_score", "p_status", "nbe"]:
        conv = P._time(c) if c.endswith("_date") else P._number(c)
        rows.append(f"SELECT '{c}' AS column_name, count({c}) AS n_values, "
                    f"count(*) FILTER (WHERE {c} IS NOT NULL AND {conv} IS NULL) AS n_rejected "
                    f"FROM consultations_raw")
    return P.q(["consultations_raw"], [], "\nUNION ALL\n".join(rows))


@register("coerce_rejects", _rejects_sql())
def q_coerce_rejects(spark, d):
    return C.coerce_rejects(raw(spark, d))


def _range_sql() -> str:
    rows = []
    for c, (lo, hi) in S.FEATURE_RANGES.items():
        bad = f"NOT ({c} BETWEEN {lo} AND {hi})"
        rows.append(f"SELECT '{c}' AS feature, '{lo}-{hi}' AS expected_range, "
                    f"count(*) FILTER (WHERE {bad}) AS n_violations, "
                    f"round(100.0 * count(*) FILTER (WHERE {bad}) / count(*), 6) AS violation_pct, "
                    f"count(DISTINCT CASE WHEN {bad} THEN {c} END) AS n_distinct_invalid FROM typed_raw")
    return tq("\nUNION ALL\n".join(rows))


@register("range_violations", _range_sql())
def q_range_violations(spark, d):
    return Q.range_violations(typed(spark, d))


def _range_values_sql() -> str:
    rows = []
    for c, (lo, hi) in S.FEATURE_RANGES.items():
        rows.append(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, count(*) AS n_rows FROM typed_raw "
                    f"WHERE NOT ({c} BETWEEN {lo} AND {hi}) GROUP BY {c}")
    return tq("\nUNION ALL\n".join(rows))


@register("range_violation_values", _range_values_sql())
def q_range_violation_values(spark, d):
    return Q.range_violation_values(typed(spark, d))


@register("binary_label_filter", tq("SELECT * FROM typed_raw WHERE nbe IN (0, 1)"))
def q_binary_label_filter(spark, d):
    return C.binary_label_filter(typed(spark, d))


@register("drop_missing_critical", tq(
    "SELECT * FROM typed_raw WHERE p_score IS NOT NULL AND p_status IS NOT NULL AND fl_score IS NOT NULL "
    "AND fl_status IS NOT NULL AND nbe IS NOT NULL"))
def q_drop_missing_critical(spark, d):
    return C.drop_missing_critical(typed(spark, d))


@register("dedup_exact", tq("SELECT DISTINCT * FROM typed_raw"))
def q_dedup_exact(spark, d):
    return C.drop_exact_duplicates(typed(spark, d))


@register("baseline_features", fq("SELECT p_score, p_status, fl_score, fl_status, nbe, anonymous_patient_id FROM feats"))
def q_baseline_features(spark, d):
    return FT.select_baseline(feats(spark, d))


@register("enhanced_features", fq(f"SELECT {P.ENH_COLS}, anonymous_patient_id FROM feats"))
def q_enhanced_features(spark, d):
    return FT.select_enhanced(feats(spark, d))


@register("fill_defaults", P.q(["scoring_requests"], [], """
SELECT request_id, p_score, p_status, fl_score, fl_status, response_type,
       COALESCE(days_since_accident, 21) AS days_since_accident,
       COALESCE(consultation_number, 2) AS consultation_number
FROM scoring_requests"""))
def q_fill_defaults(spark, d):
    return FT.fill_defaults(FX.scoring_requests(spark, d))


# =============================================================================
# Profiling and quality (Q1-Q19)
# =============================================================================

ALL_COLS = ", ".join(P.RAW_COLS)


@register("dataset_summary", tq(f"""
SELECT CAST(sum(n) AS BIGINT) AS n_rows, 8 AS n_columns, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows,
       round(100.0 * sum(n - 1) / sum(n), 6) AS duplicate_pct,
       count(DISTINCT accident_number) AS unique_patients
FROM (SELECT {ALL_COLS}, count(*) AS n FROM typed_raw GROUP BY ALL) g"""))
def q_dataset_summary(spark, d):
    return Q.dataset_summary(typed(spark, d))


def _missing_sql() -> str:
    rows = []
    for i, c in enumerate(P.RAW_COLS):
        m = f"count(*) FILTER (WHERE {c} IS NULL)"
        rows.append(f"SELECT {i} AS position, '{c}' AS column_name, {m} AS missing_count, "
                    f"round(100.0 * {m} / count(*), 6) AS missing_pct, "
                    f"round(100.0 - 100.0 * {m} / count(*), 6) AS completeness_pct FROM typed_raw")
    return tq("\nUNION ALL\n".join(rows))


@register("missing_profile", _missing_sql())
def q_missing_profile(spark, d):
    return Q.missing_profile(typed(spark, d))


def _pattern_sql() -> str:
    mask = " || ".join(f"CASE WHEN {c} IS NULL THEN '1' ELSE '0' END" for c in P.RAW_COLS)
    nm = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in P.RAW_COLS)
    return tq(f"SELECT {mask} AS null_mask, {nm} AS n_missing_columns, count(*) AS n_rows "
              f"FROM typed_raw GROUP BY ALL")


@register("missing_pattern", _pattern_sql())
def q_missing_pattern(spark, d):
    return Q.missing_pattern(typed(spark, d))


LONG = "\nlong AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM typed_raw" for c in S.PROFILE_COLUMNS) + ")"


@register("feature_profile", P.q(["consultations_raw"], ["typed_raw", LONG], """
SELECT feature, count(DISTINCT value) AS n_distinct, min(value) AS min_value, max(value) AS max_value,
       round(avg(value), 6) AS mean_value, round(stddev_samp(value), 6) AS std_value FROM long GROUP BY feature"""))
def q_feature_profile(spark, d):
    return Q.feature_profile(typed(spark, d))


@register("value_distribution", P.q(["consultations_raw"], ["typed_raw", LONG], """
SELECT feature, value, n_rows, round(100.0 * n_rows / n_all, 6) AS pct_rows,
       round(100.0 * n_rows / n_nn, 6) AS pct_non_missing
FROM (SELECT feature, value, count(*) AS n_rows,
             sum(count(*)) OVER (PARTITION BY feature) AS n_all,
             sum(count(*)) FILTER (WHERE value IS NOT NULL) OVER (PARTITION BY feature) AS n_nn
      FROM long GROUP BY feature, value) g
WHERE value IS NOT NULL"""))
def q_value_distribution(spark, d):
    return Q.value_distribution(typed(spark, d))


@register("class_balance", tq("""
SELECT class_value, n_rows,
       round(CAST(n_rows AS DOUBLE) / n_all, 6) AS share_all_rows,
       round(CAST(n_rows AS DOUBLE) / n_nn, 6) AS share_labelled,
       round(CAST(mn AS DOUBLE) / n_all, 6) AS min_share_all_rows,
       round(CAST(mn AS DOUBLE) / n_nn, 6) AS min_share_labelled,
       round(CAST(mx AS DOUBLE) / mn, 6) AS balance_ratio,
       CAST(mn AS DOUBLE) / n_all < 0.1 AS needs_balancing,
       CAST(mn AS DOUBLE) / n_nn >= 0.3 AS is_balanced
FROM (SELECT class_value, n_rows, sum(n_rows) OVER () AS n_all,
             sum(n_rows) FILTER (WHERE class_value IS NOT NULL) OVER () AS n_nn,
             min(n_rows) FILTER (WHERE class_value IS NOT NULL) OVER () AS mn,
             max(n_rows) FILTER (WHERE class_value IS NOT NULL) OVER () AS mx
      FROM (SELECT nbe AS class_value, count(*) AS n_rows FROM typed_raw GROUP BY nbe) g) t
WHERE class_value IS NOT NULL"""))
def q_class_balance(spark, d):
    return Q.class_balance(typed(spark, d))


SIZES = "\nsizes AS (SELECT accident_number, count(*) AS group_size FROM typed_raw GROUP BY accident_number)"


def sq(body: str) -> str:
    return P.q(["consultations_raw"], ["typed_raw", SIZES], body)


@register("group_size_stats", sq("""
SELECT count(*) AS n_groups, round(avg(group_size), 6) AS mean_size,
       round(quantile_cont(group_size, 0.5), 6) AS median_size, min(group_size) AS min_size,
       max(group_size) AS max_size, round(stddev_samp(group_size), 6) AS std_size FROM sizes"""))
def q_group_size_stats(spark, d):
    return Q.group_size_stats(typed(spark, d))


@register("group_size_histogram", sq("SELECT group_size, count(*) AS n_groups FROM sizes GROUP BY group_size"))
def q_group_size_histogram(spark, d):
    return Q.group_size_histogram(typed(spark, d))


@register("group_size_cdf", sq("""
SELECT group_size, n_groups, CAST(sum(n_groups) OVER (ORDER BY group_size) AS BIGINT) AS cum_groups,
       round(100.0 * sum(n_groups) OVER (ORDER BY group_size) / sum(n_groups) OVER (), 6) AS cum_pct
FROM (SELECT group_size, count(*) AS n_groups FROM sizes GROUP BY group_size) h"""))
def q_group_size_cdf(spark, d):
    return Q.group_size_cdf(typed(spark, d))


@register("group_size_box", sq("""
SELECT round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr,
       round(q1 - 1.5 * (q3 - q1), 6) AS lower_fence, round(q3 + 1.5 * (q3 - q1), 6) AS upper_fence,
       min(group_size) FILTER (WHERE group_size BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
       max(group_size) FILTER (WHERE group_size BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
       count(*) FILTER (WHERE NOT (group_size BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_fliers
FROM sizes, (SELECT quantile_cont(group_size, 0.25) AS q1, quantile_cont(group_size, 0.5) AS med,
                    quantile_cont(group_size, 0.75) AS q3 FROM sizes) q
GROUP BY q1, med, q3"""))
def q_group_size_box(spark, d):
    return Q.group_size_box(typed(spark, d))


def _pearson_sql(x: str, y: str) -> str:
    xs = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN CAST({x} AS DOUBLE) END"
    ys = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN CAST({y} AS DOUBLE) END"
    return (f"round(covar_pop({xs}, {ys}) / nullif(stddev_pop({xs}) * stddev_pop({ys}), 0), 6)")


def _corr_sql() -> str:
    cols = S.PROFILE_COLUMNS
    rows = [f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, {_pearson_sql(a, b)} AS r FROM typed_raw"
            for i, a in enumerate(cols) for b in cols[i + 1:]]
    return tq("\nUNION ALL\n".join(rows))


@register("correlation_matrix", _corr_sql())
def q_correlation_matrix(spark, d):
    return Q.correlation_matrix(typed(spark, d))


@register("label_correlation", tq("\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, {_pearson_sql(c, 'nbe')} AS r FROM typed_raw" for c in S.BASELINE_FEATURES)))
def q_label_correlation(spark, d):
    return Q.label_correlation(typed(spark, d))


BOUNDS = """
bounds AS (
  SELECT feature, n_all, q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
    SELECT feature, count(*) AS n_all, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
    FROM long GROUP BY feature) t WHERE q1 IS NOT NULL)"""


@register("iqr_outliers", P.q(["consultations_raw"], ["typed_raw", LONG, BOUNDS], """
SELECT b.feature, round(q1, 6) AS q1, round(q3, 6) AS q3, round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound,
       count(*) FILTER (WHERE l.value < lo OR l.value > hi) AS n_outliers,
       round(100.0 * count(*) FILTER (WHERE l.value < lo OR l.value > hi) / n_all, 6) AS outlier_pct
FROM bounds b JOIN long l ON l.feature = b.feature GROUP BY b.feature, q1, q3, lo, hi, n_all"""))
def q_iqr_outliers(spark, d):
    return Q.iqr_outliers(typed(spark, d))


@register("iqr_outlier_values", P.q(["consultations_raw"], ["typed_raw", LONG, BOUNDS], """
SELECT l.feature, l.value, count(*) AS n_rows FROM long l JOIN bounds b ON l.feature = b.feature
WHERE l.value < lo OR l.value > hi GROUP BY l.feature, l.value"""))
def q_iqr_outlier_values(spark, d):
    return Q.iqr_outlier_values(typed(spark, d))


@register("duplicate_profile", tq(f"""
SELECT 'exact_duplicates' AS metric, CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS value
FROM (SELECT count(*) AS n FROM typed_raw GROUP BY ALL_PLACEHOLDER) a
UNION ALL
SELECT 'patient_level_duplicates', CAST(COALESCE(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT)
FROM (SELECT count(*) AS n FROM typed_raw GROUP BY accident_number) b
UNION ALL
SELECT 'patient_date_duplicates', CAST(COALESCE(sum(n - 1), 0) AS BIGINT)
FROM (SELECT count(*) AS n FROM typed_raw GROUP BY accident_number, contact_date) c""".replace(
    "ALL_PLACEHOLDER", ALL_COLS)))
def q_duplicate_profile(spark, d):
    return Q.duplicate_profile(typed(spark, d))


@register("sample_size_check", tq("""
SELECT count(*) AS total_samples, count(*) >= 100 AS is_adequate,
       CASE WHEN count(*) >= 500 THEN 'adequate' WHEN count(*) >= 100 THEN 'marginal' ELSE 'insufficient' END
         AS recommendation FROM typed_raw"""))
def q_sample_size_check(spark, d):
    return Q.sample_size_check(typed(spark, d))


@register("feature_quality", tq("\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(100.0 * count({c}) / count(*), 6) AS completeness_pct, "
    f"round(var_samp({c}), 6) AS variance FROM typed_raw" for c in S.BASELINE_FEATURES)))
def q_feature_quality(spark, d):
    return Q.feature_quality(typed(spark, d))


@register("target_quality", tq("""
SELECT round(comp, 6) AS completeness_pct, k AS class_count, comp >= 95 AND k >= 2 AS is_suitable,
       concat_ws('; ', CASE WHEN comp < 95 THEN 'Target variable has too many missing values' END,
                 CASE WHEN k < 2 THEN 'Target variable needs at least 2 classes' END) AS recommendations
FROM (SELECT COALESCE(100.0 * count(nbe) / nullif(count(*), 0), 0) AS comp, count(DISTINCT nbe) AS k
      FROM typed_raw) t"""))
def q_target_quality(spark, d):
    return Q.target_quality(typed(spark, d))


def _verdict_sql() -> str:
    rv = " + ".join(f"v_{c}" for c in S.FEATURE_RANGES)
    nb = " + ".join(f"CASE WHEN v_{c} > 0 THEN 1 ELSE 0 END" for c in S.FEATURE_RANGES)
    aggs = ", ".join(f"count(*) FILTER (WHERE NOT ({c} BETWEEN {lo} AND {hi})) AS v_{c}"
                     for c, (lo, hi) in S.FEATURE_RANGES.items())
    comps = " + ".join(f"100.0 * nn_{c} / n" for c in S.BASELINE_FEATURES)
    nns = ", ".join(f"count({c}) AS nn_{c}" for c in S.BASELINE_FEATURES)
    return tq(f"""
SELECT n AS n_rows, true AS is_compliant, '' AS missing_columns, CAST(tv AS BIGINT) AS total_violations,
       round(COALESCE(100.0 * tv / nullif(n * nbad, 0), 0), 6) AS violation_rate,
       round(COALESCE(100.0 * tv / n, 0), 6) AS violation_rate_rows,
       CAST(dups AS BIGINT) AS duplicate_rows,
       round(greatest(0.0, 100.0 - COALESCE(100.0 * dups / n, 0)), 6) AS integrity_score,
       round(greatest(0.0, 100.0 - CASE WHEN n >= 100 THEN 0 ELSE 30 END - CASE WHEN suitable THEN 0 ELSE 40 END
                      - (100.0 - avg_comp) * 0.3), 6) AS readiness_score,
       tv = 0 AS is_valid, dups = 0 AS is_intact, n >= 100 AND suitable AS is_ready,
       tv = 0 AND dups = 0 AND n >= 100 AND suitable AS overall_valid,
       concat_ws('; ', CASE WHEN tv <> 0 THEN 'Business rule violations' END,
                 CASE WHEN NOT (n >= 100 AND suitable) THEN 'Not ready for machine learning' END) AS critical_issues
FROM (SELECT *, {rv} AS tv, {nb} AS nbad, ({comps}) / {len(S.BASELINE_FEATURES)} AS avg_comp,
             100.0 * lab_nn / n >= 95 AND lab_k >= 2 AS suitable,
             (SELECT COALESCE(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM typed_raw GROUP BY {ALL_COLS}) g) AS dups
      FROM (SELECT count(*) AS n, {aggs}, {nns}, count(nbe) AS lab_nn, count(DISTINCT nbe) AS lab_k
            FROM typed_raw) a) t""")


@register("quality_verdict", _verdict_sql())
def q_quality_verdict(spark, d):
    return Q.quality_verdict(typed(spark, d))


RULES = [("contact_after_accident", "contact_date >= accident_date"),
         ("max_pain_has_limitation", "NOT (p_score = 4 AND fl_score = 0)"),
         ("label_known", "nbe IN (0, 1)")]


@register("rule_hook", tq("\nUNION ALL\n".join(
    f"SELECT '{n}' AS rule, count(*) AS n_rows, count(*) FILTER (WHERE NOT ({e})) AS n_violations, "
    f"round(100.0 * count(*) FILTER (WHERE NOT ({e})) / count(*), 6) AS violation_pct FROM typed_raw"
    for n, e in RULES)))
def q_rule_hook(spark, d):
    return Q.rule_hook(typed(spark, d), RULES)


# =============================================================================
# Cleaning (C1-C5)
# =============================================================================

@register("label_filter_stats", tq("""
SELECT n AS original_records, k AS final_records, n - k AS removed_records,
       round(100.0 * (n - k) / n, 6) AS removal_pct, round(100.0 * no / nullif(k, 0), 6) AS nbe_no_pct,
       round(100.0 * yes / nullif(k, 0), 6) AS nbe_yes_pct
FROM (SELECT count(*) AS n, count(*) FILTER (WHERE nbe IN (0, 1)) AS k, count(*) FILTER (WHERE nbe = 0) AS no,
             count(*) FILTER (WHERE nbe = 1) AS yes FROM typed_raw) t"""))
def q_label_filter_stats(spark, d):
    return C.label_filter_stats(typed(spark, d))


NULLS = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in P.RAW_COLS)
COMPLETE = "p_score IS NOT NULL AND p_status IS NOT NULL AND fl_score IS NOT NULL AND fl_status IS NOT NULL AND nbe IS NOT NULL"


@register("missing_removal_stats", tq(f"""
SELECT count(*) AS original_records, CAST(sum({NULLS}) AS BIGINT) AS missing_cells_before,
       count(*) FILTER (WHERE NOT ({COMPLETE})) AS records_removed,
       CAST(COALESCE(sum({NULLS}) FILTER (WHERE {COMPLETE}), 0) AS BIGINT) AS missing_cells_after
FROM typed_raw WHERE nbe IN (0, 1)"""))
def q_missing_removal_stats(spark, d):
    return C.missing_removal_stats(C.binary_label_filter(typed(spark, d)))


@register("dedup_stats", tq(f"""
SELECT CAST(sum(n) AS BIGINT) AS original_records, CAST(sum(n - 1) AS BIGINT) AS exact_duplicates,
       (SELECT CAST(COALESCE(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM typed_raw
        WHERE nbe IN (0, 1) AND {COMPLETE} GROUP BY accident_number, contact_date) p) AS patient_date_duplicates,
       count(*) AS final_records, CAST(sum(n) - count(*) AS BIGINT) AS records_removed
FROM (SELECT count(*) AS n FROM typed_raw WHERE nbe IN (0, 1) AND {COMPLETE} GROUP BY {ALL_COLS}) g"""))
def q_dedup_stats(spark, d):
    return C.dedup_stats(C.drop_missing_critical(C.binary_label_filter(typed(spark, d))))


@register("clean_consultations", P.q(["consultations_raw"], ["typed_raw", "cleaned_raw"], "SELECT * FROM cleaned_raw"))
def q_clean_consultations(spark, d):
    return C.clean(raw(spark, d))


@register("cleaning_summary", tq(f"""
SELECT n AS original_records, lab AS after_label_filter, fin AS after_missing_removal, dd AS after_dedup,
       dd AS final_records, n - dd AS total_removed, round(100.0 * dd / n, 6) AS retention_pct,
       fnull AS final_missing_values, pats AS unique_patients, ea AS earliest_accident, lc AS latest_contact
FROM (SELECT CAST(sum(n) AS BIGINT) AS n,
             CAST(COALESCE(sum(n) FILTER (WHERE nbe IN (0, 1)), 0) AS BIGINT) AS lab,
             CAST(COALESCE(sum(n) FILTER (WHERE ok), 0) AS BIGINT) AS fin,
             count(*) FILTER (WHERE ok) AS dd,
             CAST(COALESCE(sum(nulls) FILTER (WHERE ok), 0) AS BIGINT) AS fnull,
             count(DISTINCT accident_number) FILTER (WHERE ok) AS pats,
             min(accident_date) FILTER (WHERE ok) AS ea, max(contact_date) FILTER (WHERE ok) AS lc
      FROM (SELECT {ALL_COLS}, count(*) AS n, COALESCE(nbe IN (0, 1) AND {COMPLETE}, false) AS ok,
                   {NULLS} AS nulls
            FROM typed_raw GROUP BY {ALL_COLS}) g) t"""))
def q_cleaning_summary(spark, d):
    return C.cleaning_summary(raw(spark, d))


# =============================================================================
# Flagship (entry): per-label profile of the feature table
# =============================================================================

@register("nbe_profile", fq("""
SELECT nbe, count(*) AS n_rows, count(DISTINCT anonymous_patient_id) AS n_patients,
       round(avg(severity_index), 6) AS mean_severity, round(avg(days_since_accident), 6) AS mean_days,
       round(avg(consultation_number), 6) AS mean_consultation_number
FROM feats GROUP BY nbe"""))
def q_nbe_profile(spark, d):
    f = feats(spark, d)
    return f.groupBy("nbe").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(S.PSEUDO_ID).alias("n_patients"),
        F.round(F.avg("severity_index"), 6).alias("mean_severity"),
        F.round(F.avg("days_since_accident"), 6).alias("mean_days"),
        F.round(F.avg("consultation_number"), 6).alias("mean_consultation_number"))


# =============================================================================
# Pseudonymization
# =============================================================================

@register("id_mapping", P.q(["consultations"], ["cleaned", P.id_map("cleaned")], "SELECT * FROM id_map"))
def q_id_mapping(spark, d):
    return A.build_id_mapping(cleaned(spark, d))


@register("pseudonymize", P.q(["consultations"], ANON_CTES, "SELECT * FROM anon"))
def q_pseudonymize(spark, d):
    return anon(spark, d)


@register("reverse_lookup", fq("""
SELECT s.anonymous_patient_id, s.split, m.original_id FROM psplit s
JOIN id_map m ON s.anonymous_patient_id = m.anonymous_id""",
                                [P.patient_label("feats"), P.split("plabel")]))
def q_reverse_lookup(spark, d):
    """Patients of both sides of the split traced back to their original ids."""
    c = cleaned(spark, d)
    an, m = A.pseudonymize(c)
    f = FT.add_interactions(FT.add_consultation_sequence(FT.add_days_since_accident(an)))
    sp = SP.stratified_patient_split(f).select(S.PSEUDO_ID, "split")
    return A.reverse_lookup(sp, m)


@register("validate_mapping", P.q(["consultations"], ANON_CTES, """
SELECT * FROM (VALUES
  (1, 'record_count_match', (SELECT count(*) FROM cleaned) = (SELECT count(*) FROM anon),
      format('{} vs {}', (SELECT count(*) FROM cleaned), (SELECT count(*) FROM anon))),
  (2, 'patient_count_match',
      (SELECT count(DISTINCT accident_number) FROM cleaned) = (SELECT count(DISTINCT anonymous_patient_id) FROM anon),
      format('{} vs {}', (SELECT count(DISTINCT accident_number) FROM cleaned),
             (SELECT count(DISTINCT anonymous_patient_id) FROM anon))),
  (3, 'original_ids_removed', true, 'true'),
  (4, 'valid_anonymous_ids', true, 'bigint'),
  (5, 'sequential_numbering', (SELECT min(anonymous_patient_id) = 1 AND max(anonymous_patient_id) = (SELECT count(*) FROM id_map) FROM anon),
      format('1 to {}', (SELECT max(anonymous_patient_id) FROM anon))),
  (6, 'mapping_unique', (SELECT count(DISTINCT anonymous_id) = count(*) FROM id_map),
      format('{} of {}', (SELECT count(DISTINCT anonymous_id) FROM id_map), (SELECT count(*) FROM id_map))),
  (7, 'columns_preserved', true, '')
) AS t(check_no, check_name, passed, detail)"""))
def q_validate_mapping(spark, d):
    c = cleaned(spark, d)
    an, m = A.pseudonymize(c)
    return A.validate_mapping(c, an, m)


def _patterns_sql() -> str:
    return P.q(["consultations"], ANON_CTES + [
        "\nsz AS (SELECT anonymous_patient_id, count(*) AS n FROM anon GROUP BY anonymous_patient_id)"], """
SELECT metric, round(value, 6) AS value FROM (
  SELECT 'mean_consultations_per_patient' AS metric, avg(n) AS value, 1 AS o FROM sz
  UNION ALL SELECT 'median_consultations_per_patient', quantile_cont(n, 0.5), 2 FROM sz
  UNION ALL SELECT 'min_consultations', CAST(min(n) AS DOUBLE), 3 FROM sz
  UNION ALL SELECT 'max_consultations', CAST(max(n) AS DOUBLE), 4 FROM sz
  UNION ALL SELECT 'std_consultations', stddev_samp(n), 5 FROM sz
  UNION ALL SELECT 'single_consultation', CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE), 6 FROM sz
  UNION ALL SELECT 'multiple_consultations', CAST(count(*) FILTER (WHERE n > 1) AS DOUBLE), 7 FROM sz
  UNION ALL SELECT 'high_frequency_patients', CAST(count(*) FILTER (WHERE n >= 5) AS DOUBLE), 8 FROM sz
  UNION ALL SELECT 'max_sequence_number', CAST(max(n) AS DOUBLE), 9 FROM sz) t""")


@register("consultation_patterns", _patterns_sql())
def q_consultation_patterns(spark, d):
    return A.consultation_patterns(anon(spark, d))


@register("sequence_distribution", fq("""
SELECT consultation_number AS sequence_number, count(*) AS n_rows FROM feats GROUP BY consultation_number"""))
def q_sequence_distribution(spark, d):
    return A.sequence_distribution(anon(spark, d))


# =============================================================================
# Features (F1-F14)
# =============================================================================

@register("days_since_accident", fq(
    "SELECT anonymous_patient_id, accident_date, contact_date, fl_score, fl_status, p_score, p_status, nbe, "
    "days_since_accident FROM feats"))
def q_days_since_accident(spark, d):
    return FT.add_days_since_accident(anon(spark, d))


@register("days_stats", tq(f"""
SELECT count(*) FILTER (WHERE {P.whole_days()} < 0) AS n_negative,
       CAST(min(greatest({P.whole_days()}, 0)) AS INTEGER) AS min_days,
       CAST(max(greatest({P.whole_days()}, 0)) AS INTEGER) AS max_days
FROM typed_raw WHERE accident_date IS NOT NULL AND contact_date IS NOT NULL"""))
def q_days_stats(spark, d):
    """Day gaps of the raw table, times of day included."""
    return FT.days_stats(typed(spark, d))


@register("raw_whole_days", tq(f"""
SELECT {P.whole_days()} AS whole_days, count(*) AS n_rows FROM typed_raw GROUP BY 1"""))
def q_raw_whole_days(spark, d):
    """F1 on times of day: rows per unclamped day count of the raw table."""
    days = FT.add_days_since_accident(typed(spark, d), clamp=False)
    return days.groupBy(F.col("days_since_accident").cast("bigint").alias("whole_days")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@register("consultation_number", fq(
    "SELECT anonymous_patient_id, accident_date, contact_date, fl_score, fl_status, p_score, p_status, nbe, "
    "days_since_accident, consultation_number, is_first_consultation, is_follow_up, "
    "total_consultations_for_patient FROM feats"))
def q_consultation_number(spark, d):
    return FT.add_consultation_sequence(FT.add_days_since_accident(anon(spark, d)))


@register("sequence_stats", fq("""
SELECT CAST(max(n) AS INTEGER) AS max_consultation_number,
       count(*) FILTER (WHERE n = 1) AS patients_with_single_consultation,
       count(*) FILTER (WHERE n > 1) AS patients_with_multiple_consultations,
       round(avg(n), 6) AS mean_consultations_per_patient
FROM (SELECT anonymous_patient_id, count(*) AS n FROM feats GROUP BY anonymous_patient_id) s"""))
def q_sequence_stats(spark, d):
    return FT.sequence_stats(anon(spark, d))


@register("interaction_features", P.q(["consultations"], [], f"""
SELECT accident_number, accident_date, contact_date, fl_score, fl_status, p_score, p_status, nbe,
       {P.interactions_sql()} FROM consultations"""))
def q_interaction_features(spark, d):
    return FT.add_interactions(FX.consultations(spark, d))


@register("interaction_stats", fq("""
SELECT round(max(severity_index), 6) AS max_severity_index,
       CAST(sum(both_improving) AS BIGINT) AS patients_both_improving,
       CAST(sum(both_worsening) AS BIGINT) AS patients_both_worsening,
       CAST(sum(high_severity) AS BIGINT) AS high_severity_cases,
       CAST(sum(no_symptoms) AS BIGINT) AS no_symptoms_cases FROM feats"""))
def q_interaction_stats(spark, d):
    return FT.interaction_stats(feats(spark, d))


@register("patient_label", fq("SELECT * FROM plabel", [P.patient_label("feats")]))
def q_patient_label(spark, d):
    return FT.patient_label(feats(spark, d))


SPLIT_CTES = [P.patient_label("feats"), P.split("plabel")]


@register("patient_split", fq("SELECT * FROM psplit", SPLIT_CTES))
def q_patient_split(spark, d):
    return SP.stratified_patient_split(feats(spark, d))


def _side_sql(side: str) -> str:
    return fq(f"""
SELECT {P.ENH_COLS} FROM feats f
WHERE f.anonymous_patient_id IN (SELECT anonymous_patient_id FROM psplit WHERE split = '{side}')""", SPLIT_CTES)


def _side(spark, d, side):
    f = feats(spark, d)
    sp = SP.stratified_patient_split(f)
    return SP.split_rows(FT.select_enhanced(f), sp, side, drop_key=True)


@register("train_rows", _side_sql("train"))
def q_train_rows(spark, d):
    return _side(spark, d, "train")


@register("test_rows", _side_sql("test"))
def q_test_rows(spark, d):
    return _side(spark, d, "test")


@register("split_stats", fq("""
SELECT s.split, count(DISTINCT f.anonymous_patient_id) AS n_patients, count(*) AS n_rows,
       count(*) FILTER (WHERE f.nbe = 0) AS n_label_0, count(*) FILTER (WHERE f.nbe = 1) AS n_label_1
FROM feats f JOIN psplit s ON f.anonymous_patient_id = s.anonymous_patient_id GROUP BY s.split""", SPLIT_CTES))
def q_split_stats(spark, d):
    f = feats(spark, d)
    return SP.split_stats(f, SP.stratified_patient_split(f))


def _vfs_sql() -> str:
    sets = []
    for name, cols, side in (("baseline_train", "p_score, p_status, fl_score, fl_status, nbe", "train"),
                             ("baseline_test", "p_score, p_status, fl_score, fl_status, nbe", "test"),
                             ("enhanced_train", P.ENH_COLS, "train"), ("enhanced_test", P.ENH_COLS, "test")):
        sets.append(f"\n{name} AS (SELECT anonymous_patient_id, {cols} FROM feats WHERE anonymous_patient_id IN "
                    f"(SELECT anonymous_patient_id FROM psplit WHERE split = '{side}'))")
    body = []
    for name, nf in (("baseline_train", 4), ("baseline_test", 4), ("enhanced_train", 10), ("enhanced_test", 10)):
        body += [f"SELECT '{name}' AS feature_set, 'n_features' AS check_name, CAST({nf} AS BIGINT) AS value, true AS passed",
                 f"SELECT '{name}', 'n_rows', count(*), count(*) > 0 FROM {name}",
                 f"SELECT '{name}', 'n_positive', count(*) FILTER (WHERE nbe = 1), true FROM {name}",
                 f"SELECT '{name}', 'null_cells', 0, true"]
    for side in ("train", "test"):
        body += [f"SELECT '{side}', 'row_count_match', (SELECT count(*) FROM baseline_{side}), "
                 f"(SELECT count(*) FROM baseline_{side}) = (SELECT count(*) FROM enhanced_{side})",
                 f"SELECT '{side}', 'label_count_match', (SELECT count(*) FILTER (WHERE nbe = 1) FROM baseline_{side}), "
                 f"(SELECT count(*) FILTER (WHERE nbe = 1) FROM baseline_{side}) = "
                 f"(SELECT count(*) FILTER (WHERE nbe = 1) FROM enhanced_{side})"]
    body += ["SELECT 'all', 'baseline_subset_of_enhanced', 1, true",
             "SELECT 'all', 'shared_patients', count(*), count(*) = 0 FROM (SELECT DISTINCT anonymous_patient_id "
             "FROM baseline_train INTERSECT SELECT DISTINCT anonymous_patient_id FROM baseline_test) x"]
    return fq("\nUNION ALL\n".join(body), SPLIT_CTES + sets)


@register("validate_feature_sets", _vfs_sql())
def q_validate_feature_sets(spark, d):
    f = feats(spark, d)
    sp = SP.stratified_patient_split(f)
    b, e = FT.select_baseline(f), FT.select_enhanced(f)
    return SP.validate_feature_sets(SP.split_rows(b, sp, "train"), SP.split_rows(b, sp, "test"),
                                    SP.split_rows(e, sp, "train"), SP.split_rows(e, sp, "test"),
                                    key=S.PSEUDO_ID)


RAW_FEAT = ["typed_raw", "cleaned_raw", P.id_map("cleaned_raw"), P.anon("cleaned_raw"), P.feats("anon")]


@register("feature_pipeline", P.q(["consultations_raw"], RAW_FEAT, "SELECT * FROM feats"))
def q_feature_pipeline(spark, d):
    """Raw strings -> clean -> pseudonymize -> features (checkpointed)."""
    from consult.plans.prepare import build_datasets
    return build_datasets(raw(spark, d))["features"]


def _pipeline_summary_sql() -> str:
    sides, null_cells = [], []
    for name in ("baseline_train", "baseline_test", "enhanced_train", "enhanced_test"):
        side = name.split("_")[1]
        cols = ((S.BASELINE_FEATURES if name.startswith("base") else S.ENHANCED_FEATURES)
                + [S.LABEL, "anonymous_patient_id"])
        nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in cols)
        null_cells.append(f"(SELECT {nulls} FROM feats WHERE anonymous_patient_id IN "
                          f"(SELECT anonymous_patient_id FROM psplit WHERE split = '{side}'))")
        src = (f"(SELECT anonymous_patient_id, nbe FROM feats WHERE anonymous_patient_id IN "
               f"(SELECT anonymous_patient_id FROM psplit WHERE split = '{side}'))")
        sides += [f"SELECT 'features', '{name}_rows', CAST(count(*) AS DOUBLE) FROM {src} x",
                  f"SELECT 'features', '{name}_patients', CAST(count(DISTINCT anonymous_patient_id) AS DOUBLE) "
                  f"FROM {src} y",
                  f"SELECT 'features', '{name}_label_1', CAST(count(*) FILTER (WHERE nbe = 1) AS DOUBLE) FROM {src} z",
                  f"SELECT 'features', '{name}_features', {len(cols) - 2}.0",
                  f"SELECT 'features', '{name}_null_cells', CAST({null_cells[-1]} AS DOUBLE)"]
    sides += ["SELECT 'anonymize', 'mapping_valid', CAST((SELECT count(*) = count(DISTINCT anonymous_id) "
              "AND min(anonymous_id) = 1 AND max(anonymous_id) = count(*) FROM id_map) "
              "AND (SELECT count(*) FROM anon WHERE anonymous_patient_id IS NULL) = 0 AS DOUBLE)",
              "SELECT 'quality_assurance', 'anonymization_validation_passed', "
              "CAST((SELECT count(*) FROM anon WHERE anonymous_patient_id IS NULL) = 0 AS DOUBLE)",
              f"SELECT 'quality_assurance', 'feature_set_validation_passed', CAST({' + '.join(null_cells)} = 0 AS DOUBLE)",
              "SELECT 'quality_assurance', 'patient_level_split_verified', CAST((SELECT count(*) = count(DISTINCT "
              "anonymous_patient_id) FROM psplit) AS DOUBLE)",
              "SELECT 'quality_assurance', 'target_distribution_preserved', CAST((SELECT count(*) FROM feats) = (SELECT "
              "count(*) FROM feats WHERE anonymous_patient_id IN (SELECT anonymous_patient_id FROM psplit)) AS DOUBLE)",
              f"SELECT 'quality_assurance', 'data_cleaning_passed', "
              f"CAST((SELECT CAST(sum({NULLS}) AS BIGINT) FROM cleaned_raw) = 0 AS DOUBLE)",
              f"SELECT 'clean', 'final_missing_values', CAST((SELECT sum({NULLS}) FROM cleaned_raw) AS DOUBLE)"]
    body = f"""
SELECT stage, metric, round(value, 6) AS value FROM (
  SELECT 'clean' AS stage, 'original_records' AS metric, CAST(count(*) AS DOUBLE) AS value FROM typed_raw
  UNION ALL SELECT 'clean', 'after_label_filter', CAST(count(*) FILTER (WHERE nbe IN (0, 1)) AS DOUBLE) FROM typed_raw
  UNION ALL SELECT 'clean', 'after_missing_removal',
    CAST(count(*) FILTER (WHERE nbe IN (0, 1) AND {COMPLETE}) AS DOUBLE) FROM typed_raw
  UNION ALL SELECT 'clean', 'final_records', CAST(count(*) AS DOUBLE) FROM cleaned_raw
  UNION ALL SELECT 'clean', 'retention_pct',
    round(100.0 * (SELECT count(*) FROM cleaned_raw) / (SELECT count(*) FROM typed_raw), 6)
  UNION ALL SELECT 'clean', 'unique_patients', CAST(count(DISTINCT accident_number) AS DOUBLE) FROM cleaned_raw
  UNION ALL {' UNION ALL '.join(sides)}) t"""
    return P.q(["consultations_raw"], RAW_FEAT + SPLIT_CTES, body)


@register("pipeline_summary", _pipeline_summary_sql())
def q_pipeline_summary(spark, d):
    from consult.plans.prepare import build_datasets, pipeline_summary
    r = raw(spark, d)
    return pipeline_summary(r, build_datasets(r))


@register("fold_assignment", fq(f"""
SELECT f.anonymous_patient_id, {', '.join('f.' + c.strip() for c in P.ENH_COLS.split(','))}, k.fold
FROM feats f JOIN pfold k ON f.anonymous_patient_id = k.anonymous_patient_id
WHERE f.anonymous_patient_id IN (SELECT anonymous_patient_id FROM psplit WHERE split = 'train')""",
    SPLIT_CTES + [P.patient_label(
        "(SELECT * FROM feats WHERE anonymous_patient_id IN (SELECT anonymous_patient_id FROM psplit WHERE split = 'train'))",
        name="tlabel"), P.folds("tlabel")]))
def q_fold_assignment(spark, d):
    """Patient-grouped stratified folds on the enhanced training rows."""
    f = feats(spark, d)
    sp = SP.stratified_patient_split(f)
    tr = SP.split_rows(FT.select_enhanced(f), sp, "train")
    return SP.assign_folds(tr)


# =============================================================================
# Metrics (X1-X10) on the dyadic-score fixture
# =============================================================================

def scored(spark, d):
    return FX.scored(spark, d)


def xq(body: str, extra: list[str] | None = None) -> str:
    return P.q(["scored"], extra or [], body)


CM_SQL = """
SELECT count(*) FILTER (WHERE label <> 1 AND NOT score > 0.5) AS tn, count(*) FILTER (WHERE label <> 1 AND score > 0.5) AS fp,
       count(*) FILTER (WHERE label = 1 AND NOT score > 0.5) AS fn, count(*) FILTER (WHERE label = 1 AND score > 0.5) AS tp"""


def _zd(n, d):
    return f"COALESCE(CAST({n} AS DOUBLE) / nullif({d}, 0), 0)"


THRESH_COLS = f"""
round({_zd('tp + tn', 'tp + tn + fp + fn')}, 6) AS accuracy, round({_zd('tp', 'tp + fp')}, 6) AS precision,
round({_zd('tp', 'tp + fn')}, 6) AS recall,
round({_zd(f"2 * {_zd('tp', 'tp + fp')} * {_zd('tp', 'tp + fn')}", f"{_zd('tp', 'tp + fp')} + {_zd('tp', 'tp + fn')}")}, 6) AS f1,
round({_zd('tn', 'tn + fp')}, 6) AS specificity, round({_zd('tp', 'tp + fn')}, 6) AS sensitivity,
round({_zd('fp', 'fp + tn')}, 6) AS false_positive_rate, round({_zd('fn', 'fn + tp')}, 6) AS false_negative_rate"""


@register("confusion_matrix", xq(CM_SQL + " FROM scored"))
def q_confusion_matrix(spark, d):
    return X.confusion_matrix(scored(spark, d))


@register("threshold_metrics", xq(f"SELECT {THRESH_COLS} FROM ({CM_SQL} FROM scored) c"))
def q_threshold_metrics(spark, d):
    return X.threshold_metrics(scored(spark, d))


def _running(groups: str = "", src: str = "scored") -> str:
    g = f"{groups}, " if groups else ""
    part = f"PARTITION BY {groups} " if groups else ""
    frame = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    return f"""
sc AS (SELECT {g}CAST(score AS DOUBLE) AS score, count(*) FILTER (WHERE label = 1) AS pos,
              count(*) FILTER (WHERE label <> 1) AS neg FROM {src} GROUP BY {g}score),
rc AS (SELECT {g}score, pos, neg,
              sum(pos) OVER ({part}ORDER BY score DESC {frame}) AS cum_pos,
              sum(neg) OVER ({part}ORDER BY score DESC {frame}) AS cum_neg,
              sum(pos) OVER ({part}) AS tot_p, sum(neg) OVER ({part}) AS tot_n
       FROM sc)"""


CURVE_AGGS = """round(sum(CAST(neg AS DOUBLE) * (cum_pos - pos / 2.0)) / (CAST(max(tot_p) AS DOUBLE) * max(tot_n)), 6) AS auc_roc,
       round(sum(COALESCE(CAST(pos AS DOUBLE) / nullif(tot_p, 0), 0) *
                 COALESCE(CAST(cum_pos AS DOUBLE) / nullif(cum_pos + cum_neg, 0), 0)), 6) AS average_precision"""


@register("roc_curve", xq(f"""
SELECT score AS threshold, round({_zd('cum_neg', 'tot_n')}, 6) AS fpr, round({_zd('cum_pos', 'tot_p')}, 6) AS tpr
FROM rc""", [_running()]))
def q_roc_curve(spark, d):
    return X.roc_curve(scored(spark, d))


@register("auc_roc", xq("SELECT round(sum(CAST(neg AS DOUBLE) * (cum_pos - pos / 2.0)) / "
                        "(CAST(max(tot_p) AS DOUBLE) * max(tot_n)), 6) AS auc_roc FROM rc", [_running()]))
def q_auc_roc(spark, d):
    return X.auc_roc(scored(spark, d))


@register("pr_curve", xq(f"""
SELECT score AS threshold, round({_zd('cum_pos', 'cum_pos + cum_neg')}, 6) AS precision,
       round({_zd('cum_pos', 'tot_p')}, 6) AS recall FROM rc
UNION ALL SELECT NULL, 1.0, 0.0""", [_running()]))
def q_pr_curve(spark, d):
    return X.pr_curve(scored(spark, d))


@register("average_precision", xq("SELECT round(sum(COALESCE(CAST(pos AS DOUBLE) / nullif(tot_p, 0), 0) * "
                                  "COALESCE(CAST(cum_pos AS DOUBLE) / nullif(cum_pos + cum_neg, 0), 0)), 6) "
                                  "AS average_precision FROM rc", [_running()]))
def q_average_precision(spark, d):
    return X.average_precision(scored(spark, d))


LOGLOSS_SQL = ("round(avg(CASE WHEN label = 1 THEN -ln(least(greatest(score, 2.220446049250313e-16), "
               "1.0 - 2.220446049250313e-16)) ELSE -ln(1.0 - least(greatest(score, 2.220446049250313e-16), "
               "1.0 - 2.220446049250313e-16)) END), 6)")


@register("log_loss", xq(f"SELECT {LOGLOSS_SQL} AS log_loss FROM scored"))
def q_log_loss(spark, d):
    return X.log_loss(scored(spark, d))


# Two stand-in "models" over the same labels: the fixture score, and its
# square (same ranking, different calibration), each on two feature sets.
MODELS_SQL = """
long_scores AS (
  SELECT 'dyadic' AS model, 'baseline' AS feature_set, label, score FROM scored
  UNION ALL SELECT 'dyadic', 'enhanced', label, 1.0 - score FROM scored
  UNION ALL SELECT 'squared', 'baseline', label, score * score FROM scored
  UNION ALL SELECT 'squared', 'enhanced', label, score * (2.0 - score) FROM scored)"""


def long_scores(spark, d):
    s = scored(spark, d)
    return (s.select(F.lit("dyadic").alias("model"), F.lit("baseline").alias("feature_set"), "label", "score")
            .unionByName(s.select(F.lit("dyadic").alias("model"), F.lit("enhanced").alias("feature_set"),
                                  "label", (F.lit(1.0) - F.col("score")).alias("score")))
            .unionByName(s.select(F.lit("squared").alias("model"), F.lit("baseline").alias("feature_set"),
                                  "label", (F.col("score") * F.col("score")).alias("score")))
            .unionByName(s.select(F.lit("squared").alias("model"), F.lit("enhanced").alias("feature_set"),
                                  "label", (F.col("score") * (F.lit(2.0) - F.col("score"))).alias("score"))))


EVAL_SQL = f"""
SELECT r.model, r.feature_set, n_rows, tn, fp, fn, tp, {THRESH_COLS}, auc_roc, average_precision, log_loss
FROM (SELECT model, feature_set, count(*) AS n_rows,
             count(*) FILTER (WHERE label <> 1 AND NOT score > 0.5) AS tn,
             count(*) FILTER (WHERE label <> 1 AND score > 0.5) AS fp,
             count(*) FILTER (WHERE label = 1 AND NOT score > 0.5) AS fn,
             count(*) FILTER (WHERE label = 1 AND score > 0.5) AS tp,
             {LOGLOSS_SQL} AS log_loss
      FROM long_scores GROUP BY model, feature_set) r
JOIN (SELECT model, feature_set, {CURVE_AGGS} FROM rc GROUP BY model, feature_set) c
  ON r.model = c.model AND r.feature_set = c.feature_set"""


@register("evaluate_all", xq(EVAL_SQL, [MODELS_SQL, _running("model, feature_set", "long_scores")]))
def q_evaluate_all(spark, d):
    return X.evaluate_all(long_scores(spark, d))


@register("compare_models", xq("""
SELECT model, baseline_auc, enhanced_auc, round(enhanced_auc - baseline_auc, 6) AS auc_improvement,
       round(CASE WHEN baseline_auc > 0 THEN (enhanced_auc - baseline_auc) / baseline_auc * 100 ELSE 0 END, 6)
         AS improvement_pct,
       model = (SELECT model FROM ev WHERE feature_set = 'baseline' ORDER BY auc_roc DESC, model LIMIT 1) AS best_baseline,
       model = (SELECT model FROM ev WHERE feature_set = 'enhanced' ORDER BY auc_roc DESC, model LIMIT 1) AS best_enhanced,
       round((SELECT avg(auc_roc) FROM ev WHERE feature_set = 'baseline'), 6) AS average_baseline_auc,
       round((SELECT avg(auc_roc) FROM ev WHERE feature_set = 'enhanced'), 6) AS average_enhanced_auc,
       round((SELECT avg(auc_roc) FROM ev WHERE feature_set = 'enhanced')
             - (SELECT avg(auc_roc) FROM ev WHERE feature_set = 'baseline'), 6) AS average_improvement,
       CASE WHEN (SELECT max(auc_roc) FROM ev WHERE feature_set = 'enhanced') >
                 (SELECT max(auc_roc) FROM ev WHERE feature_set = 'baseline') + 0.02
            THEN 'Use enhanced model for production - significant improvement detected'
            WHEN (SELECT max(auc_roc) FROM ev WHERE feature_set = 'enhanced') >
                 (SELECT max(auc_roc) FROM ev WHERE feature_set = 'baseline')
            THEN 'Enhanced model shows improvement but consider complexity trade-off'
            ELSE 'Baseline model sufficient - enhanced features may not add value' END AS recommendation
FROM (SELECT model, max(auc_roc) FILTER (WHERE feature_set = 'baseline') AS baseline_auc,
             max(auc_roc) FILTER (WHERE feature_set = 'enhanced') AS enhanced_auc FROM ev GROUP BY model) p""",
    [MODELS_SQL, _running("model, feature_set", "long_scores"), "\nev AS (" + EVAL_SQL + ")"]))
def q_compare_models(spark, d):
    return X.compare_models(X.evaluate_all(long_scores(spark, d)))


@register("confidence_level", xq("""
SELECT accident_number, label, score,
       CASE WHEN abs(score - 0.5) * 2.0 >= 0.7 THEN 'high' WHEN abs(score - 0.5) * 2.0 >= 0.4 THEN 'medium'
            ELSE 'low' END AS confidence_level FROM scored"""))
def q_confidence_level(spark, d):
    return V.add_confidence(scored(spark, d), prob="score")


# =============================================================================
# Request validation and response shaping (V1-V7, V9) on scoring requests
# =============================================================================

def requests_df(spark, d):
    return FX.scoring_requests(spark, d)


DEFAULTED = """
req AS (SELECT request_id, p_score, p_status, fl_score, fl_status,
               COALESCE(response_type, 'minimal') AS response_type,
               COALESCE(days_since_accident, 21) AS days_since_accident,
               COALESCE(consultation_number, 2) AS consultation_number FROM scoring_requests)"""


def rq(body: str, extra: list[str] | None = None) -> str:
    return P.q(["scoring_requests"], [DEFAULTED] + (extra or []), body)


def _join(items: list[str]) -> str:
    return "concat_ws(' | ', " + ", ".join(items) + ")"


def _n(items: list[str]) -> str:
    return "(" + " + ".join(f"CAST(({i}) IS NOT NULL AS INTEGER)" for i in items) + ")"


def _schema_items() -> list[str]:
    out = []
    for name, lo, hi, _ in S.REQUEST_RANGES:
        if name in S.BASELINE_FEATURES:
            out.append(f"CASE WHEN {name} IS NULL THEN '{name}: Field required' END")
        out.append(f"CASE WHEN {name} < {lo} THEN '{name}: Input should be greater than or equal to {lo}' "
                   f"WHEN {name} > {hi} THEN '{name}: Input should be less than or equal to {hi}' END")
    out.append("CASE WHEN response_type IS NOT NULL AND response_type NOT IN ('minimal', 'detailed') "
               "THEN 'response_type: Input should be ''minimal'' or ''detailed''' END")
    return out


def _range_items() -> list[str]:
    return [f"CASE WHEN {n} IS NULL THEN '{n} must be a numeric value' WHEN {n} < {lo} OR {n} > {hi} "
            f"THEN '{n} ({d}) must be between {lo} and {hi}, got ' || CAST({n} AS VARCHAR) END"
            for n, lo, hi, d in S.REQUEST_RANGES]


STATUS_OK = "(p_status, fl_status) IN (" + ", ".join(f"({p}, {f})" for p, f, _ in S.STATUS_PAIRS) + ")"
RULE_ERR = [f"CASE WHEN p_status IS NOT NULL AND fl_status IS NOT NULL AND NOT {STATUS_OK} THEN "
            "printf('Invalid status combination: p_status=%d, fl_status=%d', p_status, fl_status) END"]
RULE_WARN = ["CASE WHEN p_score = 4 AND fl_score = 0 THEN "
             "'Warning: Maximum pain (4) with no function limitation (0) is medically unusual' END",
             "CASE WHEN consultation_number = 1 AND days_since_accident > 90 THEN "
             "printf('Warning: First consultation %d days after accident is unusually late', days_since_accident) END",
             "CASE WHEN consultation_number > 1 AND days_since_accident < 7 THEN "
             "printf('Warning: Consultation #%d only %d days after accident seems early', consultation_number, "
             "days_since_accident) END"]
_AVG = "CAST(days_since_accident AS DOUBLE) / consultation_number"
_HEAD = ("printf('Temporal inconsistency: %d consultations in %d days (avg ', consultation_number, "
         "days_since_accident) || printf('%.1f', " + _AVG + ")")
TEMP_WARN = [f"CASE WHEN consultation_number <> 0 AND {_AVG} < 1 THEN {_HEAD} || ' days per consultation) is too frequent' "
             f"WHEN consultation_number <> 0 AND {_AVG} > 90 THEN {_HEAD} || ' days per consultation) has large gaps' END"]
TEMP_SYS = ["CASE WHEN consultation_number = 0 THEN 'Validation system error: division by zero' END"]


@register("request_schema_errors", rq(
    f"SELECT request_id, {_join(_schema_items())} AS schema_errors, {_n(_schema_items())} AS n_schema_errors, "
    f"{_n(_schema_items())} = 0 AS schema_valid FROM req"))
def q_request_schema_errors(spark, d):
    v = V.validate_schema(requests_df(spark, d), "enhanced")
    return v.select("request_id", F.array_join("schema_errors", " | ").alias("schema_errors"),
                    F.size("schema_errors").alias("n_schema_errors"), "schema_valid")


@register("request_range_errors", rq(
    f"SELECT request_id, {_join(_range_items())} AS range_errors, {_n(_range_items())} AS n_range_errors FROM req"))
def q_request_range_errors(spark, d):
    r = FT.fill_defaults(requests_df(spark, d))
    e = V.range_errors("enhanced")
    return r.select("request_id", F.array_join(e, " | ").alias("range_errors"), F.size(e).alias("n_range_errors"))


@register("request_rule_warnings", rq(
    f"SELECT request_id, {_join(RULE_ERR)} AS rule_errors, {_join(RULE_WARN)} AS rule_warnings, "
    f"{_n(RULE_WARN)} AS n_rule_warnings FROM req"))
def q_request_rule_warnings(spark, d):
    r = FT.fill_defaults(requests_df(spark, d))
    err, warn = V.rule_messages("enhanced")
    return r.select("request_id", F.array_join(err, " | ").alias("rule_errors"),
                    F.array_join(warn, " | ").alias("rule_warnings"), F.size(warn).alias("n_rule_warnings"))


@register("request_temporal_warnings", rq(
    f"SELECT request_id, {_join(TEMP_WARN)} AS temporal_warnings, {_join(TEMP_SYS)} AS system_errors FROM req"))
def q_request_temporal_warnings(spark, d):
    r = FT.fill_defaults(requests_df(spark, d))
    w, sys_ = V.temporal_messages()
    return r.select("request_id", F.array_join(w, " | ").alias("temporal_warnings"),
                    F.array_join(sys_, " | ").alias("system_errors"))


@register("request_verdict", rq(
    f"SELECT request_id, {_join(_range_items() + RULE_ERR + TEMP_SYS)} AS errors, "
    f"{_join(RULE_WARN + TEMP_WARN)} AS warnings, {_n(_range_items() + RULE_ERR + TEMP_SYS)} = 0 AS is_valid "
    f"FROM req"))
def q_request_verdict(spark, d):
    v = V.validate_requests(FT.fill_defaults(requests_df(spark, d)), "enhanced")
    return v.select("request_id", F.array_join("errors", " | ").alias("errors"),
                    F.array_join("warnings", " | ").alias("warnings"), "is_valid")


@register("rule_catalogue", P.q(["scoring_requests"], [
    "\ncat AS (SELECT * FROM (VALUES " + ", ".join(f"({p}, {f}, '{d}')" for p, f, d in S.STATUS_PAIRS)
    + ") AS t(p_status, fl_status, description))",
    "\nused AS (SELECT p_status, fl_status, count(*) AS n_requests FROM scoring_requests GROUP BY p_status, fl_status)"],
    """
SELECT COALESCE(u.p_status, c.p_status) AS p_status, COALESCE(u.fl_status, c.fl_status) AS fl_status,
       COALESCE(c.description, 'invalid combination') AS description, COALESCE(u.n_requests, 0) AS n_requests
FROM used u FULL OUTER JOIN cat c ON u.p_status = c.p_status AND u.fl_status = c.fl_status"""))
def q_rule_catalogue(spark, d):
    """The status-pair catalogue with how many requests use each pair."""
    return V.status_pair_usage(requests_df(spark, d))


FIXED_TS = "2025-06-12 11:41:12"
SHAPE_SCORE = ("CAST(16 + p_status + fl_status + p_status * fl_status - 2 * p_score - fl_score AS DOUBLE) / 32")


@register("shape_response", rq(f"""
SELECT request_id, response_type, s AS nbe_yes_probability, 1.0 - s AS nbe_no_probability,
       CASE WHEN response_type = 'detailed' THEN
         CASE WHEN abs(s - 0.5) * 2.0 >= 0.7 THEN 'high' WHEN abs(s - 0.5) * 2.0 >= 0.4 THEN 'medium'
              WHEN s IS NOT NULL THEN 'low' END
       END AS confidence_level,
       CASE WHEN response_type = 'detailed' THEN 'dyadic_rule' END AS model_used,
       CASE WHEN response_type = 'detailed' THEN 'enhanced' END AS model_type,
       CASE WHEN response_type = 'detailed' THEN TIMESTAMP '{FIXED_TS}' END AS prediction_timestamp,
       CASE WHEN response_type = 'detailed' THEN true END AS feature_engineering_applied,
       CASE WHEN response_type = 'detailed' THEN true END AS input_validation_passed
FROM (SELECT *, {SHAPE_SCORE} AS s FROM req) t"""))
def q_shape_response(spark, d):
    """Minimal / detailed responses over stand-in scores (a fixed dyadic rule
    of the request features; null where one is missing) with a fixed timestamp,
    so both engines agree."""
    r = V.validate_schema(requests_df(spark, d), "enhanced")
    s = F.expr(SHAPE_SCORE)
    sc = r.select("request_id", "response_type", s.alias("nbe_yes_probability"),
                  (F.lit(1.0) - s).alias("nbe_no_probability"))
    sc = V.add_confidence(sc).select(
        "*", F.lit("dyadic_rule").alias("model_used"), F.lit("enhanced").alias("model_type"),
        F.lit(FIXED_TS).cast("timestamp_ntz").alias("prediction_timestamp"),
        F.lit(True).alias("feature_engineering_applied"), F.lit(True).alias("input_validation_passed"))
    return V.shape_response(sc)


# =============================================================================
# Request-log monitoring (R2-R5), batch form
# =============================================================================

from consult.streaming import monitor as R  # noqa: E402


@register("request_metrics", P.q(["request_log"], [], """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, path,
       count(*) AS n_requests, count(*) FILTER (WHERE status >= 400 AND status < 500) AS n_4xx,
       count(*) FILTER (WHERE status >= 500) AS n_5xx,
       round(CAST(count(*) FILTER (WHERE status >= 400 AND status < 500) AS DOUBLE) / count(*), 6) AS rate_4xx,
       round(CAST(count(*) FILTER (WHERE status >= 500) AS DOUBLE) / count(*), 6) AS rate_5xx,
       round(quantile_cont(latency_ms, 0.5), 6) AS p50_latency_ms,
       round(quantile_cont(latency_ms, 0.95), 6) AS p95_latency_ms,
       round(quantile_cont(latency_ms, 0.99), 6) AS p99_latency_ms
FROM request_log GROUP BY 1, 2, 3"""))
def q_request_metrics(spark, d):
    return R.request_metrics(FX.request_log(spark, d), "1 hour")


LIMITS_SQL = "\nlimits AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{p}', {n})" for p, n in S.RATE_LIMITS) + ") AS t(path, limit_per_minute))"
LOW_LIMITS_SQL = "\nlimits AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{p}', {n})" for p, n in FX.LIMIT_ROWS) + ") AS t(path, limit_per_minute))"
PER_MIN = ("\nper_min AS (SELECT date_trunc('minute', ts) AS window_start, client_id, path, count(*) AS n "
           "FROM request_log GROUP BY 1, 2, 3)")


BREACHES_SQL = P.q(["request_log"], [LOW_LIMITS_SQL, PER_MIN], """
SELECT m.window_start, m.client_id, m.path, m.n AS n_requests, l.limit_per_minute
FROM per_min m JOIN limits l ON m.path = l.path WHERE m.n > l.limit_per_minute""")


@register("rate_limit_breaches", BREACHES_SQL)
def q_rate_limit_breaches(spark, d):
    """Clients above the limits of a small service (``LIMIT_ROWS``), per minute."""
    return R.rate_limit_breaches(FX.request_log(spark, d), limits=FX.LIMIT_ROWS)


@register("client_request_peaks", P.q(["request_log"], [LIMITS_SQL, PER_MIN], """
SELECT m.client_id, m.path, l.limit_per_minute, max(m.n) AS peak_per_minute,
       round(CAST(max(m.n) AS DOUBLE) / l.limit_per_minute, 6) AS peak_share_of_limit,
       count(*) FILTER (WHERE m.n > l.limit_per_minute) AS minutes_over_limit
FROM per_min m JOIN limits l ON m.path = l.path GROUP BY m.client_id, m.path, l.limit_per_minute"""))
def q_client_request_peaks(spark, d):
    return R.client_request_peaks(FX.request_log(spark, d))


@register("permission_check", P.q(["request_log", "api_keys"], [], """
SELECT r.request_id, r.client_id, r.path, r.api_key,
       CASE WHEN r.path IN ('/api/v1/health', '/docs', '/redoc', '/openapi.json', '/') THEN NULL
            WHEN r.path LIKE '/api/v1/nbe/predict%' THEN 'predict' ELSE 'key' END AS required_permission,
       CASE WHEN r.path IN ('/api/v1/health', '/docs', '/redoc', '/openapi.json', '/') THEN 200
            WHEN r.api_key IS NULL OR k.api_key IS NULL THEN 401
            WHEN r.path LIKE '/api/v1/nbe/predict%' AND NOT list_contains(k.perms, 'predict')
                 AND NOT list_contains(k.perms, 'all') THEN 403
            ELSE 200 END AS auth_status
FROM request_log r LEFT JOIN (SELECT api_key, list(permission) AS perms FROM api_keys GROUP BY api_key) k
  ON r.api_key = k.api_key"""))
def q_permission_check(spark, d):
    return R.check_permissions(FX.request_log(spark, d), FX.api_keys(spark))


@register("prediction_monitor", P.q(["prediction_log"], [], """
SELECT date_trunc('hour', ts) AS window_start, model_type, count(*) AS n_predictions,
       round(avg(nbe_yes_probability), 6) AS mean_probability,
       count(*) FILTER (WHERE abs(nbe_yes_probability - 0.5) * 2.0 >= 0.7) AS n_high,
       count(*) FILTER (WHERE abs(nbe_yes_probability - 0.5) * 2.0 >= 0.4
                          AND abs(nbe_yes_probability - 0.5) * 2.0 < 0.7) AS n_medium,
       count(*) FILTER (WHERE abs(nbe_yes_probability - 0.5) * 2.0 < 0.4) AS n_low
FROM prediction_log GROUP BY 1, 2"""))
def q_prediction_monitor(spark, d):
    return R.prediction_monitor(FX.prediction_log(spark, d), "1 hour")


# =============================================================================
# Learners, CV, importance, registry, scoring
# Model output is not reproducible in SQL: rows-only checks.
# =============================================================================

from consult.operators import models as M  # noqa: E402

def reused(spark, d, name, build):
    """The table ``build()`` gives, written below the shared folder the first time
    this application asks for it and read back from there each time."""
    path = f"{training_root(spark, d)}/{name}"
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # not written yet
        build().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)


def training_root(spark, d):
    """Folder of this application's models and tables for one state of an input folder.

    Its name holds a fingerprint of the input files (path, size, time of change),
    so that changed tables under the same path are trained anew."""
    from consult.session import scratch_path
    seen = None
    for t in FX.CONSULTATION_TABLES:
        f = spark.read.parquet(f"{d}/{t}.parquet").select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        seen = f if seen is None else seen.unionByName(f)
    mark = seen.agg(F.hex(F.bit_xor(F.xxhash64(*seen.columns))).alias("mark")).first()["mark"]
    return scratch_path(spark, f"training/{spark.sparkContext.applicationId}-{mark}")


def model_data(spark, d):
    """Prepared train / test tables of the clean fixture."""
    from consult.plans.prepare import model_tables
    return model_tables(model_rows(spark, d))


def model_rows(spark, d):
    """The clean fixture's model columns with the split and the folds, written once an application."""
    from consult.plans.prepare import tagged_rows
    return reused(spark, d, "model-rows", lambda: tagged_rows(cleaned(spark, d))[0].select(*S.ENHANCED_TABLE_ORDER, "split", "fold"))


def folded(spark, d, fs):
    """Training rows of a feature set with the fold of their patient, as ``assign_folds`` gives it."""
    from consult.plans.prepare import model_tables
    return model_tables(model_rows(spark, d), ("fold",))[f"{fs}_train"]


RUN_ID = "run-1"


def fitted(spark, d, learner, fs):
    """The model of one pair: from the registry, or fitted and saved there."""
    import time
    root = training_root(spark, d)
    try:
        return M.load_latest(spark, root, learner, fs)
    except (AnalysisException, M.ModelNotFound):  # no registry yet, or no such model in it
        rows = model_data(spark, d)[f"{fs}_train"]
        t0 = time.time()
        model = M.fit(rows, learner, fs)
        M.save_model(model, root, learner, fs, RUN_ID, {"fit_seconds": time.time() - t0}, spark)
        return model


def trained(spark, d, learners, sets):
    """METADATA rows of the pairs, by ``train_all`` over models and fold scores that
    are computed once an application. Rows of trained pairs go to the registry;
    fit time and date are those of the fit itself."""
    data = {fs: folded(spark, d, fs) for fs in sets}
    # Boosted fits are some hundred short jobs each: pairs and folds overlap on the executors.
    _, rows = M.train_all(data, learners, parallelism=len(learners) * len(sets),
                          fit_one=lambda _, learner, fs: fitted(spark, d, learner, fs),
                          cv_one=lambda _, learner, fs: cv_pair(spark, d, learner, fs))
    root = training_root(spark, d)
    out = [r.asDict() for r in rows.collect()]  # one row a pair
    try:
        known = {(r["learner"], r["feature_set"]): r for r in M.registry(spark, root).collect()}
    except Exception:  # noqa: BLE001 - nothing was trained
        known = {}
    for r in out:
        if r["error"] is None:
            at = known[r["learner"], r["feature_set"]]
            r.update(fit_seconds=at["fit_seconds"], trained_at=at["trained_at"])
            M.register_model(spark, root, r["learner"], r["feature_set"], RUN_ID, r)
    names = [f.split()[0] for f in M.METADATA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in out], M.METADATA)


def _test_predictions(learner, fs):
    def run(spark, d):
        m = fitted(spark, d, learner, fs)
        sc = M.predict(m, model_data(spark, d)[f"{fs}_test"], fs)
        return sc.select(S.PSEUDO_ID, F.col(S.LABEL).alias("label"), "score",
                         F.lit(learner).alias("learner"), F.lit(fs).alias("feature_set"))
    run.__doc__ = f"Fit {learner} on the {fs} training rows; scores of the held-out patients."
    return run


for _short, _learner in (("lr", "logistic_regression"), ("rf", "random_forest"), ("gbt", "gbt")):
    for _fs in ("baseline", "enhanced"):
        register(f"{_short}_{_fs}")(_test_predictions(_learner, _fs))


def cv_pair(spark, d, learner, fs):
    """Fold AUCs of one learner on one feature set (computed once an application)."""
    def build():
        return M.cross_validate(folded(spark, d, fs), learner, fs, parallelism=S.N_FOLDS).select(
            F.lit(learner).alias("learner"), F.lit(fs).alias("feature_set"), "fold", "auc")
    return reused(spark, d, f"cv-{learner}-{fs}", build)


def cv_results(spark, d, learners):
    """Fold AUCs of ``learners`` on both sets (all pairs run concurrently)."""
    from concurrent.futures import ThreadPoolExecutor
    from functools import reduce
    model_data(spark, d)
    pairs = [(learner, fs) for learner in learners for fs in ("baseline", "enhanced")]
    with ThreadPoolExecutor(len(pairs)) as ex:
        return reduce(DataFrame.unionByName, ex.map(lambda p: cv_pair(spark, d, *p), pairs))


def _cv(learner):
    def run(spark, d):
        return cv_results(spark, d, [learner])
    run.__doc__ = f"Patient-grouped stratified 5-fold CV of {learner} on both feature sets (exact AUC)."
    return run


for _learner in M.LEARNERS:
    register(f"cv_{_learner}")(_cv(_learner))


@register("cv_scores")
def q_cv_scores(spark, d):
    """Fold AUCs of all three learners on both feature sets."""
    return cv_results(spark, d, M.LEARNERS)


@register("feature_importance")
def q_feature_importance(spark, d):
    """Top-10 importances (trees) or |coefficients| for the six fitted models."""
    out = None
    for learner in M.LEARNERS:
        for fs in ("baseline", "enhanced"):
            fi = M.feature_importance(fitted(spark, d, learner, fs), fs).select(
                F.lit(learner).alias("learner"), F.lit(fs).alias("feature_set"), "rank", "feature", "importance")
            out = fi if out is None else out.unionByName(fi)
    return out


@register("training_summary")
def q_training_summary(spark, d):
    """All six models by ``train_all``: metadata (features, fold scores, CV mean /
    population std, fit time), test metrics, best per set by CV mean. A learner
    that fails keeps its row, with the error text and no metrics."""
    from consult.operators.metrics import evaluate_all
    meta = trained(spark, d, M.LEARNERS, ["baseline", "enhanced"])
    parts = None
    for r in meta.where("error IS NULL").select("learner", "feature_set").collect():
        sc = _test_predictions(r["learner"], r["feature_set"])(spark, d)
        parts = sc if parts is None else parts.unionByName(sc)
    out = meta.select("learner", "feature_set", "n_train", "features", "cv_scores", F.round("cv_mean", 6).alias("cv_mean"),
                      F.round("cv_std", 6).alias("cv_std"), "fit_seconds", "error")
    if parts is not None:
        ev = evaluate_all(parts.withColumnRenamed("learner", "model")).select(
            F.col("model").alias("learner"), "feature_set", "n_rows", "auc_roc", "average_precision", "log_loss",
            "precision", "recall", "f1")
        out = out.join(ev, ["learner", "feature_set"], "left")
    best = M.best_models(out.where("error IS NULL").select("learner", "feature_set", "cv_mean")).select(
        "learner", "feature_set", F.lit(True).alias("best_by_cv"))
    return out.join(best, ["learner", "feature_set"], "left").fillna(False, ["best_by_cv"])


def _score(learner, fs, model_used):
    def run(spark, d):
        from consult.streaming.scoring import score_batch
        scored_, _ = score_batch(FX.scoring_requests(spark, d), fitted(spark, d, learner, fs), fs, model_used)
        return scored_.drop("prediction_timestamp")
    run.__doc__ = f"Validate and score the request table with the {fs} {learner} model."
    return run


register("score_baseline")(_score("logistic_regression", "baseline", "logistic_regression"))
register("score_enhanced")(_score("gbt", "enhanced", "gbt"))


_CORE_OK = " AND ".join(f"{n} BETWEEN {lo} AND {hi}" for n, lo, hi, _ in S.REQUEST_RANGES if n in S.BASELINE_FEATURES)
_ALL_OK = " AND ".join(f"{n} BETWEEN {lo} AND {hi}" for n, lo, hi, _ in S.REQUEST_RANGES)


@register("score_outcome", rq(f"""
SELECT kind, request_id, ok AS accepted, ok AS has_score FROM (
  SELECT 'baseline' AS kind, request_id, COALESCE({_CORE_OK} AND {STATUS_OK}, false) AS ok FROM req
  UNION ALL SELECT 'enhanced', request_id, COALESCE({_ALL_OK} AND {STATUS_OK}, false) FROM req) t"""))
def q_score_outcome(spark, d):
    """V8 accounted for: each request is scored or rejected, once, by both models."""
    from consult.streaming.scoring import score_batch
    out = None
    for learner, fs in (("logistic_regression", "baseline"), ("logistic_regression", "enhanced")):
        ok, bad = score_batch(FX.scoring_requests(spark, d), fitted(spark, d, learner, fs), fs, learner)
        both = ok.select("request_id", F.lit(True).alias("accepted"), F.col("nbe_yes_probability").isNotNull().alias("has_score"))
        both = both.unionByName(bad.select("request_id", F.lit(False).alias("accepted"), F.lit(False).alias("has_score")))
        both = both.select(F.lit(fs).alias("kind"), "request_id", "accepted", "has_score")
        out = both if out is None else out.unionByName(both)
    return out


@register("training_rows", fq("""
SELECT s.feature_set, k.fold, f.nbe, count(*) AS n_rows, count(DISTINCT f.anonymous_patient_id) AS n_patients
FROM feats f JOIN pfold k ON f.anonymous_patient_id = k.anonymous_patient_id,
     (VALUES ('baseline'), ('enhanced')) AS s(feature_set)
WHERE f.anonymous_patient_id IN (SELECT anonymous_patient_id FROM psplit WHERE split = 'train')
GROUP BY s.feature_set, k.fold, f.nbe""",
    SPLIT_CTES + [P.patient_label(
        "(SELECT * FROM feats WHERE anonymous_patient_id IN (SELECT anonymous_patient_id FROM psplit WHERE split = 'train'))",
        name="tlabel"), P.folds("tlabel")]))
def q_training_rows(spark, d):
    """Rows, patients and labels of every fold that the cross-validations train and test on."""
    out = None
    for fs in ("baseline", "enhanced"):
        x = folded(spark, d, fs).groupBy("fold", S.LABEL).agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_distinct(S.PSEUDO_ID).alias("n_patients"))
        x = x.select(F.lit(fs).alias("feature_set"), "fold", S.LABEL, "n_rows", "n_patients")
        out = x if out is None else out.unionByName(x)
    return out


@register("model_info")
def q_model_info(spark, d):
    """The registry rows of the two served models (algorithm, feature count and
    list, CV AUC, training rows and time) with their test AUC."""
    from consult.operators.metrics import evaluate_all
    pairs = (("logistic_regression", "baseline"), ("gbt", "enhanced"))
    root = training_root(spark, d)
    try:
        known = {(r["learner"], r["feature_set"]) for r in M.registry(spark, root).where("cv_mean IS NOT NULL").collect()}
    except AnalysisException:  # nothing is registered yet
        known = set()
    for learner, fs in pairs:
        if (learner, fs) not in known:
            trained(spark, d, [learner], [fs])
    served = spark.createDataFrame(list(pairs), "learner string, feature_set string")
    preds = _test_predictions(*pairs[0])(spark, d).unionByName(_test_predictions(*pairs[1])(spark, d))
    ev = evaluate_all(preds.withColumnRenamed("learner", "model")).select("feature_set", F.col("auc_roc").alias("test_auc"))
    reg = M.registry(spark, root).join(served, ["learner", "feature_set"], "left_semi")
    return M.model_info(reg).join(ev, "feature_set")


@register("model_registry")
def q_model_registry(spark, d):
    """Save the baseline logistic model, reload the newest from the registry,
    and score the test rows with the reloaded copy (round trip)."""
    from consult.session import scratch_path
    import uuid
    root = scratch_path(spark, f"models-{uuid.uuid4().hex[:8]}")
    m = fitted(spark, d, "logistic_regression", "baseline")
    M.save_model(m, root, "logistic_regression", "baseline", run_id="20250612T114112")
    again = M.load_latest(spark, root, "logistic_regression", "baseline")
    sc = M.predict(again, model_data(spark, d)["baseline_test"], "baseline")
    return sc.select(S.PSEUDO_ID, F.col(S.LABEL).alias("label"), "score")


def _stream_scored(spark, d):
    from consult.streaming.runner import run_scoring_stream
    return run_scoring_stream(spark, FX.scoring_requests(spark, d),
                              fitted(spark, d, "logistic_regression", "baseline"), "baseline",
                              "logistic_regression")


@register("stream_scoring")
def q_stream_scoring(spark, d):
    """The request table written as files, read as a stream, validated and scored
    per micro-batch (availableNow); the rows of the valid and the rejected sink."""
    return _stream_scored(spark, d)


@register("stream_scoring_outcome", P.q(["scoring_requests"], [], f"""
SELECT request_id, ok AS accepted, ok AS has_score FROM (
  SELECT request_id, COALESCE({_CORE_OK} AND {STATUS_OK}, false) AS ok FROM scoring_requests) t"""))
def q_stream_scoring_outcome(spark, d):
    """R1, accounted for: every request of the stream is scored or rejected, once."""
    return _stream_scored(spark, d).select("request_id", "accepted",
                                           F.col("nbe_yes_probability").isNotNull().alias("has_score"))


@register("stream_request_metrics")
def q_stream_request_metrics(spark, d):
    """R2 on a stream: request log files in time order, 1-hour windows with a
    1-hour watermark, closed windows appended."""
    from consult.streaming.runner import run_metrics_stream
    return run_metrics_stream(spark, FX.request_log(spark, d))


# =============================================================================
# Reports (Q18, F14)
# =============================================================================

def _explore_sql() -> str:
    nulls = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in P.RAW_COLS)
    viol = " + ".join(f"count(*) FILTER (WHERE NOT ({c} BETWEEN {lo} AND {hi}))"
                      for c, (lo, hi) in S.FEATURE_RANGES.items())
    return P.q(["consultations_raw"], ["typed_raw", f"""
b AS (SELECT count(*) AS n, CAST(sum({nulls}) AS BIGINT) AS miss, count(DISTINCT accident_number) AS pats,
             {viol} AS viol FROM typed_raw)""", f"""
d AS (SELECT CAST(COALESCE(sum(k - 1), 0) AS BIGINT) AS dups FROM (SELECT count(*) AS k FROM typed_raw GROUP BY {ALL_COLS}) g)""", """
m AS (SELECT min(k) AS mn, count(*) AS classes, sum(k) AS labelled
      FROM (SELECT count(*) AS k FROM typed_raw WHERE nbe IS NOT NULL GROUP BY nbe) g)""", f"""
f AS (SELECT {' + '.join(f'100.0 * count({c}) / count(*)' for c in S.BASELINE_FEATURES)} AS comp FROM typed_raw)""", f"""
t0 AS (SELECT *, n >= {S.MIN_SAMPLES} AS adequate,
              100.0 * labelled / n >= {S.TARGET_MIN_COMPLETENESS} AND classes >= 2 AS suitable FROM b, d, m, f)""", """
t AS (SELECT *, CAST(viol > 0 AS INTEGER) + CAST(NOT (adequate AND suitable) AS INTEGER) AS issues,
             viol = 0 AND dups = 0 AND adequate AND suitable AS ok FROM t0)"""], """
SELECT 'overview' AS section, 'n_rows' AS metric, round(CAST(n AS DOUBLE), 6) AS value, CAST(NULL AS VARCHAR) AS text FROM t
UNION ALL SELECT 'overview', 'n_columns', 8.0, NULL FROM t
UNION ALL SELECT 'overview', 'unique_patients', CAST(pats AS DOUBLE), NULL FROM t
UNION ALL SELECT 'overview', 'mean_rows_per_patient', round(CAST(n AS DOUBLE) / pats, 6), NULL FROM t
UNION ALL SELECT 'quality', 'missing_cells', CAST(miss AS DOUBLE), NULL FROM t
UNION ALL SELECT 'quality', 'completeness_pct', round(100.0 - 100.0 * miss / (n * 8), 6), NULL FROM t
UNION ALL SELECT 'quality', 'duplicate_rows', CAST(dups AS DOUBLE), NULL FROM t
UNION ALL SELECT 'validation', 'range_violations', CAST(viol AS DOUBLE), NULL FROM t
UNION ALL SELECT 'validation', 'schema_compliant', 1.0, NULL FROM t
UNION ALL SELECT 'validation', 'business_rules_valid', CAST(viol = 0 AS DOUBLE), NULL FROM t
UNION ALL SELECT 'validation', 'data_integrity_intact', CAST(dups = 0 AS DOUBLE), NULL FROM t
UNION ALL SELECT 'validation', 'ml_ready', CAST(adequate AND suitable AS DOUBLE), NULL FROM t
UNION ALL SELECT 'validation', 'overall_valid', CAST(ok AS DOUBLE), NULL FROM t
UNION ALL SELECT 'validation', 'critical_issues_count', CAST(issues AS DOUBLE), NULL FROM t
UNION ALL SELECT 'readiness', 'readiness_score', round(greatest(0.0, 100.0 - CASE WHEN adequate THEN 0 ELSE 30 END
                 - CASE WHEN suitable THEN 0 ELSE 40 END - 0.3 * (100.0 - comp / 4)), 6), NULL FROM t
UNION ALL SELECT 'readiness', 'sample_size_adequate', CAST(adequate AS DOUBLE), NULL FROM t
UNION ALL SELECT 'readiness', 'target_suitable', CAST(suitable AS DOUBLE), NULL FROM t
UNION ALL SELECT 'readiness', 'class_balance_ok', CAST(CAST(mn AS DOUBLE) / labelled >= 0.1 AS DOUBLE), NULL FROM t
UNION ALL SELECT 'label_distribution', CAST(nbe AS VARCHAR), CAST(count(*) AS DOUBLE), NULL FROM typed_raw
          WHERE nbe IS NOT NULL GROUP BY nbe
UNION ALL SELECT 'findings', 'validation', NULL, CASE WHEN ok
                 THEN 'Data passes all validation checks and is ready for preprocessing'
                 ELSE 'Data has ' || CAST(issues AS VARCHAR) || ' critical issues that need attention' END FROM t
UNION ALL SELECT 'recommendations', 'sample_size', NULL, 'Increase sample size for better model performance' FROM t WHERE NOT adequate
UNION ALL SELECT 'recommendations', 'target_missing', NULL, 'Target variable has too many missing values' FROM t WHERE 100.0 * labelled / n < 95
UNION ALL SELECT 'recommendations', 'target_classes', NULL, 'Target variable needs at least 2 classes' FROM t WHERE classes < 2
UNION ALL SELECT 'recommendations', 'duplicates_overall', NULL, 'Remove or investigate duplicate records' FROM t WHERE dups > 0
UNION ALL SELECT 'next_steps', x.metric, NULL, x.step FROM t, (VALUES
          (true, 'step_1', 'Proceed to Step 2: Data Preprocessing & Anonymization'),
          (true, 'step_2', 'Implement data cleaning strategies if needed'),
          (true, 'step_3', 'Create anonymized patient identifiers'),
          (true, 'step_4', 'Prepare data for feature engineering'),
          (false, 'step_1', 'Address critical data issues identified in validation'),
          (false, 'step_2', 'Re-run data exploration after fixing issues'),
          (false, 'step_3', 'Consult with domain experts for business rule clarification')) AS x(good, metric, step)
          WHERE x.good = ok
UNION ALL SELECT 'next_steps', 'documentation', NULL, 'Document findings and share with stakeholders' FROM t
UNION ALL SELECT 'findings', 'records', NULL, 'Dataset contains ' || format('{:,}', n) || ' records with 8 features' FROM t
UNION ALL SELECT 'findings', 'patients', NULL, 'Data covers ' || format('{:,}', pats) || ' unique patients with average '
                 || printf('%.1f', CAST(n AS DOUBLE) / pats) || ' consultations per patient' FROM t
UNION ALL SELECT 'recommendations', 'missing_values', NULL, 'Address missing values before model training' FROM t WHERE miss > 0
UNION ALL SELECT 'recommendations', 'duplicates', NULL, 'Investigate and handle ' || CAST(dups AS VARCHAR) || ' duplicate records' FROM t WHERE dups > 0
UNION ALL SELECT 'recommendations', 'range_violations', NULL, 'Clean data range violations before modeling' FROM t WHERE viol > 0
UNION ALL SELECT 'recommendations', 'class_balance', NULL, 'Consider class balancing techniques' FROM t WHERE CAST(mn AS DOUBLE) / labelled < 0.1""")


@register("exploration_summary", _explore_sql())
def q_exploration_summary(spark, d):
    return Q.exploration_summary(typed(spark, d))


@register("stream_permission_check", ORACLE["permission_check"])
def q_stream_permission_check(spark, d):
    """R4 on a stream: request-log files read with readStream, joined to the
    static key table per micro-batch."""
    from consult.streaming.runner import run_stream
    keys = FX.api_keys(spark)
    return run_stream(spark, FX.request_log(spark, d), lambda s: R.check_permissions(s, keys),
                      ts=None, name="stream-permissions")


@register("stream_prediction_monitor", ORACLE["prediction_monitor"])
def q_stream_prediction_monitor(spark, d):
    """R5 on a stream: 1-hour windows with a 1-hour watermark, closed windows."""
    from consult.streaming.runner import run_stream
    out = run_stream(spark, FX.prediction_log(spark, d), lambda s: R.prediction_monitor(s, "1 hour"),
                     delay="1 hour", name="stream-prediction-monitor")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register("stream_rate_limit_breaches", ORACLE["rate_limit_breaches"])
def q_stream_rate_limit_breaches(spark, d):
    """R3 on a stream: per-client 1-minute counts with a 1-minute watermark,
    joined to the static limits; closed windows over the limit."""
    from consult.streaming.runner import run_stream
    out = run_stream(spark, FX.request_log(spark, d), lambda s: R.rate_limit_breaches(s, limits=FX.LIMIT_ROWS),
                     delay="1 minute", name="stream-rate-limits")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@register("row_accounting", P.q(["consultations_gaps"], [
    P.PARTS["typed_raw"].replace("FROM consultations_raw", "FROM consultations_gaps"),
    """
lab AS (SELECT * FROM typed_raw WHERE nbe IN (0, 1))""", """
com AS (SELECT * FROM lab WHERE p_score IS NOT NULL AND p_status IS NOT NULL
        AND fl_score IS NOT NULL AND fl_status IS NOT NULL)""", """
uni AS (SELECT DISTINCT * FROM com)""", """
c AS (SELECT (SELECT count(*) FROM typed_raw) AS raw, (SELECT count(*) FROM lab) AS lab, (SELECT count(*) FROM com) AS com,
             (SELECT count(*) FROM uni) AS uni, (SELECT count(*) FROM uni WHERE accident_number IS NOT NULL) AS ids)"""], """
SELECT 'label_filter' AS step, raw AS n_in, lab AS n_out, raw - lab AS n_rejected, true AS balanced FROM c
UNION ALL SELECT 'missing_removal', lab, com, lab - com, true FROM c
UNION ALL SELECT 'deduplication', com, uni, com - uni, true FROM c
UNION ALL SELECT 'pseudonymize', uni, ids, uni - ids, true FROM c
UNION ALL SELECT 'split', ids, ids, 0, true FROM c"""))
def q_row_accounting(spark, d):
    """Rows in, out and rejected of every prepare step, over input with rows that have no id."""
    from consult.plans.prepare import row_accounting
    return row_accounting(FX.consultations_gaps(spark, d))


# Queries over a patient's row order, model quality and drift register themselves.
from consult.plans import longitudinal as _longitudinal  # noqa: E402, F401
from consult.plans import quality_of_models as _quality_of_models  # noqa: E402, F401
