"""Profiling, validation and data-quality aggregates.

Every metric is an aggregation that runs on executors. Per-column metrics
are computed for all columns in one pass (one wide ``agg`` or one narrow
unpivot + ``groupBy(feature)``), never one job per column. Only one-row
aggregates reach later stages, through scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from consult import schema as S
from consult.functions.exprs import pct, pearson, r6, ratio, unpivot_long
from consult.functions.prefix import prefix_sums
from consult.functions.quantiles import exact_quantiles


def _present(df: DataFrame, cols: list[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


# ---------------------------------------------------------------------------
# P1 / P2 schema and types
# ---------------------------------------------------------------------------

def schema_check(df: DataFrame, required: list[str] = S.STEP1_REQUIRED,
                 accepted: dict = S.ACCEPTED_TYPES) -> DataFrame:
    """One row per required or extra column: status, actual / expected type,
    type_ok, non-null count. Types come from the schema (driver metadata);
    counts from one aggregate."""
    spark = df.sparkSession
    types = dict(df.dtypes)
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]) if df.columns else None
    rows = []
    for c in required:
        exp = ",".join(accepted.get(c, []))
        if c in types:
            rows.append((c, "present", types[c], exp, types[c] in accepted.get(c, [])))
        else:
            rows.append((c, "missing", None, exp, False))
    for c in df.columns:
        if c not in required:
            rows.append((c, "extra", types[c], None, None))
    meta = spark.createDataFrame(
        rows, "column_name string, status string, actual_type string, expected_types string, type_ok boolean")
    nn = counts.unpivot([], df.columns, "column_name", "non_null")
    return meta.join(nn, "column_name", "left").select(
        "column_name", "status", "actual_type", "expected_types", "type_ok",
        F.col("non_null").cast("bigint").alias("non_null"))


def type_convertibility(df: DataFrame, required: list[str] = S.STEP1_REQUIRED,
                        accepted: dict = S.ACCEPTED_TYPES) -> DataFrame:
    """Per required column: values, values that parse as numbers, and whether
    the whole column converts. A non-numeric expectation is never convertible
    (reference behaviour)."""
    cols = _present(df, required)
    aggs = []
    for c in cols:
        aggs += [F.count(F.col(c)).alias(f"{c}__n"),
                 F.count(F.expr(f"try_cast(trim(cast(`{c}` AS string)) AS double)")).alias(f"{c}__ok")]
    one = df.agg(*aggs)
    parts = []
    for c in cols:
        numeric = any(t in ("bigint", "int", "double") for t in accepted.get(c, []))
        parts.append(F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"{c}__n").alias("n_values"),
            F.col(f"{c}__ok").alias("n_numeric"),
            (F.lit(numeric) & (F.col(f"{c}__n") == F.col(f"{c}__ok"))).alias("can_convert")))
    return one.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


# ---------------------------------------------------------------------------
# P4 range violations
# ---------------------------------------------------------------------------

def _long(df: DataFrame, cols: list[str]) -> DataFrame:
    return unpivot_long(df, cols, val_type="double")


def range_violations(df: DataFrame, ranges: dict = S.FEATURE_RANGES) -> DataFrame:
    """Per ranged feature: expected range, violation count, % of all rows,
    distinct invalid values. Null is not a violation (T1). Features without a
    violation are listed with 0."""
    cols = _present(df, list(ranges))
    # Counted per invalid value, the rest under null: one scan, and what is
    # shuffled is the invalid values, with no row copied per DISTINCT.
    bad = F.lit(False)
    for c in cols:
        bad = bad | ((F.col("feature") == c) & ~F.col("value").between(*ranges[c]))
    values = (_long(df, cols).groupBy("feature", F.when(bad, F.col("value")).alias("invalid"))
              .agg(F.count(F.lit(1)).alias("n")))
    found = values.groupBy("feature").agg(
        F.sum("n").alias("__n"), F.count("invalid").alias("__d"),
        F.sum(F.when(F.col("invalid").isNotNull(), F.col("n"))).alias("__v"))
    # One row a ranged column, so a feature of an empty table is listed too.
    listed = df.sparkSession.createDataFrame(
        [(c, f"{ranges[c][0]}-{ranges[c][1]}") for c in cols], "feature string, expected_range string")
    v = F.coalesce(F.col("__v"), F.lit(0).cast("bigint"))
    return listed.join(found, "feature", "left").select(
        "feature", "expected_range", v.alias("n_violations"), r6(pct(v, F.col("__n"))).alias("violation_pct"),
        F.coalesce(F.col("__d"), F.lit(0).cast("bigint")).alias("n_distinct_invalid"))


def range_violation_values(df: DataFrame, ranges: dict = S.FEATURE_RANGES) -> DataFrame:
    """(feature, invalid value, rows) - the value list as a table, so a column
    full of bad values never becomes one in-memory list."""
    cols = _present(df, list(ranges))
    long = _long(df, cols)
    cond = None
    for c in cols:
        lo, hi = ranges[c]
        term = (F.col("feature") == c) & ~F.col("value").between(lo, hi)
        cond = term if cond is None else cond | term
    return (long.where(cond).groupBy("feature", "value")
            .agg(F.count(F.lit(1)).alias("n_rows")))


# ---------------------------------------------------------------------------
# Q1-Q5 summary, missing values, feature profile, value distribution
# ---------------------------------------------------------------------------

def _dup_groups(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or df.columns
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))


def duplicate_groups(df: DataFrame) -> DataFrame:
    """Rows per distinct full row (``__n``): the grouping behind every
    duplicate count; persist it to share it between reports."""
    return _dup_groups(df)


def dataset_summary(df: DataFrame, key: str = S.ID) -> DataFrame:
    """Rows, columns, duplicate rows (all but the first of each identical
    group), duplicate %, distinct patients. One shuffle: group by all columns
    (partial aggregation collapses repeats map-side), then a global agg."""
    g = _dup_groups(df)
    return g.agg(
        F.sum("__n").cast("bigint").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.sum(F.col("__n") - 1).cast("bigint").alias("duplicate_rows"),
        r6(pct(F.sum(F.col("__n") - 1), F.sum("__n"))).alias("duplicate_pct"),
        F.count_distinct(F.col(key)).alias("unique_patients"),
    )


def missing_profile(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Per column: missing count, % of rows and completeness %; one scan."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    parts = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                      F.col(c).alias("missing_count"),
                      r6(pct(F.col(c), F.col("__n"))).alias("missing_pct"),
                      r6(F.lit(100.0) - pct(F.col(c), F.col("__n"))).alias("completeness_pct"))
             for i, c in enumerate(cols)]
    out = one.select(F.explode(F.array(*parts)).alias("r")).select("r.*")
    return out.where(F.col("missing_count") > 0) if only_missing else out


def missing_pattern(df: DataFrame) -> DataFrame:
    """Row-level null mask ('1' = missing, in column order) with row counts."""
    cols = df.columns
    mask = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    nmiss = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
    return (df.select(mask.alias("null_mask"), nmiss.alias("n_missing_columns"))
            .groupBy("null_mask", "n_missing_columns").agg(F.count(F.lit(1)).alias("n_rows")))


def feature_profile(df: DataFrame, cols: list[str] = S.PROFILE_COLUMNS) -> DataFrame:
    """Distinct, min, max, mean, sample std per feature (one unpivot pass)."""
    long = _long(df, _present(df, cols))
    return long.groupBy("feature").agg(
        F.count_distinct("value").alias("n_distinct"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        r6(F.avg("value")).alias("mean_value"),
        r6(F.stddev_samp("value")).alias("std_value"),
    )


def value_distribution(df: DataFrame, cols: list[str] = S.PROFILE_COLUMNS) -> DataFrame:
    """Rows per (feature, value), % of all rows and % of non-missing rows
    (value_counts ignores missing). Totals come from a one-row-per-feature
    table joined back by broadcast (bounded by the number of columns), so a
    feature with many distinct values is never gathered into one task."""
    long = _long(df, _present(df, cols))
    g = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    tot = g.groupBy("feature").agg(F.sum("n_rows").alias("__all"),
                                   F.sum(F.when(F.col("value").isNotNull(), F.col("n_rows"))).alias("__nn"))
    return (g.where(F.col("value").isNotNull()).join(F.broadcast(tot), "feature")
            .select("feature", "value", "n_rows",
                    r6(pct(F.col("n_rows"), F.col("__all"))).alias("pct_rows"),
                    r6(pct(F.col("n_rows"), F.col("__nn"))).alias("pct_non_missing")))


# ---------------------------------------------------------------------------
# Q6 class balance
# ---------------------------------------------------------------------------

def class_balance(df: DataFrame, label: str = S.LABEL,
                  needs_threshold: float = S.BALANCE_THRESHOLD_VALIDATOR,
                  balanced_threshold: float = S.BALANCE_THRESHOLD_LOADER) -> DataFrame:
    """One row per class: count, share of all rows and of non-missing rows,
    minimum shares, max/min ratio, needs_balancing (min share of all rows <
    needs_threshold), is_balanced (min share of labelled rows >= balanced_threshold)."""
    g = df.groupBy(F.col(label).alias("class_value")).agg(F.count(F.lit(1)).alias("n_rows"))
    w = Window.partitionBy(F.lit(0))
    classes = F.col("class_value").isNotNull()
    t = g.select("class_value", "n_rows",
                 F.sum("n_rows").over(w).alias("__all"),
                 F.sum(F.when(classes, F.col("n_rows"))).over(w).alias("__nn"),
                 F.min(F.when(classes, F.col("n_rows"))).over(w).alias("__min"),
                 F.max(F.when(classes, F.col("n_rows"))).over(w).alias("__max")).where(classes)
    p_all = ratio(F.col("__min"), F.col("__all"))
    p_nn = ratio(F.col("__min"), F.col("__nn"))
    return t.select(
        "class_value", "n_rows",
        r6(ratio(F.col("n_rows"), F.col("__all"))).alias("share_all_rows"),
        r6(ratio(F.col("n_rows"), F.col("__nn"))).alias("share_labelled"),
        r6(p_all).alias("min_share_all_rows"),
        r6(p_nn).alias("min_share_labelled"),
        r6(ratio(F.col("__max"), F.col("__min"))).alias("balance_ratio"),
        (p_all < needs_threshold).alias("needs_balancing"),
        (p_nn >= balanced_threshold).alias("is_balanced"),
    )


# ---------------------------------------------------------------------------
# Q7-Q10 rows per patient
# ---------------------------------------------------------------------------

def group_sizes(df: DataFrame, key: str = S.ID) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("group_size"))


def group_size_stats(df: DataFrame, key: str = S.ID) -> DataFrame:
    """Mean, exact median, min, max, sample std of rows per patient."""
    return group_sizes(df, key).agg(
        F.count(F.lit(1)).alias("n_groups"),
        r6(F.avg("group_size")).alias("mean_size"),
        r6(F.median("group_size")).alias("median_size"),
        F.min("group_size").alias("min_size"),
        F.max("group_size").alias("max_size"),
        r6(F.stddev_samp("group_size")).alias("std_size"),
    )


def group_size_histogram(df: DataFrame, key: str = S.ID) -> DataFrame:
    """Number of patients per row count."""
    return group_sizes(df, key).groupBy("group_size").agg(F.count(F.lit(1)).alias("n_groups"))


def group_size_cdf(df: DataFrame, key: str = S.ID, **prefix_kw) -> DataFrame:
    """Cumulative patients and % by row count (one point per distinct size)."""
    h = group_size_histogram(df, key)
    c = prefix_sums(h, ["group_size"], {"cum_groups": F.col("n_groups")}, **prefix_kw)
    total = h.agg(F.sum("n_groups")).scalar()
    return c.select("group_size", "n_groups", F.col("cum_groups").cast("bigint").alias("cum_groups"),
                    r6(pct(F.col("cum_groups"), total)).alias("cum_pct"))


def group_size_box(df: DataFrame, key: str = S.ID, k: float = 1.5) -> DataFrame:
    """Box-plot numbers of rows per patient: quartiles, fences, whiskers
    (extreme values inside the fences), number of fliers."""
    sizes = group_sizes(df, key)
    qa = sizes.agg(F.percentile("group_size", [0.25, 0.5, 0.75]).alias("q")).scalar()
    q1, med, q3 = qa[0], qa[1], qa[2]
    lo = q1 - F.lit(k) * (q3 - q1)
    hi = q3 + F.lit(k) * (q3 - q1)
    inside = F.col("group_size").between(lo, hi)
    return sizes.agg(
        r6(q1).alias("q1"), r6(med).alias("median"), r6(q3).alias("q3"),
        r6(q3 - q1).alias("iqr"), r6(lo).alias("lower_fence"), r6(hi).alias("upper_fence"),
        F.min(F.when(inside, F.col("group_size"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("group_size"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_fliers"),
    )


# ---------------------------------------------------------------------------
# Q11-Q13 correlation and outliers
# ---------------------------------------------------------------------------

def correlation_matrix(df: DataFrame, cols: list[str] = S.PROFILE_COLUMNS) -> DataFrame:
    """Pearson r for every pair i < j, pairwise-complete, all pairs in one pass."""
    cols = _present(df, cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[pearson(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}")
                   for a, b in pairs])
    parts = [F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"),
                      r6(F.col(f"{a}__{b}")).alias("r")) for a, b in pairs]
    return one.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def label_correlation(df: DataFrame, label: str = S.LABEL,
                      cols: list[str] = S.BASELINE_FEATURES) -> DataFrame:
    """Pearson r of each feature with the label."""
    cols = _present(df, cols)
    one = df.agg(*[pearson(F.col(c).cast("double"), F.col(label).cast("double")).alias(c)
                   for c in cols])
    parts = [F.struct(F.lit(c).alias("feature"), r6(F.col(c)).alias("r")) for c in cols]
    return one.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def _bounds(long: DataFrame, k: float, accuracy: int | None = None) -> DataFrame:
    # Exact quartiles come from counted values (``quantiles``), so no column's
    # values meet in one buffer; ``accuracy`` takes percentile_approx instead.
    if accuracy is None:
        n = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        q = exact_quantiles(n, ["feature"], {"q1": 0.25, "q3": 0.75}).join(
            n.groupBy("feature").agg(F.sum("n").alias("__rows")), "feature")
    else:
        two = F.percentile_approx("value", [0.25, 0.75], accuracy).cast("array<double>")
        q = (long.groupBy("feature").agg(two.alias("q"), F.count(F.lit(1)).alias("__rows"))
             .select("feature", "__rows", F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3")))
    return (q.where(F.col("q1").isNotNull())
            .select("feature", "__rows", "q1", "q3",
                    (F.col("q1") - k * (F.col("q3") - F.col("q1"))).alias("lower_bound"),
                    (F.col("q3") + k * (F.col("q3") - F.col("q1"))).alias("upper_bound")))


def iqr_outliers(df: DataFrame, cols: list[str] = S.PROFILE_COLUMNS, k: float = 1.5,
                 accuracy: int | None = None) -> DataFrame:
    """Per numeric column: quartiles, Tukey bounds, outlier count and % of rows.
    Columns with no value are omitted. Bounds are one row per column, so the
    broadcast back to the rows is bounded by the column count."""
    long = _long(df, _present(df, cols))
    b = _bounds(long, k, accuracy)
    out = long.join(F.broadcast(b.select("feature", "lower_bound", "upper_bound")), "feature")
    cnt = out.groupBy("feature").agg(F.count_if(
        (F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound"))).alias("n_outliers"))
    return b.join(cnt, "feature").select(
        "feature", r6(F.col("q1")).alias("q1"), r6(F.col("q3")).alias("q3"),
        r6(F.col("lower_bound")).alias("lower_bound"), r6(F.col("upper_bound")).alias("upper_bound"),
        "n_outliers", r6(pct(F.col("n_outliers"), F.col("__rows"))).alias("outlier_pct"))


def iqr_outlier_values(df: DataFrame, cols: list[str] = S.PROFILE_COLUMNS, k: float = 1.5,
                       accuracy: int | None = None) -> DataFrame:
    """(feature, outlier value, rows) instead of a raw value list."""
    long = _long(df, _present(df, cols))
    b = _bounds(long, k, accuracy)
    j = long.join(F.broadcast(b.select("feature", "lower_bound", "upper_bound")), "feature")
    return (j.where((F.col("value") < F.col("lower_bound")) | (F.col("value") > F.col("upper_bound")))
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n_rows")))


# ---------------------------------------------------------------------------
# Q14-Q16 duplicates, sample size, feature / target quality
# ---------------------------------------------------------------------------

def duplicate_profile(df: DataFrame, key: str = S.ID, date: str = S.CONTACT_DATE) -> DataFrame:
    """Tidy (metric, value): exact duplicate rows (keep first), rows of
    multi-row patients (keep=False), repeats of (patient, contact date)."""
    exact = _dup_groups(df).agg(F.sum(F.col("__n") - 1).cast("bigint").alias("value"))
    parts = [exact.select(F.lit("exact_duplicates").alias("metric"), "value")]
    if key in df.columns:
        per = _dup_groups(df, [key])
        parts.append(per.agg(F.sum(F.when(F.col("__n") > 1, F.col("__n"))).cast("bigint").alias("value"))
                     .select(F.lit("patient_level_duplicates").alias("metric"), "value"))
        if date in df.columns:
            pd_ = _dup_groups(df, [key, date])
            parts.append(pd_.agg(F.sum(F.col("__n") - 1).cast("bigint").alias("value"))
                         .select(F.lit("patient_date_duplicates").alias("metric"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("metric", F.coalesce(F.col("value"), F.lit(0).cast("bigint")).alias("value"))


def _sample_label(n: Column) -> Column:
    return (F.when(n >= S.ADEQUATE_SAMPLES, F.lit("adequate"))
            .when(n >= S.MIN_SAMPLES, F.lit("marginal")).otherwise(F.lit("insufficient")))


def sample_size_check(df: DataFrame) -> DataFrame:
    """Total rows, adequate flag (>= 100) and recommendation."""
    return df.agg(F.count(F.lit(1)).alias("total_samples")).select(
        "total_samples", (F.col("total_samples") >= S.MIN_SAMPLES).alias("is_adequate"),
        _sample_label(F.col("total_samples")).alias("recommendation"))


def feature_quality(df: DataFrame, cols: list[str] = S.BASELINE_FEATURES) -> DataFrame:
    """Per feature: completeness % and sample variance (one pass)."""
    cols = _present(df, cols)
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count(F.col(c)).alias(f"{c}__nn") for c in cols],
                 *[F.var_samp(F.col(c)).alias(f"{c}__var") for c in cols])
    parts = [F.struct(F.lit(c).alias("feature"),
                      r6(pct(F.col(f"{c}__nn"), F.col("__n"))).alias("completeness_pct"),
                      r6(F.col(f"{c}__var")).alias("variance")) for c in cols]
    return one.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def target_quality(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Label completeness %, class count, suitability and the reasons."""
    one = df.agg(F.count(F.lit(1)).alias("__n"), F.count(F.col(label)).alias("__nn"),
                 F.count_distinct(F.col(label)).alias("class_count"))
    comp = F.coalesce(pct(F.col("__nn"), F.col("__n")), F.lit(0.0))
    low = comp < S.TARGET_MIN_COMPLETENESS
    few = F.col("class_count") < 2
    return one.select(
        r6(comp).alias("completeness_pct"), "class_count",
        (~low & ~few).alias("is_suitable"),
        F.concat_ws("; ",
                    F.when(low, F.lit("Target variable has too many missing values")),
                    F.when(few, F.lit("Target variable needs at least 2 classes"))).alias("recommendations"))


# ---------------------------------------------------------------------------
# Q17 verdict, Q19 rule hook
# ---------------------------------------------------------------------------

def _verdict(df: DataFrame, required: list[str], ranges: dict, features: list[str], label: str,
             extra: dict[str, Column]) -> DataFrame:
    """The columns of ``quality_verdict``, the two parts of readiness and
    ``extra`` aggregates, all from the same pass over the table."""
    missing_cols = [c for c in required if c not in df.columns]
    rcols = _present(df, list(ranges))
    feats = _present(df, features)
    has_label = label in df.columns
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.count_if(~F.col(c).between(*ranges[c])).alias(f"{c}__v") for c in rcols]
    aggs += [F.count(F.col(c)).alias(f"{c}__nn") for c in feats]
    if has_label:
        aggs += [F.count(F.col(label)).alias("__lab_nn"), F.count_distinct(F.col(label)).alias("__lab_k")]
    one = df.agg(*aggs, *[c.alias(k) for k, c in extra.items()])
    dups = _dup_groups(df).agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0))).scalar()

    n = F.col("n")
    total_v = sum((F.col(f"{c}__v") for c in rcols), F.lit(0).cast("bigint"))
    n_bad_cols = sum((F.when(F.col(f"{c}__v") > 0, 1).otherwise(0) for c in rcols), F.lit(0))
    dup_pct = F.coalesce(pct(dups, n), F.lit(0.0))
    integrity = F.greatest(F.lit(0.0), F.lit(100.0) - dup_pct)
    adequate = n >= S.MIN_SAMPLES
    if has_label:
        lab_comp = F.coalesce(pct(F.col("__lab_nn"), n), F.lit(0.0))
        suitable = (lab_comp >= S.TARGET_MIN_COMPLETENESS) & (F.col("__lab_k") >= 2)
    else:
        suitable = F.lit(True)
    if feats:
        comps = [F.coalesce(pct(F.col(f"{c}__nn"), n), F.lit(0.0)) for c in feats]
        avg_comp = sum(comps, F.lit(0.0)) / len(feats)
    else:
        avg_comp = F.lit(100.0)
    readiness = F.greatest(F.lit(0.0), F.lit(100.0)
                           - F.when(adequate, 0).otherwise(30)
                           - F.when(suitable, 0).otherwise(40)
                           - (F.lit(100.0) - avg_comp) * 0.3)
    is_compliant = F.lit(not missing_cols)
    is_valid = total_v == 0
    is_intact = F.lit(dups) == 0
    is_ready = adequate & suitable
    issues = F.concat_ws("; ",
                         F.when(~is_compliant, F.lit("Schema compliance failures")),
                         F.when(~is_valid, F.lit("Business rule violations")),
                         F.when(~is_ready, F.lit("Not ready for machine learning")))
    return one.select(
        n.alias("n_rows"),
        is_compliant.alias("is_compliant"),
        F.lit(",".join(missing_cols)).alias("missing_columns"),
        total_v.alias("total_violations"),
        r6(F.coalesce(pct(total_v, n * n_bad_cols), F.lit(0.0))).alias("violation_rate"),
        r6(F.coalesce(pct(total_v, n), F.lit(0.0))).alias("violation_rate_rows"),
        F.lit(dups).cast("bigint").alias("duplicate_rows"),
        r6(integrity).alias("integrity_score"),
        r6(readiness).alias("readiness_score"),
        is_valid.alias("is_valid"), is_intact.alias("is_intact"), is_ready.alias("is_ready"),
        (is_compliant & is_valid & is_intact & is_ready).alias("overall_valid"),
        issues.alias("critical_issues"),
        adequate.alias("__adequate"), suitable.alias("__suitable"), *extra,
    )


def quality_verdict(df: DataFrame, required: list[str] = S.STEP1_REQUIRED,
                    ranges: dict = S.FEATURE_RANGES, features: list[str] = S.BASELINE_FEATURES,
                    label: str = S.LABEL) -> DataFrame:
    """One-row verdict: compliance, range validity and violation rates (both
    denominators), integrity score, readiness score, four flags and overall.

    The readiness score is 100 - 30 (too few rows) - 40 (unsuitable label)
    - 0.3 * (100 - mean feature completeness), floored at 0. The critical
    issue list excludes integrity, as in the reference."""
    return _verdict(df, required, ranges, features, label, {}).drop("__adequate", "__suitable")


def rule_hook(df: DataFrame, rules: list[tuple[str, str]] | None = None) -> DataFrame:
    """User rules as (name, boolean SQL expression); counts rows where the
    rule is false (null is not a violation). Default: no rules, empty result."""
    spark = df.sparkSession
    rules = rules or []
    if not rules:
        return spark.createDataFrame([], "rule string, n_rows bigint, n_violations bigint, violation_pct double")
    one = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.count_if(~F.expr(e)).alias(f"__r{i}") for i, (_, e) in enumerate(rules)])
    parts = [F.struct(F.lit(name).alias("rule"), F.col("__n").alias("n_rows"),
                      F.col(f"__r{i}").alias("n_violations"),
                      r6(pct(F.col(f"__r{i}"), F.col("__n"))).alias("violation_pct"))
             for i, (name, _) in enumerate(rules)]
    return one.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


# ---------------------------------------------------------------------------
# Q18 exploration summary
# ---------------------------------------------------------------------------

def exploration_summary(df: DataFrame, key: str = S.ID, label: str = S.LABEL,
                        ranges: dict = S.FEATURE_RANGES, required: list[str] = S.STEP1_REQUIRED,
                        features: list[str] = S.BASELINE_FEATURES) -> DataFrame:
    """Tidy report (section, metric, value, text): overview, quality,
    validation flags, readiness and its parts, findings, recommendations, next
    steps, and one row per label value. Flags are 1 / 0. Recommendations fire
    only on evidence (missing values are recommended only when some exist).
    One aggregate over the table plus two grouped aggregates (duplicates,
    label counts)."""
    cols = df.columns
    cells = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
    lab = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("k"))
    balance = lab.agg(F.try_divide(F.min("k").cast("double"), F.sum("k").cast("double"))).scalar()
    one = _verdict(df, required, ranges, features, label, {
        "__miss": F.sum(cells).cast("bigint"), "__pats": F.count_distinct(F.col(key)),
        "__labelled": F.count(F.col(label)), "__classes": F.count_distinct(F.col(label))})
    n, miss, pats, viol, dups = (F.col(c) for c in ("n_rows", "__miss", "__pats", "total_violations", "duplicate_rows"))
    avg_visits = F.try_divide(n.cast("double"), pats.cast("double"))
    completeness = F.lit(100.0) - F.coalesce(pct(miss, n * len(cols)), F.lit(0.0))
    unbalanced = F.coalesce(balance < S.BALANCE_THRESHOLD_VALIDATOR, F.lit(False))
    n_issues = sum((F.when(F.col(c), 0).otherwise(1) for c in ("is_compliant", "is_valid", "is_ready")), F.lit(0))
    valid = F.col("overall_valid")

    def row(section, metric, value=None, text=None):
        return F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"),
                        (r6(value) if value is not None else F.lit(None).cast("double")).alias("value"),
                        (F.lit(text) if isinstance(text, str) else F.lit(None).cast("string") if text is None
                         else text).alias("text"))

    def flag_row(section, metric, cond):
        return row(section, metric, cond.cast("int"))

    low_label = F.coalesce(pct(F.col("__labelled"), n), F.lit(0.0)) < S.TARGET_MIN_COMPLETENESS
    rec = [
        ("sample_size", ~F.col("__adequate"), S.REC_SAMPLES),
        ("target_missing", low_label, S.REC_TARGET_MISSING),
        ("target_classes", F.col("__classes") < 2, S.REC_TARGET_CLASSES),
        ("class_balance", unbalanced, S.REC_BALANCE),
        ("range_violations", viol > 0, S.REC_RANGES),
        ("duplicates_overall", dups > 0, S.REC_DUPLICATES),
        ("missing_values", miss > 0, S.REC_MISSING),
        ("duplicates", dups > 0,
         F.format_string("Investigate and handle %s duplicate records", dups.cast("string"))),
    ]
    rows = [
        row("overview", "n_rows", n), row("overview", "n_columns", F.lit(len(cols))),
        row("overview", "unique_patients", pats), row("overview", "mean_rows_per_patient", avg_visits),
        row("quality", "missing_cells", miss), row("quality", "completeness_pct", completeness),
        row("quality", "duplicate_rows", dups),
        row("validation", "range_violations", viol),
        flag_row("validation", "schema_compliant", F.col("is_compliant")),
        flag_row("validation", "business_rules_valid", F.col("is_valid")),
        flag_row("validation", "data_integrity_intact", F.col("is_intact")),
        flag_row("validation", "ml_ready", F.col("is_ready")),
        flag_row("validation", "overall_valid", valid),
        row("validation", "critical_issues_count", n_issues),
        row("readiness", "readiness_score", F.col("readiness_score")),
        flag_row("readiness", "sample_size_adequate", F.col("__adequate")),
        flag_row("readiness", "target_suitable", F.col("__suitable")),
        flag_row("readiness", "class_balance_ok", ~unbalanced),
        row("findings", "records", None, F.concat(F.lit("Dataset contains "), F.format_number(n, 0),
                                                  F.lit(f" records with {len(cols)} features"))),
        row("findings", "patients", None, F.concat(
            F.lit("Data covers "), F.format_number(pats, 0), F.lit(" unique patients with average "),
            F.regexp_replace(F.format_number(avg_visits, 1), ",", ""), F.lit(" consultations per patient"))),
        row("findings", "validation", None, F.when(valid, F.lit(S.FINDING_VALID)).otherwise(
            F.format_string("Data has %d critical issues that need attention", n_issues))),
    ]
    rows += [F.when(cond, row("recommendations", name, None, txt)) for name, cond, txt in rec]
    rows += [F.when(valid, row("next_steps", f"step_{i}", None, t)) for i, t in enumerate(S.NEXT_STEPS_VALID, 1)]
    rows += [F.when(~valid, row("next_steps", f"step_{i}", None, t)) for i, t in enumerate(S.NEXT_STEPS_ISSUES, 1)]
    rows.append(row("next_steps", "documentation", None, S.NEXT_STEP_ALWAYS))
    report = one.select(F.explode(F.array_compact(F.array(*rows))).alias("r")).select("r.*")
    return report.unionByName(lab.select(
        F.lit("label_distribution").alias("section"), F.col(label).cast("string").alias("metric"),
        r6(F.col("k")).alias("value"), F.lit(None).cast("string").alias("text")))
