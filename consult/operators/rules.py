"""Request validation and response shaping (V1-V7, V9), row-parallel.

Each rule is a column expression producing a message or null; messages are
gathered with ``array_compact`` in rule order, so validation is one narrow
projection (no shuffle, no Python) over any number of requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consult import schema as S
from consult.functions.exprs import confidence_level
from consult.operators.features import fill_defaults

CORE = S.BASELINE_FEATURES
TEMPORAL = ["days_since_accident", "consultation_number"]


def _fmt1(x: Column) -> Column:
    # One decimal, rounded on the exact binary value, half-even; no grouping.
    return F.regexp_replace(F.format_number(x, 1), ",", "")


def _fields(kind: str) -> list[tuple]:
    return [r for r in S.REQUEST_RANGES if kind == "enhanced" or r[0] in CORE]


# ---------------------------------------------------------------------------
# V1 schema level (typed request model)
# ---------------------------------------------------------------------------

def schema_errors(df: DataFrame, kind: str = "enhanced") -> Column:
    """Messages for missing required fields, out-of-bound values and a bad
    response_type. Optional temporal fields are checked after defaults."""
    msgs = []
    for name, lo, hi, _ in _fields(kind):
        c = F.col(name)
        if name in CORE:
            msgs.append(F.when(c.isNull(), F.lit(f"{name}: Field required")))
        msgs.append(F.when(c < lo, F.format_string(f"{name}: Input should be greater than or equal to {lo}"))
                    .when(c > hi, F.format_string(f"{name}: Input should be less than or equal to {hi}")))
    if "response_type" in df.columns:
        rt = F.col("response_type")
        msgs.append(F.when(rt.isNotNull() & ~rt.isin("minimal", "detailed"),
                           F.lit("response_type: Input should be 'minimal' or 'detailed'")))
    return F.array_compact(F.array(*msgs))


def validate_schema(df: DataFrame, kind: str = "enhanced") -> DataFrame:
    """Apply defaults (enhanced), add ``schema_errors`` and ``schema_valid``."""
    d = fill_defaults(df) if kind == "enhanced" else df
    if "response_type" in d.columns:
        d = d.withColumn("response_type", F.coalesce(F.col("response_type"), F.lit("minimal")))
    errs = schema_errors(d, kind)
    return d.select("*", errs.alias("schema_errors")).withColumn(
        "schema_valid", F.size("schema_errors") == 0)


# ---------------------------------------------------------------------------
# V2-V4 validator rules
# ---------------------------------------------------------------------------

def range_errors(kind: str = "enhanced") -> Column:
    """'<f> (<desc>) must be between <lo> and <hi>, got <v>' in field order;
    a missing value gives '<f> must be a numeric value'."""
    msgs = []
    for name, lo, hi, desc in _fields(kind):
        c = F.col(name)
        msgs.append(F.when(c.isNull(), F.lit(f"{name} must be a numeric value"))
                    .when((c < lo) | (c > hi),
                          F.concat(F.lit(f"{name} ({desc}) must be between {lo} and {hi}, got "),
                                   c.cast("string"))))
    return F.array_compact(F.array(*msgs))


def _status_ok() -> Column:
    pairs = F.array(*[F.lit(f"{p},{f}") for p, f, _ in S.STATUS_PAIRS])
    key = F.concat_ws(",", F.col("p_status").cast("string"), F.col("fl_status").cast("string"))
    return F.array_contains(pairs, key)


def rule_messages(kind: str = "enhanced") -> tuple[Column, Column]:
    """(errors, warnings) of the business rules, in rule order."""
    p, fl = F.col("p_score"), F.col("fl_score")
    ps, fs = F.col("p_status"), F.col("fl_status")
    warn = [F.when((p == 4) & (fl == 0), F.lit(
        "Warning: Maximum pain (4) with no function limitation (0) is medically unusual"))]
    err = [F.when(ps.isNotNull() & fs.isNotNull() & ~_status_ok(),
                  F.format_string("Invalid status combination: p_status=%d, fl_status=%d", ps, fs))]
    if kind == "enhanced":
        d, n = F.col("days_since_accident"), F.col("consultation_number")
        warn.append(F.when((n == 1) & (d > 90), F.format_string(
            "Warning: First consultation %d days after accident is unusually late", d)))
        warn.append(F.when((n > 1) & (d < 7), F.format_string(
            "Warning: Consultation #%d only %d days after accident seems early", n, d)))
    return F.array_compact(F.array(*err)), F.array_compact(F.array(*warn))


def temporal_messages() -> tuple[Column, Column]:
    """(warnings, system errors) of the temporal check (enhanced only). A zero
    consultation number is a division error in the reference, recorded as a
    system error; the temporal warning is then not produced."""
    d, n = F.col("days_since_accident"), F.col("consultation_number")
    avg = F.try_divide(d.cast("double"), n.cast("double"))
    both = d.isNotNull() & n.isNotNull()
    head = F.format_string("Temporal inconsistency: %d consultations in %d days (avg ", n, d)
    w = (F.when(both & (n != 0) & (avg < 1),
                F.concat(head, _fmt1(avg), F.lit(" days per consultation) is too frequent")))
         .when(both & (n != 0) & (avg > 90),
               F.concat(head, _fmt1(avg), F.lit(" days per consultation) has large gaps"))))
    sys_err = F.when(both & (n == 0), F.lit("Validation system error: division by zero"))
    return F.array_compact(F.array(w)), F.array_compact(F.array(sys_err))


def validate_requests(df: DataFrame, kind: str = "enhanced") -> DataFrame:
    """Add ``errors`` and ``warnings`` arrays and ``is_valid`` (no errors).
    Order: range errors, status-pair error, then (enhanced) a system error;
    warnings: business rules, then (enhanced) temporal."""
    r_err = range_errors(kind)
    b_err, b_warn = rule_messages(kind)
    if kind == "enhanced":
        t_warn, t_sys = temporal_messages()
        errors = F.concat(r_err, b_err, t_sys)
        warnings = F.concat(b_warn, t_warn)
    else:
        errors = F.concat(r_err, b_err)
        warnings = b_warn
    return df.select("*", errors.alias("errors"), warnings.alias("warnings")).withColumn(
        "is_valid", F.size("errors") == 0)


def rule_catalogue(spark) -> DataFrame:
    """Ranges, the 9 status pairs and the 5 rule texts as one tidy table."""
    rows = [("range", n, f"{lo}-{hi}", d) for n, lo, hi, d in S.REQUEST_RANGES]
    rows += [("status_pair", f"p_status={p}, fl_status={f}", f"{p},{f}", d) for p, f, d in S.STATUS_PAIRS]
    rows += [("business_rule", f"rule_{i + 1}", None, t) for i, t in enumerate(S.BUSINESS_RULES)]
    return spark.createDataFrame(rows, "kind string, name string, value string, description string")


def status_pair_usage(requests: DataFrame) -> DataFrame:
    """Catalogue of status pairs joined with how many requests use each;
    pairs outside the catalogue are listed as invalid."""
    spark = requests.sparkSession
    cat = spark.createDataFrame([(p, f, d) for p, f, d in S.STATUS_PAIRS],
                                "p_status int, fl_status int, description string")
    used = requests.groupBy("p_status", "fl_status").agg(F.count(F.lit(1)).alias("n_requests"))
    j = used.join(F.broadcast(cat), ["p_status", "fl_status"], "full_outer")
    return j.select("p_status", "fl_status",
                    F.coalesce(F.col("description"), F.lit("invalid combination")).alias("description"),
                    F.coalesce(F.col("n_requests"), F.lit(0).cast("bigint")).alias("n_requests"))


# ---------------------------------------------------------------------------
# V7 confidence, V9 response shape
# ---------------------------------------------------------------------------

def add_confidence(df: DataFrame, prob: str = "nbe_yes_probability") -> DataFrame:
    return df.withColumn("confidence_level", confidence_level(F.col(prob)))


def shape_response(df: DataFrame) -> DataFrame:
    """Minimal = the two probabilities; detailed adds confidence, model,
    type, timestamp and flags. Detailed-only columns are null for minimal."""
    det = F.col("response_type") == "detailed"
    keep = ["request_id"] if "request_id" in df.columns else []
    extra = ["confidence_level", "model_used", "model_type", "prediction_timestamp",
             "feature_engineering_applied", "input_validation_passed"]
    return df.select(*keep, "response_type", "nbe_yes_probability", "nbe_no_probability",
                     *[F.when(det, F.col(c)).alias(c) for c in extra])
