"""Registered queries over the order of a patient's consultations and over streams of them, with their DuckDB text."""

from __future__ import annotations

from pyspark.sql import functions as F

from consult.operators import longitudinal as L
from consult.plans import sqlparts as P
from consult.plans.catalog import ANON_CTES, FEAT_CTES, anon, register, typed
from consult.sources import fixtures as FX
from consult.streaming import monitor as R

_ORDER = ", ".join(f"{c} ASC NULLS LAST" for c in ("contact_date", "accident_date", "fl_score", "fl_status", "p_score", "p_status", "nbe"))
_PATIENT = f"w AS (PARTITION BY anonymous_patient_id ORDER BY {_ORDER})"
_UPTO = f"w AS (PARTITION BY anonymous_patient_id ORDER BY {_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

_GAPS = f"""
gaps AS (
  SELECT anonymous_patient_id, row_number() OVER w AS consultation_number, contact_date,
         lag(contact_date) OVER w AS previous_contact_date,
         CAST(contact_date - lag(contact_date) OVER w AS INTEGER) AS days_since_previous
  FROM anon WINDOW {_PATIENT})"""


def aq(body: str, extra: list[str] | None = None) -> str:
    return P.q(["consultations"], ANON_CTES + (extra or []), body)


@register("days_between_consultations", aq("SELECT * FROM gaps", [_GAPS]))
def q_days_between_consultations(spark, d):
    """Whole days from each consultation to the patient's previous one."""
    return L.days_between_consultations(anon(spark, d))


@register("consultation_intervals", aq("""
SELECT consultation_number, count(*) AS n_intervals, round(avg(days_since_previous), 6) AS mean_days,
       min(days_since_previous) AS min_days, max(days_since_previous) AS max_days,
       count(*) FILTER (days_since_previous = 0) AS n_same_day
FROM gaps WHERE days_since_previous IS NOT NULL GROUP BY consultation_number""", [_GAPS]))
def q_consultation_intervals(spark, d):
    """Intervals by their place in the patient's sequence."""
    return L.interval_stats(L.days_between_consultations(anon(spark, d)))


_PREVIOUS = ", ".join(f"lag({c}) OVER w AS previous_{c}" for c in ("contact_date", "accident_date", "fl_score", "p_score", "nbe"))


def _status(name: str, score: str, status: str) -> str:
    moved = f"CASE WHEN {score} < previous_{score} THEN 2 WHEN {score} > previous_{score} THEN 0 ELSE 1 END"
    return f"""
  SELECT accident_number, consultation_number, '{name}' AS rule, 'logical' AS category, {status} <> {moved} AS broken,
         CAST({status} AS DOUBLE) AS observed, CAST({moved} AS DOUBLE) AS expected
  FROM seen WHERE {score} IS NOT NULL AND previous_{score} IS NOT NULL AND {status} IN (0, 1, 2)"""


def _rule(name: str, category: str, where: str, holds: str, observed: str, expected: str) -> str:
    return f"""
  SELECT accident_number, consultation_number, '{name}', '{category}', NOT ({holds}),
         CAST({observed} AS DOUBLE), CAST({expected} AS DOUBLE) FROM seen WHERE {where}"""


_GAP, _SHIFT, _SINCE = P.whole_days("previous_contact_date", "contact_date"), P.whole_days("previous_accident_date", "accident_date"), P.whole_days()
_CHECKED = [f"""
seen AS (SELECT *, row_number() OVER w AS consultation_number, {_PREVIOUS} FROM typed_raw
         WINDOW w AS (PARTITION BY accident_number ORDER BY {_ORDER}))""", "\nchecked AS (" + " UNION ALL ".join([
    _status("pain_status_follows_score", "p_score", "p_status"),
    _status("function_status_follows_score", "fl_score", "fl_status"),
    _rule("accident_date_constant", "patient", "accident_date IS NOT NULL AND previous_accident_date IS NOT NULL", "accident_date = previous_accident_date", _SHIFT, "0"),
    _rule("recovery_not_withdrawn", "patient", "nbe IN (0, 1) AND previous_nbe IN (0, 1)", "NOT (previous_nbe = 1 AND nbe = 0)", "nbe", "previous_nbe"),
    _rule("contact_after_accident", "temporal", "accident_date IS NOT NULL AND contact_date IS NOT NULL", "contact_date >= accident_date", _SINCE, "0"),
    _rule("one_contact_a_day", "temporal", "contact_date IS NOT NULL AND previous_contact_date IS NOT NULL", f"{_GAP} > 0", _GAP, "1"),
    _rule("no_long_gap", "temporal", "contact_date IS NOT NULL AND previous_contact_date IS NOT NULL", f"{_GAP} <= {L.LONG_GAP}", _GAP, str(L.LONG_GAP)),
]) + ")"]


@register("consistency_violations", P.q(["consultations_raw"], ["typed_raw", *_CHECKED], """
SELECT accident_number, consultation_number, rule, category, observed, expected FROM checked WHERE broken"""))
def q_consistency_violations(spark, d):
    """Rows that contradict the patient's previous row, or their own dates, rule by rule."""
    return L.consistency_violations(typed(spark, d))


@register("consistency_summary", P.q(["consultations_raw"], ["typed_raw", *_CHECKED], """
SELECT rule, category, count(*) AS n_checked, count(*) FILTER (broken) AS n_violations,
       count(DISTINCT accident_number) FILTER (broken) AS n_patients,
       round(100.0 * count(*) FILTER (broken) / count(*), 6) AS violation_pct
FROM checked GROUP BY rule, category"""))
def q_consistency_summary(spark, d):
    """Logical, patient and temporal consistency in counts."""
    return L.consistency_summary(typed(spark, d))


@register("patient_trajectory", aq(f"""
SELECT anonymous_patient_id, row_number() OVER w AS consultation_number,
       round(avg(p_score) OVER w, 6) AS mean_p_score, round(avg(fl_score) OVER w, 6) AS mean_fl_score,
       round(regr_slope(p_score, contact_date - accident_date) OVER w, 6) + 0.0 AS p_score_slope,
       round(regr_slope(fl_score, contact_date - accident_date) OVER w, 6) + 0.0 AS fl_score_slope
FROM anon WINDOW {_UPTO}"""))
def q_patient_trajectory(spark, d):
    """Running means and least-squares slopes of both scores, consultation by consultation."""
    return L.patient_trajectory(anon(spark, d))


@register("patient_averages", aq("""
SELECT g.anonymous_patient_id, count(*) AS n_consultations, round(avg(g.days_since_previous), 6) AS mean_days_between,
       round(avg(a.p_score), 6) AS mean_p_score, CAST(arg_max(a.p_score, g.consultation_number) - arg_min(a.p_score, g.consultation_number) AS INTEGER) AS p_score_change,
       round(regr_slope(a.p_score, a.contact_date - a.accident_date), 6) + 0.0 AS p_score_slope,
       round(avg(a.fl_score), 6) AS mean_fl_score, CAST(arg_max(a.fl_score, g.consultation_number) - arg_min(a.fl_score, g.consultation_number) AS INTEGER) AS fl_score_change,
       round(regr_slope(a.fl_score, a.contact_date - a.accident_date), 6) + 0.0 AS fl_score_slope
FROM gaps g JOIN numbered a USING (anonymous_patient_id, consultation_number) GROUP BY g.anonymous_patient_id""", [_GAPS, f"""
numbered AS (SELECT *, row_number() OVER w AS consultation_number FROM anon WINDOW {_PATIENT})"""]))
def q_patient_averages(spark, d):
    """One row per patient: means, mean interval, change from first to last consultation, slope."""
    return L.patient_averages(anon(spark, d))


_NUMBERED = """
SELECT anonymous_patient_id, accident_date, contact_date, fl_score, fl_status, p_score, p_status, nbe,
       consultation_number, false AS late FROM feats"""


@register("stream_consultation_number", P.q(["consultations"], FEAT_CTES, _NUMBERED))
def q_stream_consultation_number(spark, d):
    """F2 on a stream: consultations in time order through one counter per patient."""
    from consult.streaming.runner import run_numbering_stream
    return run_numbering_stream(spark, anon(spark, d), "anonymous_patient_id", "contact_date")


def _monitored(spark, d):
    """The hourly sketches of the request log, kept by a stream."""
    from consult.streaming.runner import run_stream
    return run_stream(spark, FX.request_log(spark, d), R.latency_sketches, delay="1 hour", name="stream-sketches")


@register("stream_request_rates", P.q(["request_log"], [], """
SELECT date_trunc('hour', ts) AS window_start, path, count(*) AS n_requests,
       count(*) FILTER (status >= 400 AND status < 500) AS n_4xx, count(*) FILTER (status >= 500) AS n_5xx,
       round(CAST(count(*) FILTER (status >= 400 AND status < 500) AS DOUBLE) / count(*), 6) AS rate_4xx,
       round(CAST(count(*) FILTER (status >= 500) AS DOUBLE) / count(*), 6) AS rate_5xx
FROM request_log GROUP BY 1, 2"""))
def q_stream_request_rates(spark, d):
    """R2 on a stream: counts and rates of every closed window."""
    m = R.with_percentiles(_monitored(spark, d))
    return m.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "path", "n_requests", "n_4xx", "n_5xx", "rate_4xx", "rate_5xx")


_WITHIN = [("1 hour", "hour"), ("1 day", "day")]


@register("stream_latency_ranks", P.q(["request_log"], [], " UNION ALL ".join(f"""
SELECT '{w}' AS window_size, date_trunc('{part}', ts)::TIMESTAMP AS window_start, path, x.percentile, count(*) AS n_requests, true AS within_bound
FROM request_log, (VALUES ('p50'), ('p95'), ('p99')) AS x(percentile) WHERE latency_ms IS NOT NULL GROUP BY 2, 3, 4""" for w, part in _WITHIN)))
def q_stream_latency_ranks(spark, d):
    """Percentiles of the stream's hourly sketches, and of those merged to days: their
    ranks among the requests are within the stated bound."""
    hourly, log = _monitored(spark, d), FX.request_log(spark, d)
    out = None
    for window, _ in _WITHIN:
        kept = hourly if window == "1 hour" else R.merge_sketches(hourly, window)
        e = R.rank_errors(log, R.with_percentiles(kept).withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), window)
        e = e.select(F.lit(window).alias("window_size"), F.col("window_start").cast("timestamp_ntz").alias("window_start"), "path", "percentile", "n_requests",
                     (F.col("rank_error") <= R.RANK_ERROR).alias("within_bound"))
        out = e if out is None else out.unionByName(e)
    return out
