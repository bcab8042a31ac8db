"""DuckDB text of derived inputs, shared by the oracle queries.

These CTEs restate, in plain SQL, what the library computes, so each oracle
query is an independent reimplementation to compare against.
"""

from __future__ import annotations

from consult import schema as S
from consult.sources.fixtures import FIXTURE_SQL

RAW_COLS = ["accident_number", "accident_date", "contact_date", "fl_score", "fl_status",
            "p_score", "p_status", "nbe"]


def _number(c: str) -> str:
    return f"try_cast(trim({c}) AS DOUBLE)"


def _time(c: str) -> str:
    return f"try_cast(trim({c}) AS TIMESTAMP)"


def whole_days(start: str = "accident_date", end: str = "contact_date") -> str:
    us = f"(epoch_us(CAST({end} AS TIMESTAMP)) - epoch_us(CAST({start} AS TIMESTAMP)))"
    return f"CAST(floor({us} / 86400000000.0) AS BIGINT)"


PARTS = {
    "typed_raw": f"""
typed_raw AS (
  SELECT CAST(accident_number AS VARCHAR) AS accident_number,
         {_time('accident_date')} AS accident_date,
         {_time('contact_date')} AS contact_date,
         {_number('fl_score')} AS fl_score, {_number('fl_status')} AS fl_status,
         {_number('p_score')} AS p_score, {_number('p_status')} AS p_status, {_number('nbe')} AS nbe
  FROM consultations_raw)""",
    "cleaned_raw": """
cleaned_raw AS (
  SELECT DISTINCT * FROM typed_raw
  WHERE nbe IN (0, 1) AND p_score IS NOT NULL AND p_status IS NOT NULL
    AND fl_score IS NOT NULL AND fl_status IS NOT NULL)""",
    "cleaned": """
cleaned AS (
  SELECT DISTINCT * FROM consultations
  WHERE nbe IN (0, 1) AND p_score IS NOT NULL AND p_status IS NOT NULL
    AND fl_score IS NOT NULL AND fl_status IS NOT NULL)""",
}


def id_map(src: str, name: str = "id_map") -> str:
    return f"""
{name} AS (
  SELECT original_id, row_number() OVER (ORDER BY original_id) AS anonymous_id
  FROM (SELECT DISTINCT CAST(accident_number AS VARCHAR) AS original_id FROM {src}
        WHERE accident_number IS NOT NULL) d)"""


def anon(src: str, mapname: str = "id_map", name: str = "anon") -> str:
    return f"""
{name} AS (
  SELECT m.anonymous_id AS anonymous_patient_id, s.accident_date, s.contact_date, s.fl_score,
         s.fl_status, s.p_score, s.p_status, s.nbe
  FROM {src} s LEFT JOIN {mapname} m ON CAST(s.accident_number AS VARCHAR) = m.original_id)"""


def feats(src: str = "anon", name: str = "feats") -> str:
    days = whole_days()
    order = ("contact_date ASC NULLS LAST, accident_date ASC NULLS LAST, fl_score ASC NULLS LAST, "
             "fl_status ASC NULLS LAST, p_score ASC NULLS LAST, p_status ASC NULLS LAST, nbe ASC NULLS LAST")
    return f"""
{name}_seq AS (
  SELECT *, CAST(CASE WHEN {days} < 0 THEN 0 ELSE {days} END AS INTEGER) AS days_since_accident,
         row_number() OVER (PARTITION BY anonymous_patient_id ORDER BY {order})
           AS consultation_number,
         count(*) OVER (PARTITION BY anonymous_patient_id) AS total_consultations_for_patient
  FROM {src}),
{name} AS (
  SELECT anonymous_patient_id, accident_date, contact_date, fl_score, fl_status, p_score, p_status, nbe,
         days_since_accident, consultation_number,
         CAST(consultation_number = 1 AS INTEGER) AS is_first_consultation,
         CAST(consultation_number > 1 AS INTEGER) AS is_follow_up,
         total_consultations_for_patient,
         {interactions_sql()}
  FROM {name}_seq)"""


def interactions_sql() -> str:
    return """p_score * fl_score AS p_score_fl_score_interaction,
         CAST(p_score + fl_score AS DOUBLE) / 2 AS severity_index,
         p_status * fl_status AS p_status_fl_status_interaction,
         CAST(COALESCE(p_status = 2 AND fl_status = 2, false) AS INTEGER) AS both_improving,
         CAST(COALESCE(p_status = 0 AND fl_status = 0, false) AS INTEGER) AS both_worsening,
         CAST(COALESCE(p_score >= 3 AND fl_score >= 3, false) AS INTEGER) AS high_severity,
         CAST(COALESCE(p_score = 0 AND fl_score = 0, false) AS INTEGER) AS no_symptoms"""


def patient_label(src: str = "feats", key: str = S.PSEUDO_ID, name: str = "plabel") -> str:
    return f"""
{name}_c AS (SELECT {key}, nbe, count(*) AS n FROM {src} GROUP BY {key}, nbe),
{name} AS (
  SELECT {key}, min(nbe) AS patient_label FROM (
    SELECT {key}, nbe, n, max(n) OVER (PARTITION BY {key}) AS mx FROM {name}_c) t
  WHERE n = mx GROUP BY {key})"""


def split(src_label: str = "plabel", key: str = S.PSEUDO_ID, frac: float = S.TEST_FRACTION,
          seed: int = S.SEED, name: str = "psplit") -> str:
    return f"""
{name}_r AS (
  SELECT {key}, patient_label,
         row_number() OVER (PARTITION BY patient_label
                            ORDER BY md5(concat_ws(':', CAST({key} AS VARCHAR), '{seed}')), {key}) AS r,
         count(*) OVER (PARTITION BY patient_label) AS n
  FROM {src_label}),
{name} AS (
  SELECT {key}, patient_label, CASE WHEN r <= ceil({frac} * n) THEN 'test' ELSE 'train' END AS split
  FROM {name}_r)"""


def folds(src_label: str, key: str = S.PSEUDO_ID, k: int = S.N_FOLDS, seed: int = S.SEED,
          name: str = "pfold") -> str:
    return f"""
{name} AS (
  SELECT {key}, CAST((row_number() OVER (PARTITION BY patient_label
                            ORDER BY md5(concat_ws(':', CAST({key} AS VARCHAR), '{seed}')), {key}) - 1) % {k}
              AS INTEGER) AS fold
  FROM {src_label})"""


ENH_COLS = ("p_score, p_status, fl_score, fl_status, days_since_accident, consultation_number, nbe, "
            "p_score_fl_score_interaction, severity_index, both_improving, high_severity")


def q(fixtures: list[str], parts: list[str], body: str) -> str:
    """Assemble WITH <fixtures>, <parts> <body>. ``parts`` are names in PARTS
    or ready CTE text."""
    deps = {"scored": ["consultations"], "prediction_log": ["request_log"], "consultations_gaps": ["consultations_raw"]}
    order: list[str] = []

    def add(n):
        for d in deps.get(n, []):
            add(d)
        if n not in order:
            order.append(n)
    for n in fixtures:
        add(n)
    ctes = [FIXTURE_SQL[n] for n in order]
    ctes += [PARTS.get(p, p) for p in parts]
    return "WITH " + ",".join(ctes) + "\n" + body
