"""Registered queries on calibration, drift, grid search and the logistic optimum, with their DuckDB text."""

from __future__ import annotations

from pyspark.sql import functions as F

from consult.functions.exprs import days_since
from consult.operators import calibration as K
from consult.operators import cleaning as C
from consult.operators import drift as D
from consult.operators import models as M
from consult.plans import sqlparts as P
from consult.plans.catalog import SPLIT_CTES, fitted, folded, fq, model_data, register
from consult.sources import fixtures as FX
from consult.sources import io as IO

_SCORES = """
sc AS (SELECT score AS s, count(*) AS n, CAST(sum(label) AS BIGINT) AS p FROM scored WHERE score IS NOT NULL GROUP BY score)"""
_BINNED = [_SCORES, """
binned AS (
  SELECT 'uniform' AS strategy, s, n, p, CAST(least(floor(s * 10), 9) AS INTEGER) AS bin FROM sc
  UNION ALL
  SELECT 'quantile', s, n, p, CAST((COALESCE(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 10) // sum(n) OVER () AS INTEGER) FROM sc)"""]


@register("calibration_curve", P.q(["scored"], _BINNED, """
SELECT strategy, bin, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(p) AS BIGINT) AS n_positive, round(sum(n * s) / sum(n), 6) AS mean_score,
       round(CAST(sum(p) AS DOUBLE) / sum(n), 6) AS observed_rate, round(min(s), 6) AS min_score, round(max(s), 6) AS max_score
FROM binned GROUP BY strategy, bin"""))
def q_calibration_curve(spark, d):
    """Mean score against observed rate, over bins of equal width and of equal mass."""
    rows = FX.scored(spark, d)
    u, q = (K.calibration_curve(rows, strategy=s).select(F.lit(s).alias("strategy"), "*") for s in ("uniform", "quantile"))
    return u.unionByName(q)


@register("brier_score", P.q(["scored"], [_SCORES, """
b AS (SELECT CAST(least(floor(s * 10), 9) AS INTEGER) AS bin, abs(sum(n * s) - sum(p)) AS gap FROM sc GROUP BY 1)""", """
t AS (SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(p) AS DOUBLE) / sum(n) AS base,
             sum(p * (1 - s) * (1 - s) + (n - p) * s * s) / sum(n) AS sq,
             sum(n * (s - CAST(p AS DOUBLE) / n) * (s - CAST(p AS DOUBLE) / n)) / sum(n) AS rel,
             sum(n * (CAST(p AS DOUBLE) / n) * (CAST(p AS DOUBLE) / n)) / sum(n) AS rr FROM sc)"""], """
SELECT n_rows, round(base, 6) AS base_rate, round(sq, 6) AS brier_score, round(rel, 6) AS reliability, round(rr - base * base, 6) AS resolution,
       round(base * (1 - base), 6) AS uncertainty, round((SELECT sum(gap) FROM b) / n_rows, 6) AS expected_calibration_error FROM t"""))
def q_brier_score(spark, d):
    """Brier score, its reliability, resolution and uncertainty, and the expected calibration error."""
    return K.brier_score(FX.scored(spark, d))


DRIFT_FEATURES = ["p_score", "fl_score", "p_status", "fl_status", "days_since_accident", "nbe"]


def _long(src: str, side: str) -> str:
    cols = {f: f for f in DRIFT_FEATURES} | {"days_since_accident": "contact_date - accident_date"}
    return " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({c} AS DOUBLE) AS value, '{side}' AS side FROM {src}" for f, c in cols.items())


@register("feature_drift", P.q(["consultations"], ["newer AS (SELECT * FROM consultations WHERE nbe IN (0, 1) AND p_score + fl_score < 6)", f"""
long AS ({_long('consultations', 'o')} UNION ALL {_long('newer', 'n')})""", """
v AS (SELECT feature, value, count(*) FILTER (side = 'o') AS o, count(*) FILTER (side = 'n') AS n FROM long GROUP BY 1, 2)""", """
r AS (SELECT *, sum(o) OVER w AS co, sum(n) OVER w AS cn, sum(o) OVER (PARTITION BY feature) AS t_o, sum(n) OVER (PARTITION BY feature) AS t_n
      FROM v WHERE value IS NOT NULL WINDOW w AS (PARTITION BY feature ORDER BY value))""", """
b AS (SELECT feature, least(floor((co - o) * 10.0 / t_o), 9) AS bin, sum(o) AS o, sum(n) AS n, max(t_o) AS t_o, max(t_n) AS t_n,
             max(abs(CAST(co AS DOUBLE) / t_o - CAST(cn AS DOUBLE) / t_n)) AS ks FROM r GROUP BY 1, 2)""", """
s AS (SELECT feature, sum((greatest(n, 0.5) / t_n - greatest(o, 0.5) / t_o) * ln((greatest(n, 0.5) / t_n) / (greatest(o, 0.5) / t_o))) AS psi, max(ks) AS ks
      FROM (SELECT feature, CAST(o AS DOUBLE) AS o, CAST(n AS DOUBLE) AS n, t_o, t_n, ks FROM b) GROUP BY 1)"""], f"""
SELECT v.feature, CAST(sum(v.o) AS BIGINT) AS n_older, CAST(sum(v.n) AS BIGINT) AS n_newer,
       round(CAST(COALESCE(sum(v.o) FILTER (value IS NULL), 0) AS DOUBLE) / sum(v.o), 6) AS missing_older,
       round(CAST(COALESCE(sum(v.n) FILTER (value IS NULL), 0) AS DOUBLE) / sum(v.n), 6) AS missing_newer,
       round(any_value(psi), 6) AS psi, round(any_value(ks), 6) AS ks,
       CASE WHEN any_value(psi) >= {D.MAJOR} THEN 'major' WHEN any_value(psi) >= {D.MODERATE} THEN 'moderate' ELSE 'none' END AS drift
FROM v JOIN s USING (feature) GROUP BY v.feature"""))
def q_feature_drift(spark, d):
    """Two runs of a stage, the newer without its severe cases: PSI and KS of every feature."""
    import uuid

    from consult.session import scratch_path
    c, path = FX.consultations(spark, d), scratch_path(spark, f"drift-{uuid.uuid4().hex}")
    IO.write_stage(c, path, "20250101")
    IO.write_stage(C.binary_label_filter(c).where("p_score + fl_score < 6"), path, "20250612")
    older, newer = (r.withColumn("days_since_accident", days_since(r)) for r in (IO.read_stage(spark, path, "20250101"), IO.read_stage(spark, path)))
    return D.feature_drift(older, newer, DRIFT_FEATURES)


#: Penalties and their kind that the grid search compares.
GRID = {"regParam": [1e-3, 1.0], "elasticNetParam": [0.0, 0.5]}


@register("grid_search")
def q_grid_search(spark, d):
    """Logistic penalties by cross-validated exact AUC, all candidates on one counted table."""
    _, out = M.grid_search(folded(spark, d, "baseline"), "logistic_regression", "baseline", GRID, tol=1e-6)
    return out


_TRAIN = "(SELECT * FROM feats WHERE anonymous_patient_id IN (SELECT anonymous_patient_id FROM psplit WHERE split = 'train'))"
_FOLDS = SPLIT_CTES + [P.patient_label(_TRAIN, name="tlabel"), P.folds("tlabel")]
_CELLS = ", ".join(f"({i})" for i in range(len(M.grid_candidates(GRID))))


@register("grid_search_rows", fq(f"""
SELECT g.candidate, k.fold, count(*) AS n_rows, CAST(sum(f.nbe) AS BIGINT) AS n_positive
FROM feats f JOIN pfold k USING (anonymous_patient_id), (VALUES {_CELLS}) AS g(candidate)
WHERE f.p_score IS NOT NULL AND f.p_status IS NOT NULL AND f.fl_score IS NOT NULL AND f.fl_status IS NOT NULL
GROUP BY g.candidate, k.fold""", _FOLDS))
def q_grid_search_rows(spark, d):
    """Rows and labels on which each candidate of the grid is tested, fold by fold, from the counted table."""
    counted, _, held = M.count_rows(M.complete_rows(folded(spark, d, "baseline"), "baseline", keep=("fold",)), "baseline", ("fold",))
    held.unpersist()
    cells = F.explode(F.array(*map(F.lit, range(len(M.grid_candidates(GRID))))))
    per = counted.groupBy("fold").agg(F.sum("weight").cast("long").alias("n_rows"), F.sum(F.col("weight") * F.col("label")).cast("long").alias("n_positive"))
    return per.select(cells.alias("candidate"), "fold", "n_rows", "n_positive")


#: Share of the sum of |x| by which a gradient may miss 0.
STATIONARY = 1e-5


@register("lr_stationarity", fq(" UNION ALL ".join(f"""
SELECT '{fs}' AS feature_set, x.coordinate, count(*) AS n_rows, true AS stationary
FROM {_TRAIN} f, (VALUES {', '.join(f"('{c}')" for c in [*M.FEATURE_SETS[fs], 'intercept'])}) AS x(coordinate)
WHERE {' AND '.join(f'f.{c} IS NOT NULL' for c in M.FEATURE_SETS[fs])} GROUP BY x.coordinate""" for fs in ("baseline", "enhanced")), SPLIT_CTES))
def q_lr_stationarity(spark, d):
    """M2 checked by its optimum: at the fitted weights the gradient of the penalised
    objective, over all training rows, is 0 in every coordinate, the intercept's too."""
    out = None
    for fs in ("baseline", "enhanced"):
        g = M.logistic_gradient(fitted(spark, d, "logistic_regression", fs), model_data(spark, d)[f"{fs}_train"], fs)
        g = g.select(F.lit(fs).alias("feature_set"), "coordinate", "n_rows", (F.abs("gradient") <= STATIONARY * F.col("scale")).alias("stationary"))
        out = g if out is None else out.unionByName(g)
    return out


@register("cv_rows", fq("""
SELECT s.feature_set, s.learner, k.fold, count(*) AS n_rows, CAST(sum(f.nbe) AS BIGINT) AS n_positive
FROM feats f JOIN pfold k USING (anonymous_patient_id), (SELECT * FROM (VALUES ('baseline'), ('enhanced')) a(feature_set),
     (VALUES ('logistic_regression'), ('random_forest'), ('gbt')) b(learner)) s
GROUP BY s.feature_set, s.learner, k.fold""", _FOLDS))
def q_cv_rows(spark, d):
    """Rows and labels of every held-out fold of the cross-validations, by the counted tables they score."""
    out = None
    for fs in ("baseline", "enhanced"):
        counted, _, held = M.count_rows(M.complete_rows(folded(spark, d, fs), fs, keep=("fold",)), fs, ("fold",))
        held.unpersist()
        per = counted.groupBy("fold").agg(F.sum("weight").cast("long").alias("n_rows"), F.sum(F.col("weight") * F.col("label")).cast("long").alias("n_positive"))
        per = per.select(F.lit(fs).alias("feature_set"), F.explode(F.array(*map(F.lit, M.LEARNERS))).alias("learner"), "fold", "n_rows", "n_positive")
        out = per if out is None else out.unionByName(per)
    return out
