"""Calibration, drift, grid search and the logistic optimum on small tables."""

import math

import pytest
from pyspark.sql import functions as F

from consult.operators import calibration as K
from consult.operators import drift as D
from consult.operators import models as M

SCORED = "model string, label int, score double"


def test_equal_scores_share_a_bin(spark):
    rows = [("m", i % 2, 0.2) for i in range(50)] + [("m", 1, 0.5 + i / 100) for i in range(10)] + [("n", 0, 1.0), ("n", 1, 0.0), (None, 1, 0.3), ("m", 1, None)]
    df = spark.createDataFrame(rows, SCORED)
    got = {(r.model, r.bin): (r.n_rows, r.n_positive) for r in K.calibration_curve(df, ["model"], n_bins=4, strategy="quantile").collect()}
    # 50 of 60 rows tie at the least score; the rest begin at 50 / 60 of the mass, in the last bin.
    assert got == {("m", 0): (50, 25), ("m", 3): (10, 10), ("n", 0): (1, 1), ("n", 2): (1, 0), (None, 0): (1, 1)}
    even = {(r.model, r.bin): r.n_rows for r in K.calibration_curve(df, ["model"], n_bins=4).collect()}
    assert even == {("m", 0): 50, ("m", 2): 10, ("n", 3): 1, ("n", 0): 1, (None, 1): 1}
    with pytest.raises(ValueError):
        K.calibration_curve(df, strategy="other")


def test_murphy_parts_add_up(spark):
    df = spark.range(500).select(F.lit("m").alias("model"), (F.hash("id") % 3 == 0).cast("int").alias("label"), (F.col("id") % 16 / 16).alias("score"))
    r = K.brier_score(df, ["model"]).first()
    assert r.brier_score == pytest.approx(r.reliability - r.resolution + r.uncertainty, abs=3e-6)
    rows = df.collect()
    assert r.brier_score == pytest.approx(sum((x.score - x.label) ** 2 for x in rows) / 500, abs=1e-6) and r.n_rows == 500
    assert K.brier_score(df.limit(0), ["model"]).count() == 0


def brute_drift(a, b, n_bins=10):
    xs, ys = sorted(x for x in a if x is not None), sorted(y for y in b if y is not None)
    ks = max(abs(sum(x <= v for x in xs) / len(xs) - sum(y <= v for y in ys) / len(ys)) for v in {*xs, *ys})
    place = lambda v: min(sum(x < v for x in xs) * n_bins // len(xs), n_bins - 1)
    psi = 0.0
    for k in {place(v) for v in {*xs, *ys}}:
        o, n = (max(sum(place(v) == k for v in side), 0.5) / len(side) for side in (xs, ys))
        psi += (n - o) * math.log(n / o)
    return psi, ks


def test_drift_by_brute_force(spark):
    a = [None if i % 9 == 0 else float(i * i % 40) for i in range(300)]
    b = [None if i % 4 == 0 else float(i * 7 % 55 + 10) for i in range(200)]
    older = spark.createDataFrame([(x, 1) for x in a], "x double, same int")
    newer = spark.createDataFrame([(x, 1) for x in b], "x double, same int")
    got = {r.feature: r for r in D.feature_drift(older, newer, ["x", "same"]).collect()}
    psi, ks = brute_drift(a, b)
    assert got["x"].psi == pytest.approx(psi, abs=1e-6) and got["x"].ks == pytest.approx(ks, abs=1e-6) and got["x"].drift == "major"
    assert (got["same"].psi, got["same"].ks, got["same"].drift) == (0.0, 0.0, "none") and (got["x"].missing_older, got["x"].missing_newer) == (pytest.approx(34 / 300, abs=1e-6), 0.25)
    none = D.feature_drift(older, newer.where("x > 1e9"), ["x"]).first()
    assert none.psi is None and none.ks is None and none.drift is None and none.n_newer == 0


@pytest.fixture(scope="module")
def train(spark):
    p = {c: F.pmod(F.hash("id", F.lit(k)), F.lit(n)) for k, (c, n) in enumerate((("p_score", 5), ("p_status", 3), ("fl_score", 5), ("fl_status", 3)))}
    rows = spark.range(3000).select("id", *[v.alias(c) for c, v in p.items()])
    y = F.col("p_score") + F.col("fl_score") - F.col("p_status") + F.pmod(F.hash("id", F.lit(9)), F.lit(4)) < 6
    return rows.select("*", y.cast("int").alias("nbe"), (F.col("id") % 3).cast("int").alias("fold")).cache()


def test_logistic_optimum_penalises_the_intercept(train):
    model = M.fit(train, "logistic_regression", "baseline")
    g = {r.coordinate: r for r in M.logistic_gradient(model, train, "baseline").collect()}
    assert set(g) == {*M.FEATURE_SETS["baseline"], "intercept"} and all(abs(r.gradient) <= 1e-5 * r.scale for r in g.values()) and g["intercept"].n_rows == 3000
    assert float(model.stages[-1].coefficients[4]) != 0.0 and model.stages[-1].intercept == 0.0


def test_weighted_folds_equal_plain_ones(train):
    from consult.operators.metrics import auc_roc
    got = {r.fold: r.auc for r in M.cross_validate(train, "logistic_regression", "baseline", k=3, parallelism=3).collect()}
    for f in range(3):
        m = M.fit(train.where(F.col("fold") != f), "logistic_regression", "baseline")
        sc = M.predict(m, train.where(F.col("fold") == f), "baseline").select(F.col("nbe").alias("label"), "score")
        assert got[f] == pytest.approx(auc_roc(sc).first()[0], abs=1e-5)


def test_grid_search_picks_the_best(train):
    model, out = M.grid_search(train, "logistic_regression", "baseline", {"regParam": [1e-4, 100.0]}, k=3)
    rows = {r.candidate: r for r in out.collect()}
    assert rows[0].best and not rows[1].best and rows[0].mean_auc >= rows[1].mean_auc and rows[0].params == {"regParam": "0.0001"}
    assert M.predict(model, train, "baseline").where("score IS NULL").isEmpty()
