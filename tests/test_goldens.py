"""Goldens from the reference's published step-1 report (FIXTURES.md §2)."""

import pytest
from pyspark.sql import functions as F

from consult.operators import quality as Q

P_SCORE_COUNTS = {1: 3281, 2: 2448, 0: 891, 3: 805, 4: 38}
NBE_COUNTS = {1: 4171, 2: 2085, 0: 1207}


@pytest.fixture(scope="module")
def pframe(spark):
    rows = [(v,) for v, n in P_SCORE_COUNTS.items() for _ in range(n)]
    return spark.createDataFrame(rows, "p_score int")


def test_p_score_profile(pframe):
    r = Q.feature_profile(pframe, ["p_score"]).first()
    assert round(r["mean_value"], 2) == 1.44
    assert round(r["std_value"], 2) == 0.86
    var = Q.feature_quality(pframe, ["p_score"]).first()["variance"]
    assert abs(var - 0.7315137776274505) < 1e-6


def test_p_score_outliers(pframe):
    r = Q.iqr_outliers(pframe, ["p_score"]).first()
    assert (r["q1"], r["q3"], r["upper_bound"], r["n_outliers"]) == (1.0, 2.0, 3.5, 38)


def test_balance_ratio(spark):
    rows = [(v,) for v, n in NBE_COUNTS.items() for _ in range(n)]
    cb = Q.class_balance(spark.createDataFrame(rows, "nbe int")).collect()
    assert {r["class_value"]: r["n_rows"] for r in cb} == NBE_COUNTS
    assert abs(cb[0]["balance_ratio"] - 3.4556752278376135) < 1e-6


def test_rows_and_patients_shape(spark):
    # 7463 rows over 2379 patients: mean group size 3.14 as published.
    sizes = [3] * 2379
    extra = 7463 - sum(sizes)
    sizes[0] += extra
    rows = [(f"P{i}",) for i, n in enumerate(sizes) for _ in range(n)]
    s = Q.group_size_stats(spark.createDataFrame(rows, "accident_number string")).first()
    assert s["n_groups"] == 2379 and round(s["mean_size"], 2) == 3.14
