"""Scans over groups of any size against plain windows; rules and trajectories on small tables."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from consult.functions.groupscan import scan_within
from consult.operators import longitudinal as L

SCHEMA = "accident_number string, accident_date date, contact_date date, fl_score int, fl_status int, p_score int, p_status int, nbe int"


@pytest.fixture(scope="module")
def hot(spark):
    """One patient holds most rows and fills several ranges; another has no id; values are missing."""
    key = F.when(F.col("id") % 10 < 7, F.lit("hot")).when(F.col("id") % 10 == 7, F.lit(None)).otherwise(F.concat(F.lit("p"), (F.col("id") % 40).cast("string")))
    return spark.range(3000).select(
        key.alias("k"), (F.hash("id") % 500).alias("t"), "id",
        F.when(F.col("id") % 11 != 0, F.col("id") % 97).alias("v")).repartition(5)


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_scan_equals_plain_window(hot, parts):
    got = scan_within(hot, ["k"], ["t", "id"], number="n", previous={"before": "v", "was": F.col("id") + 1}, running={"s": "v", "q": F.col("v") * F.col("v")}, num_partitions=parts)
    w = Window.partitionBy("k").orderBy(F.col("t").asc_nulls_last(), F.col("id"))
    want = hot.select("*", F.row_number().over(w).cast("bigint").alias("n"), F.lag("v").over(w).alias("before"), F.lag(F.col("id") + 1).over(w).alias("was"),
                      F.sum(F.coalesce("v", F.lit(0))).over(w).alias("s"), F.sum(F.coalesce(F.col("v") * F.col("v"), F.lit(0))).over(w).alias("q"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_scan_of_nothing(hot):
    assert scan_within(hot.limit(0), ["k"], ["t"], number="n", previous={"p": "v"}, running={"s": "v"}).count() == 0


def day(n):
    return dt.date(2025, 1, 1) + dt.timedelta(days=n)


@pytest.fixture(scope="module")
def rows(spark):
    a = [("x", day(0), day(3), 2, 1, 3, 1, 1), ("x", day(0), day(3), 2, 1, 4, 0, 1), ("x", day(1), day(400), 3, 2, 1, 2, 0), ("x", day(1), None, 3, 1, 1, 1, None),
         ("y", day(9), day(5), 4, 1, 0, 1, 0), (None, day(0), day(1), 1, 1, 1, 1, 1), (None, day(0), day(2), 0, 0, 2, 2, 1)]
    return spark.createDataFrame(a, SCHEMA)


def test_days_between(rows):
    got = {(r.accident_number, r.consultation_number): r.days_since_previous for r in L.days_between_consultations(rows, key="accident_number").collect()}
    assert got == {("x", 1): None, ("x", 2): 0, ("x", 3): 397, ("x", 4): None, ("y", 1): None, (None, 1): None, (None, 2): 1}


def test_rules(rows):
    got = {(r.accident_number, r.consultation_number, r.rule): (r.observed, r.expected) for r in L.consistency_violations(rows, num_partitions=3).collect()}
    assert got == {
        ("x", 2, "one_contact_a_day"): (0.0, 1.0), ("x", 3, "function_status_follows_score"): (2.0, 0.0), ("x", 3, "accident_date_constant"): (1.0, 0.0),
        ("x", 3, "recovery_not_withdrawn"): (0.0, 1.0), ("x", 3, "no_long_gap"): (397.0, 365.0), ("y", 1, "contact_after_accident"): (-4.0, 0.0),
        (None, 2, "function_status_follows_score"): (0.0, 2.0), (None, 2, "pain_status_follows_score"): (2.0, 0.0)}
    counts = {r.rule: (r.n_checked, r.n_violations, r.n_patients) for r in L.consistency_summary(rows).collect()}
    assert counts["function_status_follows_score"] == (4, 2, 2) and counts["recovery_not_withdrawn"] == (3, 1, 1) and counts["contact_after_accident"] == (6, 1, 1)


def test_own_rules(rows):
    rule = L.Rule("score_jump", "logical", F.col("previous_p_score").isNotNull(), F.abs(F.col("p_score") - F.col("previous_p_score")) < 3, F.col("p_score"), F.col("previous_p_score"))
    assert [(r.accident_number, r.consultation_number) for r in L.consistency_violations(rows, rules=[rule]).collect()] == [("x", 3)]


def test_trajectory(rows):
    got = {(r.accident_number, r.consultation_number): r for r in L.patient_trajectory(rows, key="accident_number").collect()}
    assert got["x", 1].p_score_slope is None and got["x", 2].p_score_slope is None and got["x", 2].mean_p_score == 3.5
    # Days 3, 3, 399 with scores 3, 4, 1: the row without a date counts for the mean only.
    assert got["x", 3].p_score_slope == got["x", 4].p_score_slope == pytest.approx(-2.5 / 396, abs=1e-6) and got["x", 4].mean_p_score == 2.25
    one = {r.accident_number: r for r in L.patient_averages(rows, key="accident_number").collect()}
    assert (one["x"].n_consultations, one["x"].p_score_change, one["x"].mean_days_between) == (4, -2, 198.5) and one[None].fl_score_change == -1
