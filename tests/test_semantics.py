
import datetime as dt

from pyspark.sql import functions as F

from consult.functions.exprs import clamp_negative, whole_days
from consult.operators import cleaning as C
from consult.operators import features as FT
from consult.operators import metrics as X
from consult.operators import quality as Q
from consult.operators import rules as V


def test_t1_null_is_not_a_range_violation(spark):
    df = spark.createDataFrame([(None,), (5,), (2,)], "p_score int")
    r = {x["feature"]: x for x in Q.range_violations(df, {"p_score": (0, 4)}).collect()}
    assert r["p_score"]["n_violations"] == 1


def test_t2_flag_on_missing_is_zero(spark):
    df = spark.createDataFrame([(None, 2, 3, 3)], "p_status int, fl_status int, p_score int, fl_score int")
    r = FT.add_interactions(df).first()
    assert r["both_improving"] == 0 and r["high_severity"] == 1
    assert r["p_status_fl_status_interaction"] is None  # T3 arithmetic on missing


def test_t4_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-3,), (None,), (4,)], "d int")
    assert [r[0] for r in df.select(clamp_negative(F.col("d"))).collect()] == [0, None, 4]


def test_t5_sub_day_timestamp_floor(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 0), dt.datetime(2024, 1, 2, 1, 0))],
                               "a timestamp, c timestamp")
    d = df.select(whole_days(F.col("c"), F.col("a"), T.TimestampType(), T.TimestampType())).first()[0]
    assert d == 0


def test_t9_mode_smallest_on_tie(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (2, 1), (2, 0)], "anonymous_patient_id long, nbe int")
    r = {x[0]: x[1] for x in FT.patient_label(df).collect()}
    assert r == {1: 0, 2: 1}


def test_t12_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "accident_number string, nbe int")
    s = Q.dataset_summary(df).first()
    assert s["duplicate_rows"] == 1 and s["unique_patients"] == 2
    prof = {r["metric"]: r["value"] for r in Q.duplicate_profile(df).collect()}
    assert prof["patient_level_duplicates"] == 3


def test_t13_constant_column_gives_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (1, 2)], "p_score int, nbe int")
    r = Q.label_correlation(df, cols=["p_score"]).first()
    assert r["r"] is None


def test_t14_coercion_rejects_bad_text(spark):
    df = spark.createDataFrame([("3", "2024-01-05"), ("n/a", "unknown"), ("2.0", "2024-02-30")],
                               "p_score string, contact_date string")
    r = C.coerce_types(df).collect()
    assert [x["p_score"] for x in r] == [3, None, 2]
    assert r[0]["contact_date"] == dt.datetime(2024, 1, 5) and r[1]["contact_date"] is None
    assert r[2]["contact_date"] is None


def test_fractions_and_times_of_day_survive_clean(spark):
    row = ("a", "2024-01-01 23:00:00", "2024-01-02 01:00:00", "2.5", "1", "3", "1", "1")
    df = spark.createDataFrame([row], "accident_number string, accident_date string, contact_date string, fl_score string, "
                               "fl_status string, p_score string, p_status string, nbe string")
    r = FT.add_days_since_accident(C.clean(df)).first()
    assert r["fl_score"] == 2.5 and r["days_since_accident"] == 0


def test_exact_quantiles_equal_percentile(spark):
    from consult.functions.quantiles import exact_quantiles
    rows = spark.range(0, 4000).select(
        F.when(F.col("id") % 3 > 0, F.lit("a")).when(F.col("id") % 7 > 0, F.lit(None)).otherwise(F.lit("b")).alias("g"),
        F.when(F.col("id") % 5 > 0, (F.col("id") * 37 % 1009).cast("double") / 8).alias("v"))
    n = rows.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = exact_quantiles(n, ["g"], {"q1": 0.25, "p99": 0.99}, value="v")
    want = rows.groupBy("g").agg(F.percentile("v", 0.25).alias("q1"), F.percentile("v", 0.99).alias("p99"))
    r = lambda d: {x["g"]: (round(x["q1"], 9), round(x["p99"], 9)) for x in d.collect()}
    assert r(got) == r(want) and len(r(got)) == 3


def test_t16_tied_dates_total_order(spark):
    rows = [(1, dt.date(2024, 1, 1), dt.date(2024, 1, 3), 1, 1, 1, 1, 1),
            (1, dt.date(2024, 1, 1), dt.date(2024, 1, 3), 0, 1, 1, 1, 1),
            (1, dt.date(2024, 1, 1), dt.date(2024, 1, 2), 4, 1, 1, 1, 0)]
    df = spark.createDataFrame(rows, "anonymous_patient_id long, accident_date date, contact_date date, "
                                     "fl_score int, fl_status int, p_score int, p_status int, nbe int")
    r = FT.add_consultation_sequence(df).orderBy("consultation_number").collect()
    assert [x["fl_score"] for x in r] == [4, 0, 1]
    assert all(x["total_consultations_for_patient"] == 3 for x in r)


def test_single_class_confusion_is_zero_safe(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.2)], "label int, score double")
    cm = X.confusion_matrix(df).first()
    assert (cm["tn"], cm["fp"], cm["fn"], cm["tp"]) == (0, 0, 1, 1)
    tm = X.threshold_metrics(df).first()
    assert tm["specificity"] == 0.0 and tm["recall"] == 0.5


def test_empty_frame_profiles(spark):
    df = spark.createDataFrame([], "accident_number string, p_score int, nbe int")
    assert Q.dataset_summary(df).first()["n_rows"] is None or Q.dataset_summary(df).count() <= 1
    assert Q.missing_profile(df).count() == 3


def test_confidence_bands(spark):
    df = spark.createDataFrame([(0.9,), (0.75,), (0.6,), (0.15,)], "nbe_yes_probability double")
    assert [r[-1] for r in V.add_confidence(df).collect()] == ["high", "medium", "low", "high"]


def test_temporal_message_rounding(spark):
    df = spark.createDataFrame([(7, 20, 1, 1, 1, 1)],
                               "days_since_accident int, consultation_number int, p_score int, p_status int, "
                               "fl_score int, fl_status int")
    w, _ = V.temporal_messages()
    msg = df.select(w).first()[0][0]
    assert "(avg " + "%.1f" % (7 / 20) + " days" in msg


def test_d3_missing_value_recommendation_only_when_missing(spark):
    from consult.sources import fixtures as FX
    from tests.conftest import SF_SMALL
    clean = FX.consultations(spark, SF_SMALL)          # no nulls
    recs = {r["metric"] for r in Q.exploration_summary(clean).where("section = 'recommendations'").collect()}
    assert "missing_values" not in recs
    typed = C.coerce_types(FX.consultations_raw(spark, SF_SMALL))   # has nulls
    recs = {r["metric"] for r in Q.exploration_summary(typed).where("section = 'recommendations'").collect()}
    assert "missing_values" in recs


def test_coerce_rejects_match_new_nulls(spark):
    from consult.sources import fixtures as FX
    from tests.conftest import SF_SMALL
    raw = FX.consultations_raw(spark, SF_SMALL)
    rej = {r["column_name"]: r["n_rejected"] for r in C.coerce_rejects(raw).collect()}
    typed = C.coerce_types(raw)
    for c in ("contact_date", "p_score"):
        new_nulls = typed.where(F.col(c).isNull()).count() - raw.where(F.col(c).isNull()).count()
        assert rej[c] == new_nulls and rej[c] > 0
