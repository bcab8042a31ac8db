"""Invariants and agreement between the scale paths and the simple paths."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from consult.functions.grouprank import rank_within
from consult.functions.prefix import dense_index, prefix_sums
from consult.operators import metrics as X
from consult.operators import pseudonym as A
from consult.operators import split as SP
from consult.plans import catalog as CAT
from tests.conftest import SF_SMALL


def test_prefix_range_path_equals_window(spark):
    df = spark.range(0, 20011).select((F.col("id") * 7919 % 20011).alias("k"))
    a = df.select("k", F.row_number().over(Window.orderBy("k")).cast("long").alias("idx"))
    b = dense_index(df, ["k"], num_partitions=6).select("k", "idx")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert b.agg(F.min("idx"), F.max("idx")).first() == (1, 20011)


def _plain_rank(df, keys, order, out, total):
    w = Window.partitionBy(*keys)
    o = [F.col(c).asc_nulls_last() for c in order]
    return df.select("*", F.row_number().over(w.orderBy(*o)).cast("long").alias(out),
                     F.count(F.lit(1)).over(w).alias(total))


@pytest.mark.parametrize("hot_key", [0, None])
@pytest.mark.parametrize("tied", [False, True])
def test_rank_within_equals_window(spark, hot_key, tied):
    # One key holds 60 % of the rows; the first order column has nulls or is one value throughout.
    t = F.lit(5).cast("long") if tied else F.when(F.col("id") % 11 > 0, F.col("id") * 31 % 997)
    rows = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 6, F.lit(hot_key).cast("long")).otherwise(F.col("id") % 7 + 1).alias("g"),
        t.alias("t"), F.col("id"))
    want = _plain_rank(rows, ["g"], ["t", "id"], "r", "n")
    got = rank_within(rows, ["g"], ["t", "id"], out="r", total_out="n", num_partitions=6)
    assert got.count() == 5000
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0


def test_rank_within_one_group_and_no_rows(spark):
    rows = spark.range(0, 1000).select(F.lit("a").alias("g"), F.lit(None).cast("int").alias("h"), "id")
    got = rank_within(rows, ["g", "h"], ["id"], out="r", total_out="n", num_partitions=6)
    assert got.where(F.col("r") != F.col("id") + 1).count() == 0 and got.where("n <> 1000").count() == 0
    assert rank_within(rows.limit(0), ["g"], ["id"], out="r", total_out="n").count() == 0


def test_mapping_is_bijection(spark):
    an = CAT.anon(spark, SF_SMALL)
    m = A.build_id_mapping(CAT.cleaned(spark, SF_SMALL))
    n = m.count()
    assert m.agg(F.min("anonymous_id"), F.max("anonymous_id"), F.count_distinct("anonymous_id")).first() == (1, n, n)
    assert all(r["passed"] for r in A.validate_mapping(CAT.cleaned(spark, SF_SMALL), an, m).collect())


def test_split_has_no_shared_patient(spark):
    f = CAT.feats(spark, SF_SMALL)
    sp = SP.stratified_patient_split(f)
    tr = SP.split_rows(f, sp, "train").select("anonymous_patient_id").distinct()
    te = SP.split_rows(f, sp, "test").select("anonymous_patient_id").distinct()
    assert tr.join(te, "anonymous_patient_id").count() == 0
    assert tr.count() + te.count() == f.select("anonymous_patient_id").distinct().count()


def test_split_is_the_same_over_any_partitions(spark):
    f = CAT.feats(spark, SF_SMALL)
    a = SP.stratified_patient_split(f, num_partitions=1)
    b = SP.stratified_patient_split(f, num_partitions=6)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_missing_id_fails_instead_of_vanishing(spark):
    c = CAT.cleaned(spark, SF_SMALL)
    part = c.withColumn("accident_number", F.when(F.col("p_score") > 1, F.col("accident_number")))
    m = A.build_id_mapping(part)
    with pytest.raises(Exception, match="Anonymization failed"):
        A.apply_mapping(part, m).select("anonymous_patient_id").collect()
    kept = A.apply_mapping(part, m, strict=False)
    missing = part.where("accident_number IS NULL").count()
    assert missing > 0 and A.unmapped_rows(part, m).count() == missing
    assert kept.count() == part.count() and kept.where("anonymous_patient_id IS NULL").count() == missing


def test_metric_invariants(spark):
    s = CAT.scored(spark, SF_SMALL)
    cm = X.confusion_matrix(s).first()
    assert sum(cm) == s.count()
    auc = X.auc_roc(s).first()[0]
    inv = X.auc_roc(s.withColumn("score", -F.col("score"))).first()[0]
    assert 0 <= auc <= 1 and abs(auc + inv - 1) < 1e-6


def test_curve_range_path_equals_window(spark):
    s = CAT.scored(spark, SF_SMALL)
    c = X.score_counts(s)
    w = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    a = c.select("score", F.sum("pos").over(w).alias("cum_pos"), F.sum("neg").over(w).alias("cum_neg"))
    b = X.running_counts(c, num_partitions=3).select("score", "cum_pos", "cum_neg")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_grouped_folds_keep_patients_together(spark):
    f = CAT.feats(spark, SF_SMALL)
    folds = SP.assign_folds(f)
    assert folds.groupBy("anonymous_patient_id").agg(F.count_distinct("fold").alias("k")) \
        .where("k > 1").count() == 0
    assert sorted(r[0] for r in folds.select("fold").distinct().collect()) == [0, 1, 2, 3, 4]


def test_consultation_number_equals_window(spark):
    from consult.operators import features as FT
    f = FT.add_days_since_accident(CAT.cleaned(spark, SF_SMALL))
    order = ["contact_date", *[c for c in f.columns if c not in ("accident_number", "contact_date")]]
    names = [*f.columns, "consultation_number", "total_consultations_for_patient"]
    want = _plain_rank(f, ["accident_number"], order, *names[-2:])
    got = FT.add_consultation_sequence(f, key="accident_number", num_partitions=6).select(*names)
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0
