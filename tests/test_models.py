"""Learners: quality floor on the derived label, reproducibility, round trip."""

import pytest
from pyspark.sql import functions as F

from consult.operators import metrics as X
from consult.operators import models as M
from consult.plans.prepare import build_datasets
from consult.sources import fixtures as FX
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def ds(spark):
    d = build_datasets(FX.consultations(spark, SF_SMALL))
    return {k: d[k].cache() for k in ("baseline_train", "baseline_test", "enhanced_train", "enhanced_test")}


@pytest.mark.parametrize("learner", ["logistic_regression", "random_forest"])
def test_auc_floor(ds, learner):
    m = M.fit(ds["baseline_train"], learner, "baseline")
    sc = M.predict(m, ds["baseline_test"], "baseline")
    auc = X.auc_roc(sc.select(F.col("nbe").alias("label"), "score")).first()[0]
    assert auc > 0.7


def test_same_seed_same_forest(ds):
    a = M.fit(ds["enhanced_train"], "random_forest", "enhanced").stages[-1].featureImportances
    b = M.fit(ds["enhanced_train"], "random_forest", "enhanced").stages[-1].featureImportances
    assert a == b


def test_feature_count_guard():
    with pytest.raises(M.FeatureCountError):
        M.feature_count_guard("baseline", ["p_score"])


def test_save_load_round_trip(spark, ds, tmp_path):
    m = M.fit(ds["baseline_train"], "logistic_regression", "baseline")
    M.save_model(m, str(tmp_path), "logistic_regression", "baseline", run_id="r1")
    M.save_model(m, str(tmp_path), "logistic_regression", "baseline", run_id="r2")
    again = M.load_latest(spark, str(tmp_path), "logistic_regression", "baseline")
    a = M.predict(m, ds["baseline_test"], "baseline").select("score")
    b = M.predict(again, ds["baseline_test"], "baseline").select("score")
    assert a.exceptAll(b).count() == 0


def test_scoring_defaults_and_bands(spark, ds):
    from consult.streaming.scoring import score_batch
    m = M.fit(ds["enhanced_train"], "logistic_regression", "enhanced")
    req = spark.createDataFrame([("a", 2, 1, 3, 2, None, None, "detailed"), ("b", 5, 1, 3, 2, 21, 2, "minimal")],
                                "request_id string, p_score int, p_status int, fl_score int, fl_status int, "
                                "days_since_accident int, consultation_number int, response_type string")
    ok, bad = score_batch(req, m, "enhanced", "logistic_regression")
    r = ok.first()
    assert r["request_id"] == "a" and r["days_since_accident"] == 21 and r["consultation_number"] == 2
    assert abs(r["nbe_yes_probability"] + r["nbe_no_probability"] - 1) < 1e-9
    assert [x["request_id"] for x in bad.collect()] == ["b"]


def test_predict_keeps_rows_with_a_missing_feature(ds):
    m = M.fit(ds["enhanced_train"], "logistic_regression", "enhanced")
    test = ds["enhanced_test"].withColumn(
        "days_since_accident", F.when(F.col("p_score") > 0, F.col("days_since_accident")))
    sc = M.predict(m, test, "enhanced")
    missing = test.where("days_since_accident IS NULL").count()
    assert missing > 0 and sc.count() == test.count() and sc.where("score IS NULL").count() == missing
    ev = X.evaluate_all(sc.select(F.lit("m").alias("model"), F.lit("e").alias("feature_set"),
                                  F.col("nbe").alias("label"), "score")).first()
    assert ev["n_rows"] == test.count() - missing == ev["tn"] + ev["fp"] + ev["fn"] + ev["tp"]


def test_one_failing_learner_does_not_stop_the_rest(ds):
    models, summary = M.train_all({"baseline": ds["baseline_train"]}, ["logistic_regression", "absent"], with_cv=False)
    rows = {r["learner"]: r for r in summary.collect()}
    assert list(models) == [("logistic_regression", "baseline")]
    assert rows["logistic_regression"]["error"] is None and "absent" in rows["absent"]["error"]


def test_metadata_reaches_the_registry(spark, ds, tmp_path):
    models, meta = M.train_all({"baseline": ds["baseline_train"]}, ["logistic_regression"])
    row = meta.first().asDict()
    assert len(row["cv_scores"]) == 5 and abs(sum(row["cv_scores"]) / 5 - row["cv_mean"]) < 1e-6
    for _ in range(2):  # saving again replaces the row
        M.save_model(models["logistic_regression", "baseline"], str(tmp_path), "logistic_regression", "baseline",
                     run_id="20250612", summary_row=row)
    kept = M.registry(spark, str(tmp_path)).collect()
    assert len(kept) == 1 and kept[0]["run_id"] == "20250612"
    assert set(kept[0]["importances"]) == set(kept[0]["features"]) == set(M.FEATURE_SETS["baseline"])
    info = M.model_info(M.registry(spark, str(tmp_path))).first()
    assert info["training_samples"] == ds["baseline_train"].count() and info["trained_at"] == row["trained_at"]


def test_counted_rows_fit_like_single_rows(ds):
    """Weighted distinct rows give the model that the rows themselves give."""
    from pyspark.ml import Pipeline
    cols = M.FEATURE_SETS["baseline"]
    rows = M.complete_rows(ds["baseline_train"], "baseline").withColumn("weight", F.lit(1.0))
    for learner, near in (("logistic_regression", 1e-5), ("gbt", 1e-2)):
        single = M.mirrored(rows, "baseline") if learner == "logistic_regression" else rows
        plain = Pipeline(stages=[M._assembler("baseline", learner), M.make_learner(learner, rows.count())]).fit(single)
        a = M.predict(plain, ds["baseline_test"], "baseline").select(*cols, "score").distinct()
        b = M.predict(M.fit(ds["baseline_train"], learner, "baseline"), ds["baseline_test"], "baseline")
        b = b.select(*cols, F.col("score").alias("other")).distinct()
        assert a.join(b, cols).agg(F.max(F.abs(F.col("score") - F.col("other")))).first()[0] < near


def test_cross_validation_leaves_the_callers_cache(ds):
    from consult.operators.split import assign_folds
    folded = assign_folds(ds["baseline_train"]).cache()
    M.cross_validate(folded, "logistic_regression", "baseline")
    assert folded.storageLevel.useMemory


def test_metrics_keep_the_group_without_a_name(spark):
    rows = spark.createDataFrame([(m, y, s) for m in ("a", None) for y, s in ((0, 0.25), (1, 0.75), (1, 0.25))],
                                 "model string, label int, score double")
    got = X.evaluate_all(rows.withColumn("feature_set", F.lit(None).cast("string"))).collect()
    assert sorted(str(r["model"]) for r in got) == ["None", "a"] and len({r["auc_roc"] for r in got}) == 1


def test_bags_of_counted_rows(spark):
    """Draws follow the row's values, not its place, with the mean and variance of single draws."""
    rows = spark.range(400).select(F.col("id").cast("double").alias("x"), F.lit(1.0).alias("label"), F.lit(50.0).alias("weight"))
    a = M.draw_bags(rows.repartition(3), 20, 1.0, True, 42)
    b = M.draw_bags(rows.coalesce(1), 20, 1.0, True, 42)
    assert a.exceptAll(b).count() == 0
    r = a.select(F.explode("draws").alias("n")).agg(F.avg("n").alias("mean"), F.variance("n").alias("var")).first()
    assert abs(r["mean"] - 50) < 0.5 and abs(r["var"] - 50) < 5
    assert set(M.draw_bags(rows.limit(5), 3, 1.0, False, 42).select(F.explode("draws")).distinct().toPandas()["col"]) == {50}


def test_forest_of_counted_rows_is_the_forest_of_single_rows(ds, monkeypatch):
    cols = M.FEATURE_SETS["baseline"]
    single = M.fit(ds["baseline_train"], "random_forest", "baseline", numTrees=20)
    monkeypatch.setattr(M, "SINGLE_ROWS", 0)
    bagged = M.fit(ds["baseline_train"], "random_forest", "baseline", numTrees=20)
    assert bagged.stages[-1].getNumTrees == 20
    a = M.predict(single, ds["baseline_test"], "baseline").select(*cols, "score").distinct()
    b = M.predict(bagged, ds["baseline_test"], "baseline").select(*cols, F.col("score").alias("other")).distinct()
    assert a.join(b, cols).agg(F.avg(F.abs(F.col("score") - F.col("other")))).first()[0] < 0.05


def test_forest_reads_counts_not_rows(spark):
    """Eight billion rows in eight: a forest that read single rows would not end."""
    rows = [(float(p), 1.0, float(f), 0.0, float(p), 1.0, 1e9 if p == f else 1e9 + 1) for p in (0, 1) for f in (0, 1, 2, 3)]
    counted = spark.createDataFrame(rows, [*M.FEATURE_SETS["baseline"], "label", M.BIAS, "weight"])
    m = M.fit_forest(counted, "baseline", numTrees=4, featureSubsetStrategy="all")
    assert M.importances(m, "baseline")["p_score"] > 0.99


def test_forest_runs_one_job_a_level_not_a_fit_a_tree(spark, ds):
    def jobs_so_far(group):
        spark.sparkContext.setJobGroup(group, group)
        spark.sparkContext.parallelize([1], 1).count()
        return max(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    counted, _, held = M.count_rows(M.complete_rows(ds["baseline_train"], "baseline"), "baseline")
    before = jobs_so_far("before-forest")
    m = M.fit_forest(counted, "baseline", numTrees=60)
    assert jobs_so_far("after-forest") - before < 100 and m.stages[-1].getNumTrees == 60
    held.unpersist()


def test_tree_of_counted_rows_is_sparks_tree(spark, ds):
    """Without bags and random features the one tree is that of Spark over single rows, and it survives saving."""
    from pyspark.ml import Pipeline
    cols, own = M.FEATURE_SETS["baseline"], {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all", "maxDepth": 5}
    rows = M.complete_rows(ds["baseline_train"], "baseline")
    counted, _, held = M.count_rows(rows, "baseline")
    a = Pipeline(stages=[M._assembler("baseline", "random_forest"), M.make_learner("random_forest", 0, **own)]).fit(rows)
    b = M.fit_forest(counted, "baseline", **own)
    held.unpersist()
    assert b.stages[-1].numFeatures == 4 and b.stages[-1].trees[0].depth == a.stages[-1].trees[0].depth
    x = M.predict(a, ds["baseline_test"], "baseline").select(*cols, "score").distinct()
    y = M.predict(b, ds["baseline_test"], "baseline").select(*cols, F.col("score").alias("other")).distinct()
    assert x.join(y, cols).agg(F.avg(F.abs(F.col("score") - F.col("other")))).first()[0] < 1e-3
