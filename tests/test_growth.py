"""Figures that must not grow with the input: joins through the driver, repeated counts, batches of a replay, rows of a boosted fit."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from consult import schema as S
from consult import session
from consult.operators import models as M
from consult.operators import split as SP
from consult.operators.features import add_consultation_sequence, add_interactions
from consult.plans import prepare
from consult.plans.prepare import build_datasets, tagged_rows
from consult.streaming import runner


def _cleaned(spark, patients=40, rows=6):
    n = spark.range(patients * rows)
    p, r = (F.col("id") % patients).cast("int"), (F.col("id") / patients).cast("int")
    day = F.to_date(F.lit("2024-01-01"))
    return n.select(F.concat(F.lit("P"), p.cast("string")).alias("accident_number"), day.alias("accident_date"), F.date_add(day, r * 3 + p % 5).alias("contact_date"),
                    ((p + r) % 5).alias("fl_score"), (r % 3).alias("fl_status"), ((p * 3 + r) % 5).alias("p_score"), (p % 3).alias("p_status"), ((p + r) % 2).alias("nbe"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_meet_patients_in_one_join_that_is_not_broadcast(spark):
    rows, _, _ = tagged_rows(_cleaned(spark))
    # Ranking broadcasts one row a partition; a join on an id must not be one.
    assert "SortMergeJoin" in _plan(rows) and not re.search(r"BroadcastHashJoin \[(cast\()?(accident_number|__k|anonymous)", _plan(rows))
    ds = build_datasets(_cleaned(spark), is_clean=True)
    assert all("Join" not in _plan(ds[k]) for k in ("baseline_train", "baseline_test", "enhanced_train", "enhanced_test"))


def test_tagged_rows_have_the_split_and_folds_of_the_operators(spark):
    rows, mapping, split = tagged_rows(_cleaned(spark))
    rows = rows.persist()
    plain = build_datasets(_cleaned(spark), is_clean=True, materialize=False)
    cols = plain["features"].columns
    assert rows.select(*cols).exceptAll(plain["features"]).isEmpty() and rows.count() == plain["features"].count()
    assert mapping.exceptAll(plain["mapping"]).isEmpty() and split.exceptAll(plain["split"]).isEmpty()
    train = plain["baseline_train"]
    own = rows.where("split = 'train'").select(*train.columns, "fold")
    assert own.exceptAll(SP.assign_folds(train)).isEmpty() and own.count() == train.count()


def test_rows_are_written_once_before_they_meet_their_patients(spark, monkeypatch):
    plain, written = session.stage, []

    def noted(df, name):
        out = plain(df, name)
        written.append((name, out.count()))
        return out
    monkeypatch.setattr(session, "stage", noted)
    monkeypatch.setattr(prepare, "stage", noted)
    rows, _, _ = tagged_rows(_cleaned(spark))
    # 240 rows of 40 patients, in 8 ranges: all else is one row a patient, or two where a range ends.
    assert [name for name, n in written if n > 48] == ["ranked"] and rows.count() == 240


def test_place_in_the_sequence_of_a_patient_that_spans_ranges(spark):
    who = F.when(F.col("accident_number") > "P12", "P500").otherwise(F.col("accident_number"))
    cleaned = _cleaned(spark).withColumn("accident_number", F.when(F.col("accident_number") != "P0", who)).distinct()
    rows, _, _ = tagged_rows(cleaned)
    seq = ["consultation_number", "is_first_consultation", "is_follow_up", "total_consultations_for_patient"]
    values = [c for c in cleaned.columns if c != "accident_number"]
    want = add_consultation_sequence(cleaned, key="accident_number").select(*values, *seq)
    # The rows without an id are numbered too; only their pseudonym fails.
    assert rows.select(*values, *seq).exceptAll(want).isEmpty() and rows.select(*seq).count() == want.count()
    with pytest.raises(Exception, match="id missing"):
        rows.select(S.PSEUDO_ID).collect()


def test_counted_table_outlives_its_unpersist_without_a_second_count(spark):
    rows = M.complete_rows(_cleaned(spark), "baseline")
    counted, n, held = M.count_rows(rows, "baseline")
    held.unpersist()
    assert "HashAggregate" not in _plan(counted) and counted.agg(F.sum("weight")).first()[0] == n == 240


def test_larger_replay_has_wider_ranges_not_more(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runner, "SLICE_ROWS", 10)
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, start + dt.timedelta(seconds=i)) for i in range(1000)], "id long, ts timestamp")
    slices = [s.agg(F.count("*"), F.min("id"), F.max("id")).first() for s in runner.time_slices(df, f"{tmp_path}/s")]
    assert len(slices) <= runner.MOST_SLICES and sum(s[0] for s in slices) == 1000
    assert all(a[2] < b[1] for a, b in zip(slices, slices[1:]) if a[0] and b[0])


def test_boosted_fit_reads_bins_and_scores_like_the_plain_fit(spark):
    rows = _cleaned(spark, 60, 60).select("*", F.datediff("contact_date", "accident_date").alias("days_since_accident"), (F.col("fl_score") + 1).alias("consultation_number"))
    rows = add_interactions(rows).withColumn("days_since_accident", F.col("days_since_accident") * 7)
    counted, n, _ = M.count_rows(M.complete_rows(rows, "enhanced"), "enhanced")
    found = M.bin_thresholds(counted, "enhanced")
    assert max(map(len, found.values())) <= M.BINS and len(found["days_since_accident"]) >= 25
    binned = M.fit(rows, "gbt", "enhanced", maxIter=5)
    plain = M.Pipeline(stages=[M._assembler("enhanced", "gbt"), M.make_learner("gbt", n, maxIter=5)]).fit(counted)
    wide = rows.unionByName(rows.withColumn("days_since_accident", F.col("days_since_accident") + 3)).withColumn("id", F.monotonically_increasing_id()).persist()
    a, b = (M.predict(m, wide, "enhanced").select("id", F.round("score", 9).alias("s")) for m in (binned, plain))
    assert a.exceptAll(b).isEmpty() and a.count() == 7200
