"""Sources and sinks: typed stage round trip, newest run, newest file, reports."""

import os
import time

from pyspark.sql import functions as F

from consult import schema as S
from consult.sources import fixtures as FX
from consult.sources import io as IO
from tests.conftest import SF_SMALL


def test_stage_round_trip_and_newest_run(spark, tmp_path):
    c = FX.consultations(spark, SF_SMALL)
    path = str(tmp_path / "stage")
    IO.write_stage(c, path, "20250101")
    IO.write_stage(c.where("nbe IN (0, 1)"), path, "20250612")
    newest = IO.read_stage(spark, path)
    assert newest.count() == c.where("nbe IN (0, 1)").count()
    assert newest.select("run_id").distinct().first()[0] == "20250612"
    assert dict(newest.dtypes)["contact_date"] == "date"
    old = IO.read_stage(spark, path, run_id="20250101")
    assert old.count() == c.count()


def test_latest_file_snapshot(spark, tmp_path):
    raw = FX.consultations_raw(spark, SF_SMALL)
    a, b = str(tmp_path / "drop" / "a"), str(tmp_path / "drop" / "b")
    raw.limit(10).coalesce(1).write.option("header", "true").csv(a)
    time.sleep(1.2)
    raw.limit(25).coalesce(1).write.option("header", "true").csv(b)
    got = IO.latest_file_snapshot(spark, str(tmp_path / "drop" / "*" / "*.csv"))
    assert got.count() == 25


def test_read_consultations_csv_permissive(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text("accident_number,accident_date,contact_date,fl_score,fl_status,p_score,p_status,nbe\n"
                 "P1,2024-01-01,2024-01-05,1,1,2,0,1\nP2,bad,2024-01-05,x,1,2,0,0\n")
    df = IO.read_consultations(spark, str(p), fmt="csv")
    assert df.count() == 2 and [f.name for f in df.schema.fields] == [f.name for f in S.RAW_SCHEMA.fields]


def test_conform_and_reports(spark, tmp_path):
    c = IO.conform(FX.consultations(spark, SF_SMALL))
    assert [(f.name, f.dataType) for f in c.schema.fields] == [(f.name, f.dataType) for f in S.CONSULTATION_SCHEMA.fields]
    IO.write_report(c.groupBy("nbe").count(), str(tmp_path / "rep"))
    assert spark.read.json(str(tmp_path / "rep")).count() == 3


def test_export_datasets_round_trip(spark, tmp_path):
    from consult.plans.prepare import build_datasets, export_datasets
    ds = build_datasets(FX.consultations(spark, SF_SMALL))
    paths = export_datasets(ds, str(tmp_path / "out"), "20250612T114112")
    for name in ("baseline_train", "baseline_test", "enhanced_train", "enhanced_test"):
        back = IO.read_stage(spark, paths[name])
        assert back.count() == ds[name].count()
        assert "anonymous_patient_id" not in back.columns
    m = spark.read.parquet(paths["mapping"])
    assert m.count() == ds["mapping"].count()


def test_rejects_of_text_reads(spark, tmp_path):
    csv, js = tmp_path / "in.csv", tmp_path / "in.json"
    csv.write_text("accident_number,accident_date,contact_date,fl_score,fl_status,p_score,p_status,nbe\n"
                   "P1,2024-01-01,2024-01-05,1,1,2,0,1\nP2,2024-01-01\nP3,2024-01-01,2024-01-05,1,1,2,0,1,9\n")
    js.write_text('{"accident_number": "P1", "nbe": "1"}\n{"accident_number": \n')
    for path, fmt, n in ((csv, "csv", 2), (js, "json", 1)):
        rows, rejects = IO.read_with_rejects(spark, str(path), fmt)
        assert [r.accident_number for r in rows.collect()] == ["P1"] and rows.count() == 1
        assert rejects.count() == n and all(r.line and r.file_path.endswith(fmt) for r in rejects.collect())


def test_text_stage_round_trip(spark, tmp_path):
    c = FX.consultations(spark, SF_SMALL)
    for fmt in ("csv", "json"):
        for _ in range(2):  # a retried run has its rows once
            IO.write_stage(c, str(tmp_path / fmt), "20250612", fmt=fmt)
        back = IO.read_stage(spark, str(tmp_path / fmt), fmt=fmt)
        assert back.drop("run_id").exceptAll(c).count() == 0 and back.count() == c.count()


def test_newest_drop_is_whole(spark, tmp_path):
    raw = FX.consultations_raw(spark, SF_SMALL)
    raw.repartition(4).write.option("header", "true").csv(str(tmp_path / "drop" / "a"))
    got = IO.latest_file_snapshot(spark, str(tmp_path / "drop" / "*" / "*.csv"))
    assert got.count() == raw.count()


def test_malformed_lines_are_never_rows_of_nulls(spark, tmp_path):
    import pytest
    p = tmp_path / "in.json"
    p.write_text('{"accident_number": "P1", "nbe": "1"}\n{"accident_number": "P2", nbe\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        IO.read_consultations(spark, str(p), fmt="json").collect()
    rows = IO.read_consultations(spark, str(p), fmt="json", rejects=str(tmp_path / "bad"))
    assert [r.accident_number for r in rows.collect()] == ["P1"]
    assert "P2" in spark.read.json(str(tmp_path / "bad")).first()["line"]


def test_newest_run_by_its_folder(spark, tmp_path):
    c = IO.conform(FX.consultations(spark, SF_SMALL))
    for run, n in (("20250101", 5), ("20250612", 7)):
        IO.write_stage(c.limit(n), str(tmp_path / "s"), run)
    assert IO.newest_run(spark, str(tmp_path / "s")) == "20250612" and IO.read_stage(spark, str(tmp_path / "s")).count() == 7
    assert IO.read_stage(spark, str(tmp_path / "s"), "20250101").count() == 5
