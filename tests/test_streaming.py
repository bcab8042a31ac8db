"""Stream equals batch on closed windows; stream scoring equals batch scoring."""

from pyspark.sql import functions as F

from consult.sources import fixtures as FX
from consult.streaming import monitor as R
from consult.streaming.runner import run_metrics_stream
from tests.conftest import SF_SMALL


def test_stream_metrics_equal_batch_on_closed_windows(spark):
    log = FX.request_log(spark, SF_SMALL)
    st = run_metrics_stream(spark, log)
    batch = R.request_metrics(log, "1 hour", exact=True)
    key = ["window_start", "path"]
    cols = ["n_requests", "n_4xx", "n_5xx"]
    s = st.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "path", *cols)
    b = batch.select(*key, *cols)
    assert s.count() > 0
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def test_permission_decisions(spark):
    log = FX.request_log(spark, SF_SMALL)
    d = R.check_permissions(log, FX.api_keys(spark))
    got = {(r["path"], r["api_key"]): r["auth_status"] for r in d.collect()}
    assert got.get(("/api/v1/health", None), 200) == 200
    assert {"/docs", "/api/v1/validation/rules"} <= {p for p, _ in got}
    for (path, key), st in got.items():
        if path in ("/api/v1/health", "/docs"):
            assert st == 200
        elif key is None or key == "key-3":
            assert st == 401
        elif path.startswith("/api/v1/nbe/predict"):
            assert st == (200 if key in ("key-0", "key-1") else 403)
        elif path in ("/api/v1/models/info", "/api/v1/validation/rules"):
            assert st == 200


def test_permission_stream_equals_batch(spark):
    from consult.streaming.runner import run_stream
    log = FX.request_log(spark, SF_SMALL)
    keys = FX.api_keys(spark)
    st = run_stream(spark, log, lambda s: R.check_permissions(s, keys), ts=None, name="perm")
    b = R.check_permissions(log, keys)
    assert st.count() == b.count() and st.exceptAll(b).count() == 0


def test_prediction_monitor_stream_closed_windows(spark):
    from consult.streaming.runner import run_stream
    preds = FX.prediction_log(spark, SF_SMALL).repartition(4)
    st = run_stream(spark, preds, lambda s: R.prediction_monitor(s, "1 hour"), delay="1 hour", name="pm")
    b = R.prediction_monitor(preds, "1 hour")
    s2 = st.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                   *[c for c in b.columns if c != "window_start"])
    assert s2.count() > 0 and s2.exceptAll(b).count() == 0 and b.exceptAll(s2).count() == 0


def test_rate_limit_stream_equals_batch(spark):
    from consult.streaming.runner import run_stream
    log = FX.request_log(spark, SF_SMALL)
    low = [(p, 0) for p, _ in __import__("consult.schema", fromlist=["x"]).RATE_LIMITS]
    st = run_stream(spark, log, lambda s: R.rate_limit_breaches(s, limits=low), delay="1 minute", name="rl")
    b = R.rate_limit_breaches(log, limits=low)
    s2 = st.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                   *[c for c in b.columns if c != "window_start"])
    assert s2.count() > 0 and s2.exceptAll(b).count() == 0 and b.exceptAll(s2).count() == 0


ROWS = "pid long, contact_date date, p_score int"


def _feed(spark, batches, tmp):
    """Each batch is landed and run from the checkpoint of the one before."""
    from consult.streaming import runner
    from consult.streaming.numbering import number_consultations, state_store
    src, out, ckpt = (f"{tmp}/{p}" for p in ("src", "out", "ckpt"))
    with state_store(spark):
        runner.replay(spark, [spark.createDataFrame(b, ROWS) for b in batches], src,
                      lambda: runner._to_parquet(number_consultations(spark.readStream.schema(ROWS).parquet(src), "pid"), out, ckpt))
    return sorted(((r.pid, str(r.contact_date), r.p_score, r.consultation_number, r.late) for r in spark.read.parquet(out).collect()), key=str)


def test_numbers_go_on_after_a_restart_and_late_rows_get_none(spark, tmp_path):
    import datetime as dt
    day = [dt.date(2025, 1, k) for k in range(1, 10)]
    got = _feed(spark, [[(1, day[2], 3), (1, day[0], 1), (2, day[4], 0), (None, day[1], 2)], [(1, day[2], 4), (1, day[1], 9), (1, None, 5), (None, day[3], 2)], [(1, day[8], 0), (2, day[3], 7), (2, day[5], 7)]], str(tmp_path))
    assert got == sorted([
        (1, "2025-01-01", 1, 1, False), (1, "2025-01-03", 3, 2, False), (2, "2025-01-05", 0, 1, False), (None, "2025-01-02", 2, 1, False),
        (1, "2025-01-03", 4, 3, False), (1, "2025-01-02", 9, None, True), (1, "None", 5, None, True), (None, "2025-01-04", 2, 2, False),
        (1, "2025-01-09", 0, 4, False), (2, "2025-01-04", 7, None, True), (2, "2025-01-06", 7, 2, False)], key=str)


def test_busy_hour_is_many_slices(spark, tmp_path, monkeypatch):
    """Ranges hold about equal rows however the times are dealt, in order, and lose none."""
    from consult.streaming import runner
    monkeypatch.setattr(runner, "SLICE_ROWS", 100)
    df = spark.range(2000).select(F.col("id"), F.when(F.col("id") % 50 == 49, None).otherwise(F.timestamp_seconds(F.when(F.col("id") < 1800, F.col("id")).otherwise(F.col("id") * 86400))).alias("ts"))
    slices = [s.agg(F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi")).first() for s in runner.time_slices(df, f"{tmp_path}/s")]
    assert len(slices) == 20 and sum(s.n for s in slices) == 2000 and max(s.n for s in slices) < 400
    ends = [(s.lo, s.hi) for s in slices if s.lo]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_sketches_merge_within_their_bound(spark):
    """Hourly sketches of 60,000 latencies merged to days and over paths: ranks within the bound, counts exact."""
    log = spark.range(60_000).select(
        F.timestamp_seconds(F.col("id") * 3).alias("ts"), F.when(F.col("id") % 3 == 0, "/a").otherwise("/b").alias("path"),
        F.when(F.col("id") % 50 == 0, 500).when(F.col("id") % 20 == 0, 404).otherwise(200).alias("status"),
        F.when(F.col("id") % 17 != 0, F.exp(F.randn(3) * 1.5)).alias("latency_ms"))
    hourly = R.latency_sketches(log, "1 hour")
    for keys, window in ((("path",), "1 hour"), (("path",), "1 day")):
        kept = hourly if window == "1 hour" else R.merge_sketches(hourly, window, keys)
        errors = R.rank_errors(log, R.with_percentiles(kept), window).collect()
        assert errors and max(r.rank_error for r in errors) <= R.RANK_ERROR
    whole = R.with_percentiles(R.merge_sketches(hourly, "10 days", ())).first()
    assert whole.n_requests == 60_000 and whole.n_5xx == 1200 and abs(whole.p50_latency_ms - 1.0) < 0.1
    assert R.with_percentiles(R.latency_sketches(log.where("latency_ms IS NULL"), "10 days")).first().p50_latency_ms is None


def test_state_is_kept_by_bucket_not_by_patient(spark, tmp_path, monkeypatch):
    """300 patients in 8 buckets: the state has a row a bucket, and every patient its own numbers over three batches."""
    import datetime as dt

    from consult.streaming import numbering, runner
    monkeypatch.setattr(numbering, "BUCKETS", 8)
    src, out, ckpt = (f"{tmp_path}/{p}" for p in ("src", "out", "ckpt"))
    queries = []

    def start():
        queries.append(runner._to_parquet(numbering.number_consultations(spark.readStream.schema(ROWS).parquet(src), "pid"), out, ckpt))
        return queries[-1]
    with numbering.state_store(spark):
        batches = [[(p, dt.date(2025, 1, 2 * b + k), k) for p in range(300) for k in (1, 2)] for b in range(3)]
        runner.replay(spark, [spark.createDataFrame(b, ROWS) for b in batches], src, start)
    assert queries[-1].lastProgress["stateOperators"][0]["numRowsTotal"] <= 8
    got = sorted((r.pid, r.contact_date.day, r.consultation_number, r.late) for r in spark.read.parquet(out).collect())
    assert got == [(p, day, day, False) for p in range(300) for day in range(1, 7)]
