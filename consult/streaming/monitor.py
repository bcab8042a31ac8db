"""Request-log and prediction monitoring (R2-R5), batch or streaming.

Every function takes a DataFrame that may be static or streaming and
returns the same query; on a stream the caller adds a watermark (event time
must be TIMESTAMP, not TIMESTAMP_NTZ) and runs it in append mode, so only
closed windows are emitted. Batch runs give exact percentiles from counted
values; streams keep a KLL sketch per window and path, whose state is bounded
and which merges: hourly sketches give the percentiles of a day or of all paths
without the requests. With ``SKETCH_K`` = 800 the rank of a returned value is
within ``RANK_ERROR`` of the asked one with 99 % confidence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consult import schema as S
from consult.functions.exprs import confidence_level, r6
from consult.functions.quantiles import exact_quantiles


def with_event_time(df: DataFrame, ts: str = "ts", delay: str | None = None) -> DataFrame:
    """TIMESTAMP event-time column (needed for watermarks), optional watermark."""
    out = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return out.withWatermark(ts, delay) if delay else out


#: Size parameter of a latency sketch, and the rank error it is good for.
SKETCH_K, RANK_ERROR = 800, 0.01
PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def _request_counts() -> list:
    st = F.col("status")
    return [F.count(F.lit(1)).alias("n_requests"),
            F.count_if((st >= 400) & (st < 500)).alias("n_4xx"),
            F.count_if(st >= 500).alias("n_5xx")]


def latency_sketches(log: DataFrame, window: str = "1 hour", ts: str = "ts", k: int = SKETCH_K) -> DataFrame:
    """(window_start, window_end, path, n_requests, n_4xx, n_5xx, sketch): what an hour keeps of its requests."""
    g = log.groupBy(F.window(ts, window).alias("w"), "path").agg(
        *_request_counts(), F.kll_sketch_agg_double(F.col("latency_ms").cast("double"), F.lit(k)).alias("sketch"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "path", "n_requests", "n_4xx", "n_5xx", "sketch")


def merge_sketches(sketches: DataFrame, window: str = "1 day", keys: tuple[str, ...] = ("path",)) -> DataFrame:
    """Sketch rows merged to longer windows (or fewer ``keys``): counts add up, sketches merge."""
    g = sketches.groupBy(F.window("window_start", window).alias("w"), *keys).agg(
        *[F.sum(c).alias(c) for c in ("n_requests", "n_4xx", "n_5xx")], F.kll_merge_agg_double("sketch").alias("sketch"))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n_requests", "n_4xx", "n_5xx", "sketch")


def with_percentiles(sketches: DataFrame) -> DataFrame:
    """Rates and p50 / p95 / p99 of sketch rows; null where no request has a latency."""
    some = F.kll_sketch_get_n_double("sketch") > 0
    return sketches.select(
        *[c for c in sketches.columns if c != "sketch"],
        r6(F.col("n_4xx") / F.col("n_requests")).alias("rate_4xx"), r6(F.col("n_5xx") / F.col("n_requests")).alias("rate_5xx"),
        *[r6(F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(p)))).alias(f"{name}_latency_ms") for name, p in PERCENTILES.items()])


def request_metrics(log: DataFrame, window: str = "1 hour", ts: str = "ts", exact: bool | None = None) -> DataFrame:
    """Per path and tumbling window: requests, 4xx / 5xx counts and rates,
    p50 / p95 / p99 latency."""
    exact = (not log.isStreaming) if exact is None else exact
    if not exact:
        return with_percentiles(latency_sketches(log, window, ts))
    w = F.window(ts, window).alias("w")
    n = log.groupBy(w, "path", "latency_ms").agg(F.count(F.lit(1)).alias("n"))
    q = exact_quantiles(n, ["w", "path"], PERCENTILES, value="latency_ms")
    q = q.select(F.struct("w", "path").alias("__k"), *PERCENTILES)
    g = log.groupBy(w, "path").agg(*_request_counts()).withColumn("__k", F.struct("w", "path"))
    g = g.join(q, "__k", "left")
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "path",
                    "n_requests", "n_4xx", "n_5xx",
                    r6(F.col("n_4xx") / F.col("n_requests")).alias("rate_4xx"),
                    r6(F.col("n_5xx") / F.col("n_requests")).alias("rate_5xx"),
                    *[r6(F.col(p)).alias(f"{p}_latency_ms") for p in PERCENTILES])


def rank_errors(log: DataFrame, estimates: DataFrame, window: str, ts: str = "ts") -> DataFrame:
    """(window_start, path, percentile, n_requests, rank_error): how far the rank of each
    estimated latency is from the asked one, by the requests themselves.

    A value that stands for several ranks is off by its nearest one."""
    asked = F.array(*[F.struct(F.lit(name).alias("percentile"), F.lit(p).alias("p"), F.col(f"{name}_latency_ms").alias("v")) for name, p in PERCENTILES.items()])
    e = estimates.select(F.col("window_start").alias("e_start"), F.col("path").alias("e_path"), F.inline(asked))
    at = log.where(F.col("latency_ms").isNotNull()).groupBy(F.window(ts, window)["start"].alias("window_start"), "path", "latency_ms").agg(F.count(F.lit(1)).alias("n"))
    j = at.join(e, (F.col("window_start") == F.col("e_start")) & F.col("path").eqNullSafe(F.col("e_path")))
    g = j.groupBy("window_start", "path", "percentile", "p").agg(
        F.sum("n").alias("n_requests"), F.sum(F.when(F.col("latency_ms") < F.col("v"), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("latency_ms") <= F.col("v"), F.col("n")).otherwise(0)).alias("upto"))
    low, high = F.col("below") / F.col("n_requests"), F.col("upto") / F.col("n_requests")
    return g.select("window_start", "path", "percentile", "n_requests", F.greatest(low - F.col("p"), F.col("p") - high, F.lit(0.0)).alias("rank_error"))


def _limits(spark, limits=S.RATE_LIMITS) -> DataFrame:
    return spark.createDataFrame(limits, "path string, limit_per_minute int")


def rate_limit_breaches(log: DataFrame, limits=S.RATE_LIMITS, ts: str = "ts") -> DataFrame:
    """Clients above the per-minute limit of a path, per 1-minute window."""
    per_min = log.groupBy(F.window(ts, "1 minute").alias("w"), "client_id", "path").agg(
        F.count(F.lit(1)).alias("n_requests"))
    j = per_min.join(_limits(log.sparkSession, limits), "path", "inner")
    return j.where(F.col("n_requests") > F.col("limit_per_minute")).select(
        F.col("w.start").alias("window_start"), "client_id", "path", "n_requests", "limit_per_minute")


def client_request_peaks(log: DataFrame, limits=S.RATE_LIMITS, ts: str = "ts") -> DataFrame:
    """Per client and limited path: busiest minute, its share of the limit
    and the number of minutes over the limit (batch report)."""
    per_min = log.groupBy(F.window(ts, "1 minute").alias("w"), "client_id", "path").agg(
        F.count(F.lit(1)).alias("n"))
    j = per_min.join(_limits(log.sparkSession, limits), "path", "inner")
    return j.groupBy("client_id", "path", "limit_per_minute").agg(
        F.max("n").alias("peak_per_minute"),
        F.count_if(F.col("n") > F.col("limit_per_minute")).alias("minutes_over_limit")).select(
        "client_id", "path", "limit_per_minute", "peak_per_minute",
        r6(F.col("peak_per_minute") / F.col("limit_per_minute")).alias("peak_share_of_limit"),
        "minutes_over_limit")


def required_permission(path) -> F.Column:
    """``predict`` for predictions, ``key`` (any known key) for the rest, null for public paths."""
    return (F.when(path.isin(*S.PUBLIC_PATHS), F.lit(None))
            .when(path.startswith(S.PREDICT_PREFIX), F.lit("predict"))
            .otherwise(F.lit("key")))


def check_permissions(log: DataFrame, keys: DataFrame) -> DataFrame:
    """Per request: public paths pass (200); no or unknown key is 401; a key
    without the path's permission (its own name or ``all``) is 403; else 200. Works as a stream-static
    join (the key table is static)."""
    perms = keys.groupBy("api_key").agg(F.collect_set("permission").alias("__perms"))
    j = log.join(perms, "api_key", "left")
    need = required_permission(F.col("path"))
    decision = (F.when(need.isNull(), F.lit(200))
                .when(F.col("api_key").isNull() | F.col("__perms").isNull(), F.lit(401))
                .when((need != "key") & ~F.array_contains(F.col("__perms"), need)
                      & ~F.array_contains(F.col("__perms"), "all"), F.lit(403))
                .otherwise(F.lit(200)))
    return j.select("request_id", "client_id", "path", F.col("api_key"),
                    need.alias("required_permission"), decision.alias("auth_status"))


def prediction_monitor(preds: DataFrame, window: str = "1 hour", ts: str = "ts",
                       prob: str = "nbe_yes_probability", model: str = "model_type") -> DataFrame:
    """Per window and model: predictions, mean probability, band counts."""
    band = confidence_level(F.col(prob))
    g = preds.groupBy(F.window(ts, window).alias("w"), model).agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.avg(prob).alias("mean_probability"),
        F.count_if(band == "high").alias("n_high"),
        F.count_if(band == "medium").alias("n_medium"),
        F.count_if(band == "low").alias("n_low"))
    return g.select(F.col("w.start").alias("window_start"), model, "n_predictions",
                    r6(F.col("mean_probability")).alias("mean_probability"), "n_high", "n_medium", "n_low")
