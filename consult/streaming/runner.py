"""Replay finished tables as streams, one micro-batch per range of event time.

A table is range-partitioned by its event time once, into pieces of about
``SLICE_ROWS`` rows (a busy hour is many pieces), and written below the shared
checkpoint folder. A range is as many consecutive pieces as keep the number of
ranges at ``MOST_SLICES``, so that a larger table gives wider batches, which run
on more tasks, not more batches one after the other. Each range is then landed in the stream's source folder and
the query is run on it with ``trigger(availableNow=True)``, from the checkpoint
of the run before: no row arrives behind the watermark, and every range is also
a restart. The sinks are read back as tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from consult.session import scratch_path
from consult.streaming.monitor import request_metrics, with_event_time
from consult.streaming.scoring import REQUEST_SCHEMA, read_request_stream, start_scoring_stream

#: Rows of one piece, and the least and the largest number of ranges of a replay.
SLICE_ROWS, LEAST_SLICES, MOST_SLICES = 500_000, 4, 24


def _dir(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:10]}")


def slice_count(df: DataFrame) -> tuple[int, int]:
    """Ranges of a replay of ``df``, and pieces of a range."""
    pieces = max(LEAST_SLICES, -(-df.count() // SLICE_ROWS))
    per = -(-pieces // MOST_SLICES)
    return -(-pieces // per), per


def time_slices(df: DataFrame, path: str, ts: str = "ts") -> list[DataFrame]:
    """``df`` in consecutive ranges of ``ts`` (rows without a time first), one folder each and a task a piece.

    Equal times are never in two ranges."""
    (n, per), schema = slice_count(df), StructType([*df.schema.fields, StructField("__slice", IntegerType())])
    t = F.col(ts).cast("timestamp")
    piece = df.repartitionByRange(n * per, t.asc_nulls_first())
    piece.withColumn("__slice", F.floor(F.spark_partition_id() / per).cast("int")).write.partitionBy("__slice").parquet(path)
    kept = df.sparkSession.read.schema(schema).parquet(path)
    return [kept.where(F.col("__slice") == i).drop("__slice") for i in range(n)]


def _closing(df: DataFrame, ts: str) -> list[DataFrame]:
    """Twice a row with a time far beyond the rest: the time of the one closes every
    window when the other is read, and their own window never closes."""
    end = df.agg(F.timestamp_seconds(F.max(F.col(ts).cast("timestamp")).cast("long") + 400 * 86400)).first()[0]
    one = df.where(F.col(ts).isNotNull()).limit(1).withColumn(ts, F.lit(end).cast(df.schema[ts].dataType))
    return [one, one]


def replay(spark: SparkSession, slices: list[DataFrame], source: str, start: Callable[[], StreamingQuery]) -> None:
    """Land the slices in ``source`` one after the other, and run the query on each to its end."""
    for s in slices:
        s.write.mode("append").parquet(source)
        start().awaitTermination()


def _to_parquet(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    return (df.writeStream.outputMode(mode).format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_scoring_stream(spark: SparkSession, requests: DataFrame, model: PipelineModel, kind: str,
                       model_used: str) -> DataFrame:
    """Every request once: scored, or rejected (``accepted`` false) with its messages."""
    base = _dir(spark, "stream-scoring")
    src, out, rej, ckpt = (f"{base}/{p}" for p in ("source", "scored", "rejected", "_checkpoint"))
    n, per = slice_count(requests)
    requests.select(*[F.col(f.name).cast(f.dataType) for f in REQUEST_SCHEMA.fields]) \
        .repartition(n * per).write.parquet(src)
    q = start_scoring_stream(read_request_stream(spark, src, max_files=per), model, kind, model_used,
                             out, rej, ckpt, available_now=True)
    q.awaitTermination()
    scored, bad = spark.read.parquet(out), spark.read.parquet(rej)
    return (scored.withColumn("accepted", F.lit(True))
            .unionByName(bad.withColumn("accepted", F.lit(False)), allowMissingColumns=True))


def run_metrics_stream(spark: SparkSession, log: DataFrame, window: str = "1 hour",
                       delay: str = "1 hour") -> DataFrame:
    return run_stream(spark, log, lambda s: request_metrics(s, window, exact=False), delay=delay, name="stream-metrics")


def run_stream(spark: SparkSession, df: DataFrame, fn, ts: str | None = "ts", delay: str | None = None,
               name: str = "stream", mode: str = "append") -> DataFrame:
    """Replay ``df`` (in event-time order when ``ts`` is given), apply ``fn`` (a
    batch/stream-agnostic operator), write the result to a Parquet sink, and
    return the sink table. With ``delay`` the event time gets a watermark, as
    stateful windows need, and every window is closed at the end."""
    base = _dir(spark, name)
    src, out, ckpt = (f"{base}/{p}" for p in ("source", "out", "_checkpoint"))
    slices = [df] if ts is None else time_slices(df, f"{base}/slices", ts)
    if delay:
        slices += _closing(df, ts)

    def start() -> StreamingQuery:
        stream = spark.readStream.schema(df.schema).parquet(src)
        if ts:
            stream = with_event_time(stream, ts, delay)
        return _to_parquet(fn(stream), out, ckpt, mode)
    replay(spark, slices, src, start)
    return spark.read.parquet(out)


def run_numbering_stream(spark: SparkSession, df: DataFrame, key: str, date: str) -> DataFrame:
    """F2 on a stream: ``df`` replayed in the order of ``date``, with its consultation numbers."""
    from consult.streaming.numbering import number_consultations, state_store
    base = _dir(spark, "stream-numbers")
    src, out, ckpt = (f"{base}/{p}" for p in ("source", "out", "_checkpoint"))
    with state_store(spark):
        replay(spark, time_slices(df, f"{base}/slices", date), src,
               lambda: _to_parquet(number_consultations(spark.readStream.schema(df.schema).parquet(src), key, date), out, ckpt))
    return spark.read.parquet(out)
