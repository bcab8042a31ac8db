"""Streaming request scoring (R1): the batch validation and scoring
functions applied to a ``readStream`` source, with valid and rejected rows
written to two sinks from one ``foreachBatch`` (exactly-once per batch id
through the checkpoint)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from consult.operators.models import score_requests
from consult.operators.rules import validate_requests, validate_schema

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("p_score", T.IntegerType()),
    T.StructField("p_status", T.IntegerType()),
    T.StructField("fl_score", T.IntegerType()),
    T.StructField("fl_status", T.IntegerType()),
    T.StructField("days_since_accident", T.IntegerType()),
    T.StructField("consultation_number", T.IntegerType()),
    T.StructField("response_type", T.StringType()),
])


def read_request_stream(spark: SparkSession, path: str, schema: T.StructType = REQUEST_SCHEMA,
                        max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def validated(requests: DataFrame, kind: str = "enhanced") -> DataFrame:
    """Schema check (defaults applied) plus validator rules; stateless."""
    v = validate_requests(validate_schema(requests, kind), kind)
    return v.withColumn("accepted", F.col("schema_valid") & F.col("is_valid"))


def score_batch(batch: DataFrame, model: PipelineModel, kind: str, model_used: str) -> tuple[DataFrame, DataFrame]:
    """(scored valid rows, rejected rows with their messages)."""
    v = validated(batch, kind)
    ok = v.where("accepted").drop("schema_errors", "errors", "accepted")
    bad = v.where(~F.col("accepted")).select(
        *batch.columns, F.concat(F.col("schema_errors"), F.col("errors")).alias("errors"), "warnings")
    return score_requests(ok.drop("warnings", "schema_valid", "is_valid"), model, kind, model_used), bad


def start_scoring_stream(requests: DataFrame, model: PipelineModel, kind: str, model_used: str,
                         out_path: str, rejected_path: str, checkpoint: str, available_now: bool = True):
    """Run R1: valid rows scored to ``out_path``, rejects to ``rejected_path``."""
    def each(batch: DataFrame, batch_id: int) -> None:
        # A retried batch rewrites only its own partition: idempotent sinks.
        # Both sinks read the batch, so it is kept until both are written.
        batch = batch.persist()
        try:
            scored, bad = score_batch(batch, model, kind, model_used)
            for d, path in ((scored, out_path), (bad, rejected_path)):
                (d.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
                 .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))
        finally:
            batch.unpersist()

    w = requests.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
