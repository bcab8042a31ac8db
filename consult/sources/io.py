"""Sources and sinks.

Typed Parquet between stages, partitioned by ``run_id`` so "newest
snapshot" is a partition filter (pruned at runtime through a scalar
subquery) instead of a file-system scan by modification time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from consult import schema as S


def conform(df: DataFrame, schema: T.StructType = S.CONSULTATION_SCHEMA) -> DataFrame:
    """Project ``df`` onto ``schema`` (order and types); missing columns raise."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_consultations(spark: SparkSession, path: str, fmt: str = "parquet",
                       schema: T.StructType | None = None, rejects: str | None = None, **options) -> DataFrame:
    """Load the raw table with an explicit schema (no inference).

    No malformed CSV or JSON line becomes nulls unseen: the read fails at the
    first one, or, with ``rejects``, such lines are written there (JSON lines of
    text and file, see ``read_with_rejects``) and the others are returned.
    Parquet input is conformed to the schema after the read."""
    if fmt == "parquet":
        df = spark.read.options(**options).parquet(path)
        return conform(df, schema) if schema is not None else df
    if fmt not in ("csv", "json"):
        raise ValueError(f"unsupported format {fmt}; land workbooks as Parquet or CSV first")
    if rejects is not None:
        rows, bad = read_with_rejects(spark, path, fmt, schema or S.RAW_SCHEMA, **options)
        bad.write.mode("append").json(rejects)
        return rows
    r = spark.read.schema(schema or S.RAW_SCHEMA).options(**{"header": "true", **options, "mode": "FAILFAST"})
    return r.format(fmt).load(path)


#: Column that holds a malformed line of a text read.
BAD_LINE = "_corrupt_record"


def read_with_rejects(spark: SparkSession, path: str, fmt: str, schema: T.StructType = S.RAW_SCHEMA,
                      **options) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of CSV or JSON lines read with ``schema``.

    A line that does not fit (fields too many or too few, a value of another
    type, broken JSON) is a reject, with its text and its file; every other
    line is a row, so no line becomes nulls unseen."""
    if fmt not in ("csv", "json"):
        raise ValueError(f"unsupported text format {fmt}")
    full = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    r = spark.read.schema(full).options(mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE)
    r = r.options(**({"header": "true", **options} if fmt == "csv" else options)).format(fmt)
    df = r.load(path).select("*", F.col("_metadata.file_path").alias("file_path"))
    # Text sources refuse to read the bad-line column alone (a count, say), so
    # the condition reads the fields too; their joined length is never negative.
    names = [F.col(f.name).cast("string") for f in schema.fields]
    parsed = F.length(F.concat_ws("", *names)) >= 0
    fits = F.col(BAD_LINE).isNull()
    return (df.where(fits & parsed).select(*[f.name for f in schema.fields]),
            df.where(~fits & parsed).select(F.col(BAD_LINE).alias("line"), "file_path"))


def write_stage(df: DataFrame, path: str, run_id: str, fmt: str = "parquet",
                mode: str = "overwrite") -> None:
    """Write one run of a stage under ``run_id=<id>`` (typed Parquet by default).

    Only that run's partition is replaced, so a retried run has its rows once."""
    w = df.withColumn("run_id", F.lit(run_id)).write.mode(mode).partitionBy("run_id")
    w = w.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """Path and time of the files at ``path``, from the listing alone: no content is read."""
    return spark.read.format("binaryFile").load(path).select("path", "modificationTime")


def newest_run(spark: SparkSession, path: str) -> str | None:
    """The greatest run id of a stage, by its folders."""
    runs = _listing(spark, path).select(F.regexp_extract("path", "/run_id=([^/]*)/", 1).alias("r")).where("r <> ''")
    return runs.agg(F.max("r")).first()[0]


def read_stage(spark: SparkSession, path: str, run_id: str | None = None, fmt: str = "parquet",
               schema: T.StructType = S.CONSULTATION_SCHEMA) -> DataFrame:
    """Typed re-read of a stage: a given run, or the newest one. A CSV or JSON
    stage is read with ``schema``; a line that does not fit it fails the read,
    as ``write_stage`` wrote the file (``read_with_rejects`` sorts such lines out)."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        full = T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])
        df = spark.read.schema(full).options(mode="FAILFAST", header="true").format(fmt).load(path)
    # Partition discovery may type "20250612" as a number; run ids are text.
    df = df.withColumn("run_id", F.col("run_id").cast("string"))
    return df.where(F.col("run_id") == (run_id or newest_run(spark, path)))


def latest_file_snapshot(spark: SparkSession, path_glob: str, fmt: str = "csv",
                         schema: T.StructType | None = None) -> DataFrame:
    """For raw file drops: rows of the newest drop, that is of all files matching
    the glob in the folder of the most recently modified one. The folder comes
    from the file listing, and no other folder is read."""
    newest = _listing(spark, path_glob).agg(F.max_by(F.regexp_replace("path", "/[^/]*$", ""), "modificationTime")).first()[0]
    r = spark.read.schema(schema or S.RAW_SCHEMA).options(**({"header": "true"} if fmt == "csv" else {}))
    if newest is None:
        return r.format(fmt).load(path_glob)
    return r.format(fmt).load(f"{newest}/{path_glob.rsplit('/', 1)[1]}")


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tidy report rows as JSON lines."""
    report.write.mode(mode).json(path)


def write_mapping(mapping: DataFrame, path: str) -> None:
    """The pseudonym map goes to its own location and is never joined into outputs."""
    mapping.write.mode("overwrite").parquet(path)
