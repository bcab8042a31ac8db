"""Session helpers.

Library code never creates its own session; it takes the caller's. These
helpers are for tests, the bench and local runs. Settings that matter for
results (UTC session time zone, ANSI mode) are asserted, not assumed.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "consult", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (never used by library code)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/ABFS)
    folder and is used as is. Where it is unset, a local master (tests) gets
    a scratch folder; any other master is refused.
    """
    sc = spark.sparkContext
    cur = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    active = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if active and not cur:
        return active
    if not cur:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        cur = tempfile.mkdtemp(prefix="consult-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        try:
            spark.conf.set("spark.checkpoint.dir", cur)
        except Exception:  # noqa: BLE001 - static conf on some deployments
            pass
    if active != cur and not (active or "").startswith(cur.rstrip("/")):
        sc.setCheckpointDir(cur)
    return cur


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: compressed, and lineage ends there."""
    path = scratch_path(df.sparkSession, f"stage/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for materialized tables."""
    base = ensure_checkpoint_dir(spark)
    return base.rstrip("/") + "/" + name
