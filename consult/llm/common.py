"""Helpers shared by the operators: shared scratch tables, fresh names, joins that keep one row."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Where it is unset, a local master gets a scratch folder of its own; any
    other master is refused, as no folder is known to be shared there.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    active = spark.sparkContext.getCheckpointDir()
    if active:
        return active.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    made = tempfile.mkdtemp(prefix="consult-llm-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back: lineage ends there."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(taken: list[str], *names: str) -> list[str]:
    """``names``, each changed as far as needed to clash with none of ``taken`` (case is ignored)."""
    used, out = {c.lower() for c in taken}, []
    for n in names:
        while n.lower() in used:
            n += "_"
        used.add(n.lower())
        out.append(n)
    return out


def text_or_empty(col: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce((F.col(col) if isinstance(col, str) else col).cast("string"), F.lit(""))


def numbered_copies(df: DataFrame, copies: str, nth: str) -> DataFrame:
    """Each row ``copies`` times, numbered from 1 in ``nth``; in two steps, so that no array grows with the copies."""
    block, part = 1 << 16, f"{nth}_part"
    parts = df.withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(copies) - 1) / block))))
    rest = F.least(F.lit(block).cast("long"), F.col(copies) - F.col(part) * block)
    return parts.withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), rest))).withColumn(nth, F.col(part) * block + F.col(nth)).drop(part)


def keep_rows(docs: DataFrame, kept: DataFrame, on: dict[str, str], copies: str) -> DataFrame:
    """The rows of ``docs`` that ``kept`` names, one of each set of repeated rows.

    ``on`` maps columns of ``docs`` to columns of ``kept`` (compared null-safe);
    ``copies`` of ``kept`` counts the rows of ``docs`` that share those values.
    Only rows that repeat are dealt out again to drop their repeats.
    """
    names = fresh(docs.columns, *[f"k_{v}" for v in on.values()], "k_copies")
    right = kept.select(*[F.col(v).alias(n) for v, n in zip(on.values(), names, strict=False)], F.col(copies).alias(names[-1]))
    cond = None
    for left, n in zip(on, names, strict=False):
        c = docs[left].eqNullSafe(right[n])
        cond = c if cond is None else cond & c
    joined = docs.join(right, cond, "inner")
    once = joined.where(F.col(names[-1]) == 1).select(*docs.columns)
    more = joined.where(F.col(names[-1]) > 1).dropDuplicates(list(on)).select(*docs.columns)
    return once.unionByName(more)
