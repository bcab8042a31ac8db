"""Running totals over a global order without a single hot task.

A window with ``orderBy`` and no ``partitionBy`` moves every row to one task.
Dense ids (1..N), cumulative distributions and ROC / PR curves all need a
running count over a *total* order, so they share this primitive:

1. the caller reduces first (distinct ids, one row per distinct score);
2. the reduced table is range-partitioned on the order key and sorted inside
   each partition, then written to the shared checkpoint folder (range bounds
   are sampled, so a recomputation after a lost executor could move rows
   between partitions; the checkpoint pins them). One total per partition is
   aggregated (a table with exactly ``numPartitions`` rows, so its broadcast
   is bounded) and turned into exclusive offsets. A dense index then needs
   no window at all (position in the partition from
   ``monotonically_increasing_id``); general running sums add the offsets to
   a window partitioned by the captured partition id (one more exchange of
   the reduced table, never of the raw rows).

There is one path, whatever the size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PID = "_prefix_pid"


def _before() -> "Window":
    """All partitions before a partition, over the table of one total per partition.

    That table is as long as there are partitions, so it is one named group."""
    return Window.partitionBy(F.col(_PID) < 0).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)


def _order_cols(order: list) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def prefix_sums(df: DataFrame, order: list, sums: dict[str, Column | str],
                num_partitions: int | None = None) -> DataFrame:
    """Add inclusive running sums ``{out_name: value}`` over the total ``order``.

    ``order`` must be unique per row (a key of the reduced table), otherwise
    ties make the running value order-dependent.
    """
    spark = df.sparkSession
    ords = _order_cols(order)
    vals = {k: (F.col(v) if isinstance(v, str) else v) for k, v in sums.items()}
    from consult.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    nparts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = (df.select("*", *[v.alias(f"_v_{k}") for k, v in vals.items()])
              .repartitionByRange(nparts, *ords)
              .sortWithinPartitions(*ords)
              .withColumn(_PID, F.spark_partition_id()))
    staged = staged.checkpoint(eager=True)
    totals = staged.groupBy(_PID).agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in vals])
    wt = _before()
    offsets = totals.select(_PID, *[F.coalesce(F.sum(f"_t_{k}").over(wt), F.lit(0)).alias(f"_o_{k}")
                                    for k in vals])
    w = Window.partitionBy(_PID).orderBy(*ords).rowsBetween(Window.unboundedPreceding,
                                                              Window.currentRow)
    out = staged.join(F.broadcast(offsets), _PID, "left")
    out = out.select(*df.columns,
                     *[(F.sum(f"_v_{k}").over(w) + F.col(f"_o_{k}")).alias(k) for k in vals])
    return out


def dense_index(df: DataFrame, order: list, out: str = "idx", start: int = 1,
                num_partitions: int | None = None) -> DataFrame:
    """``start``-based position of each row in the total ``order``.

    No window is needed: after the range shuffle and the sort
    inside each partition, ``monotonically_increasing_id`` is
    (partition index << 33) + position in the partition, so the position
    comes for free in the same narrow stage; the checkpoint pins it. One row
    per partition gives the offsets (bounded broadcast)."""
    spark = df.sparkSession
    ords = _order_cols(order)
    from consult.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    nparts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = (df.repartitionByRange(nparts, *ords).sortWithinPartitions(*ords)
              .select("*", F.spark_partition_id().alias(_PID),
                      F.monotonically_increasing_id().alias("__mid")))
    staged = staged.checkpoint(eager=True)
    counts = staged.groupBy(_PID).agg(F.count(F.lit(1)).alias("__n"))
    wt = _before()
    offsets = counts.select(_PID, F.coalesce(F.sum("__n").over(wt), F.lit(0)).alias("__off"))
    local = F.col("__mid") - F.shiftleft(F.col(_PID).cast("long"), 33)
    return (staged.join(F.broadcast(offsets), _PID, "left")
            .select(*df.columns, (local + F.col("__off") + F.lit(start)).cast("bigint").alias(out)))
