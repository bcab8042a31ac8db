"""Previous rows and running totals inside a group, whatever the size of the group.

``lag`` and ``sum`` over (partition by key order by ...) put each group in one
task. As in ``grouprank`` the rows are range-partitioned and sorted by the full
order, keys first, and pinned in the shared checkpoint folder, so that a large
group, or the null key, is cut wherever the range bounds fall. Windows run per
(partition, group), never more than one range. What crosses a cut comes from the
pieces of the few groups at a range's edge: the totals of the pieces before, and
the last row of the piece right before. That table has at most two rows a
partition and is broadcast. There is one path at every size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PID, _MID, _KEY = "__scan_pid", "__scan_mid", "__scan_key"


def _c(o) -> Column:
    return F.col(o) if isinstance(o, str) else o


def scan_within(df: DataFrame, keys: list[str], order: list, number: str | None = None,
                previous: dict[str, str | Column] | None = None, running: dict[str, str | Column] | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """``df`` with columns that depend on the rows before each row of its group.

    ``number``: 1-based BIGINT position inside ``keys`` by ``order`` (ascending,
    nulls last; total, or rows that tie are alike). ``previous``: {name: value}
    of the row before, null at the first. ``running``: {name: value} summed up to
    and with the row, nulls as 0. Null keys form a group of their own."""
    from consult.session import ensure_checkpoint_dir
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    previous, running = previous or {}, running or {}
    nparts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    full = [F.col(k).asc_nulls_first() for k in keys] + [_c(o).asc_nulls_last() for o in order]
    lags = {name: f"__lag_{i}" for i, name in enumerate(previous)}
    sums = {name: f"__sum_{i}" for i, name in enumerate(running)}
    staged = df.select("*", *[_c(v).alias(lags[n]) for n, v in previous.items()],
                       *[F.coalesce(_c(v), F.lit(0)).alias(sums[n]) for n, v in running.items()])
    staged = (staged.repartitionByRange(nparts, *full).sortWithinPartitions(*full)
              .select("*", F.spark_partition_id().alias(_PID), F.monotonically_increasing_id().alias(_MID))
              .checkpoint(eager=True))
    key = F.struct(*keys)
    edges = staged.groupBy(_PID).agg(F.min(key).alias("__lo"), F.max(key).alias("__hi"))
    cut = (edges.select(F.explode(F.array_distinct(F.array("__lo", "__hi"))).alias(_KEY))
           .groupBy(_KEY).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(_KEY))
    last = F.struct(F.lit(True).alias("__is"), *lags.values())
    pieces = (staged.withColumn(_KEY, key).join(F.broadcast(cut), _KEY, "left_semi").groupBy(_PID, _KEY)
              .agg(F.count(F.lit(1)).alias("__n"), F.max_by(last, _MID).alias("__last"), *[F.sum(s).alias(s) for s in sums.values()]))
    pieces_in_order = Window.partitionBy(_KEY).orderBy(_PID)
    before = pieces_in_order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(_PID, _KEY, F.sum("__n").over(before).alias("__off"), F.lag("__last").over(pieces_in_order).alias("__before"),
                            *[F.sum(s).over(before).alias(f"__off{s}") for s in sums.values()])
    w = Window.partitionBy(_PID, *keys).orderBy(_MID)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    scanned = staged.select("*", key.alias(_KEY), F.row_number().over(w).alias("__r"),
                            *[F.lag(v).over(w).alias(f"__own{v}") for v in lags.values()],
                            *[F.sum(v).over(upto).alias(f"__own{v}") for v in sums.values()])
    res = scanned.join(F.broadcast(offsets), [_PID, _KEY], "left")
    out = []
    if number:
        out.append((F.col("__r") + F.coalesce("__off", F.lit(0))).cast("bigint").alias(number))
    out += [F.when(F.col("__r") == 1, F.col(f"__before.{v}")).otherwise(F.col(f"__own{v}")).alias(n) for n, v in lags.items()]
    out += [(F.col(f"__own{v}") + F.coalesce(f"__off{v}", F.lit(0))).alias(n) for n, v in sums.items()]
    return res.select(*df.columns, *out)
