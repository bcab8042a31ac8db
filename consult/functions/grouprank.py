"""Position inside a group, whatever the size of the group.

``row_number() over (partition by key order by ...)`` puts each group in one
task, so one patient (or one label stratum) with a large share of the rows is
sorted by one task alone. Here the rows are range-partitioned and sorted by the
*full* order, keys first: a large group, the null key included, is cut wherever
the range bounds fall, and rows tied on the first order column are cut by the
next ones. Range bounds are sampled, so the sorted table is written to the shared
checkpoint folder before it is read.

Rows are then numbered per (partition, group), which is never more than one
range partition. Only a group at the edge of two or more partitions needs an
offset, and there are fewer of those than partitions: their pieces are counted
into a table of at most two rows a partition, which is broadcast. Rows that are
equal in every key and order column stay together in one range.

A caller that joins its rows with one row a group anyway needs no window and no
exchange for it: rows of a group follow each other in their range, so a position is
the distance from the first row of its piece plus the piece's offset
(``ranged_rows``, ``group_pieces``, ``position``).

There is one path at every size; positions and totals are BIGINT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PID, _MID, _KEY = "__rank_pid", "__rank_mid", "__rank_key"
#: Range and number of a row of ``ranged_rows``; in ``group_pieces`` a piece's first number, the rows before it and those of its group.
RANGE, NUMBER, FIRST, BEFORE, TOTAL = _PID, _MID, "__rank_first", "__rank_before", "__rank_total"


def _c(o) -> Column:
    return F.col(o) if isinstance(o, str) else o


def ranged_rows(df: DataFrame, keys: list[str], order: list, num_partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``keys`` (nulls first) and ``order`` (nulls last), written
    with their ``RANGE`` and ``NUMBER``, which rises by 1 from row to row of a range."""
    from consult.session import stage
    nparts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    full = [F.col(k).asc_nulls_first() for k in keys] + [_c(o).asc_nulls_last() for o in order]
    return stage(df.repartitionByRange(nparts, *full).sortWithinPartitions(*full)
                 .select("*", F.spark_partition_id().alias(_PID),
                         F.monotonically_increasing_id().alias(_MID)), "ranked")


def group_pieces(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each group and range of ``ranged_rows``: ``RANGE``, ``keys``, ``FIRST``, ``BEFORE``, ``TOTAL``.

    The rows are sorted by group, so they are counted before the exchange; a
    group has at most as many pieces as there are ranges."""
    pieces = rows.groupBy(RANGE, *keys).agg(F.min(NUMBER).alias(FIRST), F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*keys)
    before = w.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return pieces.select(RANGE, *keys, FIRST, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(BEFORE), F.sum("__n").over(w).alias(TOTAL))


def position() -> Column:
    """1-based position in its group of a row joined with its piece."""
    return (F.col(NUMBER) - F.col(FIRST) + F.col(BEFORE) + F.lit(1)).cast("bigint")


def rank_within(df: DataFrame, keys: list[str], order: list, out: str = "rank",
                total_out: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based position inside ``keys`` by ``order`` (ascending,
    nulls last; the order should be total), and optionally ``total_out`` =
    rows in the group. Null keys form a group of their own."""
    staged = ranged_rows(df, keys, order, num_partitions)
    key = F.struct(*keys)
    # Nulls are lowest in a struct's order too, so min / max are the keys at the two edges.
    edges = staged.groupBy(_PID).agg(F.min(key).alias("__lo"), F.max(key).alias("__hi"))
    cut = (edges.select(F.explode(F.array_distinct(F.array("__lo", "__hi"))).alias(_KEY))
           .groupBy(_KEY).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(_KEY))
    pieces = (staged.select(_PID, key.alias(_KEY)).join(F.broadcast(cut), _KEY, "left_semi")
              .groupBy(_PID, _KEY).agg(F.count(F.lit(1)).alias("__n")))
    wk = Window.partitionBy(_KEY)
    before = wk.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(_PID, _KEY, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"),
                            F.sum("__n").over(wk).alias("__tot"))
    w = Window.partitionBy(_PID, *keys)
    ranked = staged.select("*", key.alias(_KEY), F.row_number().over(w.orderBy(_MID)).alias("__r"),
                           F.count(F.lit(1)).over(w).alias("__c"))
    res = ranked.join(F.broadcast(offsets), [_PID, _KEY], "left")
    cols = [(F.col("__r") + F.coalesce(F.col("__off"), F.lit(0))).cast("bigint").alias(out)]
    if total_out:
        cols.append(F.coalesce(F.col("__tot"), F.col("__c")).cast("bigint").alias(total_out))
    return res.select(*df.columns, *cols)
