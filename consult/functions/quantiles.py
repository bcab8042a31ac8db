"""Exact quantiles from counted values, without a group in one buffer.

``percentile`` keeps every distinct value of a group in one aggregation buffer.
Here equal values are counted first (map-side combined), the counted values get
running totals over the order (group, value) from ``prefix``, and the values at
the wanted positions are picked by one more aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consult.functions.prefix import prefix_sums


def exact_quantiles(counts: DataFrame, keys: list[str], probs: dict[str, float],
                    value: str = "value", n: str = "n") -> DataFrame:
    """``keys`` and one DOUBLE per ``{name: probability}``, interpolated between
    the two nearest values. ``counts`` has one row per (keys, value) with its
    number of rows; null values do not count, and a group of nulls has no row."""
    # A struct compares equal on nulls, so a null key is a group like any other.
    c = counts.where(F.col(value).isNotNull()).select(
        F.struct(*keys).alias("__k"), F.col(value).cast("double").alias("__v"), F.col(n).alias("__n"))
    c = prefix_sums(c, ["__k", "__v"], {"__cum": "__n"})
    size = c.groupBy("__k").agg(F.min(F.col("__cum") - F.col("__n")).alias("__start"),
                                F.sum("__n").alias("__total"))
    last = F.col("__cum") - F.col("__start")
    first = last - F.col("__n")
    out = []
    for name, p in probs.items():
        at = (F.col("__total") - 1) * F.lit(float(p))
        low, high = (F.max(F.when((first <= i) & (i < last), F.col("__v"))) for i in (F.floor(at), F.ceil(at)))
        out.append((low + (high - low) * F.max(at - F.floor(at))).alias(name))
    return c.join(size, "__k").groupBy("__k").agg(*out).select("__k.*", *probs)
