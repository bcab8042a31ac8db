"""Drift of feature distributions between an older and a newer table.

Both tables reduce to counts per (feature, value), merged into one table with
two counts. Running sums of both over (feature, value) give the two cumulative
distributions at every value, from which both statistics follow:

* Kolmogorov-Smirnov: the largest distance of the two distributions.
* Population stability index over bins of equal mass of the older table: a
  value's bin is the share of older rows with a smaller value, times the number
  of bins, so equal values share a bin and values that the older table lacks
  fall between their neighbours. A bin that one side leaves empty counts as half
  a row there; one that both leave empty does not count.

Missing values have no place in an order; their shares are reported beside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consult.functions.exprs import r6
from consult.functions.prefix import prefix_sums

N_BINS = 10
#: PSI from which a feature has drifted somewhat, and a lot.
MODERATE, MAJOR = 0.1, 0.25


def _counts(df: DataFrame, features: list[str], name: str, other: str) -> DataFrame:
    long = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])).alias("r")).select("r.*")
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias(name)).withColumn(other, F.lit(0).cast("bigint"))


def feature_drift(older: DataFrame, newer: DataFrame, features: list[str], n_bins: int = N_BINS) -> DataFrame:
    """Per feature: rows and missing shares of both sides, PSI, KS and a verdict; null statistics where a side has no value."""
    both = _counts(older, features, "o", "n").unionByName(_counts(newer, features, "n", "o"))
    both = both.groupBy("feature", "value").agg(F.sum("o").alias("o"), F.sum("n").alias("n"))
    rows = both.groupBy("feature").agg(
        F.sum("o").alias("n_older"), F.sum("n").alias("n_newer"),
        F.sum(F.when(F.col("value").isNull(), F.col("o")).otherwise(0)).alias("no"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nn"))
    run = prefix_sums(both.where(F.col("value").isNotNull()), ["feature", "value"], {"__o": "o", "__n": "n"})
    size = run.groupBy("feature").agg(F.sum("o").alias("to"), F.sum("n").alias("tn"), F.min(F.col("__o") - F.col("o")).alias("bo"), F.min(F.col("__n") - F.col("n")).alias("bn"))
    at = run.join(size, "feature").select("feature", "o", "n", "to", "tn", (F.col("__o") - F.col("bo")).alias("co"), (F.col("__n") - F.col("bn")).alias("cn"))
    share = lambda c, t: F.try_divide(F.col(c).cast("double"), F.col(t).cast("double"))
    place = F.floor(F.try_divide((F.col("co") - F.col("o")) * F.lit(n_bins), F.col("to")))
    at = at.select("*", F.least(place, F.lit(n_bins - 1)).alias("bin"), F.abs(share("co", "to") - share("cn", "tn")).alias("ks"))
    bins = at.groupBy("feature", "bin").agg(F.sum("o").alias("o"), F.sum("n").alias("n"), F.max("to").alias("to"), F.max("tn").alias("tn"), F.max("ks").alias("ks"))
    po, pn = (F.try_divide(F.greatest(F.col(c).cast("double"), F.lit(0.5)), F.col(t)) for c, t in (("o", "to"), ("n", "tn")))
    stats = bins.groupBy("feature").agg(F.sum((pn - po) * F.log(pn / po)).alias("psi"), F.max("ks").alias("ks"))
    out = rows.join(stats, "feature", "left")
    return out.select(
        "feature", "n_older", "n_newer", r6(share("no", "n_older")).alias("missing_older"), r6(share("nn", "n_newer")).alias("missing_newer"),
        r6(F.col("psi")).alias("psi"), r6(F.col("ks")).alias("ks"),
        F.when(F.col("psi") >= MAJOR, "major").when(F.col("psi") >= MODERATE, "moderate").when(F.col("psi").isNotNull(), "none").alias("drift"))
