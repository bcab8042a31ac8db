"""Leakage-free splits and folds.

A patient's position inside its label stratum is its rank by
``md5(concat_ws(':', id, seed))``. The test side is the first
``ceil(frac * n)`` patients of each stratum, so the split is exact, order
free and reproducible in any engine. Strata are few and large, and
``grouprank`` cuts them by ranges of the hash.
Every row follows its patient through a semi join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consult import schema as S
from consult.functions.exprs import r6
from consult.functions.grouprank import rank_within
from consult.operators.features import patient_label


def hash_key(c: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", c.cast("string"), F.lit(str(seed))))


def stratified_rank(df: DataFrame, key: str, stratum: str, seed: int, out: str = "stratum_rank",
                    size_out: str = "stratum_size", num_partitions: int | None = None) -> DataFrame:
    """Rank rows of ``df`` (one per ``key``) inside ``stratum`` by the seeded hash."""
    h = df.select("*", hash_key(F.col(key), seed).alias("__h"))
    r = rank_within(h, [stratum], ["__h", key], out=out, total_out=size_out,
                    num_partitions=num_partitions)
    return r.drop("__h")


def stratified_patient_split(df: DataFrame, key: str = S.PSEUDO_ID, label: str = S.LABEL,
                             test_fraction: float = S.TEST_FRACTION, seed: int = S.SEED,
                             num_partitions: int | None = None, labels: DataFrame | None = None) -> DataFrame:
    """(key, patient_label, split) with split in {'train', 'test'}; per label
    stratum exactly ceil(test_fraction * n) patients go to test. ``labels``:
    the ``patient_label`` table, if it is known already."""
    pl = patient_label(df, key, label) if labels is None else labels
    r = stratified_rank(pl, key, "patient_label", seed, num_partitions=num_partitions)
    is_test = F.col("stratum_rank") <= F.ceil(F.lit(test_fraction) * F.col("stratum_size"))
    return r.select(key, "patient_label",
                    F.when(is_test, F.lit("test")).otherwise(F.lit("train")).alias("split"))


def split_rows(df: DataFrame, split: DataFrame, side: str, key: str = S.PSEUDO_ID,
               drop_key: bool = False) -> DataFrame:
    """Rows of the patients on ``side`` (left semi join: no column added)."""
    ids = split.where(F.col("split") == side).select(key)
    out = df.join(ids, key, "left_semi")
    return out.drop(key) if drop_key else out


def split_stats(df: DataFrame, split: DataFrame, key: str = S.PSEUDO_ID,
                label: str = S.LABEL) -> DataFrame:
    """Per side: patients, rows, rows per label, share of patients."""
    tagged = df.join(split.select(key, "split"), key, "inner")
    rows = tagged.groupBy("split").agg(
        F.count_distinct(key).alias("n_patients"), F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(label) == 0).alias("n_label_0"),
        F.count_if(F.col(label) == 1).alias("n_label_1"))
    return rows.select("split", "n_patients", "n_rows", "n_label_0", "n_label_1")


def patient_folds(labels: DataFrame, k: int = S.N_FOLDS, seed: int = S.SEED, key: str = S.PSEUDO_ID,
                  num_partitions: int | None = None) -> DataFrame:
    """(key, fold) of the patients of a ``patient_label`` table, stratified by it."""
    r = stratified_rank(labels, key, "patient_label", seed, num_partitions=num_partitions)
    return r.select(key, ((F.col("stratum_rank") - 1) % k).cast("int").alias("fold"))


def assign_folds(df: DataFrame, k: int = S.N_FOLDS, seed: int = S.SEED,
                 key: str = S.PSEUDO_ID, label: str = S.LABEL, grouped: bool = True,
                 row_key: list[str] | None = None,
                 num_partitions: int | None = None) -> DataFrame:
    """Add ``fold`` in 0..k-1, stratified by label.

    ``grouped`` (default): patients are ranked inside their (mode) label
    stratum and all their rows share one fold, so no patient is in two folds.
    Otherwise rows are ranked inside their own label by a hash of
    ``row_key`` (reference behaviour, one patient may span folds)."""
    if grouped:
        return df.join(patient_folds(patient_label(df, key, label), k, seed, key, num_partitions), key, "inner")
    rk = row_key or [key, "consultation_number"]
    tmp = df.select("*", F.concat_ws("|", *[F.col(c).cast("string") for c in rk]).alias("__rk"))
    r = stratified_rank(tmp, "__rk", label, seed, num_partitions=num_partitions)
    return r.select(*df.columns, ((F.col("stratum_rank") - 1) % k).cast("int").alias("fold"))


def fold_stats(folded: DataFrame, key: str = S.PSEUDO_ID, label: str = S.LABEL) -> DataFrame:
    return folded.groupBy("fold").agg(
        F.count_distinct(key).alias("n_patients"), F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(label) == 1).alias("n_positive"),
        r6(F.avg(F.col(label).cast("double"))).alias("positive_rate"))


def validate_feature_sets(b_train: DataFrame, b_test: DataFrame, e_train: DataFrame,
                          e_test: DataFrame, key: str | None = None,
                          label: str = S.LABEL) -> DataFrame:
    """Tidy checks over the four tables: shapes, label counts, equal rows and
    labels between sets, baseline subset of enhanced, nulls per set, and no
    patient on both sides (when ``key`` is kept). One aggregation over the
    four tables tagged and unioned, plus one join for shared patients."""
    sets = {"baseline_train": b_train, "baseline_test": b_test,
            "enhanced_train": e_train, "enhanced_test": e_test}
    tagged = None
    nfeat = {}
    for name, d in sets.items():
        nfeat[name] = len([c for c in d.columns if c not in (label, key)])
        nulls = sum((F.col(c).isNull().cast("int") for c in d.columns), F.lit(0))
        t = d.select(F.lit(name).alias("__set"), (F.col(label) == 1).alias("__pos"), nulls.alias("__nulls"))
        tagged = t if tagged is None else tagged.unionByName(t)
    aggs = []
    for name in sets:
        mine = F.col("__set") == name
        aggs += [F.count_if(mine).alias(f"{name}__n"), F.count_if(mine & F.col("__pos")).alias(f"{name}__pos"),
                 F.coalesce(F.sum(F.when(mine, F.col("__nulls"))), F.lit(0)).cast("bigint").alias(f"{name}__nulls")]
    one = tagged.agg(*aggs)
    checks = []
    for name in sets:
        n, pos, nulls = (F.col(f"{name}__{m}") for m in ("n", "pos", "nulls"))
        checks += [(name, "n_features", F.lit(nfeat[name]).cast("bigint"), F.lit(True)),
                   (name, "n_rows", n, n > 0), (name, "n_positive", pos, F.lit(True)),
                   (name, "null_cells", nulls, nulls == 0)]
    for side in ("train", "test"):
        bn, en = F.col(f"baseline_{side}__n"), F.col(f"enhanced_{side}__n")
        bp, ep = F.col(f"baseline_{side}__pos"), F.col(f"enhanced_{side}__pos")
        checks += [(side, "row_count_match", bn, bn == en), (side, "label_count_match", bp, bp == ep)]
    subset = set(b_train.columns) <= set(e_train.columns)
    checks.append(("all", "baseline_subset_of_enhanced", F.lit(int(subset)).cast("bigint"), F.lit(subset)))
    if key and key in b_train.columns and key in b_test.columns:
        shared = b_train.select(key).distinct().join(b_test.select(key).distinct(), key, "inner")
        ns = shared.agg(F.count(F.lit(1))).scalar()
        checks.append(("all", "shared_patients", ns, ns == 0))
    parts = [F.struct(F.lit(s_).alias("feature_set"), F.lit(m).alias("check_name"),
                      v.cast("bigint").alias("value"), ok.alias("passed")) for s_, m, v, ok in checks]
    return one.select(F.explode(F.array(*parts)).alias("r")).select("r.*")
