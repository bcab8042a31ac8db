"""Pseudonymization (A1-A6): sorted distinct ids to dense 1..N.

The id map is built from the distinct ids with the global prefix primitive
(no single-task window at scale), kept as its own table, and applied with a
plain equi-join (AQE picks broadcast or sort-merge from runtime size; a hot
id on the data side is split by AQE skew-join since the map side has one
row per id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consult import schema as S
from consult.functions.exprs import r6
from consult.functions.prefix import dense_index


def build_id_mapping(df: DataFrame, key: str = S.ID, unique: bool = False, **prefix_kw) -> DataFrame:
    """(original_id STRING, anonymous_id BIGINT) with ids 1..N in id order.
    Ids are compared as strings (fixes the numeric-id lookup defect).
    ``unique=True`` says ``df`` already has one row per id (skips the distinct)."""
    ids = df.select(F.col(key).cast("string").alias("original_id")).where(
        F.col("original_id").isNotNull())
    ids = ids if unique else ids.distinct()
    m = dense_index(ids, ["original_id"], out="anonymous_id", **prefix_kw)
    return m.select("original_id", F.col("anonymous_id").cast("bigint").alias("anonymous_id"))


def apply_mapping(df: DataFrame, mapping: DataFrame, key: str = S.ID,
                  out: str = S.PSEUDO_ID, strict: bool = True) -> DataFrame:
    """Replace ``key`` with its pseudonym, pseudonym first.

    A row whose id is null or not in the map fails the job that reads its
    pseudonym; the check is part of the expression and costs no extra job.
    ``strict=False`` leaves such pseudonyms null, ``unmapped_rows`` lists them."""
    j = (df.join(mapping.select(F.col("original_id").alias("__k"), F.col("anonymous_id").alias(out)),
                 F.col(key).cast("string") == F.col("__k"), "left"))
    pid = F.col(out)
    if strict:
        pid = F.coalesce(pid, F.raise_error(F.lit("Anonymization failed: id missing or not in the map"))
                         .cast("bigint"))
    return j.select(pid.alias(out), *[c for c in df.columns if c != key])


def unmapped_rows(df: DataFrame, mapping: DataFrame, key: str = S.ID) -> DataFrame:
    """Rows that ``apply_mapping`` refuses: id null or not in the map."""
    return df.join(mapping, F.col(key).cast("string") == F.col("original_id"), "left_anti")


def pseudonymize(df: DataFrame, key: str = S.ID, **prefix_kw) -> tuple[DataFrame, DataFrame]:
    """Build the map from ``df`` and apply it. Returns (anonymized, mapping)."""
    m = build_id_mapping(df, key, **prefix_kw)
    return apply_mapping(df, m, key), m


def reverse_lookup(ids: DataFrame, mapping: DataFrame, col: str = S.PSEUDO_ID) -> DataFrame:
    """Pseudonym back to the original id (inner join)."""
    return ids.join(mapping, F.col(col) == F.col("anonymous_id"), "inner").drop("anonymous_id")


def validate_mapping(orig: DataFrame, anon: DataFrame, mapping: DataFrame,
                     key: str = S.ID, pid: str = S.PSEUDO_ID) -> DataFrame:
    """The seven mapping checks as rows (check, passed, detail)."""
    spark = orig.sparkSession
    o = orig.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("k"))).scalar()
    a = anon.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_distinct(pid).alias("k"),
                          F.min(pid).alias("lo"), F.max(pid).alias("hi"))).scalar()
    m = mapping.agg(F.struct(F.count(F.lit(1)).alias("n"),
                             F.count_distinct("anonymous_id").alias("k"))).scalar()
    on, ok, an, ak = o["n"], o["k"], a["n"], a["k"]
    lo, hi, mn, mk = a["lo"], a["hi"], m["n"], m["k"]
    id_gone = key not in anon.columns
    int_ids = pid in anon.columns and dict(anon.dtypes)[pid] in ("int", "bigint")
    expected = (set(orig.columns) - {key}) | {pid}
    cols_ok = expected == set(anon.columns)
    base = spark.range(1)
    checks = [
        ("record_count_match", on == an, F.format_string("%d vs %d", on, an)),
        ("patient_count_match", ok == ak, F.format_string("%d vs %d", ok, ak)),
        ("original_ids_removed", F.lit(id_gone), F.lit(str(id_gone).lower())),
        ("valid_anonymous_ids", F.lit(int_ids), F.lit(dict(anon.dtypes).get(pid, "absent"))),
        ("sequential_numbering", (lo == 1) & (hi == mn), F.format_string("1 to %d", hi)),
        ("mapping_unique", mk == mn, F.format_string("%d of %d", mk, mn)),
        ("columns_preserved", F.lit(cols_ok), F.lit(",".join(sorted(expected ^ set(anon.columns))))),
    ]
    parts = [F.struct(F.lit(i + 1).alias("check_no"), F.lit(name).alias("check_name"),
                      F.coalesce(cond, F.lit(False)).alias("passed"), det.alias("detail"))
             for i, (name, cond, det) in enumerate(checks)]
    return base.select(F.explode(F.array(*parts)).alias("r")).select("r.*")


def consultation_patterns(df: DataFrame, key: str = S.PSEUDO_ID) -> DataFrame:
    """Tidy (metric, value): rows-per-patient stats; single (=1), multiple
    (>1) and high-frequency (>= 5) patients; longest sequence."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    one = sizes.agg(
        F.avg("n").alias("mean_consultations_per_patient"),
        F.median("n").alias("median_consultations_per_patient"),
        F.min("n").cast("double").alias("min_consultations"),
        F.max("n").cast("double").alias("max_consultations"),
        F.stddev_samp("n").alias("std_consultations"),
        F.count_if(F.col("n") == 1).cast("double").alias("single_consultation"),
        F.count_if(F.col("n") > 1).cast("double").alias("multiple_consultations"),
        F.count_if(F.col("n") >= S.HIGH_FREQUENCY_VISITS).cast("double").alias("high_frequency_patients"),
        F.max("n").cast("double").alias("max_sequence_number"),
    )
    names = one.columns
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), r6(F.col(c)).alias("value")) for c in names])).alias("r")).select("r.*")


def sequence_distribution(df: DataFrame, key: str = S.PSEUDO_ID) -> DataFrame:
    """Rows per sequence position s = patients with at least s rows. Derived
    from the size histogram (one row per distinct size), so no per-row
    window runs."""
    h = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(
        F.count(F.lit(1)).alias("patients"))
    return (h.select(F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("s"), "patients")
            .groupBy(F.col("s").cast("int").alias("sequence_number"))
            .agg(F.sum("patients").cast("bigint").alias("n_rows")))
