"""Prepare pipeline (F13) and its reports.

clean -> pseudonymize -> days / sequence / interactions -> patient split ->
baseline and enhanced train / test tables. The cleaned rows are written once,
sorted by patient and date, as the id map and the patients' labels read them.
Pseudonym, split, fold and the place in the sequence follow from one row per
patient and range of that order; a single join, which sends no patient table
through the driver, gives them to the rows, and the rows are written once more.
The four outputs are columns and rows of that table.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consult import schema as S
from consult.functions.grouprank import BEFORE, NUMBER, RANGE, TOTAL, group_pieces, position, ranged_rows
from consult.operators.cleaning import clean
from consult.operators.features import (add_consultation_sequence, add_days_since_accident, add_interactions,
                                        patient_label, select_baseline, select_enhanced, sequence_columns)
from consult.operators.pseudonym import apply_mapping, build_id_mapping
from consult.operators.split import patient_folds, split_rows, stratified_patient_split
from consult.session import stage


def feature_table(cleaned: DataFrame, materialize: bool = False,
                  **prefix_kw) -> tuple[DataFrame, DataFrame]:
    """(features, id mapping) from a cleaned consultation table.

    The sequence is numbered on the original id and the pseudonym is joined
    afterwards: the pseudonym is a bijection of the id, so the numbering is
    the same, and each patient's first row is the id list for the map. A row
    without an id has no pseudonym and fails the job that reads it
    (``apply_mapping``); it never falls out of the split unseen.
    """
    f = _numbered(cleaned)
    if materialize:
        f = stage(f, "features")
    mapping = _mapping(f, **prefix_kw)
    return apply_mapping(f, mapping), mapping


def _numbered(cleaned: DataFrame) -> DataFrame:
    """Days, sequence and interactions under the original id."""
    return add_interactions(add_consultation_sequence(add_days_since_accident(cleaned), key=S.ID))


def _mapping(numbered: DataFrame, **prefix_kw) -> DataFrame:
    # Each patient's first consultation is its one row: the id list for the
    # map needs no distinct (and no second pass over the raw input).
    return build_id_mapping(numbered.where(F.col("consultation_number") == 1), S.ID, unique=True, **prefix_kw)


def tagged_rows(cleaned: DataFrame, test_fraction: float = S.TEST_FRACTION, seed: int = S.SEED,
                **prefix_kw) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(features with ``split`` and, for training rows, ``fold``; id mapping; split table).

    Positions, labels, split and folds are worked out per patient (and range of the
    sorted rows); the rows are written once, sorted, and joined once, by
    sort-merge: at no size does a patient table go through the driver."""
    # Days follow from the dates, so they do not order rows: they are worked out behind the sort.
    ordered = [c for c in cleaned.columns if c not in (S.ID, S.CONTACT_DATE, "days_since_accident")]
    rows = ranged_rows(cleaned, [S.ID], [c for c in (S.CONTACT_DATE,) if c in cleaned.columns] + ordered, prefix_kw.get("num_partitions"))
    pieces = stage(group_pieces(rows, [S.ID]), "pieces")
    # A patient's first piece is its one row in the id list of the map.
    mapping = stage(build_id_mapping(pieces.where(F.col(BEFORE) == 0), S.ID, unique=True, **prefix_kw), "mapping")
    named = mapping.select(F.col("original_id").alias("__k"), F.col("anonymous_id").alias(S.PSEUDO_ID))
    labels = patient_label(rows.select(F.col(S.ID).cast("string").alias("__k"), S.LABEL), "__k").join(named.hint("merge"), "__k").drop("__k")
    split = stage(stratified_patient_split(rows, test_fraction=test_fraction, seed=seed, labels=labels), "split")
    folds = patient_folds(split.where("split = 'train'").select(S.PSEUDO_ID, "patient_label"))
    who = named.join(split.select(S.PSEUDO_ID, "split").hint("merge"), S.PSEUDO_ID).join(folds.hint("merge"), S.PSEUDO_ID, "left")
    p = pieces.join(who.hint("merge"), F.col(S.ID).cast("string") == F.col("__k"), "left").drop("__k")
    p = p.withColumnsRenamed({RANGE: "__range", S.ID: "__id"})
    f = add_days_since_accident(rows)
    # Rows without an id have pieces too, so that only their pseudonym fails.
    j = f.join(p.hint("merge"), (F.col(RANGE) == F.col("__range")) & F.col(S.ID).eqNullSafe(F.col("__id")))
    pid = F.coalesce(S.PSEUDO_ID, F.raise_error(F.lit("Anonymization failed: id missing or not in the map")).cast("bigint"))
    j = j.select(pid.alias(S.PSEUDO_ID), *[c for c in f.columns if c not in (S.ID, RANGE, NUMBER)], *sequence_columns(position(), F.col(TOTAL)), "split", "fold")
    j = add_interactions(j)
    return j.select(*[c for c in j.columns if c not in ("split", "fold")], "split", "fold"), mapping, split


def model_tables(rows: DataFrame, keep: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The four model tables of ``tagged_rows``, the training tables with ``keep`` too."""
    out = {}
    for name, pick in (("baseline", select_baseline), ("enhanced", select_enhanced)):
        cols = pick(rows).columns
        for side in ("train", "test"):
            out[f"{name}_{side}"] = rows.where(F.col("split") == side).select(*cols, *(keep if side == "train" else ()))
    return out


def build_datasets(raw: DataFrame, test_fraction: float = S.TEST_FRACTION, seed: int = S.SEED,
                   is_clean: bool = False, materialize: bool = True, **prefix_kw) -> dict[str, DataFrame]:
    """All prepare outputs. Train / test tables keep the pseudonym column
    (needed for grouped folds); ``export_sets`` drops it."""
    cleaned = raw if is_clean else clean(raw)
    if materialize:
        rows, mapping, split = tagged_rows(cleaned, test_fraction, seed, **prefix_kw)
        rows = stage(rows, "tagged")
        return {"cleaned": cleaned, "mapping": mapping, "features": rows.drop("split", "fold"), "split": split, **model_tables(rows)}
    feats, mapping = feature_table(cleaned, **prefix_kw)
    split = stratified_patient_split(feats, test_fraction=test_fraction, seed=seed)
    base = select_baseline(feats)
    enh = select_enhanced(feats)
    out = {"cleaned": cleaned, "mapping": mapping, "features": feats, "split": split}
    for name, d in (("baseline", base), ("enhanced", enh)):
        for side in ("train", "test"):
            out[f"{name}_{side}"] = split_rows(d, split, side)
    return out


def export_sets(ds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four model tables without the pseudonym (reference output shape)."""
    return {k: v.drop(S.PSEUDO_ID) for k, v in ds.items()
            if k.startswith(("baseline_", "enhanced_"))}


def pipeline_summary(raw: DataFrame, ds: dict[str, DataFrame]) -> DataFrame:
    """Tidy (stage, metric, value) record flow: the clean stages, the mapping
    verdict, rows, patients, features and labels of the four model tables, and
    the five quality-assurance flags (1 / 0)."""
    from consult.operators.cleaning import cleaning_summary
    from consult.operators.pseudonym import validate_mapping
    from consult.operators.split import validate_feature_sets

    def row(stage, metric, value):
        return F.struct(F.lit(stage).alias("stage"), metric.alias("metric"), value.cast("double").alias("value"))

    cleaned, names = ds["cleaned"], ("baseline_train", "baseline_test", "enhanced_train", "enhanced_test")
    swapped = ds["features"].select(S.PSEUDO_ID, *[c for c in cleaned.columns if c != S.ID])
    mapped = validate_mapping(cleaned, swapped, ds["mapping"]).agg(F.bool_and("passed").alias("mapped"))
    # At most 22 checks, so one row holds them all.
    checks = validate_feature_sets(*[ds[n] for n in names], key=S.PSEUDO_ID).agg(
        F.collect_list(F.struct("feature_set", "check_name", "value", "passed")).alias("checks"))
    one = (cleaning_summary(raw).unionByName(mapped, allowMissingColumns=True)
           .unionByName(checks, allowMissingColumns=True))
    one = one.agg(*[F.max(c).alias(c) for c in one.columns])

    def passed(*check):
        hit = F.filter("checks", lambda c: c.check_name.isin(*check)) if check else F.col("checks")
        return F.forall(hit, lambda c: c.passed).cast("int")

    metric = {"n_rows": "rows", "n_positive": "label_1", "n_features": "features", "null_cells": "null_cells"}
    per_table = F.transform(
        F.filter("checks", lambda c: c.check_name.isin(*metric)),
        lambda c: row("features", F.concat_ws("_", c.feature_set, F.element_at(
            F.create_map(*[F.lit(x) for kv in metric.items() for x in kv]), c.check_name)), c.value))
    flow = [row("clean", F.lit(c), F.col(c)) for c in (
        "original_records", "after_label_filter", "after_missing_removal", "final_records",
        "retention_pct", "unique_patients", "final_missing_values")]
    flags = [row("anonymize", F.lit("mapping_valid"), F.col("mapped").cast("int"))]
    flags += [row("quality_assurance", F.lit(n), v) for n, v in (
        ("data_cleaning_passed", (F.col("final_missing_values") == 0).cast("int")),
        ("anonymization_validation_passed", F.col("mapped").cast("int")),
        ("feature_set_validation_passed", passed()),
        ("patient_level_split_verified", passed("row_count_match", "shared_patients")),
        ("target_distribution_preserved", passed("label_count_match")))]
    report = one.select(F.explode(F.concat(F.array(*flow, *flags), per_table)).alias("r")).select("r.*")
    tables = [ds[n].select(F.lit(n).alias("name"), S.PSEUDO_ID) for n in names]
    patients = tables[0]
    for t in tables[1:]:
        patients = patients.unionByName(t)
    patients = patients.groupBy("name").agg(F.count_distinct(S.PSEUDO_ID).cast("double").alias("value"))
    out = report.unionByName(patients.select(F.lit("features").alias("stage"),
                                             F.concat("name", F.lit("_patients")).alias("metric"), "value"))
    return out.select("stage", "metric", F.round("value", 6).alias("value"))


def row_accounting(raw: DataFrame) -> DataFrame:
    """(step, n_in, n_out, n_rejected, balanced) of the prepare steps, each side counted by itself.

    Rows without an id cannot be pseudonymized: they leave at ``pseudonymize``
    as rejects (``unmapped_rows``) and the other rows go on to the split."""
    from consult.operators import cleaning as C
    from consult.operators.pseudonym import unmapped_rows
    key = F.col(S.LABEL).isin(0, 1)
    typed = C.coerce_types(raw)
    labelled = C.binary_label_filter(typed)
    complete = C.drop_missing_critical(labelled)
    cleaned = clean(raw).persist(StorageLevel.MEMORY_AND_DISK)
    ds = build_datasets(cleaned.where(F.col(S.ID).isNotNull()), is_clean=True)
    lacking = F.lit(False)
    for c in S.CRITICAL_COLUMNS:
        lacking = lacking | F.col(c).isNull()
    copies = complete.groupBy(*complete.columns).agg((F.count(F.lit(1)) - 1).alias("n"))
    sides = ds["enhanced_train"].select(F.lit(1)).unionAll(ds["enhanced_test"].select(F.lit(1)))
    nothing = raw.sparkSession.range(0)

    def n(df, step, what, value=None):
        total = F.count(F.lit(1)) if value is None else F.coalesce(F.sum(value), F.lit(0))
        return df.agg(total.cast("bigint").alias("n")).select(F.lit(step).alias("step"), F.lit(what).alias("what"), "n")

    parts = [n(raw, "label_filter", "n_in"), n(labelled, "label_filter", "n_out"),
             n(typed.where(~F.coalesce(key, F.lit(False))), "label_filter", "n_rejected"),
             n(labelled, "missing_removal", "n_in"), n(complete, "missing_removal", "n_out"),
             n(labelled.where(lacking), "missing_removal", "n_rejected"),
             n(complete, "deduplication", "n_in"), n(cleaned, "deduplication", "n_out"),
             n(copies, "deduplication", "n_rejected", F.col("n")),
             n(cleaned, "pseudonymize", "n_in"), n(ds["features"], "pseudonymize", "n_out"),
             n(unmapped_rows(cleaned, ds["mapping"]), "pseudonymize", "n_rejected"),
             n(ds["features"], "split", "n_in"), n(sides, "split", "n_out"), n(nothing, "split", "n_rejected")]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionAll(x)
    out = out.groupBy("step").pivot("what", ["n_in", "n_out", "n_rejected"]).agg(F.max("n"))
    return out.withColumn("balanced", F.col("n_in") == F.col("n_out") + F.col("n_rejected"))


def export_datasets(ds: dict[str, DataFrame], root: str, run_id: str, parallelism: int = 4) -> dict[str, str]:
    """Write the four model tables (pseudonym dropped) as ``run_id``
    partitions under ``root/<table>``, and the id map to its own location
    ``root/_mapping/run_id=<id>`` (never joined into the outputs). The
    writes run concurrently. Returns {table: path}."""
    from concurrent.futures import ThreadPoolExecutor

    from consult.sources.io import write_mapping, write_stage
    paths = {k: f"{root.rstrip('/')}/{k}" for k in export_sets(ds)}
    tables = export_sets(ds)
    with ThreadPoolExecutor(max(1, parallelism)) as ex:
        list(ex.map(lambda k: write_stage(tables[k], paths[k], run_id), paths))
    paths["mapping"] = f"{root.rstrip('/')}/_mapping/run_id={run_id}"
    write_mapping(ds["mapping"], paths["mapping"])
    return paths
