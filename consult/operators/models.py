"""Distributed learners, cross-validation, registry and scoring.

Fits run on executors (Spark ML); the driver only loops over the six
(learner, feature set) jobs and the folds, optionally in a thread pool so
independent fits share the cluster. Fold AUCs use the exact distributed
metric of ``metrics.auc_roc``, not a binned one.
"""

from __future__ import annotations

import itertools
import math
import sys
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from consult import schema as S
from consult.functions.exprs import confidence_level, r6
from consult.operators import forest
from consult.operators.features import SCORING_INTERACTIONS, add_interactions, fill_defaults
from consult.operators.metrics import auc_roc
from consult.session import scratch_path, stage

LEARNERS = ["logistic_regression", "random_forest", "gbt"]
FEATURE_SETS = {"baseline": S.BASELINE_FEATURES, "enhanced": S.ENHANCED_FEATURES}


class FeatureCountError(ValueError):
    pass


def feature_count_guard(feature_set: str, cols: list[str]) -> None:
    """The table's columns must hold every feature of the set (4 or 10)."""
    want = FEATURE_SETS[feature_set]
    missing = [c for c in want if c not in cols]
    if missing:
        raise FeatureCountError(f"{feature_set} expects {len(want)} features, "
                                f"got {len(want) - len(missing)}; missing {missing}")


#: The constant feature whose weight is the logistic intercept.
BIAS = "__bias"
#: Distinct rows of a counted table that one partition holds.
COUNTED_ROWS = 100_000


def make_learner(name: str, n_train: int, seed: int = S.SEED, **params):
    """Reference hyperparameters in Spark terms; ``params`` override them.

    Logistic: the sum of log losses plus half the squared weights (C = 1), the
    intercept's included: a constant feature instead of an intercept (fitted on
    ``mirrored`` rows), and regParam = 1 / n on the mean loss. Forest: 100 trees, depth 10, at least 2
    rows per leaf, sqrt features. Boosted: 100 rounds, depth 6, step 0.1, log
    loss; node ids are not cached (shallow trees: the cache costs more than it
    saves; the deep forest does cache them), and the per-round lineage is
    checkpointed every 10 rounds. Trees aggregate a level's nodes in up to 1 GB
    at once. Logistic and boosted learners take weights, the forest's trees those of their bags."""
    if name == "logistic_regression":
        return LogisticRegression(**{**dict(
            featuresCol="features", labelCol="label", weightCol="weight", regParam=1.0 / max(n_train, 1), elasticNetParam=0.0,
            standardization=False, fitIntercept=False, maxIter=1000, tol=1e-8), **params})
    if name == "random_forest":
        return RandomForestClassifier(**{**dict(
            featuresCol="features", labelCol="label", numTrees=100, maxDepth=10, minInstancesPerNode=2, featureSubsetStrategy="sqrt",
            seed=seed, cacheNodeIds=True, checkpointInterval=10, maxMemoryInMB=1024), **params})
    if name == "gbt":
        return GBTClassifier(**{**dict(
            featuresCol="features", labelCol="label", weightCol="weight", maxIter=100, maxDepth=6, stepSize=0.1, seed=seed,
            lossType="logistic", cacheNodeIds=False, checkpointInterval=10, maxMemoryInMB=1024), **params})
    raise ValueError(f"unknown learner {name}")


def complete_rows(df: DataFrame, feature_set: str, label: str = S.LABEL, keep: tuple[str, ...] = ()) -> DataFrame:
    """Features and ``label`` as DOUBLE, the constant feature and ``keep``; rows that miss a feature or label are left out."""
    cols = FEATURE_SETS[feature_set]
    feature_count_guard(feature_set, df.columns)
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(label).cast("double").alias("label"), *keep)
    return rows.na.drop(subset=[*cols, "label"]).withColumn(BIAS, F.lit(1.0))


def count_rows(rows: DataFrame, feature_set: str, keep: tuple[str, ...] = ()) -> tuple[DataFrame, int, DataFrame]:
    """Distinct ``complete_rows`` with their count as ``weight``, the number of all rows, and what is persisted.

    Scores and states are small integers, so rows repeat. The table is written
    once, so that nothing counts it again after the unpersist, and gets one
    partition per ``COUNTED_ROWS`` distinct rows, as a boosted fit runs some
    hundred short jobs over it; unpersist the last after use."""
    counted = stage(rows.groupBy(*FEATURE_SETS[feature_set], "label", BIAS, *keep).agg(F.count(F.lit(1)).cast("double").alias("weight")), "counted")
    distinct, n = counted.agg(F.count(F.lit(1)), F.sum("weight")).first()
    table = counted.coalesce(max(1, -(-distinct // COUNTED_ROWS))).persist()
    return table, int(n or 0), table


def mirrored(counted: DataFrame, feature_set: str) -> DataFrame:
    """Every row twice: as it is, and with all features negated and the other label.

    Both have the same logistic loss, so the mean loss stays as it is, and the
    constant feature varies: Spark gives a feature without variance no weight."""
    s = F.col("__sign")
    both = counted.select("*", F.explode(F.array(F.lit(1.0), F.lit(-1.0))).alias("__sign"))
    changed = {c: F.col(c) * s for c in [*FEATURE_SETS[feature_set], BIAS]} | {"label": F.when(s < 0, 1.0 - F.col("label")).otherwise(F.col("label"))}
    return both.select(*[changed.get(c, F.col(c)).alias(c) for c in counted.columns])


#: Bins of a feature in a boosted fit (Spark's own default).
BINS = 32


def bin_thresholds(counted: DataFrame, feature_set: str, bins: int = BINS) -> dict[str, list[float]]:
    """Rising split points of every feature, at most ``bins`` - 1, by the rule of Spark's trees
    (midpoints next to equal shares of the weight), over all rows instead of a sample of them.

    One task holds the distinct values of one feature; a bin's rows all go the same way in every tree."""
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in FEATURE_SETS[feature_set]]))
    values = counted.select(pairs, "weight").groupBy("feature", "value").agg(F.sum("weight").alias("weight"))

    def one(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("value")
        v, w = p["value"].tolist(), p["weight"].tolist()
        mid = [(a + b) / 2 for a, b in zip(v, v[1:])]
        if len(mid) >= bins:
            stride = sum(w) / bins
            target, seen, kept = stride, w[0], []
            for m, x in zip(mid, w[1:]):
                if abs(seen - target) < abs(seen + x - target):
                    kept.append(m)
                    target += stride
                seen += x
            mid = kept
        return pd.DataFrame({"feature": [p["feature"].iloc[0]], "thresholds": [mid]})
    found = values.groupBy("feature").applyInPandas(one, "feature string, thresholds array<double>").collect()  # one short row a feature
    return {r["feature"]: list(r["thresholds"]) for r in found}


def _bucketizer(thresholds: list[list[float]], cols: list[str], out: list[str]) -> Bucketizer:
    # A tree sends values up to the threshold left, a bucket starts with its own split: splits are the next larger number.
    splits = [[-math.inf, *([math.nextafter(t, math.inf) for t in ts] or [sys.float_info.max]), math.inf] for ts in thresholds]
    return Bucketizer(splitsArray=splits, inputCols=cols, outputCols=out, handleInvalid="keep")


def _binned(counted: DataFrame, feature_set: str, bins: int, rows: int = COUNTED_ROWS) -> tuple[Bucketizer, VectorAssembler, DataFrame]:
    """Buckets, assembler, and one row of (bins, label, weight) for each combination that is there, ``rows`` of them a partition."""
    cols = FEATURE_SETS[feature_set]
    own = [f"{c}__bin" for c in cols]
    found = bin_thresholds(counted, feature_set, bins)
    buckets = _bucketizer([found.get(c, []) for c in cols], cols, own)
    binned = stage(buckets.transform(counted).groupBy(*own, "label").agg(F.sum("weight").alias("weight")), "binned")
    binned = binned.coalesce(max(1, -(-binned.count() // rows)))
    return buckets, VectorAssembler(inputCols=own, outputCol="features", handleInvalid="skip"), binned


def fit_boosted(counted: DataFrame, feature_set: str, **params) -> PipelineModel:
    """Boosted pipeline (buckets, assembler, learner) fitted on the counted rows' bins.

    Trees only see a value's bin, so rows of the same bins count as one: a round
    reads at most one row for each combination of bins and label, however many rows there are."""
    buckets, assembler, binned = _binned(counted, feature_set, params.get("maxBins", BINS))
    binned = binned.persist()
    try:
        # With that many bins allowed, Spark's own search of splits reads all binned rows and keeps every bin.
        learner = make_learner("gbt", 0, **{**params, "maxBins": 1024})
        return PipelineModel([buckets, assembler, learner.fit(assembler.transform(binned))])
    finally:
        binned.unpersist()


#: Rows of bins of a forest that one task goes through, all trees of a level in one go.
FOREST_ROWS = 50_000
#: Rows up to which a forest reads single rows: it keeps the models of small tables as they are.
SINGLE_ROWS = 1_000_000


def draw_bags(binned: DataFrame, trees: int, rate: float, bootstrap: bool, seed: int) -> DataFrame:
    """``binned`` with ``draws``: how often each tree's bag holds the row.

    Single rows are each drawn Poisson(``rate``) times by Spark's forest (without
    bootstrap: kept with that probability), so a row that stands for ``weight``
    equal ones is drawn Poisson(``rate`` * ``weight``) times (binomially). Draws
    depend on the row's values and the seed alone, not on partitions or order."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            draws = []
            for h, w in zip(b.pop("__hash"), b["weight"], strict=True):
                rng = np.random.default_rng([seed % 2**64, h % 2**64])
                draws.append(rng.poisson(w * rate, trees) if bootstrap else rng.binomial(int(w), rate, trees))
            b["draws"] = draws
            yield b
    hashed = binned.withColumn("__hash", F.xxhash64(*[c for c in binned.columns if c != "weight"]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in binned.schema.fields)
    return hashed.mapInPandas(run, f"{fields}, draws array<bigint>")


def fit_forest(counted: DataFrame, feature_set: str, rows: DataFrame | None = None, **params) -> PipelineModel:
    """Forest pipeline (buckets, assembler, learner) fitted on the counted rows' bins.

    Every tree has its own bag of single rows. Rows of the same bins go the same
    way in every tree, so a bag is the number of times that each combination of bins
    and label is drawn (``draw_bags``). All trees grow together, one job a level
    (``forest.grow``). Leaves hold at least ``minInstancesPerNode`` drawn rows.
    A tree with an empty bag has no vote. Of ``rows``, the same rows
    singly (``SINGLE_ROWS`` at most), Spark's forest draws the bags itself."""
    learner = make_learner("random_forest", 0, **params)
    if rows is not None:
        return Pipeline(stages=[_assembler(feature_set, "random_forest"), learner]).fit(rows)
    cols, n_trees, kind = FEATURE_SETS[feature_set], learner.getNumTrees(), learner.getImpurity()
    buckets, assembler, binned = _binned(counted, feature_set, learner.getMaxBins(), FOREST_ROWS)
    bags = draw_bags(binned, n_trees, learner.getSubsamplingRate(), learner.getBootstrap(), learner.getSeed())
    blocks = stage(forest.pack_bags(bags, assembler.getInputCols()), "bags").persist()
    try:
        sizes = forest.bag_sizes(blocks, n_trees)
        if not sizes.any():
            raise ValueError("no rows to fit a forest on")
        least = np.maximum(learner.getMinInstancesPerNode(), learner.getMinWeightFractionPerNode() * sizes.sum(1))
        subset = forest.subset_size(learner.getFeatureSubsetStrategy(), len(cols), n_trees)
        trees = forest.grow(blocks, sizes, subset, len(cols), max(map(len, buckets.getSplitsArray())), learner.getMaxDepth(), least, learner.getMinInfoGain(), kind, learner.getSeed())
    finally:
        blocks.unpersist()
    return PipelineModel([buckets, assembler, _forest(counted.sparkSession, learner, forest.nodes_table(trees, kind), len(trees), len(cols), sizes.shape[1])])


def _forest(spark: SparkSession, learner: RandomForestClassifier, nodes: pa.Table, n_trees: int, n_features: int, classes: int) -> RandomForestClassificationModel:
    """Spark's model of the nodes: a forest of roots, saved, gets them in their place and is read again."""
    label = F.col("label").alias("label", metadata={"ml_attr": {"type": "nominal", "num_vals": classes}})
    zeros = VectorAssembler(inputCols=["zero"] * n_features, outputCol="features").transform(spark.range(2).select(F.col("id").cast("double").alias("label"), F.lit(0.0).alias("zero")))
    roots = RandomForestClassifier(numTrees=n_trees, maxDepth=0, bootstrap=False, seed=learner.getSeed()).fit(zeros.select("features", label))
    path = scratch_path(spark, f"forest/{uuid.uuid4().hex}")
    roots.write().session(spark).save(path)
    spark.createDataFrame(nodes, forest.NODES).write.mode("overwrite").parquet(f"{path}/data")
    model = RandomForestClassificationModel.load(path)
    model._resetUid(learner.uid)
    return learner._copyValues(model)


def _training_rows(counted: DataFrame, learner: str, feature_set: str) -> DataFrame:
    return mirrored(counted, feature_set) if learner == "logistic_regression" else counted


def _assembler(feature_set: str, learner: str, invalid: str = "skip") -> VectorAssembler:
    cols = FEATURE_SETS[feature_set] + ([BIAS] if learner == "logistic_regression" else [])
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid=invalid)


def _vectors(df: DataFrame, cols: list[str], model: PipelineModel) -> DataFrame:
    """``df`` with the feature vector of ``cols`` that the fitted model reads; incomplete rows stay."""
    if isinstance(model.stages[0], Bucketizer):
        binned = [f"__bin_{i}" for i in range(len(cols))]
        buckets = Bucketizer(splitsArray=model.stages[0].getSplitsArray(), inputCols=cols, outputCols=binned, handleInvalid="keep")
        return VectorAssembler(inputCols=binned, outputCol="features", handleInvalid="keep").transform(buckets.transform(df)).drop(*binned)
    own = cols + ([BIAS] if model.stages[-1].numFeatures > len(cols) else [])
    return VectorAssembler(inputCols=own, outputCol="features", handleInvalid="keep").transform(df.withColumn(BIAS, F.lit(1.0)))


def fit(df: DataFrame, learner: str, feature_set: str, label: str = S.LABEL,
        n_train: int | None = None, **params) -> PipelineModel:
    """Assembler + learner pipeline fitted on ``df`` (label 0/1). Rows with a
    missing feature (e.g. an unparseable contact date gives no day count)
    are left out of the fit rather than failing it.

    Logistic fits read each distinct (features, label) row once, weighted by its
    count, boosted ones each distinct row of bins (``fit_boosted``), which leaves their sums as they are. The forest bags
    single rows by drawing how many of a counted row each tree gets (``fit_forest``). ``n_train`` sets the logistic penalty
    (default: the number of complete rows)."""
    rows = complete_rows(df, feature_set, label)
    counted, n, held = count_rows(rows, feature_set)
    try:
        if learner == "random_forest":
            return fit_forest(counted, feature_set, rows if n <= SINGLE_ROWS else None, **params)
        if learner == "gbt":
            return fit_boosted(counted, feature_set, **params)
        return Pipeline(stages=[_assembler(feature_set, learner), make_learner(learner, n_train or n, **params)]).fit(_training_rows(counted, learner, feature_set))
    finally:
        held.unpersist()


def predict(model: PipelineModel, df: DataFrame, feature_set: str) -> DataFrame:
    """Every input row (features as DOUBLE) plus ``score`` = P(label = 1).

    A row that misses a feature keeps its place with a null score."""
    cols = FEATURE_SETS[feature_set]
    feature_count_guard(feature_set, df.columns)
    d = df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])
    out = model.stages[-1].transform(_vectors(d, cols, model))
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull() & ~F.isnan(c)
    return out.select(*df.columns, F.when(complete, vector_to_array("probability")[1]).alias("score"))


def cross_validate(df: DataFrame, learner: str, feature_set: str, folds_col: str = "fold",
                   k: int = S.N_FOLDS, label: str = S.LABEL, parallelism: int = 1) -> DataFrame:
    """(fold, auc) for each held-out fold; ``df`` carries the fold column.

    Rows are counted once by (features, label, fold). That table is filtered per
    fold for the fits, and the held-out rows are
    scored from it with their counts. The AUCs are exact, of all folds in one go."""
    spark = df.sparkSession
    rows = complete_rows(df, feature_set, label, (folds_col,))
    counted, total, cached = count_rows(rows, feature_set, (folds_col,))
    single = learner == "random_forest" and total <= SINGLE_ROWS
    if single:
        rows = rows.persist()

    def scores(m, held):
        return predict(m, counted.where(held), feature_set).select(F.col(folds_col).cast("int").alias("fold"), "label", "weight", "score")

    def one(f):
        held = F.col(folds_col) == f
        part = counted.where(~held)
        if learner == "random_forest":
            return scores(fit_forest(part, feature_set, rows.where(~held) if single else None), held)
        if learner == "gbt":
            return scores(fit_boosted(part, feature_set), held)
        n = int(part.agg(F.sum("weight")).first()[0] or 0)
        m = Pipeline(stages=[_assembler(feature_set, learner), make_learner(learner, n)]).fit(_training_rows(part, learner, feature_set))
        return scores(m, held)

    if parallelism > 1:
        with ThreadPoolExecutor(parallelism) as ex:
            scored = list(ex.map(one, range(k)))
    else:
        scored = [one(f) for f in range(k)]
    whole = scored[0]
    for s in scored[1:]:
        whole = whole.unionByName(s)
    found = {r["fold"]: r["auc_roc"] for r in auc_roc(whole, ["fold"], weight="weight").collect()}  # one row a fold
    cached.unpersist()
    if single:
        rows.unpersist()
    return spark.createDataFrame([(f, found.get(f)) for f in range(k)], "fold int, auc double")


class ExactAUC(Evaluator):
    """Area under the ROC curve by the exact distributed metric, over weighted rows."""

    def _evaluate(self, dataset: DataFrame) -> float:
        # Mirrored rows have a negative constant; they take part in fits only.
        scored = dataset.where(F.col(BIAS) > 0).select("label", "weight", vector_to_array("probability")[1].alias("score"))
        auc = auc_roc(scored, weight="weight").first()["auc_roc"]
        return float("nan") if auc is None else float(auc)

    def isLargerBetter(self) -> bool:  # noqa: N802 - the interface's name
        return True


def grid_candidates(grid: dict[str, list]) -> list[dict]:
    """Every combination of the grid's values, the last name varying fastest."""
    return [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]


def grid_search(df: DataFrame, learner: str, feature_set: str, grid: dict[str, list], folds_col: str = "fold",
                k: int = S.N_FOLDS, label: str = S.LABEL, parallelism: int = 8, **params) -> tuple[PipelineModel, DataFrame]:
    """Best model, and (candidate, params, mean_auc, std_auc, best) of every candidate.

    ``grid`` maps the learner's parameters to values, ``params`` fixes others. All candidates are fitted
    on one table of rows counted by (features, label, fold) and compared by their
    exact AUC on the held-out folds of ``folds_col``; the best (ties: the first)
    is fitted on all rows. The forest bags single rows, so it reads them."""
    spark = df.sparkSession
    rows = complete_rows(df, feature_set, label, (folds_col,))
    if learner == "random_forest":
        table, n, held = rows.withColumn("weight", F.lit(1.0)).persist(), 0, None
    else:
        table, n, held = count_rows(rows, feature_set, (folds_col,))
    estimator = make_learner(learner, n, **params)
    candidates = grid_candidates(grid)
    maps = [{estimator.getParam(p): v for p, v in c.items()} for c in candidates]
    search = CrossValidator(estimator=Pipeline(stages=[_assembler(feature_set, learner), estimator]), estimatorParamMaps=maps, evaluator=ExactAUC(),
                            numFolds=k, foldCol=folds_col, parallelism=parallelism, seed=S.SEED)
    try:
        found = search.fit(_training_rows(table, learner, feature_set))
    finally:
        (held if held is not None else table).unpersist()
    top = max(range(len(maps)), key=lambda i: found.avgMetrics[i])
    out = [(i, {p: str(v) for p, v in c.items()}, float(found.avgMetrics[i]), float(found.stdMetrics[i]), i == top) for i, c in enumerate(candidates)]
    return found.bestModel, spark.createDataFrame(out, "candidate int, params map<string,string>, mean_auc double, std_auc double, best boolean")


def logistic_gradient(model: PipelineModel, df: DataFrame, feature_set: str, label: str = S.LABEL, c: float = 1.0) -> DataFrame:
    """(coordinate, n_rows, gradient, scale): the gradient of C * sum of log losses + half
    the squared weights at the fitted weights, summed over all complete rows; ``scale`` is the
    sum of |x| of the coordinate. At the optimum every gradient is 0."""
    cols = [*FEATURE_SETS[feature_set], BIAS]
    beta = [float(b) for b in model.stages[-1].coefficients.toArray()]
    rows = complete_rows(df, feature_set, label).groupBy(*cols, "label").agg(F.count(F.lit(1)).alias("n"))
    margin = sum((F.col(x) * b for x, b in zip(cols, beta, strict=True)), F.lit(0.0))
    off = F.col("n") * (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) - F.col("label"))
    one = rows.agg(F.sum("n").alias("n_rows"), *[F.sum(off * F.col(x)).alias(f"g_{i}") for i, x in enumerate(cols)],
                   *[F.sum(F.col("n") * F.abs(F.col(x))).alias(f"s_{i}") for i, x in enumerate(cols)])
    named = ["intercept" if x == BIAS else x for x in cols]
    parts = [F.struct(F.lit(x).alias("coordinate"), (F.lit(c) * F.col(f"g_{i}") + b).alias("gradient"), F.col(f"s_{i}").alias("scale"))
             for i, (x, b) in enumerate(zip(named, beta, strict=True))]
    return one.select("n_rows", F.inline(F.array(*parts))).select("coordinate", "n_rows", "gradient", "scale")


def cv_summary(cv: DataFrame) -> DataFrame:
    """Mean and population std of the fold AUCs."""
    return cv.agg(r6(F.avg("auc")).alias("cv_mean"), r6(F.stddev_pop("auc")).alias("cv_std"),
                  F.count(F.lit(1)).alias("n_folds"))


def importances(model: PipelineModel, feature_set: str) -> dict[str, float]:
    """Tree importance or |coefficient| of each feature of a fitted pipeline."""
    est = model.stages[-1]
    vals = est.featureImportances if hasattr(est, "featureImportances") else est.coefficients
    return {c: abs(float(v)) for c, v in zip(FEATURE_SETS[feature_set], vals.toArray())}


def feature_importance(model: PipelineModel, feature_set: str, top: int = 10) -> DataFrame:
    """Tree importances or |coefficient|, ranked, top ``top`` (a top-k report)."""
    spark = SparkSession.getActiveSession()
    ranked = sorted(importances(model, feature_set).items(), key=lambda t: -t[1])[:top]
    return spark.createDataFrame([(i + 1, c, v) for i, (c, v) in enumerate(ranked)],
                                 "rank int, feature string, importance double")


#: One row per trained model (M9): what the registry keeps of it.
METADATA = ("learner string, feature_set string, n_train bigint, n_features int, features array<string>, "
            "cv_scores array<double>, cv_mean double, cv_std double, fit_seconds double, "
            "importances map<string,double>, trained_at string, error string")


def train_all(train_sets: dict[str, DataFrame], learners: list[str] = LEARNERS, k: int = S.N_FOLDS,
              with_cv: bool = True, parallelism: int = 1, fold_seed: int = S.SEED,
              fit_one=None, cv_one=None):
    """Fit every learner on every feature set; one failure does not stop the
    rest. Returns ({(learner, set): PipelineModel}, METADATA rows); a failed
    pair has its error text and no model.

    ``fit_one(rows, learner, set)`` and ``cv_one(folded, learner, set)`` may
    stand in for ``fit`` and ``cross_validate``, e.g. to reuse saved results.
    Rows that have a ``fold`` keep it."""
    from consult.operators.split import assign_folds
    spark = next(iter(train_sets.values())).sparkSession
    fit_one = fit_one or fit
    cv_one = cv_one or (lambda folded, learner, fs: cross_validate(folded, learner, fs, k=k))
    held = {fs: (assign_folds(d, k=k, seed=fold_seed) if with_cv and "fold" not in d.columns else d) for fs, d in train_sets.items()}
    # Rows that are only counted here are not kept.
    held = {fs: d if "fold" in train_sets[fs].columns else d.persist() for fs, d in held.items()}
    counts = {fs: d.count() for fs, d in held.items()}

    def job(pair):
        learner, fs = pair
        row = dict.fromkeys(("cv_scores", "cv_mean", "cv_std", "fit_seconds", "importances", "error"))
        row.update(learner=learner, feature_set=fs, n_train=counts[fs], n_features=len(FEATURE_SETS[fs]),
                   features=FEATURE_SETS[fs], trained_at=time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime()))
        try:
            t0 = time.time()
            m = fit_one(held[fs], learner, fs)
            row.update(fit_seconds=time.time() - t0, importances=importances(m, fs))
            if with_cv:
                cv = cv_one(held[fs], learner, fs).persist()
                row.update(cv_scores=[r["auc"] for r in cv.orderBy("fold").collect()],
                           **cv_summary(cv).drop("n_folds").first().asDict())
                cv.unpersist()
            return pair, m, row
        except Exception as e:  # keep going with the other learners
            return pair, None, {**row, "error": str(e)}

    pairs = [(lr, fs) for fs in train_sets for lr in learners]
    if parallelism > 1:
        with ThreadPoolExecutor(parallelism) as ex:
            out = list(ex.map(job, pairs))
    else:
        out = [job(p) for p in pairs]
    for d in held.values():
        d.unpersist()
    names = [f.split()[0] for f in METADATA.split(", ")]
    summary = spark.createDataFrame([tuple(row[c] for c in names) for _, _, row in out], METADATA)
    return {pair: m for pair, m, _ in out if m is not None}, summary


def best_models(summary: DataFrame, metric: str = "cv_mean") -> DataFrame:
    """Best learner per feature set by ``metric`` (ties to the first name)."""
    from pyspark.sql import Window
    w = Window.partitionBy("feature_set").orderBy(F.col(metric).desc_nulls_last(), F.col("learner"))
    return summary.select("*", F.row_number().over(w).alias("__r")).where("__r = 1").drop("__r")


# ---------------------------------------------------------------------------
# S6 registry, V8 scoring, V10 model info
# ---------------------------------------------------------------------------

class ModelNotFound(LookupError):
    pass


def save_model(model: PipelineModel, root: str, learner: str, feature_set: str, run_id: str,
               summary_row: dict | None = None, spark: SparkSession | None = None) -> str:
    """Pipeline under <root>/<run_id>/<learner>_<set>, with its registry row.

    A caller in a thread of its own passes its session."""
    path = f"{root.rstrip('/')}/{run_id}/{learner}_{feature_set}"
    model.write().overwrite().save(path)
    row = {"importances": importances(model, feature_set), **(summary_row or {})}
    register_model(spark or SparkSession.active(), root, learner, feature_set, run_id, row)
    return path


def register_model(spark: SparkSession, root: str, learner: str, feature_set: str, run_id: str, row: dict) -> None:
    """METADATA row (as far as ``row`` has it) of a saved model in <root>/_registry,
    in a partition of its run and model: registering again replaces it."""
    names = [f.split()[0] for f in METADATA.split(", ")]
    full = {"n_features": len(FEATURE_SETS[feature_set]), "features": FEATURE_SETS[feature_set],
            "trained_at": time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime()),
            **{k: v for k, v in row.items() if v is not None}, "learner": learner, "feature_set": feature_set}
    name = f"{learner}_{feature_set}"
    (spark.createDataFrame([(*[full.get(c) for c in names], f"{root.rstrip('/')}/{run_id}/{name}", run_id, name)],
                           METADATA + ", path string, run_id string, model string")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id", "model").parquet(f"{root.rstrip('/')}/_registry"))


def registry(spark: SparkSession, root: str) -> DataFrame:
    """Metadata rows of all saved models; run ids are text."""
    reg = spark.read.parquet(f"{root.rstrip('/')}/_registry")
    return reg.withColumn("run_id", F.col("run_id").cast("string"))


def load_latest(spark: SparkSession, root: str, learner: str, feature_set: str) -> PipelineModel:
    """Newest model of a kind (max run_id, partition-pruned)."""
    reg = registry(spark, root).where((F.col("learner") == learner) & (F.col("feature_set") == feature_set))
    newest = reg.orderBy(F.col("run_id").desc()).select("path").first()
    if newest is None:
        raise ModelNotFound(f"no {learner} for {feature_set} in {root}")
    return PipelineModel.load(newest["path"])


def score_requests(requests: DataFrame, model: PipelineModel, feature_set: str, model_used: str,
                   defaults: dict = S.SCORING_DEFAULTS) -> DataFrame:
    """Defaults, interactions (enhanced), model probabilities of both
    classes, confidence band and model fields; one narrow pass."""
    d = requests
    if feature_set == "enhanced":
        d = add_interactions(fill_defaults(d, defaults), SCORING_INTERACTIONS)
    cols = FEATURE_SETS[feature_set]
    d2 = d.select("*", *[F.col(c).cast("double").alias(f"__f_{c}") for c in cols])
    out = model.stages[-1].transform(_vectors(d2, [f"__f_{c}" for c in cols], model))
    prob = vector_to_array("probability")
    return out.select(
        *requests.columns,
        *[c for c in d.columns if c not in requests.columns],
        prob[1].alias("nbe_yes_probability"), prob[0].alias("nbe_no_probability"),
        confidence_level(prob[1]).alias("confidence_level"),
        F.lit(model_used).alias("model_used"), F.lit(feature_set).alias("model_type"),
        F.current_timestamp().alias("prediction_timestamp"),
        F.lit(feature_set == "enhanced").alias("feature_engineering_applied"),
        F.lit(True).alias("input_validation_passed"))


def model_info(summary: DataFrame) -> DataFrame:
    """Algorithm, feature count and list, CV AUC, training rows and time per set,
    from METADATA rows (a registry or a training summary)."""
    return summary.select(
        "feature_set", F.col("learner").alias("algorithm"), F.col("n_features").alias("features"),
        F.col("cv_mean").alias("cv_auc"), F.col("n_train").alias("training_samples"),
        F.array_join("features", ",").alias("feature_list"), "trained_at", "fit_seconds")
