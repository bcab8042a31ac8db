"""Toxicity by FTRL-proximal logistic regression (operator 7).

Features are hashed words, neighbouring word pairs and skip-grams (word, any,
word) of a whole text, each counted as present or not, in ``BUCKETS`` buckets.
FTRL-proximal keeps a rate per coordinate and zeroes weights that L1 does not
let through; the weights that remain are few and are broadcast for scoring.

Learning reads at most about ``MAX_ROWS`` labelled rows (a documented bound;
they are chosen by a hash of their id): their features are hashed where the
texts lie, the bounded feature lists are dealt to one task in a fixed order,
and that task makes ``EPOCHS`` passes. Scoring reads all rows, shuffling
nothing.

Defined results: a null or empty text has the bias as its only feature; without
any labelled row, or with labels of one class only, the scores follow from
that alone (0.5 if nothing was learned); a document with several labels counts
as toxic if one says so; each input row gives one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consult.llm.words import Words, chunks, mix

BITS = 20
BUCKETS = 1 << BITS
#: Labelled rows that are learned from, about; passes over them.
MAX_ROWS, EPOCHS = 8_192, 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.0


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every feature occurrence (with repeats)."""
    w = Words(texts)
    text, h = w.text_of_word(), w.hash
    a, b, c = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    out_t, out_h = [text], [h]
    for gap, salt in ((1, a), (2, c)):
        same = text[gap:] == text[:-gap]
        out_t.append(text[:-gap][same])
        out_h.append(mix(h[:-gap][same] * b + h[gap:][same] * salt + np.uint64(gap)))
    return np.concatenate(out_t), (np.concatenate(out_h) >> np.uint64(64 - BITS)).astype(np.int64)


def distinct_features(text: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique((text << BITS) | bucket)
    return key >> BITS, key & (BUCKETS - 1)


def ftrl(rows: list[np.ndarray], labels: list[int], epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray, float]:
    """Non-zero coordinates, their weights, and the bias (coordinate ``BUCKETS``, free of L1)."""
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        zz = z[at]
        cut = np.where(at == BUCKETS, 0.0, L1)
        return np.where(np.abs(zz) <= cut, 0.0, -(zz - np.sign(zz) * cut) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    order = np.arange(len(rows))
    for e in range(epochs):
        np.random.default_rng(e).shuffle(order)
        for i in order:
            at = np.append(rows[i], BUCKETS)
            w = weights(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - labels[i]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(BUCKETS + 1))
    at = np.flatnonzero(w[:-1])
    return at, w[at], float(w[-1])


def learn(docs: DataFrame, labels: DataFrame, trainable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights learned from the labelled rows for which ``trainable`` (over the id) holds."""
    said = labels.where(trainable & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("l_id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    share = min(1.0, max_rows / max(1, said.count()))
    said = said.where(F.pmod(F.xxhash64(F.col("l_id").cast("string")), F.lit(1 << 20)) < share * (1 << 20))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(said), F.col("id") == F.col("l_id")).select("id", "t", "y")
    kind = rows.schema["id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in chunks(batches, "t"):
            t, f = distinct_features(*features(texts))
            cut = np.searchsorted(t, np.arange(len(texts) + 1))
            lists = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(f.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), lists], ["id", "y", "f"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, ys = [], []
        for b in batches:
            ys += b.column("y").to_pylist()
            xs += [x.values.to_numpy(zero_copy_only=False).astype(np.int64) for x in b.column("f")]
        at, w, bias = ftrl(xs, ys)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int64)), pa.array(np.append(w, bias))], ["at", "w"])

    lists = rows.mapInArrow(hashed, f"id {kind}, y int, f array<int>").repartition(1).sortWithinPartitions("id")
    got = lists.mapInArrow(fit, "at long, w double").toArrow()
    at, w = got.column("at").to_numpy(), got.column("w").to_numpy()
    own = at >= 0
    return at[own], w[own], float(w[~own].sum())


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; the broadcast holds the non-zero weights, at most one per bucket."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, w, bias = sent.value
        weight = np.zeros(BUCKETS)
        weight[at] = w
        for b, texts in chunks(batches, "t"):
            t, f = features(texts)
            use = weight[f] != 0
            t, f = distinct_features(t[use], f[use])
            s = bias + np.bincount(t, weight[f], len(texts))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(1.0 / (1.0 + np.exp(-np.clip(s, -35, 35))))], ["id", "score"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5)) == 0, F.lit(False))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole document, by FTRL-proximal regression over hashed n-grams and skip-grams."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), ~held_out("doc_id"))
    out = score(docs, model)
    return out.select(F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
