"""Language ID by mixture inference (operator 6).

Learning: byte trigrams of labelled texts are counted per language in
``BUCKETS`` hash buckets, over at most about ``PER_LANGUAGE`` rows of each
language (a documented bound; the rows are chosen by a hash of their id). The
table, languages x buckets, is what the driver collects and broadcasts: its
size does not grow with the corpus.

Prediction: the trigrams of a text are taken as drawn from a mixture of
languages. Expectation-maximisation estimates the proportions, with the best
single language first, then with the k languages of the largest proportions;
the set grows while the log-likelihood less ``PENALTY * (k-1) * log(n)`` does.
The language of the largest proportion is predicted, that proportion is the
score, and ``mixture`` holds all proportions of the chosen set. Texts of one
Arrow batch are estimated together, by segment sums.

Defined results: a null text or one without a letter is ``und`` with score 0,
as is every text if nothing was learned; ties go to the language that sorts
first; each input row gives one row; further columns are not read; bytes that
are not UTF-8 are no letters, and count in trigrams as they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consult.llm.common import fresh
from consult.llm.words import chunks

BUCKETS = 1 << 16
#: Labelled rows of a language that are learned from, about.
PER_LANGUAGE = 2_000
PENALTY, ROUNDS = 2.0, 8

_FOLD = np.full(256, 32, np.uint8)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def trigram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, bucket) pairs in order, with their counts. Trigrams of separators only are left out."""
    size = np.array([len(t) + 4 for t in texts])
    buf = _FOLD[np.frombuffer(b"".join(b"  " + t + b"  " for t in texts), np.uint8)].astype(np.uint32)
    code = (buf[:-2] << 16) | (buf[1:-1] << 8) | buf[2:]
    text = np.repeat(np.arange(len(texts), dtype=np.uint64), size)[:-2]
    use = (buf[1:-1] != 32) | ((buf[:-2] != 32) & (buf[2:] != 32))
    bucket = (code * np.uint32(2654435761)) >> np.uint32(16)
    key = np.sort(((text << np.uint64(16)) | bucket.astype(np.uint64))[use])
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.concatenate([edge, [len(key)]]))
    key = key[edge]
    return (key >> np.uint64(16)).astype(np.int64), (key & np.uint64(0xFFFF)).astype(np.int64), count.astype(np.float64)


def learn(docs: DataFrame, trainable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages in order and P(bucket | language) as float32 [buckets, languages]."""
    rows = docs.where(trainable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("t"), F.col(lang_col).alias("lang"))
    have = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(have)
    if not langs:
        return [], np.zeros((BUCKETS, 0), np.float32)
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, per_language / have[k]))])
    chosen = F.pmod(F.xxhash64(F.coalesce("id", F.lit(""))), F.lit(1 << 20)) < share[F.col("lang")] * F.lit(1 << 20)
    number = {k: i for i, k in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b, texts in chunks(batches, "t"):
            lang = np.array([number[x] for x in b.column("lang").to_pylist()])
            text, bucket, n = trigram_counts(texts)
            for k in np.unique(lang):
                own = lang[text] == k
                total.setdefault(int(k), np.zeros(BUCKETS))
                total[int(k)] += np.bincount(bucket[own], n[own], BUCKETS)
        for k, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(c[at].astype(np.int64))], ["lang", "bucket", "n"])

    counted = rows.where(chosen).select("t", "lang").mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = np.full((BUCKETS, len(langs)), 0.5)
    got = counted.toArrow()
    np.add.at(table, (got.column("bucket").to_numpy(), got.column("lang").to_numpy()), got.column("n").to_numpy())
    return langs, (table / table.sum(0)).astype(np.float32)


def mixtures(text: np.ndarray, bucket: np.ndarray, count: np.ndarray, n_texts: int, table: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS) -> np.ndarray:
    """Proportions [texts, languages] of the language set that penalised likelihood selects."""
    langs = table.shape[1]
    out = np.zeros((n_texts, langs))
    if not len(text) or not langs:
        return out
    p, present = table[bucket].astype(np.float64), np.unique(text)
    starts = np.searchsorted(text, present)
    row = np.repeat(np.arange(len(present)), np.diff(np.concatenate([starts, [len(text)]])))
    total = np.add.reduceat(count, starts)

    def fit(p, count, row, starts, total, pi):
        for _ in range(rounds):
            q = p * pi[row]
            q *= (count / q.sum(1))[:, None]
            pi = np.add.reduceat(q, starts, axis=0) / total[:, None]
        like = np.add.reduceat(count * np.log((p * pi[row]).sum(1)), starts)
        return pi, like

    single = np.add.reduceat(count[:, None] * np.log(p), starts, axis=0)
    best = single.argmax(1)
    chosen = np.zeros((len(present), langs))
    chosen[np.arange(len(present)), best] = 1.0
    score = single.max(1)
    if langs > 1:
        pi, _ = fit(p, count, row, starts, total, np.full((len(present), langs), 1.0 / langs))
        order = np.argsort(-pi, axis=1, kind="stable")
        open_ = np.arange(len(present))
        for k in range(2, langs + 1):
            if not len(open_):
                break
            own = np.isin(row, open_) if len(open_) < len(present) else np.ones(len(row), bool)
            mine = np.searchsorted(open_, row[own])
            begin = np.searchsorted(mine, np.arange(len(open_)))
            mask = np.zeros((len(open_), langs))
            np.put_along_axis(mask, order[open_, :k], 1.0, axis=1)
            first = mask * np.maximum(pi[open_], 1e-6)
            fitted, like = fit(p[own], count[own], mine, begin, total[open_], first / first.sum(1, keepdims=True))
            gain = like - penalty * (k - 1) * np.log(total[open_])
            better = gain > score[open_]
            score[open_[better]] = gain[better]
            chosen[open_[better]] = fitted[better]
            open_ = open_[better]
    out[present] = chosen
    return out


def predict(docs: DataFrame, langs: list[str], table: np.ndarray, text_col: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "mixture")) -> DataFrame:
    """``docs`` with the predicted language, its proportion and the mixture (a map), under ``names``."""
    import regex
    from pyspark.sql import types as T
    model = docs.sparkSession.sparkContext.broadcast((langs, table))
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.MapType(T.StringType(), T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = model.value
        letter = regex.compile(r"\p{L}").search
        for b, texts in chunks(batches, text_col):
            known = np.array([letter(t.decode(errors="replace")) is not None for t in texts]) & bool(langs)
            pi = mixtures(*trigram_counts(texts), len(texts), table)
            top = pi.argmax(1) if langs else np.zeros(len(texts), int)
            pred = [langs[k] if ok else "und" for k, ok in zip(top, known, strict=True)]
            score = np.where(known, pi.max(1) if langs else 0.0, 0.0)
            mix = [[(langs[k], float(x[k])) for k in np.flatnonzero(x)] if ok else [] for x, ok in zip(pi, known, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(mix, pa.map_(pa.string(), pa.float64()))], [*b.schema.names, *names])

    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4)) == 2, F.lit(False))


def drop_undetermined(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents whose language cannot be told; columns as they were.

    Those are the texts without a letter; if nothing was learned, no other text is dropped.
    """
    langs, table = learn(docs, ~held_out())
    if not langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    names = fresh(docs.columns, "lang_pred", "score", "mixture")
    return predict(docs, langs, table, names=tuple(names)).where(F.col(names[0]) != "und").select(*docs.columns)


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    """Language, score and mixture of every whole document, by EM over n-gram likelihoods."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    langs, table = learn(docs, ~held_out())
    out = predict(docs.select("doc_id", "text"), langs, table)
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "mixture")
