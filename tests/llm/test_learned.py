"""Language ID and toxicity against plain dictionary versions; bytes that are not UTF-8; BPE of edge texts against tiktoken."""

import base64
import math
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from consult.llm import bpe, language_id, toxicity
from consult.llm.catalog import QUERIES
from tests.conftest import SF_MID, SF_SMALL


def trigrams(text):
    """Bucket counts of a text's byte trigrams: letters folded, all else of ASCII a separator."""
    fold = [x if x >= 0x80 else x | 32 if chr(x).isalpha() else 32 for x in b"  " + text.encode() + b"  "]
    out = Counter()
    for a, b, c in zip(fold, fold[1:], fold[2:], strict=False):
        if b != 32 or (a != 32 and c != 32):
            out[(((a << 16 | b << 8 | c) * 2654435761) & 0xFFFFFFFF) >> 16] += 1
    return out


@pytest.fixture(scope="module")
def language(spark):
    """(doc_id, text, held out), P(bucket | language) by plain counting, languages."""
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", language_id.held_out().alias("out")).collect()
    counts = defaultdict(Counter)
    for r in rows:
        if not r.out and r.lang is not None and r.text is not None:
            counts[r.lang].update(trigrams(r.text))
    total = {k: sum(c.values()) + 0.5 * language_id.BUCKETS for k, c in counts.items()}
    return rows, lambda k, b: float(np.float32((counts[k][b] + 0.5) / total[k])), sorted(counts)


def em(grams, p, start, rounds):
    """Proportions after ``rounds`` of EM from ``start``, and their log-likelihood."""
    pi, n = dict(start), sum(grams.values())
    for _ in range(rounds):
        share = dict.fromkeys(pi, 0.0)
        for b, c in grams.items():
            own = {k: p(k, b) * pi[k] for k in pi}
            whole = sum(own.values())
            for k in pi:
                share[k] += c * own[k] / whole
        pi = {k: x / n for k, x in share.items()}
    return pi, sum(c * math.log(sum(p(k, b) * pi[k] for k in pi)) for b, c in grams.items())


def by_steps(grams, p, langs):
    """The best language alone, then the k languages of largest proportion while the penalised likelihood grows."""
    alone = {k: em(grams, p, {k: 1.0}, 0)[1] for k in langs}
    top = max(langs, key=lambda k: alone[k])
    chosen, score = {top: 1.0}, alone[top]
    pi, _ = em(grams, p, dict.fromkeys(langs, 1 / len(langs)), language_id.ROUNDS)
    order = sorted(langs, key=lambda k: -pi[k])
    for k in range(2, len(langs) + 1):
        first = {x: max(pi[x], 1e-6) for x in order[:k]}
        got, like = em(grams, p, {x: v / sum(first.values()) for x, v in first.items()}, language_id.ROUNDS)
        gain = like - language_id.PENALTY * (k - 1) * math.log(sum(grams.values()))
        if gain <= score:
            break
        chosen, score = got, gain
    return chosen, score


def test_op6_by_brute_force(spark, language):
    """Every document of up to 3,000 characters: prediction and score of the plain version."""
    rows, p, langs = language
    got = {r.doc_id: r for r in QUERIES["op6_language_id"](spark, SF_SMALL).collect()}
    assert len(got) == len(rows)
    for r in rows:
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
        elif len(r.text) <= 3_000:
            chosen, _ = by_steps(trigrams(r.text), p, langs)
            top = max(sorted(chosen), key=lambda k: chosen[k])
            assert got[r.doc_id].lang_pred == top and got[r.doc_id].score == pytest.approx(chosen[top], abs=1e-6)
            assert got[r.doc_id].held_out == r.out


def test_op6_set_is_the_best_of_all_sets(language):
    """Short texts, and two of different languages set end to end: no language set has a clearly larger penalised likelihood."""
    rows, p, langs = language
    short = [r for r in rows if r.text and r.lang and 200 <= len(r.text) <= 1_500][:24]
    texts = [r.text for r in short] + [a.text + " " + b.text for a, b in zip(short, short[1:], strict=False) if a.lang != b.lang][:8]
    assert len(texts) >= 16
    for t in texts:
        grams = trigrams(t)
        chosen, score = by_steps(grams, p, langs)
        for k in range(1, len(langs) + 1):
            for own in combinations(langs, k):
                _, like = em(grams, p, dict.fromkeys(own, 1 / k), 12)
                assert like - language_id.PENALTY * (k - 1) * math.log(sum(grams.values())) <= score + 1.0, (chosen, own)


def test_features_are_words_pairs_and_skip_grams():
    texts = ["A rose is a rose", "one", "", "x y x y x y", "ünder the-bridge, UNDER"]
    text, bucket = toxicity.distinct_features(*toxicity.features([t.encode() for t in texts]))
    for i, t in enumerate(texts):
        w = "".join(c.lower() if c.isalnum() and c.isascii() else c if ord(c) > 127 else " " for c in t).split()
        want = {(x,) for x in w} | set(zip(w, w[1:], strict=False)) | {(a, None, b) for a, b in zip(w, w[2:], strict=False)}
        assert len(bucket[text == i]) == len(want)


def test_op7_by_brute_force(spark):
    """FTRL-proximal over dictionaries, row by row, gives the scores of every document."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", toxicity.held_out("doc_id").alias("out")).orderBy("doc_id").collect()
    said = {}
    for r in spark.read.parquet(f"{SF_MID}/labels.parquet").where("toxic IS NOT NULL").collect():
        said[r.doc_id] = max(said.get(r.doc_id, 0), int(r.toxic))
    own = {r.doc_id: set(toxicity.features([(r.text or "").encode()])[1].tolist()) for r in docs}
    rows = [(sorted(own[r.doc_id]), said[r.doc_id]) for r in docs if r.doc_id in said and not r.out]
    assert 100 < len(rows) <= toxicity.MAX_ROWS
    z, n = defaultdict(float), defaultdict(float)

    def weight(k):
        cut = 0.0 if k == "bias" else toxicity.L1
        return 0.0 if abs(z[k]) <= cut else -(z[k] - math.copysign(cut, z[k])) / ((toxicity.BETA + math.sqrt(n[k])) / toxicity.ALPHA + toxicity.L2)

    def chance(s):
        return 1 / (1 + math.exp(-min(max(s, -35), 35)))

    order = np.arange(len(rows))
    for e in range(toxicity.EPOCHS):
        np.random.default_rng(e).shuffle(order)
        for i in order:
            f, y = [*rows[i][0], "bias"], rows[i][1]
            w = [weight(k) for k in f]
            g = chance(sum(w)) - y
            for k, x in zip(f, w, strict=True):
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / toxicity.ALPHA * x
                n[k] += g * g
    learned = {k: x for k in list(z) if (x := weight(k))}
    assert any(k != "bias" for k in learned)
    got = {r.doc_id: r for r in QUERIES["op7_toxicity"](spark, SF_MID).collect()}
    assert len(got) == len(docs)
    for r in docs:
        want = chance(learned.get("bias", 0.0) + sum(learned.get(k, 0.0) for k in own[r.doc_id]))
        assert got[r.doc_id].score == pytest.approx(want, abs=1e-6) and got[r.doc_id].held_out == r.out


def test_bytes_that_are_not_utf8(spark):
    """BPE encodes them as U+FFFD; to language ID they are no letters."""
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.expr("CASE id WHEN 0 THEN CAST(x'61ff20c362' AS STRING) WHEN 1 THEN CAST(x'fffe' AS STRING) ELSE 'plain' END").alias("text"), F.lit("en").alias("lang"))
    got = {r.id: bytes(r.decoded).decode() for r in bpe.encode_decode(docs).collect()}
    assert got == {0: "a� �b", 1: "��", 2: "plain"}
    langs, table = language_id.learn(docs, F.lit(True))
    assert {r.doc_id: r.lang_pred for r in language_id.predict(docs, langs, table).collect()} == {0: "en", 1: "und", 2: "en"}


def test_edge_texts_equal_tiktoken(spark, edge):
    """The edge table, and matches of far more than 256 bytes."""
    with open(public_tokenizers.path(bpe.DEFAULT_RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    long = [(100, "ab" * 3_000), (101, "=" * 5_000), (102, "ü" * 700 + " " * 900 + "\n" * 300), (103, "Donaudampfschifffahrt" * 40)]
    docs = edge.select("doc_id", "text").unionByName(spark.createDataFrame(long, "doc_id long, text string"))
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = bpe.encode_decode(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == lib.encode_ordinary(text[r.id]) and bytes(r.decoded).decode() == text[r.id]
