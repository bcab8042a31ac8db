"""Registered queries against SQL or brute force (sf0.001)."""

import base64
import hashlib
import math
import struct
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from consult.llm import license_scan
from consult.llm.catalog import ORACLE, QUERIES
from scripts.oracle_check import digest, duck
from tests.conftest import SF_SMALL
from tests.llm.conftest import shingle_set, word_list


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    want = duck(SF_SMALL).execute(ORACLE[name])
    cols = [c[0] for c in want.description]
    assert digest(df.columns, got)[0] == digest(cols, want.fetchall())[0]


def same_as_tiktoken(rows, texts):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in rows:
        ids = lib.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_op3_equals_tiktoken(spark, texts):
    rows = QUERIES["op3_byte_bpe"](spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    same_as_tiktoken(rows, texts)


def brute_notices(w, idf):
    """Labels, and the best IDF-weighted share, of all templates at all places where their phrases stand."""
    labels, score = set(), 0.0
    for t in license_scan.templates():
        for o in range(-len(t.words), len(w)):
            at = {i: 0 <= o + i < len(w) and w[o + i] == x for i, x in enumerate(t.words)}
            if all(at[i] for lo, hi in t.phrases for i in range(lo, hi)):
                labels.add(t.label)
                score = max(score, sum(idf[x] for i, x in enumerate(t.words) if at[i]) / sum(idf[x] for x in t.words))
    return labels, score


def test_op8_base_places(spark, texts):
    words = {i: word_list(t) for i, t in texts.items()}
    having = Counter(x for w in words.values() for x in set(w))
    idf = {x: math.log((len(words) + 1) / (having[x] + 1)) + 1 for t in license_scan.templates() for x in t.words}
    for r in QUERIES["op8_license_scan"](spark, SF_SMALL).collect():
        w = word_list(texts[r.doc_id])
        found = [(i, label) for label, p in (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")) for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        at = [i for i, _ in found]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(at), min(at, default=None), max(at, default=None))
        labels, score = brute_notices(w, idf)
        assert r.base_labels == ",".join(sorted({x for _, x in found})) and r.labels == ",".join(sorted(labels))
        assert r.score == pytest.approx(score, abs=1e-12)


def components(pairs, nodes):
    up = {i: i for i in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        up[find(a)] = find(b)
    out = defaultdict(set)
    for i in nodes:
        out[find(i)].add(i)
    return {i: max(c) for c in out.values() for i in c}


def brute_classes(texts):
    sets, having, pairs = {i: shingle_set(t) for i, t in texts.items()}, defaultdict(list), []
    for i in sets:
        for s in sets[i]:
            having[s].append(i)
    for i in sets:
        for j, m in Counter(j for s in sets[i] for j in having[s] if j < i).items():
            if m >= 0.8 * (len(sets[i]) + len(sets[j]) - m):
                pairs.append((i, j))
    return components(pairs, texts)


def test_op10_classes(spark, texts):
    rows = QUERIES["op10_ngram_jaccard"](spark, SF_SMALL).collect()
    assert {r.doc_id: r.class_id for r in rows} == brute_classes(texts)


def brute_degrees(texts):
    """Other texts linked to each text, by all shared shingles; copies count once."""
    sets, having, degree = {t: shingle_set(t) for t in set(texts.values()) if t}, defaultdict(list), Counter()
    for t, own in sets.items():
        for s in own:
            having[s].append(t)
    for t, own in sets.items():
        for other, m in Counter(x for s in own for x in having[s] if x != t).items():
            degree[t] += m >= 0.8 * (len(own) + len(sets[other]) - m)
    return {i: degree[t] for i, t in texts.items()}


def test_op10_links(spark, texts):
    rows = QUERIES["op10_ngram_jaccard"](spark, SF_SMALL).collect()
    assert {r.doc_id: r.n_links for r in rows} == brute_degrees(texts)


def test_op1_passages(spark, texts):
    rows = QUERIES["op1_substring_dedup"](spark, SF_SMALL).collect()
    words, runs = {i: word_list(t) for i, t in texts.items()}, defaultdict(set)
    for r in rows:
        a, b = words[r.doc_id][r.start_word:r.start_word + r.n_words], words[r.source_doc_id][r.source_start:r.source_start + r.source_n_words]
        assert len(a) == r.n_words >= 50 and len(b) == r.source_n_words >= 50
        # Spans of one offset count places (of repeated shingles too), aligned ones count sets.
        one, two = [[tuple(x[k:k + 5]) for k in range(len(x) - 4)] for x in (a, b)]
        m = len(set(one) & set(two))
        aligned = sum(x == y for x, y in zip(one, two, strict=False))
        share = [m / (len(set(one)) + len(set(two)) - m)] + [aligned / (2 * len(one) - aligned)] * (len(one) == len(two))
        assert r.similarity >= 0.8 and any(r.similarity == pytest.approx(x) for x in share)
    for i, w in words.items():
        for k in range(len(w) - 49):
            runs[tuple(w[k:k + 50])].add(i)
    assert {i for own in runs.values() for i in own if i != min(own)} <= {r.doc_id for r in rows}


def test_op6_accuracy(spark):
    rows = QUERIES["op6_language_id"](spark, SF_SMALL).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_op7_learns(spark):
    rows = QUERIES["op7_toxicity"](spark, "/root/testdata/sf0.01").collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    known = [r for r in rows if r.doc_id in toxic]
    assert len(rows) == 1000 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted for r in known if toxic[r.doc_id]) >= 0.7 * sum(toxic.values())
    assert sum(r.predicted for r in known if not toxic[r.doc_id]) <= 0.02 * len(known)


def test_pipeline(spark, texts):
    """Stages by brute force: letters, equal texts, near copies, benchmark items, tokens."""
    keep = {i: t for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    last = {}
    for i in sorted(keep):
        last[keep[i]] = i
    keep = {i: t for t, i in last.items()}
    near = brute_classes(keep)
    keep = {i: t for i, t in keep.items() if near[i] == i}
    items = [shingle_set(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert all(len(g) == 5 for s in items for g in s)
    keep = {i: t for i, t in keep.items() if not any(len(s & shingle_set(t)) >= 0.8 * len(s) for s in items)}
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r.doc_id for r in rows} == set(keep) and len(rows) == len(keep)
    same_as_tiktoken(rows, keep)
