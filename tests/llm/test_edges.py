"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from consult.llm import bpe, chat_format, decontaminate, exact_dedup, language_id, license_scan, ngram_join, substring_dedup, toxicity, warc
from consult.llm.common import numbered_copies, scratch


def test_exact(edge, empty):
    rows = exact_dedup.exact_dedup(edge, bucket_keys=2).collect()
    assert len(rows) == edge.count()
    same = [r for r in rows if r.group_size == 4]
    assert {r.id for r in same} == {3, 4, None} and all(r.keep_id == 4 for r in same)
    assert sum(r.kept for r in same) == 1
    assert {r.keep_id for r in rows if r.id in (1, 2)} == {2}
    left = exact_dedup.drop_copies(edge)
    assert left.columns == edge.columns and left.count() == 10
    assert exact_dedup.exact_dedup(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0


def test_many_copies_and_splits(spark):
    """A text in a third of 30,000 rows, repeated ids among them, null ids; buckets that must split."""
    docs = spark.range(30_000).select(
        F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 20_000).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("the popular text")).otherwise(F.concat(F.lit("text "), (F.col("id") % 9000).cast("string"))).alias("text"))
    got = exact_dedup.exact_dedup(docs, bucket_keys=64)
    want = docs.groupBy("text").agg(F.max("doc_id").alias("keep"), F.count("*").alias("n"))
    assert got.count() == 30_000 and got.where("kept").count() == want.count()
    pairs = got.select("text_sha256", "keep_id", "group_size").distinct()
    assert pairs.exceptAll(want.select(F.sha2("text", 256), "keep", "n")).isEmpty() and pairs.count() == want.count()
    assert exact_dedup.drop_copies(docs).count() == want.count()


def test_two_texts_of_one_key_stay_apart(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "id long, t string").withColumn("key", F.when(F.col("t") == "c", 1).otherwise(7).cast("long"))
    index = {r.key: [(c.keep, c.n) for c in r.chain] for r in exact_dedup.build_index(rows).collect()}
    assert sorted(index[7]) == [(2, 1), (3, 2)] and index[1] == [(4, 1)]


def test_copies_beyond_one_array(spark):
    got = numbered_copies(spark.createDataFrame([(1, 150_000), (2, 1), (3, 65_536)], "a long, n long"), "n", "nth").groupBy("a").agg(F.count("*").alias("c"), F.min("nth").alias("lo"), F.max("nth").alias("hi"), F.count_distinct("nth").alias("d"))
    assert {tuple(r) for r in got.collect()} == {(1, 150_000, 1, 150_000, 150_000), (2, 1, 1, 1, 1), (3, 65_536, 1, 65_536, 65_536)}


def test_directory_doubles(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    directory, depth = exact_dedup.grow_directory(keys, 40)
    slots = directory.collect()
    assert sorted(r.slot for r in slots) == list(range(1 << depth))
    placed = keys.join(directory, F.shiftrightunsigned("key", 64 - depth) == F.col("slot")).groupBy("bucket", "depth").count().collect()
    assert sum(r["count"] for r in placed) == 5000 and max(r["count"] for r in placed) <= 40


def test_near(edge, empty):
    rows = {(r.id, r.text_copies): r for r in ngram_join.jaccard_classes(edge).collect()}
    by = {k[0]: r for k, r in rows.items()}
    assert by[6].class_id == by[7].class_id == by[12].class_id == 12
    assert by[3].class_id == by[4].class_id == by[5].class_id == 5 and by[1].class_id == 2
    assert by[8].class_id == 8 and by[9].links == 0
    left = ngram_join.drop_near_copies(edge)
    assert left.columns == edge.columns and sorted(r.doc_id for r in left.collect()) == [2, 5, 8, 9, 10, 11, 12]
    assert ngram_join.drop_near_copies(empty).count() == 0


def test_unlinked_members_find_each_other(spark):
    """A hot bucket: variants too far from the pivot link among themselves, as brute force says."""
    random.seed(3)
    base = [f"t{i}" for i in range(150)]
    texts = {}
    for i in range(120):
        w = list(base)
        for _ in range(random.choice([0, 1, 2, 4, 5, 6])):
            w[random.randrange(150)] = f"e{random.randrange(10**6)}"
        texts[i] = " ".join(w)
        if i % 5 == 0:
            w[random.randrange(150)] = "child"
            texts[1000 + i] = " ".join(w)
    from tests.llm.test_queries import brute_classes
    got = ngram_join.jaccard_classes(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.id: r.class_id for r in got} == brute_classes(texts)


def test_every_link_of_a_hot_bucket_counts(spark, monkeypatch):
    """Variants that are all alike are credited with all partners, over many blocks, as brute force says."""
    random.seed(5)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "SHARE", 2)
    base, texts = [f"t{i}" for i in range(200)], {}
    for i in range(150):
        w = list(base)
        for _ in range(random.choice([0, 1, 1, 2, 5])):
            w[random.randrange(200)] = f"e{random.randrange(10**6)}"
        texts[i] = " ".join(w)
    from tests.llm.test_queries import brute_classes, brute_degrees
    got = ngram_join.jaccard_classes(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    want = brute_degrees(texts)
    assert max(want.values()) > 80 and {r.id: r.links for r in got} == want
    assert {r.id: r.class_id for r in got} == brute_classes(texts)


def test_pruning_keeps_true_pairs():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 32, (4000, ngram_join.HASHES), dtype=np.uint32)
    for similarity, low, high in ((0.85, 0.999, 1.0), (0.3, 0.0, 0.01)):
        b = np.where(rng.random(a.shape) < similarity, a, a + np.uint32(1))
        assert low <= len(ngram_join.survivors(a, b, ngram_join.least_matches())) / len(a) <= high


def test_passages(edge, empty):
    rows = substring_dedup.shared_passages(edge).collect()
    assert {(r.id, r.source_id) for r in rows} >= {(7, 6), (12, 6)} and all(r.id in (7, 12) for r in rows)
    assert substring_dedup.shared_passages(empty).count() == 0


def test_passages_of_documents_that_share_an_id_or_have_none(spark):
    p = " ".join(f"pass{i}" for i in range(120))
    docs = [(1, p), (2, "aaa " * 30), (2, "zzz " + p), (None, "left " + p), (None, p + " right"), (None, "clean text of no one"), (3, "other " + p), (3, "other " + p), (4, None), (4, "")]
    rows = substring_dedup.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert all(r.n_words == r.source_n_words == 120 and r.similarity == 1.0 for r in rows)
    # Every copy but the first is reported, rows without an id too; equal rows count once.
    assert sorted((r.id is None, r.id or 0, r.start_word) for r in rows if r.source_id == 1) == [(False, 2, 1), (False, 3, 1), (True, 0, 0), (True, 0, 1)]
    p = " ".join(f"none{i}" for i in range(60))
    rows = substring_dedup.shared_passages(spark.createDataFrame([(None, "a " + p), (None, "b " + p), (7, "c")], "doc_id long, text string")).collect()
    assert [(r.id, r.source_id, r.n_words) for r in rows] == [(None, None, 60)]


def test_op1_hubs_that_share_less_than_a_passage(spark):
    """Wherever a window of the shared passage stands, a document of smaller id has its signature, but not 50 words."""
    def words(name, n):
        return [f"{name}{i}" for i in range(n)]
    docs, want = [], set()
    for k in range(8):
        p, n = words(f"p{k}x", 60), 10 * k
        pieces = [p[:48], p[12:], words(f"l{k}x", 30) + p, p + words(f"r{k}x", 30), p[:48]]
        docs += [(n + i, " ".join(words(f"a{k}x{i}x", 25) + piece + words(f"b{k}x{i}x", 25))) for i, piece in enumerate(pieces)]
        want.add((n + 3, 25, 60, n + 2, 55, 60))
    docs.append((99, docs[2][1]))
    got = substring_dedup.shared_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    whole = len(docs[2][1].split())
    want |= {(99, 0, whole, 2, 0, whole)}
    rows = {(r.id, r.start_word, r.n_words, r.source_id, r.source_start, r.source_n_words) for r in got if r.similarity == 1}
    assert len(got) == len(rows) and rows == want


def test_passages_with_edits_are_found(spark):
    """Recall on passages of 60 to 90 words with a word put in, left out or changed in the middle."""
    random.seed(7)

    def words(n):
        return [f"v{random.randrange(10**7)}" for _ in range(n)]
    rows, kind = [], {}
    for k in range(300):
        p = words(60 + k % 31)
        q, at = list(p), len(p) // 2
        q[at:at + (k % 3 > 0)] = [] if k % 3 == 1 else ["edit"]
        kind[1000 + k] = ("insertion", "deletion", "substitution")[k % 3]
        rows += [(k, " ".join(words(80) + p + words(70))), (1000 + k, " ".join(words(33) + q + words(120)))]
    got = substring_dedup.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.source_id == r.id - 1000 and r.similarity >= 0.8 and r.n_words >= 50 for r in got)
    found = {r.id for r in got if abs(r.start_word - 33) <= 1}
    for name in ("insertion", "deletion", "substitution"):
        own = {i for i, x in kind.items() if x == name}
        assert len(own & found) >= 0.9 * len(own), name


def test_compact_windows_by_brute_force():
    rng = np.random.default_rng(0)
    v, first = rng.integers(0, 1 << 60, 700).astype(np.uint64), np.array([0, 300, 300, 320, 700])
    got = {(int(p), int(lo), int(hi)) for p, lo, hi in zip(*substring_dedup.compact_windows(v, first, 46), strict=True)}
    want = set()
    for s, e in zip(first[:-1], first[1:], strict=True):
        for p in range(s, e):
            lo, hi = p, p
            while lo > s and v[lo - 1] > v[p]:
                lo -= 1
            while hi < e - 1 and v[hi + 1] > v[p]:
                hi += 1
            if hi - lo + 1 >= 46:
                want.add((p, int(lo), int(hi)))
    assert got == want


def test_decontaminate(spark, edge, empty, monkeypatch):
    item = " ".join(f"word{i} of passage" for i in range(20, 33))
    items = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (4, item)], "item_id long, text string")
    rows = decontaminate.find_contaminated(edge, items).collect()
    assert {(r.id, r.item_id) for r in rows} >= {(6, 1), (6, 4), (12, 1)} and {r.item_id for r in rows} == {1, 4}
    few = spark.createDataFrame([(1, "Text here"), (2, "TWO"), (3, "text same"), (4, "word0 of passage word1"), (5, "here"), (6, "!")], "item_id long, text string")
    got = {(r.id, r.item_id, r.containment) for r in decontaminate.find_contaminated(edge, few).collect()}
    assert got == {(i, k, 1.0) for k in (1, 5) for i in (3, 4, 5, None)} | {(9, 2, 1.0), (6, 4, 1.0), (7, 4, 1.0)}
    both = decontaminate.find_contaminated(edge, items.unionByName(few))
    for block in (1, 2):
        monkeypatch.setattr(decontaminate, "BLOCK", block)
        assert sorted(map(str, decontaminate.find_contaminated(edge, items.unionByName(few)).collect())) == sorted(map(str, both.collect()))
    left = decontaminate.drop_contaminated(edge, items)
    assert left.columns == edge.columns and {6, 12}.isdisjoint({r.doc_id for r in left.collect()})
    assert decontaminate.find_contaminated(empty, items).count() == 0 and decontaminate.drop_contaminated(edge, items.limit(0)).count() == edge.count()


def test_clean_rows_that_share_an_id_stay(spark):
    """A contaminated row takes no clean row of its id along, null ids included."""
    item = " ".join(f"leak{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "clean one"), (1, f"x {item} y"), (None, "clean null"), (None, item), (2, None), (3, f"x {item} y"), (None, "clean null")], "doc_id long, text string")
    left = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert left.columns == docs.columns
    assert sorted(map(str, left.collect())) == sorted(str(r) for r in docs.collect() if "leak" not in (r.text or ""))


def test_short_items_are_found_in_long_documents(spark):
    """Every item of 1 to 11 words, and one of few distinct shingles, in a document of 600 words."""
    random.seed(11)
    docs, items = [], []
    for k in range(440):
        w = [f"d{random.randrange(10**12)}" for _ in range(600)]
        at, n = random.randrange(580), 1 + k % 11
        docs.append((k, " ".join(w)))
        items.append((k, " ".join(w[at:at + n])))
    docs.append((440, "lead in " + "ab cd " * 30 + "and out"))
    items.append((440, "ab cd " * 30))
    got = decontaminate.find_contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.id, r.item_id) for r in got} == {(k, k) for k in range(441)}
    assert decontaminate.Items([1], [b""]).candidates(np.zeros(0, np.uint64), np.zeros(2, np.int64)).shape == (0, 2)


def test_language(edge, empty):
    langs, table = language_id.learn(edge, F.lit(True))
    assert langs == ["en"]
    names = ("p1", "p2", "p3")
    rows = {r.doc_id: r for r in language_id.predict(edge, langs, table, names=names).collect()}
    assert {i for i, r in rows.items() if r.p1 == "und"} == {1, 2, 10} and all(0 <= r.p2 <= 1 for r in rows.values())
    left = language_id.drop_undetermined(edge)
    assert left.columns == edge.columns and left.count() == edge.count() - 3
    assert language_id.drop_undetermined(empty).count() == 0


def test_unlabelled_corpus_keeps_texts_with_a_letter(edge):
    bare = edge.withColumn("lang", F.lit(None).cast("string"))
    left = language_id.drop_undetermined(bare)
    assert left.columns == bare.columns
    assert sorted(map(str, left.collect())) == sorted(str(r) for r in bare.collect() if r.text and any(c.isalpha() for c in r.text))


def test_mixture_of_two_languages():
    count = np.zeros((language_id.BUCKETS, 2))
    texts = [b"the cat and the dog were in the house with their friends " * 30, "der Hund und die Katze waren im Haus mit ihren Freunden ".encode() * 30]
    for k, t in enumerate(texts):
        _, bucket, n = language_id.trigram_counts([t])
        count[bucket, k] = n
    table = ((count + 0.5) / (count + 0.5).sum(0)).astype(np.float32)
    both = language_id.mixtures(*language_id.trigram_counts([texts[0], texts[0] + texts[1]]), 2, table)
    assert both[0].tolist() == [1.0, 0.0] and 0.3 < both[1][0] < 0.7


def test_toxicity(spark, edge, empty):
    labels = spark.createDataFrame([(6, 0), (7, 1), (7, 0), (8, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.learn(edge, labels, F.lit(True))
    assert toxicity.score(edge, model).count() == edge.count() and toxicity.score(empty, model).count() == 0
    nothing = toxicity.learn(edge, labels.limit(0), F.lit(True))
    assert {r.score for r in toxicity.score(edge, nothing).collect()} == {0.5}


def test_bpe(edge, empty):
    rows = bpe.encode_decode(edge).collect()
    text = {(r.doc_id): r.text or "" for r in edge.collect()}
    assert len(rows) == edge.count() and all(bytes(r.decoded).decode() == text[r.id] for r in rows) and bpe.encode_decode(empty).count() == 0
    with open(bpe.public_tokenizers.path(bpe.DEFAULT_RANKS), "rb") as f:
        ranks = bpe.parse_ranks(f.read())
    random.seed(1)
    for n in (3, 40, 250):
        piece = bytes(random.choice(b"aeintsh") for _ in range(n))
        assert bpe.merge(piece, ranks) == bpe._merge_long(piece, ranks) or ranks.get(piece) is not None


def test_license(spark, edge, empty):
    """Null, empty and very long texts; repeated rows; clashing columns; no rows."""
    out = license_scan.scan_licenses(edge).collect()
    rows = {r.id: r for r in out}
    assert len(out) == edge.count() and len(rows[11].base_places) == 3 and {m.label for m in rows[11].matches} == {"mit", "apache", "gpl"}
    assert rows[1].n_words == rows[2].n_words == 0 and rows[1].matches == [] and rows[8].n_words == 30_000
    assert license_scan.scan_licenses(empty).count() == 0
    long = "word " * 200_000 + "mit license " * 50 + "redistribution in source and binary forms"
    got = license_scan.scan_licenses(spark.createDataFrame([(1, long)], "id long, text string"), id_col="id").first()
    assert got.base_places == list(range(200_000, 200_100, 2)) and {m.label for m in got.matches} == {"mit", "bsd"}


def test_a_mandatory_phrase_alone_is_found(spark):
    """Whatever the corpus makes rare: each phrase, word for word, with nothing else of its notice."""
    phrases = [(label, p) for label, _, own in license_scan.NOTICES for p in own]
    docs = [(k, f"see {p} for more") for k, (_, p) in enumerate(phrases)] + [(1000 + k, "gnu licensed 3 mozilla the of under software free") for k in range(40)]
    rows = {r.id: {m.label for m in r.matches} for r in license_scan.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(label in rows[k] for k, (label, _) in enumerate(phrases)) and all(rows[1000 + k] == set() for k in range(40))


def test_templates_of_the_caller(spark):
    """A table of 300 notices with two phrases each; one without phrases; one without words; a wrong phrase."""
    notices = [(f"own-{k}", f"grant{k} use and share clause{k} with keep{k} this note{k}", [f"grant{k} use", f"keep{k} this"]) for k in range(300)]
    notices += [("whole", "only as a whole", None), ("none", " ", [])]
    table = spark.createDataFrame(notices, "label string, text string, phrases array<string>")
    docs = [(1, notices[7][1]), (2, "grant7 use and share clause7 with keep8 this"), (3, "x grant9 use a b c d e keep9 this"), (4, "only as a"), (5, "so only as a whole thing")]
    rows = {r.id: {m.label: m for m in r.matches} for r in license_scan.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string"), notices=table).collect()}
    assert set(rows[1]) == {"own-7"} and rows[1]["own-7"].share == 1.0 and rows[1]["own-7"].support >= 3
    assert not rows[2] and not rows[3] and not rows[4] and rows[5]["whole"].place == 1
    with pytest.raises(ValueError):
        license_scan.templates([("bad", "some words", ["other words"])])


def test_chat(spark):
    tree = [(1, 1, None, 0.0, "user", "q"), (1, 2, 1, 5.0, "assistant", "low"), (1, 3, 1, 1.0, "assistant", "#<\\h\\"), (1, 4, 3, 9.0, None, None), (1, 4, 3, 9.0, None, None),
            (None, 7, 99, 0.0, "a: \n#", "</turn>\n### x\n"), (3, 1, 2, 1.0, "u", "cycle"), (3, 2, 1, 1.0, "u", "cycle")]
    nodes = spark.createDataFrame(tree, "tree long, node long, parent long, score double, role string, text string")
    got = {r.tree: r for r in chat_format.format_chats(nodes).select("tree", "leaf", chat_format.read_turns(F.col("formatted")).alias("t"), chat_format.read_learned(F.col("formatted"), F.col("loss_spans")).alias("l")).collect()}
    assert [(t.role, t.text) for t in got[1].t] == [("user", "q"), ("assistant", "#<\\h\\"), ("", "")] and got[1].l == "#<\\h\\" and got[1].leaf == 4
    assert [(t.role, t.text) for t in got[None].t] == [("a: \n#", "</turn>\n### x\n")] and 3 not in got
    assert chat_format.format_chats(nodes, branches=2).count() == 3 and chat_format.format_chats(nodes.limit(0)).count() == 0


def test_warc(spark):
    big = "é\r\n\r\n" * 400
    rows = [(1, "http://B.example/x", big), (2, None, big), (2, None, big), (3, "http://a.example/a b", None), (4, "http://b.example/x", "small"), (5, "http://b.example/x", "small"), (6, "http://c.example/", "long " * 300_000)]
    pages = spark.createDataFrame([(*r, "f", 7, "g", 0) for r in rows], "id long, url string, payload string, first string, n int, digest string, salt int")
    path = scratch(spark, "warc-test")
    warc.write_archives(pages.withColumn("ts", F.timestamp_seconds("id")), path)
    rows = warc.capture_history(spark, path).collect()
    assert sorted((r.id, r.record_type, r.refers_to, r.payload_bytes) for r in rows if r.id != "2") == [("1", "revisit", "2", 2400), ("3", "response", None, 0), ("4", "response", None, 5), ("5", "response", None, 5), ("6", "response", None, 1_500_000)]
    merged = [(r.url_key, r.ts) for r in warc.merge_runs(warc.index_runs(spark, path)).collect()]
    assert merged == sorted(merged) and len(merged) == 7
    warc.write_archives(pages.limit(0).withColumn("ts", F.timestamp_seconds("id")), path + "-none")
    assert warc.capture_history(spark, path + "-none").count() == 0


def test_history_is_in_order(spark, monkeypatch):
    """Many runs in rounds of three, small slices, a hot URL, empty pages in half the rows, one payload in a third; no adaptive joins."""
    monkeypatch.setattr(warc, "FAN_IN", 3)
    monkeypatch.setattr(warc, "SLICE", 90)
    pages = spark.range(600).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, "http://hot.example/").otherwise(F.concat(F.lit("http://h"), (F.col("id") * 37 % 23).cast("string"), F.lit(".example/p"), (F.col("id") % 7).cast("string"))).alias("url"),
        F.timestamp_seconds(F.col("id") * 7919 % 1000).alias("ts"), F.when(F.col("id") % 2 == 0, "").when(F.col("id") % 3 == 1, F.repeat(F.lit("same page "), 200)).otherwise(F.concat(F.lit("page "), "id")).alias("payload")).repartition(20)
    path = scratch(spark, "warc-order")
    warc.write_archives(pages, path)
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = warc.capture_history(spark, path).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    order = [(r.url_key, r.ts, len(r.id), r.id) for r in got]
    assert order == sorted(order) and {int(r.id) for r in got} == set(range(600)) and len(got) == 600
    same = [i for i in range(600) if i % 2 and i % 3 == 1]
    assert {int(r.id) for r in got if r.record_type == "revisit"} == set(same) - {max(same)}
    assert all(r.payload_bytes == 2000 and r.refers_to == str(max(same)) for r in got if r.record_type == "revisit")


def test_loser_tree():
    random.seed(2)
    for k in (1, 2, 3, 7, 16):
        runs = [sorted(random.choices(range(50), k=random.randrange(20))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: (x,))) == sorted(x for r in runs for x in r)
