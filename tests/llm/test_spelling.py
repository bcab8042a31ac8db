"""Spelling groups against all pairs by brute force."""

import re
import zlib
from collections import Counter, defaultdict

from consult.llm import spelling
from consult.llm.catalog import QUERIES
from tests.conftest import SF_SMALL

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def brute_groups(n):
    """By words with a place left out: equal rests are replacements, rests that are words are insertions."""
    rest, near, form = defaultdict(set), defaultdict(set), {}
    for w in n:
        for p in range(len(w)):
            rest[w[:p], w[p + 1:]].add(w)
            if (v := w[:p] + w[p + 1:]) in n:
                near[w].add(v)
                near[v].add(w)
    for own in rest.values():
        for w in own:
            near[w] |= own - {w}
    for w in n:
        if near[w] and n[f := min(near[w], key=lambda x: (-n[x], x))] >= 10 * n[w]:
            form[w] = f

    def root(w):
        return root(form[w]) if w in form else w
    return sorted(((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n), key=str)


def test_op12_by_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op12_spelling_variants"](spark, SF_SMALL).collect()), key=str)
    assert got == brute_groups(brute_words(rows)) and any(g[1] for g in got)


def groups(spark, counts):
    out = spelling.spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long"))
    return sorted(map(tuple, out.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_every_kind_of_edit_at_every_place(spark):
    counts = {}
    for base in ("abcdefg", "straßenbahn", "übermäßig", "aaaaaaa", "abababab"):
        counts[base] = 100
        for p in range(len(base) + 1):
            counts.setdefault(base[:p] + "q" + base[p:], 2)
            if p < len(base):
                counts.setdefault(base[:p] + "q" + base[p + 1:], 3)
                counts.setdefault(base[:p] + base[p + 1:], 4)
    counts = {w: c for w, c in counts.items() if len(w) >= 7}
    assert groups(spark, counts) == brute_groups(counts)


def test_chains_ties_and_far_roots(spark):
    chain = {"correctly": 3, "correctla": 40, "correctba": 500, "correccba": 6000, "corretcba": 70000, "corrxtcba": 800000, "corrxycba": 9000000}
    tie = {"grouping": 20, "groupinh": 20, "groupinx": 2}
    got = {r[0]: r for r in groups(spark, chain | tie)}
    assert got["correctly"][1:3] == ("correctla", "corrxycba") and got["groupinx"][1] == "grouping" and got["grouping"][1] is None
    assert list(got.values()) == brute_groups(chain | tie)


def test_edges(spark, edge, empty):
    """Null and empty texts, a run of 60,000 letters, repeated rows, null ids, clashing columns, no rows."""
    long = "".join(chr(97 + i * 7 % 26) for i in range(60_000))
    extra = spark.createDataFrame([(None, long + " passages"), (None, long + " passagen passages passages"), (7, long[1:] + " " + long[1:])], "doc_id long, text string")
    docs = edge.withColumn("word", edge["text"]).unionByName(extra, allowMissingColumns=True)
    got = spelling.spelling_groups(spelling.count_words(spelling.damaged_runs(docs)))
    got = sorted(map(tuple, got.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)
    assert got == brute_groups(brute_words([(r.doc_id, r.text) for r in docs.collect()])) and any(len(g[0]) > 50_000 for g in got)
    assert spelling.spelling_groups(spelling.count_words(spelling.damaged_runs(empty))).count() == 0
    assert {r.word for r in spelling.damaged_runs(edge.where("doc_id = 3"), damage=None).collect()} == {"same", "text", "here"}
