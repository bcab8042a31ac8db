"""Licence notices by a positional rare-token index (operator 8, DataFrame functions only).

The index holds the positions of every word of every template. One pass counts
in how many documents each of these words occurs. A second pass looks up, in
each file, the licence words of highest IDF that this file has (``LOOKED_UP`` of
them), and always the rarest word of every mandatory phrase. A hit of a word is
turned into the place where a template would begin by its position there. Places
of the words of a template are intersected; as a notice must hold its phrases,
only places that a phrase's rarest word names can remain, and they remain also
if no other word of the notice is there. At each of them the mandatory phrases
are verified word by word, and ``support`` counts the looked-up words that stand
at their relative positions. The score is the IDF-weighted share of a template's
words found at a verified place.

Templates are a table (label, text, phrases); ``NOTICES`` is the default one, and
base phrases are templates whose whole text is mandatory, so every place of them
is found. The templates, not the documents, are collected to the driver.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z. Defined
results: a null or empty text has no words, labels ``''``, score 0; every row
gives one row, repeated ids too; with no documents all IDFs are equal; a template
without phrases is mandatory as a whole, one without words is left out, and a
phrase that its template lacks is an error. Nothing is shuffled but one count per
licence word.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consult.llm.common import text_or_empty

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Licence words of highest IDF that are looked up in each file.
LOOKED_UP = 8

# Phrases and labels of the base, then notices (label, text, mandatory phrases).
BASE = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
NOTICES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software", ["hereby granted free of charge"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["general public license version 2"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["general public license version 3"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["lesser general public license"]),
    ("agpl-3.0", "licensed under the gnu affero general public license version 3", ["affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", ["source and binary forms"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4"]),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4"]),
    ("cc0-1.0", "cc0 1 0 universal public domain dedication", ["cc0 1 0"]),
]


@dataclass
class Template:
    """A notice as words, the ranges of its mandatory phrases, and whether it is a base phrase."""

    label: str
    words: list[str]
    phrases: list[tuple[int, int]]
    base: bool = False


def split_words(text: str | None) -> list[str]:
    """The words of a text, by the rule of this module."""
    return re.findall(WORD, (text or "").translate(str.maketrans(UPPER, LOWER)))


def templates(notices: list[tuple[str, str, list[str]]] = NOTICES) -> list[Template]:
    """The base phrases and the notices, in order."""
    out = [Template(label, w := split_words(text), [(0, len(w))], True) for label, text in BASE]
    for label, text, phrases in notices:
        words, spans = split_words(text), []
        for p in filter(None, map(split_words, phrases or [])):
            at = next((i for i in range(len(words)) if words[i:i + len(p)] == p), None)
            if at is None:
                raise ValueError(f"the notice of {label} does not hold its phrase {' '.join(p)!r}")
            spans.append((at, at + len(p)))
        if words:
            out.append(Template(label, words, spans or [(0, len(words))]))
    return out


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({WORD})"), F.lit(1))


def inverse_document_frequency(words: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """IDF of each licence word over all documents; the driver gets one row per licence word."""
    own = F.array_distinct(F.filter("words", lambda w: w.isin(vocabulary)))
    seen = words.select(F.explode(F.array_append(own, F.lit(""))).alias("w")).groupBy("w").count()
    df = {r["w"]: r["count"] for r in seen.collect()}
    n = df.get("", 0)
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1.0 for w in vocabulary}


def index_of(ts: list[Template], idf: dict[str, float]) -> Column:
    """The templates as an array literal: words with IDF, phrases, and the rarest word of all phrases with its position."""
    def one(t: Template) -> Column:
        inside = {i for lo, hi in t.phrases for i in range(lo, hi)}
        key = min(inside, key=lambda i: (-idf[t.words[i]], t.words[i], i))
        return F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), F.lit(t.words[key]).alias("key"), F.lit(key).alias("at"),
            F.array(*[F.struct(F.lit(w).alias("w"), F.lit(idf[w]).alias("idf")) for w in t.words]).alias("words"),
            F.lit(reduce(add, (idf[w] for w in t.words))).alias("total"),
            F.array(*[F.struct(F.lit(lo).alias("at"), F.array(*map(F.lit, t.words[lo:hi])).alias("words")) for lo, hi in t.phrases]).alias("phrases"))
    return F.array(*map(one, ts))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: DataFrame | None = None, looked_up: int = LOOKED_UP) -> DataFrame:
    """id, n_words, base_places (sorted starts), matches (label, base, place, share, support; one per template and place).

    ``notices`` is a table (label string, text string, phrases array<string>); by default ``NOTICES``.
    """
    ts = templates(NOTICES if notices is None else [(r["label"], r["text"], r["phrases"]) for r in notices.select("label", "text", "phrases").collect()])
    words = docs.select(F.col(id_col).alias("id"), words_of(text_or_empty(text_col)).alias("words"))
    idf = inverse_document_frequency(words, sorted({w for t in ts for w in t.words}))
    by_idf = F.array(*map(F.lit, sorted(idf, key=lambda w: (-idf[w], w))))
    rarest = sorted({min(t.words[lo:hi], key=lambda w: (-idf[w], w)) for t in ts for lo, hi in t.phrases})
    keys = sorted({min((t.words[i] for lo, hi in t.phrases for i in range(lo, hi)), key=lambda w: (-idf[w], w)) for t in ts})
    index = index_of(ts, idf)

    hits = F.filter(F.transform("words", lambda w, i: F.when(w.isin(keys), F.struct(i.alias("p"), w.alias("w")))), lambda h: h.isNotNull())
    # array_intersect keeps the order of its first side: the file's own licence words, rarest first.
    looked = words.select("id", "words", hits.alias("hits"), F.array_union(F.slice(F.array_intersect(by_idf, F.col("words")), 1, looked_up), F.array(*map(F.lit, rarest))).alias("looked"))

    def begins(h: Column) -> Column:
        return F.transform(F.filter(index, lambda t: t["key"] == h["w"]), lambda t: F.struct(t.alias("t"), (h["p"] - t["at"]).alias("o")))

    def holds(c: Column) -> Column:
        return F.forall(c["t"]["phrases"], lambda f: (c["o"] + f["at"] >= 0) & (F.slice("words", F.greatest(c["o"] + f["at"], F.lit(0)) + 1, F.size(f["words"])) == f["words"]))

    def match(c: Column) -> Column:
        there = F.filter(c["t"]["words"], lambda x, i: F.get(F.col("words"), c["o"] + i).eqNullSafe(x["w"]))
        share = F.aggregate(there, F.lit(0.0), lambda s, x: s + x["idf"]) / c["t"]["total"]
        support = F.size(F.array_distinct(F.transform(F.filter(there, lambda x: F.array_contains("looked", x["w"])), lambda x: x["w"])))
        return F.struct(c["t"]["label"].alias("label"), c["t"]["base"].alias("base"), c["o"].alias("place"), F.least(share, F.lit(1.0)).alias("share"), support.alias("support"))

    found = looked.select("id", "words", "looked", F.filter(F.flatten(F.transform("hits", begins)), holds).alias("found"))
    base = F.array_sort(F.transform(F.filter("matches", lambda m: m["base"]), lambda m: m["place"]))
    return found.select("id", F.size("words").cast("long").alias("n_words"), F.transform("found", match).alias("matches")).select("id", "n_words", base.alias("base_places"), "matches")


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licence labels of every whole document, by the positional rare-token index."""
    m = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def joined(matches: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda x: x["label"]))), ",")
    return m.select(
        F.col("id").alias("doc_id"), "n_words", F.size("base_places").cast("long").alias("n_base"),
        F.array_min("base_places").cast("long").alias("first_word"), F.array_max("base_places").cast("long").alias("last_word"),
        joined(F.filter("matches", lambda x: x["base"])).alias("base_labels"), joined(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda x: x["share"])), F.lit(0.0)).alias("score"))
