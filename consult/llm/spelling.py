"""Spelling variants grouped through asymmetric q-chunks (operator 12).

Two words are near if they differ by exactly one inserted, deleted or replaced
code point. Of two words, the longer (either, at equal length) contributes two
disjoint chunks, its first and its second run of half its length; the other
contributes its positional grams of that size. One edit touches one chunk at
most, so the other stands in the partner, shifted by one place at most: words
are joined on (length of the chunked word, number of the chunk, gram) within
shift one, and the join itself verifies the distance, so that unverified pairs
are never rows. Chunks of half a word are as selective as two disjoint chunks
can be; only grams within shift one of a chunk's place are written, as no other
can match.

A word's form is its near word of largest count (ties: smallest in code-point
order) if that count is at least ``RATIO`` times its own. Along forms counts
grow at least tenfold, so the way to the root has no cycle and is halved by
pointer jumps in a few rounds.

Words are counted with a map-side combine; a popular word costs one row a task.
A pair that shares both chunks is verified twice and kept once. Nothing is
broadcast.

Defined results: a null text has no words; a null id counts as empty in the
hash; ids may repeat, each row counts; an empty table gives no rows; further
columns are not read. Texts and runs of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consult.llm.common import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "([A-Za-zÀ-ÿ]+)"
#: Shortest word (code points), least count, how much more common a form is, and the share of runs that lose a code point.
LENGTH, LEAST, RATIO, DAMAGE = 7, 2, 10, 31


def damaged_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int | None = DAMAGE) -> DataFrame:
    """(word): every letter run, A-Z as a-z; with ``damage``, one of so many loses a code point by its hash."""
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"),
        F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(RUN), F.lit(1))).alias("run"))
    runs = runs.select("i", F.translate("run", UPPER, LOWER).alias("run"))
    if damage is None:
        return runs.select(F.col("run").alias("word"))
    hashed = runs.select("run", F.crc32(F.concat("i", F.lit(":"), "run")).alias("h"), F.char_length("run").alias("n"))
    at = (F.col("h") % F.col("n")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.col("n")))
    return hashed.select(F.when(F.col("h") % damage == 0, cut).otherwise(F.col("run")).alias("word"))


def _piece(word: str, start: Column, size: Column) -> Column:
    return F.substring(F.col(word), (start + 1).cast("int"), size.cast("int"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): all pairs of distinct ``word`` at distance one, once; ``a`` is the longer or, at equal length, the smaller one.

    A word of one code point has no two chunks: words have two at least.
    """
    half = (F.col("len") / 2).cast("int")
    w = words.select("word", F.char_length("word").alias("len"))
    chunks = w.select(F.col("word").alias("a"), F.col("len").alias("size"), F.explode(F.array(F.lit(0), F.lit(1))).alias("chunk"), half.alias("q"))
    chunks = chunks.select("a", "size", "chunk", (F.col("chunk") * F.col("q")).alias("at"), _piece("a", F.col("chunk") * F.col("q"), F.col("q")).alias("gram"))
    # The partner is as long as this word or one longer.
    grams = w.select(F.col("word").alias("b"), "len", F.explode(F.array(F.col("len"), F.col("len") + 1)).alias("size"))
    grams = grams.select("b", "len", "size", (F.col("size") / 2).cast("int").alias("q"), F.explode(F.array(F.lit(0), F.lit(1))).alias("chunk"))
    grams = grams.select("b", "len", "size", "q", "chunk", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("shift"))
    place = F.col("chunk") * F.col("q") + F.col("shift")
    grams = grams.where((place >= 0) & (place + F.col("q") <= F.col("len"))).select("b", "size", "chunk", place.alias("place"), _piece("b", place, F.col("q")).alias("gram"))
    same = [chunks[c] == grams[c] for c in ("size", "chunk", "gram")]
    order = (chunks["size"] > F.char_length("b")) | (F.col("a") < F.col("b"))
    found = chunks.join(grams, [*same, F.abs(F.col("at") - F.col("place")) <= 1, order, F.levenshtein("a", "b", 1) == 1])
    return found.select("a", "b").distinct()


def spelling_groups(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every row of ``words`` (word, n)."""
    pairs = stage(near_pairs(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))
    named = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("m")), "other")
    # The least of (-count, word) is the most common near word, ties to the smallest.
    best = named.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("top"))
    out = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("top.other").alias("other"), (-F.col("top.m")).alias("m"))
    good = F.col("m") >= ratio * F.col("n")
    out = stage(out.select("word", "n", "n_near", F.when(good, F.col("other")).alias("form"), F.when(good, F.col("m")).alias("form_n")), "forms")
    way = stage(out.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        step = way.join(way.select(F.col("word").alias("root"), F.col("root").alias("far")), "root", "left")
        step = stage(step.select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "roots")
        way = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    return out.join(way, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def count_words(runs: DataFrame, length: int = LENGTH, least: int = LEAST) -> DataFrame:
    """(word, n) of the words that are long and common enough, written once."""
    counted = runs.where(F.char_length("word") >= length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return stage(counted.where(F.col("n") >= least), "words")


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """Every word of at least 7 code points and 2 occurrences, with its near words' count, its form and its root."""
    words = count_words(damaged_runs(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return spelling_groups(words).select("word", "form", "root", "n", "n_near", "form_n")
