"""Exact duplicates through an extendible-hash index on shared files (operator 9, DataFrame functions only).

1. Rows collapse to one entry per distinct text: 64-bit key, length, SHA-256,
   the largest id and the number of rows. Texts are compared whole, byte by
   byte, by grouping on them; copies collapse before the shuffle, so a popular
   text costs one row a task.
2. The directory starts one level short of what the number of keys calls for.
   While a bucket holds more than ``bucket_keys`` distinct keys the directory
   doubles, and only the overfull buckets are split by the next bit. Copies of
   one text share a key and never force a split.
3. Entries find their bucket through the directory. Owner tasks take contiguous
   ranges of (bucket, key) and chain the entries of a key: entries of one chain
   have the same hash and different texts. The index is written to shared files.
4. Rows look up the chains that stand for more than one row, by key and digest;
   the lookup is salted, so the rows of one hot text are spread over tasks.

Defined results: a null text counts as empty; of equal texts the row with the
largest id stays (a null id is smaller than any other); among rows that repeat
both id and text one stays; texts are compared unchanged. An empty table gives
no rows. Further columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consult.llm.common import fresh, keep_rows, numbered_copies, stage, text_or_empty

#: Distinct keys that a bucket of the directory may hold.
BUCKET_KEYS = 16_384
#: Parts into which the lookup of each key is spread.
SALTS = 16


def _prefix(depth: int):
    """The top ``depth`` bits of the key."""
    return F.shiftrightunsigned(F.col("key"), 64 - depth) if depth else F.lit(0).cast("long")


def grow_directory(keys: DataFrame, bucket_keys: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """``(slot, bucket, depth)`` for a table of distinct ``key`` values, and the global depth.

    ``depth`` is a bucket's local depth; all slots that share its prefix point to it.
    """
    depth = max(0, math.floor(math.log2(max(1, keys.count() / bucket_keys))))
    left, leaves = keys, []
    while True:
        sizes = stage(left.groupBy(_prefix(depth).alias("prefix")).agg(F.count("*").alias("n_keys")), "directory")
        leaves.append((depth, sizes.where(F.col("n_keys") <= bucket_keys)))
        full = sizes.where(F.col("n_keys") > bucket_keys)
        if depth >= 62 or full.isEmpty():
            leaves[-1] = (depth, sizes) if depth >= 62 else leaves[-1]
            break
        left = left.join(full.select("prefix"), _prefix(depth) == F.col("prefix"), "left_semi")
        depth += 1
    out = None
    for d, leaf in leaves:
        up = depth - d
        slots = F.sequence(F.shiftleft("prefix", up), F.shiftleft("prefix", up) + F.lit((1 << up) - 1))
        part = leaf.select(F.explode(slots).alias("slot"), F.shiftleft("prefix", up).alias("bucket"), F.lit(d).alias("depth"))
        out = part if out is None else out.unionByName(part)
    return stage(out, "directory"), depth


def build_index(rows: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """The index of ``rows`` (id, t, key): (bucket, key, chain), a chain entry for each distinct text of the key."""
    equal = rows.groupBy("key", "t").agg(F.max("id").alias("keep"), F.count("*").alias("n"))
    entries = stage(equal.select("key", F.octet_length("t").alias("bytes"), F.sha2("t", 256).alias("sha"), "keep", "n"), "entries")
    directory, depth = grow_directory(stage(entries.select("key").distinct(), "keys"), bucket_keys)
    placed = entries.join(directory.select("slot", "bucket"), _prefix(depth) == F.col("slot")).select("bucket", "key", "bytes", "sha", "keep", "n")
    # A range of (bucket, key) is an owner task; grouping by both needs no other exchange.
    owned = placed.repartitionByRange(F.col("bucket"), F.col("key"))
    return stage(owned.groupBy("bucket", "key").agg(F.array_sort(F.collect_list(F.struct("bytes", "sha", "keep", "n"))).alias("chain")), "index")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, bucket, copies.

    ``copies`` counts the rows that share id and text; ``bucket`` is null for a text that is there once.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t"))
    rows = rows.select("id", "t", F.xxhash64("t").alias("key"))
    index = build_index(rows, bucket_keys)
    groups = index.select("bucket", "key", F.inline("chain")).where("n > 1")
    groups = groups.select("bucket", "key", "sha", "keep", "n", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    own = rows.select("id", "key", F.sha2("t", 256).alias("sha"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    own = own.groupBy("key", "sha", "id", "salt").agg(F.count("*").alias("copies"))
    found = numbered_copies(own.join(groups, ["key", "sha", "salt"], "left"), "copies", "nth")
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep"))
    return found.select(
        F.col("id"), keep.alias("keep_id"), F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        (F.col("id").eqNullSafe(keep) & (F.col("nth") == 1)).alias("kept"), F.col("sha").alias("text_sha256"),
        F.col("bucket"), F.col("copies"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without exact copies; columns as they were."""
    (sha,) = fresh(docs.columns, "sha")
    marked = docs.withColumn(sha, F.sha2(text_or_empty(text_col), 256))
    kept = exact_dedup(docs, id_col, text_col).where("kept")
    return keep_rows(marked, kept, {id_col: "id", sha: "text_sha256"}, "copies").drop(sha)


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of documents with the row that stays of its equal texts (through the extendible-hash index)."""
    out = exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


ORACLE = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
