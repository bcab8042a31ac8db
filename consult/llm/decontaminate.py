"""Benchmark decontamination by size-partitioned MinHash containment search (operator 2).

Items and documents are sets of five-word shingles. Containment is the share
of an item's distinct shingles that a document has; an item of at least
``CONTAINMENT`` contaminates the document.

Whole documents cannot be compared by MinHash: an item of 30 shingles in a text
of 20,000 has a Jaccard similarity of 0.0015. So sizes are partitioned on both
sides. Items fall into classes of 16, 32, 64, ... shingles. For each class a
document is cut into windows of two class sizes that begin at every class size,
so every place an item can stand lies whole in one window. Two minima of each
hash give a window's MinHash from those of its halves, and a class's from the
class below. Within a class the window has at most four times the item's
shingles, which turns the containment threshold c into a Jaccard threshold of
``c / (4 + 1 - c)``, about 0.19; one of ``HASHES`` = 48 minima agrees with
probability 0.99996 or more. Windows with an agreeing minimum name (document,
item) candidates, verified by exact shingle containment in the whole document.
Items for which that bound does not hold, those of fewer than 8 shingles or of
many repeated ones, are looked up by each of their shingles instead.

An item of one to four words has one shingle, of all its words, and stands in a
document that has these words in a row; runs of that many words of a document
are looked up where there is such an item.

The items are the stated query set. They are taken in blocks of at most
``BLOCK`` items (and their shingles), so what is broadcast is bounded however
many there are; with more than one block, each block's result is written and its
broadcast given up before the next. Nothing is shuffled.

Defined results: null and empty texts, and items without words, have no shingles
and match nothing; equal items each match; repeated documents give repeated
rows; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consult.llm.common import fresh, stage, text_or_empty
from consult.llm.words import SHINGLE, Words, chunks, mix, seeds

CONTAINMENT = 0.8
HASHES = 48
SMALLEST = 16
#: Items, and shingles of items, that one pass broadcasts.
BLOCK, BLOCK_SHINGLES = 20_000, 4_000_000


class Items:
    """A block of items: shingles, per size class and hash the minima with their items, short items' shingles, and items of under five words."""

    def __init__(self, ids: list, texts: list[bytes]):
        self.ids = ids
        words = Words(texts)
        sh, _, first = words.shingles(short=False)
        self.sets = [np.unique(sh[first[i]:first[i + 1]]) for i in range(len(texts))]
        self.few: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in range(1, SHINGLE):
            own = np.flatnonzero(np.diff(words.first) == n)
            if len(own):
                runs, _, cut = words.shingles(n, short=False)
                held = runs[cut[own]]
                order = np.argsort(held, kind="stable")
                self.few[n] = held[order], own[order]
        self.seeds = seeds(HASHES, 2)
        self.classes: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        by: dict[int, list[int]] = {}
        direct = []
        for i, s in enumerate(self.sets):
            if len(s):
                n = max(int(first[i + 1] - first[i]), SMALLEST)
                size = 1 << (n - 1).bit_length()
                if 2 * size <= 4 * len(s):
                    by.setdefault(size, []).append(i)
                else:
                    direct.append(i)
        held = np.concatenate([np.zeros(0, np.uint64), *[self.sets[i] for i in direct]])
        order = np.argsort(held, kind="stable")
        self.direct = held[order], np.repeat(np.array(direct, np.int64), [len(self.sets[i]) for i in direct])[order]
        for size, own in sorted(by.items()):
            per = []
            for seed in self.seeds:
                low = np.array([mix(self.sets[i] ^ seed).min() for i in own], np.uint64)
                order = np.argsort(low, kind="stable")
                per.append((low[order], np.array(own)[order]))
            self.classes[size] = per

    def candidates(self, sh: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Distinct (text, item) pairs, as rows, some window of which shares a minimum or, for short items, a shingle."""
        n = np.diff(first)
        found = [np.zeros(0, np.int64)]
        top = max(self.classes, default=0)

        def look_up(own: np.ndarray, item: np.ndarray, values: np.ndarray, cut: np.ndarray) -> None:
            found.append(self._pairs(own, item, values, cut))

        if len(self.direct[0]):
            look_up(*self.direct, sh, first)
        blocks = -(-n // SMALLEST)
        at = np.zeros(len(n) + 1, np.int64)
        np.cumsum(blocks, out=at[1:])
        begin = np.repeat(first[:-1] - at[:-1] * SMALLEST, blocks) + np.arange(at[-1]) * SMALLEST
        layout = [(SMALLEST, at)]
        while layout[-1][0] < top:
            size, cut = layout[-1]
            halves = -(-np.diff(cut) // 2)
            up = np.zeros(len(n) + 1, np.int64)
            np.cumsum(halves, out=up[1:])
            layout.append((size * 2, up))
        for h, seed in enumerate(self.seeds if top and len(sh) else ()):
            low = np.minimum.reduceat(mix(sh ^ seed), begin)
            for k, (size, cut) in enumerate(layout):
                if k:
                    below = layout[k - 1][1]
                    left = np.repeat(below[:-1] - 2 * cut[:-1], np.diff(cut)) + 2 * np.arange(cut[-1])
                    last = np.repeat(below[1:], np.diff(cut)) - 1
                    low = np.minimum(low[left], low[np.minimum(left + 1, last)])
                if size in self.classes:
                    look_up(*self.classes[size][h], low, cut)
        pairs = np.unique(np.concatenate(found))
        return np.stack([pairs // len(self.ids), pairs % len(self.ids)], 1)

    def _pairs(self, own: np.ndarray, item: np.ndarray, values: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Distinct text * items + item where one of the text's ``values`` is among the items' ``own`` (sorted)."""
        spread, stop = np.searchsorted(own, values, "left"), np.searchsorted(own, values, "right")
        hit = np.flatnonzero(stop > spread)
        many = stop[hit] - spread[hit]
        pos = np.repeat(spread[hit] - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.unique(np.repeat(np.searchsorted(cut, hit, "right") - 1, many) * len(self.ids) + item[pos])

    def whole(self, words: Words) -> np.ndarray:
        """Distinct (text, item) pairs, as rows, of items of under five words that stand in the text."""
        found = [np.zeros(0, np.int64)]
        for n, (held, item) in self.few.items():
            runs, _, cut = words.shingles(n, short=False)
            found.append(self._pairs(held, item, runs, cut))
        pairs = np.concatenate(found)
        return np.stack([pairs // len(self.ids), pairs % len(self.ids)], 1)


def _blocks(rows: list) -> Iterator[list]:
    block, size = [], 0
    for r in rows:
        if block and (len(block) >= BLOCK or size >= BLOCK_SHINGLES):
            yield block
            block, size = [], 0
        block.append(r)
        size += len(r["t"] or "") // 2
    if block:
        yield block


def find_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = CONTAINMENT) -> DataFrame:
    """(id, item_id, shared, item_shingles, containment) of every document and item at or above ``threshold``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    asked = items.select(F.col(item_id).alias("item"), F.col(item_text).alias("t"))
    item_kind = asked.schema["item"].dataType
    arrow_kind = {"bigint": pa.int64(), "int": pa.int32()}.get(item_kind.simpleString(), pa.string())
    schema = f"id {rows.schema['id'].dataType.simpleString()}, item_id {'string' if arrow_kind == pa.string() else item_kind.simpleString()}, shared long, item_shingles long, containment double"
    out, blocks = None, _blocks(asked.toLocalIterator())
    block = next(blocks, None)
    alone = block is not None and (later := next(blocks, None)) is None
    while block is not None:
        ids = [r["item"] if arrow_kind != pa.string() or r["item"] is None else str(r["item"]) for r in block]
        sent = spark.sparkContext.broadcast((ids, [(r["t"] or "").encode() for r in block]))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known = Items(*sent.value)
            for b, texts in chunks(batches, "t"):
                words = Words(texts)
                sh, _, first = words.shingles(short=False)
                got = [(text, item, 1, 1) for text, item in known.whole(words)]
                for text, item in known.candidates(sh, first):
                    want = known.sets[item]
                    shared = int(np.isin(want, sh[first[text]:first[text + 1]]).sum())
                    if shared >= threshold * len(want):
                        got.append((text, item, shared, len(want)))
                if got:
                    t, i, s, n = map(list, zip(*got, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [b.column("id").take(pa.array(t)), pa.array([known.ids[x] for x in i], arrow_kind), pa.array(s, pa.int64()), pa.array(n, pa.int64()),
                         pa.array([x / y for x, y in zip(s, n, strict=True)], pa.float64())],
                        ["id", "item_id", "shared", "item_shingles", "containment"])

        part = rows.mapInArrow(run, schema)
        if not alone:
            part = stage(part, "contaminated-block")
            sent.unpersist()
        out = part if out is None else out.unionByName(part)
        block, later = later, next(blocks, None)
    return out if out is not None else spark.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item, by their texts, as ids may be null or repeat; columns as they were."""
    own, bad = fresh(docs.columns, "own_text", "held_text")
    marked = docs.withColumn(own, F.unhex(F.md5(text_or_empty("text"))))
    held = stage(find_contaminated(marked, items, id_col=own).select(F.col("id").alias(bad)).distinct(), "contaminated")
    return marked.join(held, F.col(own) == F.col(bad), "left_anti").select(*docs.columns)


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Benchmark items inside whole documents, by size-partitioned MinHash search and exact containment."""
    out = find_contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select(F.col("id").alias("doc_id"), "item_id", "shared", "item_shingles", "containment")


def _sql_words(table: str, key: str) -> str:
    return f"""SELECT {key}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {table}"""


ORACLE = f"""
WITH iw AS ({_sql_words('benchmark', 'item_id')}), dw AS ({_sql_words('documents', 'doc_id')}),
sizes AS (SELECT DISTINCT least(len(w), 5) AS k FROM iw WHERE len(w) > 0),
i AS (SELECT DISTINCT item_id, array_to_string(w[p:p + least(len(w), 5) - 1], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS p FROM iw)),
d AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + k - 1], ' ') AS s FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM dw, sizes)),
n AS (SELECT item_id, count(*) AS item_shingles FROM i GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS shared, any_value(item_shingles) AS item_shingles, count(*) / any_value(item_shingles) AS containment
FROM d JOIN i USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(item_shingles)
"""
