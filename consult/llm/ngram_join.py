"""N-gram Jaccard join with Bayesian candidate pruning (operator 10).

Texts are sets of five-word shingles; two texts are linked at a Jaccard
similarity of 0.8 or more. Equal texts are one node, so copies cost a row each.

1. Every text gets ``HASHES`` MinHash values; 16 bands of four put nodes into
   buckets (a pair at 0.8 shares none with probability 0.0002).
   Buckets of one and the same set of members, which near copies make in most
   bands, count as one bucket, that of the lowest band.
2. In each bucket the pivot is the node whose buckets are largest in sum (of a
   text and its variants, the text they stem from); all others are compared
   with it, not with each other.
3. A comparison looks at eight more MinHash values at a time. With a uniform
   prior, m agreements of n leave similarity Beta(m+1, n-m+1); a pair whose
   probability of reaching the threshold falls below ``TOLERANCE`` is dropped.
   The others are verified on their exact shingle sets.
4. The other members of a bucket are compared with each other, in blocks of
   about ``BLOCK`` on both sides: one row per pair of blocks, the comparison
   (step 3) inside it, each pair in its first common band only and pairs of
   step 2 left out. Similarity is exact there too: a member is kept as its
   difference from the pivot, which is short for near copies. So every pair
   that shares a bucket is linked or refuted once and no bucket is capped; what
   comes out is a number of links per node and block pair, and rows for the
   links between nodes that the pivots do not connect.
5. Connected components of the links are the classes; a class is named by its
   largest id.

Defined results: a null text counts as empty; texts without a word are linked
to no other text; a text of one to four words has one shingle, all of it; rows
that repeat are copies; null ids are smaller than all others. ``links`` counts
all other texts that a text is linked to. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consult.llm.common import fresh, keep_rows, numbered_copies, stage, text_or_empty
from consult.llm.graph import components
from consult.llm.words import Words, chunks, seeds

THRESHOLD, HASHES, BAND, TOLERANCE, STEP = 0.8, 64, 4, 1e-4, 8
#: Members of a block, and bytes of their differences, about; left blocks of a share.
BLOCK, BLOCK_BYTES, SHARE = 256, 4 << 20, 8


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[tuple[int, int]]:
    """(values seen, agreements needed) for each step of the comparison."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        tail, m = 0.0, -1
        while m < n:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
        out.append((n, m))
    return out


def survivors(a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Numbers of the row pairs of two signature arrays that no step drops."""
    alive, seen, match = np.arange(len(a)), 0, np.zeros(len(a), np.int64)
    for n, least in steps:
        match = match + (a[alive, seen:n] == b[alive, seen:n]).sum(1)
        keep = match >= least
        alive, match, seen = alive[keep], match[keep], n
    return alive


def signatures(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """MinHash values (uint32 [texts, HASHES]) and the number of shingles (0: no words)."""
    sh, _, first = Words(texts).shingles()
    n = np.diff(first)
    out = np.zeros((len(texts), HASHES), np.uint32)
    has = np.flatnonzero(n)
    if len(has):
        add = seeds(HASHES, 10)
        for h in range(HASHES):
            low = np.minimum.reduceat(sh * (add[h] | np.uint64(1)) + add[-1 - h], first[has])
            out[has, h] = (low >> np.uint64(32)).astype(np.uint32)
    return out, n


def _sketch(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in chunks(batches, "t"):
            sig, n = signatures(texts)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([b.column("node").take(pa.array(at)), pa.array([sig[i].tobytes() for i in at], pa.binary())], ["node", "sig"])
    return rows.mapInArrow(run, "node binary, sig binary")


def _array(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint32).reshape(-1, HASHES)


def _sets(rows: DataFrame) -> DataFrame:
    """(node, sig, shingles): signatures and sorted distinct shingles of (node, t)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in chunks(batches, "t"):
            sig, _ = signatures(texts)
            sh, _, first = Words(texts).shingles()
            own = [np.unique(sh[first[i]:first[i + 1]]).tobytes() for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([x.tobytes() for x in sig], pa.binary()), pa.array(own, pa.binary())], ["node", "sig", "shingles"])
    return rows.mapInArrow(run, "node binary, sig binary, shingles binary")


STAR = "node binary, pivot binary, similarity double, n_pivot long, less binary, more binary"


def _compare_with_pivot(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, pivot) with exact similarity (null where pruned), the pivot's size, and how the node differs.

    ``less`` has the pivot's shingles that the node lacks, ``more`` those the pivot lacks.
    """
    steps, schema = least_matches(), pa.schema([("node", pa.binary()), ("pivot", pa.binary()), ("similarity", pa.float64()), ("n_pivot", pa.int64()), ("less", pa.binary()), ("more", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for lo in range(0, x.num_rows, 1000):
                part = x.slice(lo, 1000).to_pydict()
                alive = set(survivors(_array(part["sn"]), _array(part["sp"]), steps).tolist())
                rows = []
                for i, (n, p) in enumerate(zip(part["hn"], part["hp"], strict=True)):
                    n, p = np.frombuffer(n, np.uint64), np.frombuffer(p, np.uint64)
                    more, less = np.setdiff1d(n, p, True), np.setdiff1d(p, n, True)
                    rows.append({"node": part["node"][i], "pivot": part["pivot"][i], "similarity": (len(n) - len(more)) / (len(p) + len(more)) if i in alive else None,
                                 "n_pivot": len(p), "less": less.tobytes(), "more": more.tobytes()})
                yield pa.RecordBatch.from_pylist(rows, schema)
    n = sets.select("node", F.col("sig").alias("sn"), F.col("shingles").alias("hn"))
    p = sets.select(F.col("node").alias("pivot"), F.col("sig").alias("sp"), F.col("shingles").alias("hp"))
    return pairs.join(n, "node").join(p, "pivot").select("node", "pivot", "sn", "sp", "hn", "hp").mapInArrow(run, STAR)


def _overlaps(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets a[i] and b[j], pair by pair."""
    ua, ub = np.unique(i), np.unique(j)
    one, two = np.concatenate([a[k] for k in ua]), np.concatenate([b[k] for k in ub])
    common = np.intersect1d(one, two)
    held = [x[np.isin(x, common)] for x in [a[k] for k in ua] + [b[k] for k in ub]]
    _, number = np.unique(np.concatenate(held), return_inverse=True)
    width = int(number.max()) + 1 if len(number) else 0
    if (len(ua) + len(ub)) * width > 1 << 24:
        return np.array([len(np.intersect1d(a[x], b[y], assume_unique=True)) for x, y in zip(i, j, strict=True)], np.int64)
    table = np.zeros((len(held), max(width, 1)), np.float32)
    table[np.repeat(np.arange(len(held)), [len(x) for x in held]), number] = 1
    both = table[:len(ua)] @ table[len(ua):].T
    return both[np.searchsorted(ua, i), np.searchsorted(ub, j)].astype(np.int64)


def _link_blocks(r: dict, steps: list[tuple[int, int]], threshold: float) -> list[dict]:
    """Verified links between two blocks of one bucket: first band in common, no pair of step 2, not pruned, exact.

    A row (a, n) per node and its number of links here, a row (a, b, similarity) per link of two roots.
    """
    u, v = ({k: [x[k] for x in r[side]] for k in ("node", "sig", "root", "less", "more", "pivots")} for side in ("u", "v"))
    a, b = _array(u["sig"]), _array(v["sig"])
    bands = b.reshape(len(b), -1, BAND)
    told = np.zeros((len(a), len(b)), bool)
    at_u, at_v = ({x: k for k, x in enumerate(side["node"])} for side in (u, v))
    for i, pivots in enumerate(u["pivots"]):
        told[i, [at_v[x] for x in pivots if x in at_v]] = True
    for j, pivots in enumerate(v["pivots"]):
        told[[at_u[x] for x in pivots if x in at_u], j] = True
    left, right = [], []
    for i in range(len(a)):
        j = np.flatnonzero(~told[i])
        j = j[j > i] if r["same"] else j
        j = j[(bands[j] == a[i].reshape(1, -1, BAND)).all(2).argmax(1) == r["band"]] if len(j) else j
        j = j[survivors(np.broadcast_to(a[i], (len(j), HASHES)), b[j], steps)]
        left.append(np.full(len(j), i))
        right.append(j)
    i, j = np.concatenate(left), np.concatenate(right)
    if not len(i):
        return []
    sets = {k + x: [np.frombuffer(y, np.uint64) for y in side[x]] for k, side in (("u", u), ("v", v)) for x in ("less", "more")}
    size = {k: np.array([len(x) for x in y]) for k, y in sets.items()}
    lost = size["uless"][i] + size["vless"][j] - _overlaps(sets["uless"], sets["vless"], i, j)
    both = r["n_pivot"] - lost + _overlaps(sets["umore"], sets["vmore"], i, j)
    whole = 2 * r["n_pivot"] - size["uless"][i] + size["umore"][i] - size["vless"][j] + size["vmore"][j] - both
    s = both / np.maximum(whole, 1)
    i, j, s = i[s >= threshold], j[s >= threshold], s[s >= threshold]
    out = [{"a": side["node"][k], "n": int(n)} for side, at in ((u, i), (v, j)) for k, n in zip(*np.unique(at, return_counts=True), strict=True)]
    for x, y, z in zip(i.tolist(), j.tolist(), s.tolist(), strict=True):
        if u["root"][x] != v["root"][y]:
            p, q = u["node"][x], v["node"][y]
            out.append({"a": min(p, q), "b": max(p, q), "similarity": z})
    return out


def _link_members(members: DataFrame, wide: DataFrame, threshold: float) -> DataFrame:
    """Links among the members of a bucket that are not its pivot: (a, n) counts and (a < b, similarity) between roots.

    ``members``: key, band, n, node, pivot, root, size; ``wide``: node, pivot, sig, n_pivot, less,
    more, pivots. Buckets are cut into blocks by their number and bytes; a row is a pair of blocks.
    """
    steps, schema = least_matches(), pa.schema([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            for k in range(x.num_rows):
                if got := _link_blocks(x.slice(k, 1).to_pylist()[0], steps, threshold):
                    yield pa.RecordBatch.from_pylist(got, schema)

    total = stage(members.groupBy("key").agg(F.sum("size").alias("bytes")), "totals")
    parts = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES))
    around = members.join(total, "key").join(wide, ["node", "pivot"]).withColumn("parts", parts)
    held = F.collect_list(F.struct("node", "sig", "root", "less", "more", "pivots")).alias("x")
    blocks = stage(around.groupBy("key", F.pmod(F.xxhash64("node"), F.col("parts")).alias("block"), "parts").agg(held, F.max("band").alias("band"), F.max("n_pivot").alias("n_pivot")), "blocks")
    # Blocks stand in a circle: each meets itself and the half of the circle before it, so a bucket's
    # shares (runs of SHARE left blocks) have equal work, and a block is sent to the shares of that half.
    u = blocks.select("key", F.floor(F.col("block") / SHARE).alias("share"), F.col("block").alias("i"), "parts", F.col("x").alias("u"), "band", "n_pivot")
    back = F.col("block") - F.floor(F.col("parts") / 2)
    span = lambda lo, hi: F.sequence(F.floor(lo / SHARE), F.floor(hi / SHARE))
    around_end = F.when(back < 0, span(back + F.col("parts"), F.col("parts") - 1)).otherwise(F.array().cast("array<bigint>"))
    meets = F.array_distinct(F.concat(span(F.greatest(back, F.lit(0)), F.col("block")), around_end))
    v = blocks.select("key", F.explode(meets).alias("share"), F.col("block").alias("j"), F.col("x").alias("v"))
    ahead = F.pmod(F.col("j") - F.col("i"), F.col("parts")) * 2
    once = (ahead < F.col("parts")) | ((ahead == F.col("parts")) & (F.col("i") < F.col("j")))
    pairs = u.join(v, ["key", "share"]).where(once).select((F.col("i") == F.col("j")).alias("same"), "u", "v", "band", "n_pivot")
    return pairs.mapInArrow(run, "a binary, b binary, similarity double, n long")


def find_links(rows: DataFrame, nodes: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Verified links (a < b, similarity) that connect all classes, and (node, links) with all links counted.

    ``rows`` has id, node, t, ``nodes`` has node, copies, keep.
    """
    sketch = stage(_sketch(rows.select("node", "t")).dropDuplicates(["node"]), "sketch")
    keys = F.transform(F.sequence(F.lit(0), F.lit(HASHES // BAND - 1)), lambda k: F.xxhash64(k, F.substring("sig", k * (4 * BAND) + 1, F.lit(4 * BAND))))
    bands = stage(sketch.join(nodes.select("node", "copies"), "node").select("node", "copies", F.posexplode(keys).alias("band", "key")), "bands")
    prints = [F.bit_xor(F.xxhash64(F.lit(k), "node")).alias(f"print_{k}") for k in (1, 2)]
    sizes = bands.groupBy("key").agg(F.count("*").alias("n"), F.min("band").alias("band"), *prints).where("n > 1")
    # Buckets of the same members are one: each pair of theirs has its first common band in the lowest.
    alike = sizes.groupBy("n", "print_1", "print_2").agg(F.min(F.struct("band", "key"))["key"].alias("key"), F.count("*").alias("times"))
    shared = stage(bands.join(stage(alike.select("key", "n", "times"), "sizes"), "key"), "shared")
    weight = stage(shared.groupBy("node").agg(F.sum(F.col("n") * F.col("times")).alias("weight")), "weights")
    pivots = shared.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "copies", "node"))["node"].alias("pivot"))
    members = stage(shared.join(stage(pivots, "pivots"), "key").select("key", "band", "n", "node", "pivot"), "members")
    wanted = members.select("node").distinct().join(nodes.select("node", "keep"), "node").select(F.col("node").alias("n_node"), "keep")
    own = rows.join(wanted, (F.col("node") == F.col("n_node")) & F.col("id").eqNullSafe(F.col("keep")))
    sets = stage(_sets(own.select("node", "t")).dropDuplicates(["node"]), "sets")
    star = stage(_compare_with_pivot(members.where("node <> pivot").select("node", "pivot").distinct(), sets), "star")
    links = star.where(F.col("similarity") >= threshold).select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"), "similarity")
    links = stage(links.dropDuplicates(["a", "b"]), "links")

    roots = stage(components(links), "roots")
    named = sets.select("node").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    near = star.select("node", "pivot", (F.octet_length("less") + F.octet_length("more")).alias("size"))
    told = stage(members.where("n > 2").join(near, ["node", "pivot"]).join(named, "node").select("key", "band", "n", "node", "pivot", "root", "size"), "told")
    aimed = star.groupBy("node").agg(F.collect_list("pivot").alias("pivots"))
    wide = star.join(told.select("node", "pivot").distinct(), ["node", "pivot"]).select("node", "pivot", "n_pivot", "less", "more")
    rest = stage(_link_members(told, stage(wide.join(sets.select("node", "sig"), "node").join(aimed, "node"), "wide"), threshold), "rest")
    ends = links.select(F.col("a").alias("node"), F.lit(1).cast("long").alias("n")).unionAll(links.select("b", F.lit(1).cast("long")))
    degree = ends.unionAll(rest.where("b IS NULL").select("a", "n")).groupBy("node").agg(F.sum("n").alias("links"))
    return stage(links.unionByName(rest.where("b IS NOT NULL").select("a", "b", "similarity").distinct()), "links"), degree


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, node, class_id, links, text_copies, kept, copies (rows that share id and text)."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t"))
    rows = rows.select("id", "t", F.unhex(F.md5("t")).alias("node"))
    member = stage(rows.groupBy("id", "node").agg(F.count("*").alias("copies")), "membership")
    nodes = stage(member.groupBy("node").agg(F.sum("copies").alias("copies"), F.max("id").alias("keep")), "nodes")
    links, degree = find_links(rows, nodes, threshold)
    placed = nodes.join(components(links), "node", "left").join(degree, "node", "left")
    placed = placed.select("node", F.col("copies").alias("text_copies"), "keep", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0).cast("long")).alias("links"))
    placed = stage(placed, "placed")
    named = placed.groupBy("root").agg(F.max(F.struct("keep", "node")).alias("best"))
    known = stage(placed.join(stage(named, "named"), "root").select("node", "text_copies", "links", F.col("best.keep").alias("class_id"), F.col("best.node").alias("class_node")), "classes")
    out = numbered_copies(member.join(known, "node"), "copies", "nth")
    kept = F.col("id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("class_node")) & (F.col("nth") == 1)
    return out.select("id", "node", "class_id", "links", "text_copies", kept.alias("kept"), "copies")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class; columns as they were."""
    (node,) = fresh(docs.columns, "node")
    marked = docs.withColumn(node, F.unhex(F.md5(text_or_empty(text_col))))
    kept = jaccard_classes(docs, id_col, text_col).where("kept")
    return keep_rows(marked, kept, {id_col: "id", node: "node"}, "copies").drop(node)


def op10_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Class, number of links and of equal texts of every document, by the pruned n-gram Jaccard join."""
    out = jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "class_id", F.col("links").alias("n_links"), F.col("text_copies").alias("n_copies"), "kept")
