"""Exact inner-product top-k by ball trees per shard (operator 11).

1. Every component x becomes floor(256 * x). Rows are dealt out by a hash of
   their row number into shards of about ``SHARD_ROWS``; a task builds one
   shard's ball tree (median splits along the widest dimension; each node has a
   centre, a radius and its smallest id) and keeps it as one binary value.
2. The queries are packed into blocks of about ``BLOCK`` with their k best hits
   so far. Round by round a block meets further shards, four times as many as
   it has seen; a pair of block and shard is one row.
3. In a shard, each query first goes down to the leaf of greatest bound, then
   the tree level by level; a node lives while ``q . centre + |q| * radius`` can
   still beat the query's current kth score (at equal score: kth id). Leaves
   are scanned in falling order of their bound, and the kth score is raised
   after each. Only hits that beat the kth score are sent on; they are merged
   into the block before the next round, so all shards share that score.

Shards are of equal size whatever the data (equal vectors have distinct rows),
and nothing is broadcast: blocks and shards meet by sort-merge at every size. Scores are exact: in floats where every product sum
is below 2^53, else in Python integers.

Defined results: vectors that are null or hold a null or non-finite component
take no part; an empty vector scores 0; of vectors of unequal length the
shorter is padded with zeros; a query's own row is no candidate, but another
row with the same id is; repeated rows each count; a null id comes after all
others in a tie (2^63-1 stands for it); scores beyond a long are reported as its
ends. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consult.llm.common import stage

#: Rows of a shard, queries of a block, rows of a leaf, growth of the shards seen from round to round.
SHARD_ROWS, BLOCK, LEAF, GROWTH = 8192, 1024, 32, 4
EXACT = float(1 << 53)
NONE = np.iinfo(np.int64).max
LEAST = np.iinfo(np.int64).min


def pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw)) as z:
        return {k: z[k] for k in z.files}


def components(table: pa.Table) -> np.ndarray:
    """floor(256 * x) of every vector, as whole floats, padded with zeros."""
    vec = table.column("vec").combine_chunks()
    if isinstance(vec, pa.ChunkedArray):
        vec = pa.concat_arrays(vec.chunks)
    flat, size = vec.flatten().to_numpy(zero_copy_only=False), np.diff(vec.offsets.to_numpy())
    out = np.zeros((len(vec), int(size.max(initial=0))))
    with np.errstate(over="ignore"):
        out[np.arange(out.shape[1]) < size[:, None]] = np.clip(np.floor(flat * 256.0), -1e300, 1e300)
    return out


def numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().fill_null(NONE).to_numpy(zero_copy_only=False).astype(np.int64)


def build_tree(points: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> dict[str, np.ndarray]:
    """Nodes in breadth-first order over points reordered so that a node is a range ``lo:hi``.

    ``child`` is the first of two neighbouring children, 0 at a leaf.
    """
    order = np.lexsort((rows, ids))
    lo, hi, child, centre, radius, least = [0], [len(order)], [], [], [], []
    k = 0
    while k < len(lo):
        own = order[lo[k]:hi[k]]
        p = points[own]
        c = p.mean(0)
        centre.append(c)
        radius.append(np.sqrt(((p - c) ** 2).sum(1).max(initial=0.0)))
        least.append(ids[own].min(initial=NONE))
        child.append(0)
        if len(own) > LEAF:
            spread = p.max(0) - p.min(0) if p.shape[1] else np.zeros(1)
            if spread.max() > 0:
                half = len(own) // 2
                own = own[np.argpartition(p[:, spread.argmax()], half)]
                order[lo[k]:hi[k]] = np.concatenate([np.sort(own[:half]), np.sort(own[half:])])
            mid = lo[k] + len(own) // 2
            child[k] = len(lo)
            lo += [lo[k], mid]
            hi += [mid, hi[k]]
        k += 1
    return {"points": points[order], "ids": ids[order], "rows": rows[order], "lo": np.array(lo), "hi": np.array(hi), "child": np.array(child),
            "centre": np.array(centre), "radius": np.array(radius), "least": np.array(least)}


def best(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first k of every line by falling score, then id, then row."""
    at = np.lexsort((rows, ids, ~score), axis=1)[:, :k]
    return tuple(np.take_along_axis(x, at, 1) for x in (score, ids, rows))


def products(points: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of ``points`` (m, n, d) with ``q`` (m, d) as longs."""
    if exact:
        return np.matmul(points, q[:, :, None])[:, :, 0].astype(np.int64)
    whole = np.frompyfunc(int, 1, 1)
    return np.clip((whole(points) * whole(q)[:, None, :]).sum(2), LEAST, NONE).astype(np.int64)


class Search:
    """Branch and bound of one block of queries in one shard; ``ts`` and ``ti`` are their kth scores and ids so far."""

    def __init__(self, tree: dict[str, np.ndarray], state: dict[str, np.ndarray], k: int):
        d = max(tree["points"].shape[1], state["q"].shape[1])
        wide = [np.pad(x, ((0, 0), (0, d - x.shape[1]))) for x in (tree["points"], tree["centre"], state["q"])]
        self.points, centre, self.q = wide
        self.tree, self.own, self.k = tree, state["row"], k
        with np.errstate(over="ignore", invalid="ignore"):
            self.exact = bool(np.abs(self.points).max(initial=0) * np.abs(self.q).max(initial=0) * max(d, 1) < EXACT)
            norm = np.sqrt((self.q ** 2).sum(1))[:, None]
            reach = norm * tree["radius"]
            # The bound of every query and node, with room for the rounding of floats; scores are whole.
            bound = self.q @ centre.T + reach + 1e-9 * (norm * np.sqrt((centre ** 2).sum(1)) + reach) + 1e-3
        self.bound = np.where(np.isnan(bound), np.inf, np.floor(bound))
        self.ts, self.ti = state["score"][:, -1].copy(), state["id"][:, -1].copy()
        shape = (len(self.q), k)
        self.found = [np.full(shape, LEAST), np.full(shape, NONE), np.full(shape, NONE)]

    def alive(self, qi: np.ndarray, node: np.ndarray) -> np.ndarray:
        b, t = self.bound[qi, node], self.ts[qi]
        return (b > t) | ((b >= t) & (self.tree["least"][node] <= self.ti[qi]))

    def scan(self, qi: np.ndarray, node: np.ndarray) -> None:
        """Compare each query with the points of its leaf (no query twice in a call)."""
        step = max(1, (1 << 21) // (LEAF * max(1, self.q.shape[1])))
        for a in range(0, len(qi), step):
            self._scan(qi[a:a + step], node[a:a + step])

    def _scan(self, qi: np.ndarray, node: np.ndarray) -> None:
        t = self.tree
        at = t["lo"][node][:, None] + np.arange(LEAF)
        ok = at < t["hi"][node][:, None]
        at = np.minimum(at, len(t["rows"]) - 1)
        s, i, r = products(self.points[at], self.q[qi], self.exact), t["ids"][at], t["rows"][at]
        ts, ti = self.ts[qi][:, None], self.ti[qi][:, None]
        ok &= (r != self.own[qi][:, None]) & ((s > ts) | ((s == ts) & (i <= ti)))
        hit = ok.any(1)
        if not hit.any():
            return
        qi, ok = qi[hit], ok[hit]
        new = (np.where(ok, s[hit], LEAST), np.where(ok, i[hit], NONE), np.where(ok, r[hit], NONE))
        top = best(*[np.concatenate([f[qi], x], 1) for f, x in zip(self.found, new, strict=True)], self.k)
        for f, x in zip(self.found, top, strict=True):
            f[qi] = x
        s, i = top[0][:, -1], top[1][:, -1]
        up = (s > self.ts[qi]) | ((s == self.ts[qi]) & (i < self.ti[qi]))
        self.ts[qi[up]], self.ti[qi[up]] = s[up], i[up]

    def run(self) -> dict[str, np.ndarray]:
        """The hits of this shard that beat the kth scores, for the queries that have any."""
        child, everyone = self.tree["child"], np.arange(len(self.q))
        near = np.zeros(len(self.q), np.int64)
        while (inner := child[near] > 0).any():
            left = child[near]
            down = left + (self.bound[everyone, np.minimum(left + 1, len(child) - 1)] > self.bound[everyone, left])
            near = np.where(inner, down, near)
        self.scan(everyone, near)
        qi, node, leaves = everyone, np.zeros(len(self.q), np.int64), []
        while len(qi):
            live = self.alive(qi, node)
            qi, node = qi[live], node[live]
            leaf = child[node] == 0
            leaves.append((qi[leaf], node[leaf]))
            qi, node = qi[~leaf], child[node[~leaf]]
            qi, node = np.concatenate([qi, qi]), np.concatenate([node, node + 1])
        qi, node = (np.concatenate(x) for x in zip(*leaves, strict=True))
        rest = node != near[qi]
        qi, node = qi[rest], node[rest]
        order = np.lexsort((-self.bound[qi, node], qi))
        qi, node = qi[order], node[order]
        place = np.arange(len(qi)) - np.searchsorted(qi, qi)
        for wave in range(int(place.max(initial=-1)) + 1):
            now = np.flatnonzero(place == wave)
            now = now[self.alive(qi[now], node[now])]
            if len(now):
                self.scan(qi[now], node[now])
        some = np.flatnonzero(self.found[2][:, 0] != NONE)
        return {"at": some, "score": self.found[0][some], "id": self.found[1][some], "hit": self.found[2][some]}


def merge(state: dict[str, np.ndarray], parts: list[dict[str, np.ndarray]], k: int) -> dict[str, np.ndarray]:
    """The block with the hits of ``parts`` among its best."""
    for p in parts:
        at = p["at"]
        top = best(*[np.concatenate([state[c][at], p[c]], 1) for c in ("score", "id", "hit")], k)
        for c, x in zip(("score", "id", "hit"), top, strict=True):
            state[c][at] = x
    return state


def top_products(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
                 shard_rows: int = SHARD_ROWS, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows that satisfy ``is_query`` the ``k`` best of all other rows."""
    spark = vectors.sparkSession
    vec = F.col(vec_col).cast("array<double>")
    whole = F.forall(vec, lambda x: F.coalesce((x == x) & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    rows = vectors.where(F.col(vec_col).isNotNull() & whole).select(
        F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"), F.coalesce(is_query, F.lit(False)).alias("asks"), F.monotonically_increasing_id().alias("row"))
    rows = stage(rows, "vectors")
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(asked / block))
    rows = rows.withColumn("vec", F.col("vec").cast("array<double>"))

    def index(table: pa.Table) -> pa.Table:
        tree = build_tree(components(table), numbers(table, "id"), numbers(table, "row"))
        return pa.table({"shard": table.column("shard").slice(0, 1), "tree": pa.array([pack(**tree)], pa.binary())})

    def start(table: pa.Table) -> pa.Table:
        q, shape = components(table), (table.num_rows, k)
        held = pack(q=q, row=numbers(table, "row"), asker=numbers(table, "id"), score=np.full(shape, LEAST), id=np.full(shape, NONE), hit=np.full(shape, NONE))
        return pa.table({"block": table.column("block").slice(0, 1), "state": pa.array([held], pa.binary())})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tree = None, None
        for b in batches:
            for i in range(b.num_rows):
                if (shard := b.column("shard")[i].as_py()) != last:
                    last, tree = shard, unpack(b.column("tree")[i].as_py())
                hits = Search(tree, unpack(b.column("state")[i].as_py()), k).run()
                if len(hits["at"]):
                    yield pa.RecordBatch.from_arrays([b.column("block").slice(i, 1), pa.array([pack(**hits)], pa.binary())], ["block", "state"])

    def gather(table: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in table.column("state").to_pylist()]
        held = next(p for p in parts if "q" in p)
        return pa.table({"block": table.column("block").slice(0, 1), "state": pa.array([pack(**merge(held, [p for p in parts if "q" not in p], k))], pa.binary())})

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column("state").to_pylist():
                s = unpack(raw)
                line, rank = np.nonzero(s["hit"] != NONE)
                ids = s["id"][line, rank]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s["asker"][line]), pa.array((rank + 1).astype(np.int32)), pa.array(ids, mask=ids == NONE), pa.array(s["score"][line, rank])],
                    ["query_id", "rank", "vec_id", "score"])

    trees = stage(rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")).groupBy("shard").applyInArrow(index, "shard int, tree binary"), "trees")
    asks = rows.where("asks").withColumn("block", F.pmod(F.xxhash64("row", F.lit("block")), F.lit(blocks)).cast("int"))
    held = stage(asks.groupBy("block").applyInArrow(start, "block int, state binary"), "blocks")
    seen = 0
    while seen < shards and asked:
        upto = min(shards, max(1, seen * GROWTH))
        turn = F.explode(F.sequence(F.lit(seen), F.lit(upto - 1)))
        pairs = held.select("block", "state", turn.alias("turn")).withColumn("shard", F.pmod(F.col("block") + F.col("turn"), F.lit(shards)).cast("int"))
        # A block becomes a row for every shard it meets, which no estimate sees: by the blocks' size on file
        # Spark would broadcast all pairs. A partition gets few shards, so that tasks share the work.
        hits = pairs.repartition(2 * shards, "shard").hint("merge").join(trees, "shard").select("shard", "tree", "block", "state").mapInArrow(meet, "block int, state binary")
        held = stage(held.unionByName(hits).groupBy("block").applyInArrow(gather, "block int, state binary"), "blocks")
        seen = upto
    return held.mapInArrow(report, "query_id long, rank int, vec_id long, score long")


def op11_topk_search(spark, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every 50th vector id with all other vectors, components scaled to whole numbers."""
    return top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id) p) t
WHERE r <= 5"""
