"""Trees of a forest, grown level by level over rows that stay where they are.

The rows are combinations of bins with a label and, for every tree, how often its
bag holds them (``draws``). They are packed once into blocks (``pack_bags``). For a
level of all trees there is one job (``grow``): every task sends its rows down the
trees so far and counts draws by (node, feature, bin, label) for the open nodes;
the counts of a tree are summed in one task, which picks the best split of each
open node. Only splits come to the driver. A task holds the counts of one level,
at most 2^depth x features x bins x labels a tree, however many rows there are.

Splits follow Spark's forest: its gain, a random set of features for each node,
``least`` draws on both sides, no gain is a leaf, and leaves of one parent with the
same prediction are merged. ``nodes_table`` gives the nodes as Spark stores them.
"""

from __future__ import annotations

import io
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Nodes of one tree, as Spark's models store them.
NODES = ("treeID int, nodeData struct<id:int,prediction:double,impurity:double,impurityStats:array<double>,rawCount:bigint,gain:double,"
         "leftChild:int,rightChild:int,split:struct<featureIndex:int,leftCategoriesOrThreshold:array<double>,numCategories:int>>")


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays in one value, whole numbers in the shortest type that holds them."""
    out = io.BytesIO()
    np.savez(out, **{k: x.astype(np.min_scalar_type(x.max(initial=0))) if x.dtype.kind == "i" and x.min(initial=0) >= 0 else x for k, x in arrays.items()})
    return out.getvalue()


def unpack(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw)) as z:
        return {k: z[k] for k in z.files}


def pack_bags(bags: DataFrame, cols: list[str]) -> DataFrame:
    """Blocks of rows (bins of ``cols``, label, draws by tree) as single binary values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                bins = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in cols], 1).astype(np.int64)
                draws = b.column("draws").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                held = pack(bins=bins, label=b.column("label").to_numpy(zero_copy_only=False).astype(np.int64), draws=np.ascontiguousarray(draws.T))
                yield pa.RecordBatch.from_arrays([pa.array([held], pa.binary())], ["block"])
    return bags.select(*cols, "label", "draws").mapInArrow(run, "block binary")


def bag_sizes(blocks: DataFrame, trees: int) -> np.ndarray:
    """Counts by label of each tree's bag, a line a tree; two labels at least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for raw in (x for b in batches for x in b.column("block").to_pylist()):
            held = unpack(raw)
            for c in np.unique(held["label"]):
                drawn = held["draws"][:, held["label"] == c].sum(1, dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([int(c)], pa.int32()), pa.array([drawn.tolist()], pa.list_(pa.int64()))], ["label", "drawn"])
    found = blocks.mapInArrow(run, "label int, drawn array<bigint>").groupBy("label").agg(F.array(*[F.sum(F.col("drawn")[t]) for t in range(trees)]).alias("drawn")).collect()
    out = np.zeros((trees, max([2, *[r["label"] + 1 for r in found]])))
    for r in found:  # one row a label
        out[:, r["label"]] = r["drawn"]
    return out


def subset_size(strategy: str, features: int, trees: int) -> int:
    """Features that a node looks at, by Spark's names of the strategies."""
    if strategy == "auto":
        strategy = "sqrt" if trees > 1 else "all"
    named = {"all": features, "sqrt": math.ceil(math.sqrt(features)), "log2": max(1, math.ceil(math.log2(features))), "onethird": math.ceil(features / 3)}
    if strategy in named:
        return named[strategy]
    return min(features, int(strategy)) if strategy.isdigit() else math.ceil(float(strategy) * features)


def impurities(counts: np.ndarray, kind: str) -> np.ndarray:
    """Gini impurity or entropy of the counts by label in the last axis."""
    total = counts.sum(-1, keepdims=True)
    p = np.divide(counts, total, out=np.zeros(counts.shape), where=total > 0)
    if kind == "entropy":
        return -(p * np.log2(p, out=np.zeros(p.shape), where=p > 0)).sum(-1)
    return np.where(total[..., 0] > 0, 1.0 - (p * p).sum(-1), 0.0)


class Tree:
    """Nodes by rising depth: feature, last bin that goes left, first of two children (a leaf: itself), counts by label, gain."""

    def __init__(self, counts: np.ndarray):
        self.feature, self.cut, self.child = np.zeros(1, np.int32), np.full(1, np.iinfo(np.int32).max, np.int32), np.zeros(1, np.int32)
        self.counts, self.gain, self.depth = counts[None, :].astype(float), np.full(1, -1.0), np.zeros(1, np.int32)

    def split(self, node: np.ndarray, feature: np.ndarray, cut: np.ndarray, gain: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Split the nodes; their children, left and right by turns."""
        first = len(self.feature) + 2 * np.arange(len(node), dtype=np.int32)
        self.feature[node], self.cut[node], self.child[node], self.gain[node] = feature, cut, first, gain
        own = np.arange(len(self.feature), len(self.feature) + 2 * len(node), dtype=np.int32)
        self.counts = np.concatenate([self.counts, np.stack([left, self.counts[node] - left], 1).reshape(2 * len(node), self.counts.shape[1])])
        self.depth = np.concatenate([self.depth, np.repeat(self.depth[node] + 1, 2)])
        self.feature = np.concatenate([self.feature, np.zeros(len(own), np.int32)])
        self.cut = np.concatenate([self.cut, np.full(len(own), np.iinfo(np.int32).max, np.int32)])
        self.child, self.gain = np.concatenate([self.child, own]), np.concatenate([self.gain, np.full(len(own), -1.0)])
        return own

    def merge_leaves(self) -> None:
        """Make a node a leaf where both its children are leaves of the same prediction, from the deepest up."""
        best = self.counts.argmax(1)
        for d in range(int(self.depth.max()), -1, -1):
            at = np.flatnonzero((self.depth == d) & (self.child != np.arange(len(self.child))))
            a, b = self.child[at], self.child[at] + 1
            flat = at[(self.child[a] == a) & (self.child[b] == b) & (best[a] == best[b])]
            self.child[flat], self.gain[flat] = flat, -1.0


def _send_down(feature: np.ndarray, cut: np.ndarray, child: np.ndarray, bins: np.ndarray, depth: int) -> np.ndarray:
    """The node of each row after ``depth`` levels."""
    node, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        node = child[node] + (bins[row, feature[node]] > cut[node])
    return node


def _counter(trees: dict[int, tuple], open_nodes: dict[int, np.ndarray], chosen: dict[int, np.ndarray], depth: int, n_bins: int, classes: int) -> Callable:
    """Counts of a task's rows by tree, as places and values of a table (open node, chosen feature, bin, label)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for raw in (x for b in batches for x in b.column("block").to_pylist()):
            held = unpack(raw)
            bins, label = held["bins"], held["label"].astype(np.int64)
            for t, nodes in open_nodes.items():
                used = np.flatnonzero(held["draws"][t])
                at = np.full(len(trees[t][0]), -1)
                at[nodes] = np.arange(len(nodes))
                place = at[_send_down(*trees[t], bins[used], depth)]
                used, place = used[place >= 0], place[place >= 0]
                m = chosen[t].shape[1]
                cell = ((place[:, None] * m + np.arange(m)) * n_bins + bins[used[:, None], chosen[t][place]]) * classes + label[used][:, None]
                drawn = np.repeat(held["draws"][t][used].astype(float), m)
                part = np.bincount(cell.ravel(), drawn, minlength=len(nodes) * m * n_bins * classes)
                sums[t] = part + sums[t] if t in sums else part
        for t, part in sums.items():
            at = np.flatnonzero(part)
            held = pack(gap=np.diff(at, prepend=0), count=part[at].astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([held], pa.binary())], ["tree", "counts"])
    return run


def best_splits(table: np.ndarray, least: float, min_gain: float, impurity: str) -> tuple[np.ndarray, ...]:
    """Of counts (node, feature, bin, label): place of the feature, last bin on the left, gain (0: no split) and counts on the left."""
    left = table.cumsum(2)[:, :, :-1]
    whole = table.sum(2, keepdims=True)
    right = whole - left
    n, a, b = whole.sum(-1), left.sum(-1), right.sum(-1)
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = impurities(whole, impurity) - a / n * impurities(left, impurity) - b / n * impurities(right, impurity)
    gain = np.where((a >= least) & (b >= least) & (gain >= min_gain), gain, 0.0)
    flat = gain.reshape(len(table), -1)
    top = flat.argmax(1)
    feature, cut = np.divmod(top, gain.shape[2])
    every = np.arange(len(table))
    return feature, cut, np.maximum(flat[every, top], 0.0), left[every, feature, cut]


def _chooser(shape: dict[int, tuple], least: np.ndarray, min_gain: float, impurity: str) -> Callable:
    """The best splits of a tree's open nodes, from the counts that the tasks made of it."""
    def run(parts: pa.Table) -> pa.Table:
        t = parts.column("tree")[0].as_py()
        table = np.zeros(math.prod(shape[t]))
        for raw in parts.column("counts").to_pylist():
            held = unpack(raw)
            table[held["gap"].cumsum(dtype=np.int64)] += held["count"]
        feature, cut, gain, left = best_splits(table.reshape(shape[t]), least[t], min_gain, impurity)
        return pa.table({"tree": pa.array([t], pa.int32()), "splits": pa.array([pack(feature=feature, cut=cut, gain=gain, left=left)], pa.binary())})
    return run


def grow(blocks: DataFrame, sizes: np.ndarray, subset: int, features: int, n_bins: int, max_depth: int, least: np.ndarray, min_gain: float, impurity: str, seed: int) -> list[Tree]:
    """Trees of the bags in ``blocks``; ``sizes`` are each bag's counts by label, ``least`` the draws that a side of a split needs."""
    trees = {t: Tree(c) for t, c in enumerate(sizes) if c.sum()}
    fresh = {t: np.zeros(1, np.int64) for t in trees}
    for depth in range(max_depth):
        # A node of one label, or too small for two sides, stays a leaf.
        open_nodes = {t: at[((c := trees[t].counts[at]).sum(1) >= 2 * least[t]) & ((c > 0).sum(1) > 1)] for t, at in fresh.items()}
        open_nodes = {t: at for t, at in open_nodes.items() if len(at)}
        if not open_nodes or n_bins < 2:
            break
        chosen = {t: np.sort(np.random.default_rng([seed % 2**64, t, depth]).random((len(at), features)).argsort(1)[:, :subset], 1) for t, at in open_nodes.items()}
        shape = {t: (*x.shape, n_bins, sizes.shape[1]) for t, x in chosen.items()}

        paths = {t: (trees[t].feature, trees[t].cut, trees[t].child) for t in open_nodes}
        counts = blocks.mapInArrow(_counter(paths, open_nodes, chosen, depth, n_bins, sizes.shape[1]), "tree int, counts binary")
        fresh = {}
        for r in counts.groupBy("tree").applyInArrow(_chooser(shape, least, min_gain, impurity), "tree int, splits binary").collect():  # one row a tree: its new splits
            t, s = r["tree"], unpack(r["splits"])
            real = np.flatnonzero(s["gain"] > 0)
            fresh[t] = trees[t].split(open_nodes[t][real], chosen[t][real, s["feature"][real]], s["cut"][real], s["gain"][real], s["left"][real])
    for tree in trees.values():
        tree.merge_leaves()
    return list(trees.values())


def nodes_table(trees: list[Tree], impurity: str) -> pa.Table:
    """The trees' nodes in the form of ``NODES``, parents before their children; bins are split halfway between two."""
    parts = []
    for t, tree in enumerate(trees):
        n = len(tree.child)
        inner, seen = tree.child != np.arange(n), np.zeros(n, bool)
        seen[0] = True
        for d in range(int(tree.depth.max())):
            at = np.flatnonzero(inner & seen & (tree.depth == d))
            seen[tree.child[at]] = seen[tree.child[at] + 1] = True
        kept, own = np.flatnonzero(seen), seen.cumsum() - 1
        inner, counts = inner[kept], tree.counts[kept]
        child = np.where(inner, own[tree.child[kept]], -1)
        ends = np.concatenate([[0], inner.cumsum()]).astype(np.int32)
        split = pa.StructArray.from_arrays([
            pa.array(np.where(inner, tree.feature[kept], -1).astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(tree.cut[kept][inner] + 0.5)),
            pa.array(np.full(len(kept), -1, np.int32))], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
        stats = pa.ListArray.from_arrays(pa.array((np.arange(len(kept) + 1) * counts.shape[1]).astype(np.int32)), pa.array(counts.ravel()))
        data = pa.StructArray.from_arrays([
            pa.array(np.arange(len(kept), dtype=np.int32)), pa.array(counts.argmax(1).astype(float)), pa.array(impurities(counts, impurity)), stats,
            pa.array(counts.sum(1).astype(np.int64)), pa.array(np.where(inner, tree.gain[kept], -1.0)), pa.array(child.astype(np.int32)),
            pa.array(np.where(inner, child + 1, -1).astype(np.int32)), split],
            ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
        parts.append(pa.table({"treeID": pa.array(np.full(len(kept), t, np.int32)), "nodeData": data}))
    return pa.concat_tables(parts)
