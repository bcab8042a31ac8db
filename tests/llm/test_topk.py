"""Ball-tree search against plain numpy, whole numbers and ties included."""

import math

import numpy as np
from pyspark.sql import functions as F

from consult.llm import topk_search
from consult.llm.topk_search import Search, build_tree, top_products

SCHEMA = "vec_id long, embedding array<float>, label int, row string, shard string, score string"


def brute(rows, every, k=5):
    """Python integers over rows (id, vector): {row number of the query: [(id, score), ...]}."""
    whole = [(n, i, [math.floor(256 * float(np.float32(x))) for x in v]) for n, (i, v) in enumerate(rows)
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in whole:
        if i is not None and i % every == 0:
            hits = [(-sum(a * b for a, b in zip(q, v, strict=False)), j is None, j or 0, m, j) for m, j, v in whole if m != n]
            out += [(i, r + 1, h[4], -h[0]) for r, h in enumerate(sorted(hits)[:k])]
    return sorted(out, key=str)


def run(spark, rows, every, **kw):
    df = spark.createDataFrame([(i, v, 1, "r", "s", "x") for i, v in rows], SCHEMA)
    return sorted(map(tuple, top_products(df, F.col("vec_id") % every == 0, **kw).collect()), key=str)


def test_small_shards_and_blocks(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(0, 0.4, 9).tolist()) for i in range(600)]
    assert run(spark, rows, 20, shard_rows=70, block=8) == brute(rows, 20)


def test_pairs_do_not_go_through_the_driver(spark, monkeypatch):
    """Blocks small enough on file to be broadcast become many pairs: no plan sends them through the driver."""
    plans, stage = [], topk_search.stage
    monkeypatch.setattr(topk_search, "stage", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), stage(df, name))[1])
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 0.4, 5).tolist()) for i in range(200)]
    assert run(spark, rows, 20, shard_rows=20, block=4) == brute(rows, 20)
    assert sum("SortMergeJoin" in p for p in plans) == 3 and not any("Broadcast" in p for p in plans)


def test_ties_nulls_and_repeats(spark):
    """Half the rows are one vector; ids repeat or are null; lengths differ; some vectors take no part."""
    rng = np.random.default_rng(6)
    rows = [(i if i % 11 else None, [0.5, -0.25, 1.0]) for i in range(150)]
    rows += [(200 + i % 40, np.round(rng.normal(0, 1, 3), 1).tolist()) for i in range(120)]
    rows += [(400, None), (420, [1.0, None, 0.0]), (440, [math.nan]), (460, [math.inf, 0.0]), (480, []), (500, [1.0]), (500, [1.0]), (520, [0.1] * 5)]
    for shard_rows in (40, 8192):
        assert run(spark, rows, 20, shard_rows=shard_rows, block=4) == brute(rows, 20)


def test_fewer_than_k_and_none(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [-1.0])]
    assert run(spark, rows, 50) == [(0, 1, 1, 131072), (0, 2, 2, -65536)]
    assert run(spark, rows[:1], 50) == [] and run(spark, rows[1:], 50) == [] and run(spark, [], 50) == []


def test_scores_beyond_floats_are_exact(spark):
    """Scores over 2^53 differ in their last place; scores over a long are its end."""
    rows = [(0, [float(1 << 21), 1.0]), (1, [float(1 << 21), 0.0]), (2, [float(1 << 21), 0.00390625]), (3, [1e30, 0.0])]
    got = run(spark, rows, 50)
    assert got[0] == (0, 1, 3, 2**63 - 1) and got[1:] == [(i, r + 1, j, x) for i, r, j, x in brute(rows[:3], 50)]


def test_branches_are_cut():
    """On clustered points most leaves are never scanned, and the hits are those of all products."""
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 400, (40, 16))
    points = np.floor(centres[rng.integers(0, 40, 8000)] + rng.normal(0, 4, (8000, 16)))
    ids = np.arange(8000)
    tree = build_tree(points, ids, ids)
    assert sorted(tree["rows"]) == list(range(8000)) and (tree["hi"] - tree["lo"])[tree["child"] == 0].max() <= topk_search.LEAF
    q = np.floor(points[:50] + 1)
    shape = (50, 5)
    state = {"q": q, "row": np.full(50, -1), "score": np.full(shape, topk_search.LEAST), "id": np.full(shape, topk_search.NONE)}
    search, scanned = Search(tree, state, 5), []
    inner = search._scan
    search._scan = lambda qi, node: (scanned.append(len(qi)), inner(qi, node))
    hits = search.run()
    want = np.argsort(-(q @ points.T), axis=1, kind="stable")[:, :5]
    assert (hits["id"] == want).all() and sum(scanned) < 0.25 * 50 * (tree["child"] == 0).sum()
