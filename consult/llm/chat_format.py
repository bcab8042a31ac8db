"""Conversations from reply trees (operator 4, DataFrame functions only).

Nodes (tree, node, parent, role, text, score) form reply trees. Iterated
self-joins double the reach of every node's pointer towards its root, adding
up scores; nodes that reach it leave the joins, and after about log2(depth)
of them each leaf knows the score of its root-to-leaf path. Branches are ranked within their tree by that score and the
best ``branches`` are chosen; the same pointers, from the longest to the
shortest, list the nodes of each chosen path. One path becomes one text:

    ### role\\ntext</turn>\\n

Inside roles and texts ``\\``, ``#`` and ``<`` are written ``\\b``, ``\\h`` and
``\\l`` (and a line feed of a role ``\\e``), so no marker can occur there and
the escape can be undone. ``loss_spans`` holds the code-point ranges of the
texts of the learning role.

Defined results: a null role or text counts as empty; null trees form one
tree; a node whose parent is null or missing is a root; rows that repeat
(tree, node) count once; nodes on or below a parent cycle have no root and are
on no path; ties in score go to the smaller leaf. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from consult.llm.common import stage, text_or_empty

HEAD, TAIL = "### ", "</turn>\n"


def escape(c: Column, role: bool = False) -> Column:
    for raw, code in (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"), *([("\n", "\\e")] if role else [])):
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for code, raw in (("\\e", "\n"), ("\\l", "<"), ("\\h", "#"), ("\\b", "\\")):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def _on(a: DataFrame, left: str, b: DataFrame, right: str) -> Column:
    return a["tree"].eqNullSafe(b["tree"]) & (a[left] == b[right])


def root_to_leaf_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, node, back, path_score) of the chosen paths; ``back`` counts from the leaf (0).

    ``nodes`` has distinct (tree, node) rows with parent and score.
    """
    ids = nodes.select(F.col("tree"), F.col("node"))
    known = ids.select(F.col("tree").alias("tree"), F.col("node").alias("parent_node"))
    links = nodes.join(known, nodes["tree"].eqNullSafe(known["tree"]) & (nodes["parent"] == known["parent_node"]), "left")
    reach = stage(links.select(nodes["tree"], nodes["node"], F.col("parent_node").alias("up"), nodes["score"].cast("double").alias("gain")), "reach")
    opens, done, n, span = [reach.where("up IS NOT NULL")], reach.where("up IS NULL"), reach.count(), 1
    while span <= n and not opens[-1].isEmpty():
        a = opens[-1]
        b = a.unionByName(done).select(F.col("tree").alias("b_tree"), F.col("node").alias("b_node"), F.col("up").alias("b_up"), F.col("gain").alias("b_gain"))
        far = a.join(b, a["tree"].eqNullSafe(F.col("b_tree")) & (a["up"] == F.col("b_node")))
        far = stage(far.select("tree", "node", F.col("b_up").alias("up"), (F.col("gain") + F.col("b_gain")).alias("gain")), "reach")
        opens.append(far.where("up IS NOT NULL"))
        done = done.unionByName(far.where("up IS NULL"))
        span *= 2
    rooted, parents = done, reach.where("up IS NOT NULL").select("tree", F.col("up").alias("node")).distinct()
    leaves = rooted.join(parents, rooted["tree"].eqNullSafe(parents["tree"]) & (rooted["node"] == parents["node"]), "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("gain"), "node"))
    chosen = leaves.withColumn("rank", rank).where(F.col("rank") <= branches)
    path = chosen.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back"), F.col("gain").alias("path_score"))
    for r in range(len(opens) - 2, -1, -1):
        s = opens[r].select(F.col("tree").alias("s_tree"), F.col("node").alias("s_node"), "up")
        path = stage(path, "path")
        more = path.join(s, path["tree"].eqNullSafe(F.col("s_tree")) & (path["node"] == F.col("s_node")))
        path = path.unionByName(more.select("tree", "leaf", F.col("up").alias("node"), (F.col("back") + F.lit(1 << r)).alias("back"), "path_score"))
    return path


def format_chats(nodes: DataFrame, branches: int = 1, learn: str = "assistant") -> DataFrame:
    """One row per chosen path: tree, leaf, path_score, formatted, loss_spans array<struct<start,end>>."""
    rows = nodes.select("tree", "node", "parent", "score", text_or_empty("role").alias("role"), text_or_empty("text").alias("text"))
    rows = stage(rows.dropDuplicates(["tree", "node"]), "nodes")
    path = root_to_leaf_paths(rows, branches)
    said = rows.select(F.col("tree").alias("r_tree"), F.col("node").alias("r_node"), "role", "text")
    turns = path.join(said, path["tree"].eqNullSafe(F.col("r_tree")) & (path["node"] == F.col("r_node")))
    head = F.concat(F.lit(HEAD), escape(F.col("role"), True), F.lit("\n"))
    turns = turns.select("tree", "leaf", "path_score", "back", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    turn = F.concat("head", "body", F.lit(TAIL))
    before = Window.partitionBy("tree", "leaf").orderBy(F.desc("back"))
    placed = turns.withColumn("end", F.sum(F.char_length(turn)).over(before))
    stop = F.col("end") - F.lit(len(TAIL))
    span = F.when(F.col("role") == learn, F.struct((stop - F.char_length("body")).alias("start"), stop.alias("end")))
    placed = placed.select("tree", "leaf", "path_score", F.struct((-F.col("back")).alias("nth"), turn.alias("turn"), span.alias("span")).alias("t"))
    chats = placed.groupBy("tree", "leaf").agg(F.max("path_score").alias("path_score"), F.array_sort(F.collect_list("t")).alias("ts"))
    return chats.select(
        "tree", "leaf", "path_score", F.array_join(F.transform("ts", lambda t: t["turn"]), "").alias("formatted"),
        F.filter(F.transform("ts", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role,text>> read back from a formatted conversation."""
    parts = F.filter(F.split(formatted, TAIL, -1), lambda p: p != "")

    def turn(p: Column) -> Column:
        head = F.substring_index(p, "\n", 1)
        role = F.substring(head, F.lit(len(HEAD) + 1), F.char_length(head))
        text = F.substring(p, F.char_length(head) + 2, F.char_length(p))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))
    return F.transform(parts, turn)


def read_learned(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def chains(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as reply trees: each turn answers the one before; a node scores its length."""
    nth = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return rows.select(
        F.col("conv_id").alias("tree"), nth.alias("node"), F.when(nth > 1, nth - 1).alias("parent"),
        F.char_length(text_or_empty("text")).alias("score"), "role", "text")


def op4_chat_format(spark, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7 formatted as chats; digests are read back from the formatted text."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = F.lit("\\### Assistant: </turn> ok")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    chats = format_chats(chains(rows.unionByName(own)))
    back = chats.select("tree", "formatted", read_turns(F.col("formatted")).alias("turns"), read_learned(F.col("formatted"), F.col("loss_spans")).alias("learned"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(13 + length(role) + length(regexp_replace(role, '[^\\#<\n]', '', 'g'))
                + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
