r"""Conversation structure repair by a persistent audit DP (operator 13).

The rows of a conversation are to have roles ``(s?(ua)+)?`` (initials). Four
states say what was written last: nothing, system, user, assistant. For every
state the DP keeps the cheapest edits and, of equally cheap ones, the ASCII-least
audit. Audits share their prefixes: an edit is a linked node with its parent, its
binary-lifting ancestors and a rolling hash of all edits up to it. Two audits of
equal cost are compared at their first difference, found by descending the
ancestors while hashes differ; the equal part is verified node by node up to the
first shared node, so a collision changes nothing. From one start state the same
edits always lead the same way, hence of two audits of equal cost over the same
rows none is a prefix of the other, and the least prefix stays least whatever
follows.

1. Rows are numbered within their conversation by ``rank_within``, which splits a
   conversation of any size over ranges; repeats are found by one aggregate.
2. Conversations are cut into segments of ``SEGMENT`` rows. A task runs the DP
   over a segment from every state it may start in: (start, end, cost, audit).
   Only initials and faults go there, no texts.
3. Segments of one conversation are chained in order; prefixes are again linked
   nodes, one per segment. That decides each segment's edits.
4. Edits and rows are read in order and the repaired text is hashed as it streams
   by. One SHA-256 over a conversation runs in sequence by its definition, so a
   conversation's rows pass one task there, in constant memory but for its audit.

Nothing else meets in one task, and no table is broadcast but the bounded offsets
of the numbering.

Defined results: null texts and roles are one space each, in the hash of the
damage also null ids and turns; rows of a null conversation form one; rows of one
turn are ordered by role, then text; a role without characters has no initial and
cannot be kept. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from consult.functions.grouprank import rank_within
from consult.llm.common import stage

#: Rows of a segment.
SEGMENT = 2048
SPACES = " \t\n\x0b\x0c\r"
#: States, and where an inserted or reroled row leads from each of them.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")
KEEP = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 3, 2, 2, 1
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
_MOD, _MUL = (1 << 61) - 1, 0x1F3D5B79A2C4E687 % ((1 << 61) - 1)


class Trail:
    """Persistent strings: a node adds a piece of text to its parent's; node 0 is empty."""

    def __init__(self):
        self.piece, self.depth, self.size, self.hash, self.up = [""], [0], [0], [0], [[]]

    def add(self, parent: int, piece: str) -> int:
        h = self.hash[parent]
        for c in piece:
            h = (h * _MUL + ord(c)) % _MOD
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.piece.append(piece)
        self.depth.append(self.depth[parent] + 1)
        self.size.append(self.size[parent] + len(piece))
        self.hash.append(h)
        self.up.append(up)
        return len(self.piece) - 1

    def at_depth(self, v: int, depth: int) -> int:
        while (rest := self.depth[v] - depth) > 0:
            v = self.up[v][rest.bit_length() - 1]
        return v

    def pieces(self, v: int, depth: int = 0) -> list[str]:
        """The pieces after the first ``depth``, in order."""
        out = []
        while self.depth[v] > depth:
            out.append(self.piece[v])
            v = self.up[v][0]
        return out[::-1]

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` is smaller than that of ``b``."""
        if a == b:
            return False
        low = min(self.depth[a], self.depth[b])
        x, y = self.at_depth(a, low), self.at_depth(b, low)
        if (self.hash[x], self.size[x]) != (self.hash[y], self.size[y]):
            for k in range(low.bit_length() - 1, -1, -1):
                if k < len(self.up[x]) and k < len(self.up[y]):
                    p, q = self.up[x][k], self.up[y][k]
                    if (self.hash[p], self.size[p]) != (self.hash[q], self.size[q]):
                        x, y = p, q
            x, y = self.up[x][0], self.up[y][0]
        # Up to x and y the strings have equal hashes: verified back to the node that both share.
        common = self.depth[x]
        p, q = x, y
        while p != q:
            if self.piece[p] != self.piece[q]:
                common = self.depth[p] - 1
            p, q = self.up[p][0], self.up[q][0]
        return _first(self, a, b, common)


def _first(trail: Trail, a: int, b: int, depth: int) -> bool:
    """Whether ``a`` is smaller, by the pieces after the common ones; the way back is as long as the difference."""
    one, two = "".join(trail.pieces(a, depth)), "".join(trail.pieces(b, depth))
    return one < two


class Best:
    """The cheapest audit of one state: cost and node; ``offer`` takes a cheaper or, at equal cost, smaller one."""

    __slots__ = ("cost", "node")

    def __init__(self, cost: int | None = None, node: int = 0):
        self.cost, self.node = cost, node

    def offer(self, trail: Trail, cost: int, parent: int, piece: str) -> None:
        if self.cost is None or cost < self.cost:
            self.cost, self.node = cost, trail.add(parent, piece)
        elif cost == self.cost:
            new = trail.add(parent, piece)
            if trail.less(new, self.node):
                self.node = new


def insert_rows(trail: Trail, at: list[Best]) -> None:
    """Inserted rows before the next one: at most a user and an assistant help."""
    for s in (NOTHING, SYSTEM, ASSISTANT):
        if at[s].cost is not None:
            at[USER].offer(trail, at[s].cost + INSERT_COST, at[s].node, "I")
    if at[USER].cost is not None:
        at[ASSISTANT].offer(trail, at[USER].cost + INSERT_COST, at[USER].node, "I")


def segment_audits(rows: list[tuple[str, int]], start: int, last: bool) -> list[tuple[int, int, str]]:
    """(end, cost, audit) of the best edits from state ``start`` over rows (initial, fault)."""
    trail = Trail()
    at = [Best() for _ in range(4)]
    at[start] = Best(0)
    for initial, fault in rows:
        if fault in (BLANK, DUPLICATE):
            # Inserted rows wait: before or after a deletion they cost the same, and "D" sorts first.
            now = [Best() for _ in range(4)]
            for s in range(4):
                if at[s].cost is not None:
                    now[s].offer(trail, at[s].cost + DELETE_COST, at[s].node, "D")
            at = now
            continue
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        insert_rows(trail, at)
        now = [Best() for _ in range(4)]
        for s, b in enumerate(at):
            if b.cost is None:
                continue
            now[s].offer(trail, b.cost + DELETE_COST, b.node, "D")
            if (to := KEEP.get((s, initial))) is not None:
                now[to].offer(trail, b.cost + extra, b.node, "K")
            now[NEXT[s]].offer(trail, b.cost + REROLE_COST + extra, b.node, "R")
        at = now
    if last:
        insert_rows(trail, at)
    return [(s, b.cost, "".join(trail.pieces(b.node))) for s, b in enumerate(at) if b.cost is not None]


def chain(segments: Iterator[list[tuple[int, int, int, str]]]) -> tuple[int, list[tuple[int, str]]]:
    """Cost, and (start, audit) of every segment, of the best way through entries (start, end, cost, audit)."""
    trail, at, starts = Trail(), [Best(0), Best(), Best(), Best()], {}
    for entries in segments:
        now = [Best() for _ in range(4)]
        for start, end, cost, audit in entries:
            if at[start].cost is not None:
                was = now[end].node if now[end].cost is not None else None
                now[end].offer(trail, at[start].cost + cost, at[start].node, audit)
                if now[end].node != was:
                    starts[now[end].node] = start
        at = now
    done = at[ASSISTANT]
    if at[NOTHING].cost is not None and (done.cost is None or at[NOTHING].cost < done.cost or at[NOTHING].cost == done.cost and trail.less(at[NOTHING].node, done.node)):
        done = at[NOTHING]
    way, v = [], done.node
    while v:
        way.append((starts[v], trail.piece[v]))
        v = trail.up[v][0]
    return done.cost, way[::-1]


def damage(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text): rows dropped, emptied, cut, repeated or reroled by crc32(``conv_id:turn``) % 20."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text", "conv_id", "turn")]
    d = rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), said[0].alias("role"), said[1].alias("text"),
                    (F.crc32(F.concat(said[2], F.lit(":"), said[3])) % 20).alias("h"))
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    d = d.where("h <> 0").select("conv", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                                 F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return d.select("conv", "turn", "role", "text")


def faulted(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text) with position, segment, segments of the conversation, and first fault."""
    order = [F.col("turn").isNotNull(), "turn", "role", "text", "mid"]
    placed = rank_within(rows.withColumn("mid", F.monotonically_increasing_id()), ["conv"], order, out="pos", total_out="total").drop("mid")
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    placed = placed.select("*", F.sha2("text", 256).alias("sha"), trimmed.alias("trimmed"))
    again = placed.where("trimmed <> ''").groupBy("conv", "role", "sha").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = again.select(*[F.col(c).alias(f"r_{c}") for c in ("conv", "role", "sha")], "first")
    joined = placed.join(again, placed["conv"].eqNullSafe(again["r_conv"]) & (placed["role"] == again["r_role"]) & (placed["sha"] == again["r_sha"]), "left")
    fault = (F.when(F.col("trimmed") == "", BLANK).when(F.col("pos") > F.col("first"), DUPLICATE)
             .when(~F.right("trimmed", F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(FINE))
    return joined.select("conv", "turn", "role", "text", "pos", F.floor((F.col("pos") - 1) / SEGMENT).alias("seg"),
                         F.ceil(F.col("total") / SEGMENT).alias("segs"), fault.alias("fault"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            yield from b.slice(lo, 256).to_pylist()


def _grouped(rows: Iterator[dict], *keys: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    return itertools.groupby(rows, lambda r: tuple(r[k] for k in keys))


def audits(rows: DataFrame) -> DataFrame:
    """(conv, seg, start, cost, audit): the edits of every segment of ``faulted`` rows; ``cost`` is the conversation's."""
    conv, kind = rows.schema["conv"].dataType.simpleString(), to_arrow_type(rows.schema["conv"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv", kind), ("seg", pa.int64()),
                            ("ways", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))])
        out = []
        for (c, seg, segs), own in _grouped(_rows(batches), "conv", "seg", "segs"):
            kinds = [(r["initial"], r["fault"]) for r in own]
            ways = [{"start": s, "end": e, "cost": cost, "audit": a} for s in (range(4) if seg else (NOTHING,)) for e, cost, a in segment_audits(kinds, s, seg == segs - 1)]
            out.append({"conv": c, "seg": seg, "ways": ways})
            if len(out) >= 256:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv", kind), ("seg", pa.int64()), ("start", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
        for (c,), own in _grouped(_rows(batches), "conv"):
            cost, way = chain([(w["start"], w["end"], w["cost"], w["audit"]) for w in r["ways"]] for r in own)
            for lo in range(0, len(way), 256):
                part = way[lo:lo + 256]
                yield pa.RecordBatch.from_pylist([{"conv": c, "seg": lo + i, "start": s, "cost": cost, "audit": a} for i, (s, a) in enumerate(part)], schema)

    small = rows.select("conv", "seg", "segs", "pos", F.left("role", F.lit(1)).alias("initial"), "fault")
    ways = small.repartition("conv", "seg").sortWithinPartitions("conv", "seg", "pos").mapInArrow(
        run, f"conv {conv}, seg long, ways array<struct<start:int,end:int,cost:bigint,audit:string>>")
    return ways.repartition("conv").sortWithinPartitions("conv", "seg").mapInArrow(decide, f"conv {conv}, seg long, start int, cost long, audit string")


class Repair:
    """The repaired text of one conversation, hashed as its rows come, and the counts of its report."""

    def __init__(self):
        self.count, self.illegal, self.cost, self.audit = [0] * 4, 0, 0, []
        self.turns, self.least, self.most, self.turn = 0, None, None, None
        self.before, self.slice, self.at, self.state = None, "", 0, NOTHING
        self.sha, self.first = hashlib.sha256(), True

    def write(self, role: str, text: str) -> None:
        self.sha.update(("" if self.first else "\n").encode() + role.encode() + b":" + text.encode())
        self.first = False

    def inserted(self) -> None:
        while self.at < len(self.slice) and self.slice[self.at] == "I":
            self.write(ROLE[self.state], "")
            self.state, self.at = NEXT[self.state], self.at + 1

    def decided(self, r: dict) -> None:
        self.inserted()
        self.cost, self.slice, self.at, self.state = r["cost"], r["audit"], 0, r["start"]
        self.audit.append(r["audit"])

    def row(self, r: dict) -> None:
        self.count[r["fault"]] += 1
        initial = r["role"][:1]
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.before = initial
        if (t := r["turn"]) is not None:
            self.turns += t != self.turn
            self.least, self.most, self.turn = t if self.least is None else self.least, t, t
        self.inserted()
        edit, self.at = self.slice[self.at], self.at + 1
        if edit == "K":
            self.write(r["role"], r["text"])
            self.state = KEEP[self.state, initial]
        elif edit == "R":
            self.write(ROLE[self.state], r["text"])
            self.state = NEXT[self.state]

    def report(self) -> dict:
        self.inserted()
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return {"gaps": gaps, "blank": self.count[BLANK], "duplicate": self.count[DUPLICATE], "truncated": self.count[TRUNCATED], "illegal": self.illegal,
                "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.sha.hexdigest()}


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def repair(rows: DataFrame, everyone: DataFrame) -> DataFrame:
    """One report per ``conv`` of ``everyone`` over ``rows`` (conv, turn, role, text)."""
    rows = stage(faulted(rows), "faulted")
    edits = stage(audits(rows), "audits")
    conv, kind = rows.schema["conv"].dataType.simpleString(), to_arrow_type(rows.schema["conv"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv", kind), *[(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in (f.split()[0] for f in REPORT.split(", "))]])
        out = []
        for (c,), own in _grouped(_rows(batches), "conv"):
            now = Repair()
            for r in own:
                if r["pos"] == 0:
                    now.decided(r)
                elif r["pos"] is not None:
                    now.row(r)
            out.append({"conv": c, **now.report()})
            if len(out) >= 256:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    names = {"conv": conv, "seg": "long", "pos": "long", "turn": "long", "role": "string", "text": "string", "fault": "int", "start": "int", "cost": "long", "audit": "string"}

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in names.items()])
    marks = everyone.select("conv").distinct().withColumn("seg", F.lit(-1))
    both = shaped(rows).unionByName(shaped(edits.withColumn("pos", F.lit(0)))).unionByName(shaped(marks))
    return both.repartition("conv").sortWithinPartitions("conv", "seg", "pos").mapInArrow(run, f"conv {conv}, {REPORT}")


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by the rule of its rows' hashes and repaired at least cost: counts, cost, audit, digest."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    out = repair(damage(rows), rows.select(F.col("conv_id").alias("conv")))
    return out.select(F.col("conv").alias("conv_id"), *[f.split()[0] for f in REPORT.split(", ")])
