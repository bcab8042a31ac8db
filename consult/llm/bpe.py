"""Byte-level BPE encoding and decoding (operator 3).

Spark deals out the documents; each task splits its texts into the matches of
the tokenizer's pattern and folds the ranked merges over the bytes of every
distinct match once (the lowest rank of all neighbouring pairs first, the
leftmost of equals), against the rank table that the driver broadcast. Ids are
kept per distinct match as packed little-endian unsigned 32-bit integers, so a
document is a concatenation. Decoding concatenates the pieces of the ids.

The broadcast holds the rank file, whose size does not depend on the data. The
memo of distinct matches is emptied when it reaches ``MEMO`` entries.

Defined results: a null text counts as empty and has no tokens; repeated rows
are encoded each; an empty table gives no rows; further columns are not read;
bytes that are not UTF-8 are encoded as U+FFFD, as Python decodes them.
Higher-order functions over the JVM's maps were not taken for the hot path
(see README).
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from consult.llm.words import chunks

#: Distinct matches that a task remembers, and the longest (characters) that it does.
MEMO, MEMO_CHARS = 400_000, 64
DEFAULT_RANKS = "byte_bpe_multi_50k.tiktoken"
#: White space as Unicode defines it, spelled out so that all regex engines agree.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

_STATE: dict = {}


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: the best-ranked neighbours are merged until no pair has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > 256:
        return _merge_long(piece, ranks)
    parts = [piece[i:i + 1] for i in range(len(piece))]
    none = 1 << 60
    pair = [ranks.get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
    while pair:
        best = min(pair)
        if best == none:
            break
        i = pair.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i < len(pair):
            pair[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pair[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As ``merge``, with a heap over a linked list: near-linear in the length of the match."""
    import heapq
    n = len(piece)
    end, nxt, prev = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    alive = bytearray(b"\x01") * n
    heap = []

    def offer(i: int) -> None:
        j = nxt[i]
        if j < n and (r := ranks.get(piece[i:end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        r, i, stop = heapq.heappop(heap)
        if not alive[i] or nxt[i] >= n or end[nxt[i]] != stop:
            continue
        j = nxt[i]
        alive[j] = 0
        end[i], nxt[i] = end[j], nxt[j]
        if nxt[j] < n:
            prev[nxt[j]] = i
        offer(i)
        if prev[i] >= 0:
            offer(prev[i])
    return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]


def _portable(pattern: str) -> str:
    r"""The pattern with \s spelled out (inside and outside of classes)."""
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


class Codec:
    """The rank table of one worker, with its memo."""

    def __init__(self, raw: bytes, pattern: str):
        import regex
        self.ranks = parse_ranks(raw)
        self.pieces = {v: k for k, v in self.ranks.items()}
        self.split = regex.compile(_portable(pattern)).findall
        self.memo: dict[str, bytes] = {}

    def pack(self, match: str) -> bytes:
        ids = merge(match.encode(), self.ranks)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(match) <= MEMO_CHARS:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[match] = packed
        return packed

    def encode(self, text: str) -> bytes:
        get, pack = self.memo.get, self.pack
        return b"".join([get(m) or pack(m) for m in self.split(text)])

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(id, n_tokens, ids, decoded): ids as little-endian unsigned 32-bit integers, decoded as bytes."""
    with open(path or public_tokenizers.path(DEFAULT_RANKS), "rb") as f:
        table = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (table.value, pattern)
        if _STATE.get("key") != key:
            _STATE.update(key=key, codec=Codec(table.value, pattern))
        codec = _STATE["codec"]
        for b, texts in chunks(batches, "t"):
            ids = [codec.encode(t.decode(errors="replace")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array([codec.decode(x) for x in ids], pa.binary())],
                ["id", "n_tokens", "ids", "decoded"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids binary, decoded binary")


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded by byte-level BPE; digests of ids and of the decoded bytes."""
    out = encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
