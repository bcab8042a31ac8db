"""Passages that documents share, by compact windows (operator 1).

A text is its sequence of five-word shingles; a passage is at least
``PASSAGE`` words. For each of ``HASHES`` hash functions all passages of a text
whose smallest hash stands at one place p form a compact window (l, p, r): they
contain p and lie within l..r. These are the nodes of the Cartesian tree over
the hashes that span a passage or more. Their places are found as the minima of
all passages of the least length; a node's nearest smaller neighbours are its
ancestors, so the tree (l and r) is built over those places alone.

The signature of a window is its smallest shingle with the 15 words that begin
or end with it. Windows of a signature are linked to one window of it, the hub
(smallest id), not to each other, so copies cost a row each. A hub may share less
than a passage with two windows that share one: where a signature has three
windows or more, they are compared with the hub shingle by shingle, as far as a
passage reaches from p, and those that leave it at the same shingle, on the left or
the right, with the same next one form a group with a hub of its own, as long as one of
them shares less than a passage with the hub before (``_finer``). So two texts
with a verbatim passage are linked to each other or each to a hub that has a
passage there. The interval join
keeps links whose windows, laid over each other at p, share a passage or more;
links of one (document, hub document, offset) whose intervals overlap form a
place if at least ``ENOUGH`` hash functions agree or one of them is verbatim over a
passage; overlapping places whose
offsets are at most ``DRIFT`` apart form a candidate. A candidate is verified:
the longest stretches of the two texts at one offset with a shingle similarity
of ``SIMILARITY`` or more and of a passage's length or more are returned. Where
they leave out common shingles, words were put in or left out: the longest
common subsequence of the two spans' shingles, offsets up to ``DRIFT`` beyond
the places', is cut into stretches in the same way, and those that hold such
shingles are returned if the Jaccard of the shingle sets of both spans is
``SIMILARITY`` or more and each span is a passage.

Of equal texts only the one of smallest number is compared with others; the rest
are linked to it as a whole and share the passages found for it.

A document is an id with its text. Where every id is there once it is its own
number; else documents are numbered by (id, text), null ids last, and results
carry the ids.

Defined results: null, empty and short texts have no passage; repeats within a
document do not count; rows equal in id and text count as one; documents that
share an id, or have none, are each compared, also with each other, and of two
the one whose text has the smaller digest is the source. An empty table gives no
rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from consult.functions.prefix import dense_index
from consult.llm.common import stage, text_or_empty
from consult.llm.words import SHINGLE, Words, chunks, mix, seeds

PASSAGE, SIMILARITY, HASHES, ENOUGH = 50, 0.8, 3, 2
#: Words between offsets that one passage may have.
DRIFT = 16
#: Shingles of the least passage.
WIDTH = PASSAGE - SHINGLE + 1
#: Shingles left or right of a place that a least passage around it may hold.
SIDE = WIDTH - 1


def compact_windows(v: np.ndarray, first: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, left and right ends (shingle numbers) of the windows of hashes ``v`` at least ``width`` wide."""
    n = len(v)
    none = np.zeros(0, np.int64)
    if n < width:
        return none, none, none
    low, span = v, 1
    while span * 2 <= width:
        low, span = np.minimum(low[:-span], low[span:]), span * 2
    low = np.minimum(low[:n - width + 1], low[width - span:width - span + n - width + 1])
    length = np.diff(first)
    text = np.repeat(np.arange(len(length)), np.maximum(length - width + 1, 0))
    if not len(text):
        return none, none, none
    many = np.maximum(length - width + 1, 0)
    start = np.arange(len(text)) - np.repeat(np.cumsum(many) - many - first[:-1], many)
    low = low[start]
    new = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (text[1:] != text[:-1])]))
    begin = start[new]
    place = begin + v[begin[:, None] + np.arange(width)].argmin(1)
    own = text[new]
    fresh_ = np.concatenate([[True], place[1:] != place[:-1]])
    place, own = place[fresh_], own[fresh_]
    left, right = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
    stack: list[int] = []
    values, places, owners = v[place].tolist(), place.tolist(), own.tolist()
    now = -1
    for i, (x, p, o) in enumerate(zip(values, places, owners, strict=True)):
        if o != now:
            for j in stack:
                right[j] = first[now + 1] - 1
            stack, now = [], o
        while stack and values[stack[-1]] > x:
            right[stack.pop()] = p - 1
        left[i] = places[stack[-1]] + 1 if stack else first[o]
        stack.append(i)
    for j in stack:
        right[j] = first[now + 1] - 1
    return place, left, right


WINDOW = "key long, id long, f byte, p int, l int, r int"


def _windows(rows: DataFrame, hashes: int) -> DataFrame:
    """Signatures of all compact windows of ``rows`` (id long, t)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add = seeds(hashes, 1)
        for b, texts in chunks(batches, "t"):
            ids = b.column("id").to_numpy()
            sh, _, first = Words(texts).shingles(short=False)
            for f in range(hashes):
                p, l, r = compact_windows(mix(sh ^ add[f]), first)
                text = np.searchsorted(first, p, "right") - 1
                for side in (1, -1):
                    far = p + side * 10
                    ok = (far >= first[text]) & (far < first[text + 1])
                    q, t = p[ok], text[ok]
                    key = mix(sh[q] * np.uint64(3) + sh[q + side * 5] * np.uint64(0xC2B2AE3D27D4EB4F) + sh[q + side * 10] * np.uint64(0x165667B19E3779F9) + np.uint64(2 * f + (side > 0)))
                    at = first[t]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(ids[t]), pa.array(np.full(len(q), f, np.int8)), pa.array((q - at).astype(np.int32)),
                         pa.array((l[ok] - at).astype(np.int32)), pa.array((r[ok] - at).astype(np.int32))],
                        ["key", "id", "f", "p", "l", "r"])
    return rows.mapInArrow(run, WINDOW)


def _copies(rows: DataFrame) -> DataFrame:
    """(id, same): documents whose text one of smaller id, the smallest being ``same``, has too; texts too short for a passage are left out."""
    texts = rows.where(F.length("t") >= 2 * PASSAGE - 1).select("id", F.sha2("t", 256).alias("digest"))
    least = texts.groupBy("digest").agg(F.min("id").alias("same"), F.max("id").alias("last")).where("same < last")
    return texts.join(least, "digest").where("id <> same").select("id", "same")


def _around(windows: DataFrame, rows: DataFrame) -> DataFrame:
    """``windows`` with ``around``: a byte for each shingle up to ``SIDE`` left and right of p, 0 outside l..r."""
    held = windows.groupBy("id").agg(F.collect_list(F.struct("key", "f", "p", "l", "r")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in chunks(batches, "t"):
            sh, _, first = Words(texts).shingles(short=False)
            code = (mix(sh) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
            many = b.column("at").value_lengths().to_numpy()
            at, ids = b.column("at").flatten(), np.repeat(b.column("id").to_numpy(), many)
            start = np.repeat(first[:-1], many)
            p, l, r = (start + at.field(c).to_numpy() for c in "plr")
            for lo in range(0, len(p), 1 << 14):
                cut = slice(lo, lo + (1 << 14))
                spot = p[cut, None] + np.arange(-SIDE, SIDE + 1)
                inside = (spot >= l[cut, None]) & (spot <= r[cut, None])
                bytes_ = np.where(inside, code[np.clip(spot, 0, len(code) - 1)], 0).astype(np.uint8)
                ends = np.arange(0, bytes_.size + 1, 2 * SIDE + 1, dtype=np.int32)
                around = pa.Array.from_buffers(pa.binary(), len(bytes_), [None, pa.py_buffer(ends), pa.py_buffer(bytes_.tobytes())])
                part = at.slice(lo, len(bytes_))
                yield pa.RecordBatch.from_arrays([part.field("key"), pa.array(ids[cut]), *[part.field(c) for c in "fplr"], around], ["key", "id", *"fplr", "around"])
    return held.join(rows, "id").select("id", "at", "t").mapInArrow(run, f"{WINDOW}, around binary")


def _parting(pairs: DataFrame) -> DataFrame:
    """``pairs`` with the distances from p, left (dl) and right (dr), of the first shingle that ``around`` does not share with ``other``; ``SIDE`` + 1: none.

    Of ``around`` only the shingles less than ``clip`` left of p count."""
    columns = [c for c in pairs.columns if c != "other"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            one, two = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, 2 * SIDE + 1) for c in ("around", "other"))
            unlike = (one != two) | (one == 0)
            left, right = unlike[:, :SIDE][:, ::-1] | (np.arange(1, SIDE + 1) >= b.column("clip").to_numpy()[:, None]), unlike[:, SIDE + 1:]
            far = [np.where(side.any(1), side.argmax(1) + 1, SIDE + 1).astype(np.int32) for side in (left, right)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in columns], *map(pa.array, far)], [*columns, "dl", "dr"])
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema.fields if f.name != "other")
    return pairs.mapInArrow(run, f"{fields}, dl int, dr int")


def _laid(links: DataFrame, by: Column) -> DataFrame:
    """Links (id, p, l, r; hub, h) as (a, b, bits of the hash functions, shift, lo, hi), if they share a passage or more."""
    move = F.col("p") - F.col("h.p")
    out = links.select(F.col("id").alias("a"), F.col("hub").alias("b"), by.cast("int").alias("by"), move.alias("shift"), F.greatest(F.col("l"), F.col("h.l") + move).alias("lo"), F.least(F.col("r"), F.col("h.r") + move).alias("hi"))
    return out.where(F.col("hi") - F.col("lo") + 1 >= WIDTH)


def _finer(shared: DataFrame, rows: DataFrame, hashes: int) -> list[DataFrame]:
    """Links of windows whose signature three or more have, to hubs of finer groups; those verbatim over a passage count for all hash functions.

    Two windows that share more than both share with the hub leave it at the same
    shingle with the same next one, so they meet again in the group of it; in the group of
    the right side only what the left one does not cover (``clip``) counts. A group whose
    windows all share a passage with the hub before is done. Each
    round the windows of a group agree on one shingle more, and most are alone in the next."""
    crowded = shared.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 2").select("key")
    now = _around(shared.join(crowded, "key").select("key", "id", *"fplr"), rows).withColumn("clip", F.lit(SIDE + 1))
    out: list[DataFrame] = []
    while True:
        now = stage(now, "finer")
        hubs = now.groupBy("key").agg(F.min(F.struct("id", *"plr", "around")).alias("h"))
        pairs = now.join(hubs, "key").where("id <> h.id")
        pairs = pairs.select("key", "id", *"fplr", "clip", "around", F.col("h.id").alias("hub"), F.struct(*[F.col(f"h.{c}").alias(c) for c in "plr"]).alias("h"), F.col("h.around").alias("other"))
        parted = stage(_parting(pairs).withColumn("sure", F.expr(f"dl + dr > {WIDTH}")), "parted")
        # The signature's group is linked to its hub already, so of the first round only the verbatim links are new.
        links = parted if out else parted.where("sure")
        out.append(_laid(links, F.when(F.col("sure"), F.lit((1 << hashes) - 1)).otherwise(F.expr("shiftleft(1, CAST(f AS int))"))))
        right = f"least({SIDE}, r - p)"
        ways = parted.select("id", *"fplr", "around", "sure", F.explode(F.expr(f"""filter(array(
            struct(xxhash64(key, 0, dl, substring(around, {SIDE + 1} - dl, 1)) AS key, clip AS clip, dl < clip AND dl <= least({SIDE}, p - l) AS ok),
            struct(xxhash64(key, 1, dr, substring(around, {SIDE + 1} + dr, 1)) AS key, dl AS clip, dr <= {right} AND dl - 1 + {right} >= {SIDE} AS ok)), w -> w.ok)""")).alias("w"))
        ways = ways.select("w.key", "id", *"fplr", "around", "w.clip", "sure")
        groups = ways.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("last"), F.bool_and("sure").alias("done")).where("least < last AND NOT done").select("key")
        groups = stage(groups, "finer_groups")
        if groups.isEmpty():
            return out
        now = ways.drop("sure").join(groups, "key")


def candidates(rows: DataFrame, hashes: int = HASHES, enough: int = ENOUGH, copies: DataFrame | None = None) -> DataFrame:
    """(a, b, at): at each (shift, lo, hi), shingles lo..hi of a may stand in b, ``shift`` shingles earlier; of ``copies`` (id, same) only with the document they copy."""
    copies = stage(_copies(rows), "copies") if copies is None else copies
    windows = stage(_windows(rows, hashes), "windows")
    hubs = stage(windows.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last").select("key", "hub"), "hubs")
    # The hub has the smallest id, so it is no copy.
    shared = stage(windows.join(hubs, "key").join(copies.select("id"), "id", "left_anti"), "shared")
    one = shared.where("id = hub").groupBy("key").agg(F.min(F.struct("p", "l", "r")).alias("h"))
    links = shared.where("id <> hub").join(stage(one, "hub_windows"), "key")
    laid = _laid(links, F.expr("shiftleft(1, CAST(f AS int))"))
    for more in _finer(shared, rows, hashes):
        laid = laid.unionByName(more)
    whole = copies.select(F.col("id").alias("a"), F.col("same").alias("b"), F.lit((1 << hashes) - 1).alias("by"), F.lit(0).alias("shift"), F.lit(0).alias("lo"), F.lit((1 << 31) - 2).alias("hi"))
    laid = laid.distinct().unionByName(whole)
    cut = _islands(laid, "a", "b", "shift")
    grouped = cut.groupBy("a", "b", "shift", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.expr("bit_count(bit_or(by))").alias("agree"))
    w = Window.partitionBy("a", "b").orderBy("shift")
    placed = grouped.where(F.col("agree") >= enough).select("a", "b", "shift", "lo", "hi").withColumn("far", F.coalesce((F.col("shift") - F.lag("shift").over(w) > DRIFT).cast("int"), F.lit(0)))
    near = placed.withColumn("course", F.sum("far").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    return _islands(near, "a", "b", "course").groupBy("a", "b", "course", "island").agg(F.collect_list(F.struct("shift", "lo", "hi")).alias("at")).select("a", "b", "at")


def _islands(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with the number (island) of the run of overlapping intervals lo..hi that each is in."""
    w = Window.partitionBy(*keys).orderBy("lo", "hi")
    reach = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return rows.withColumn("new", F.when(F.col("lo") <= reach, 0).otherwise(1)).withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def stretches(same: np.ndarray, need: float = 2 * SIMILARITY / (1 + SIMILARITY), width: int = WIDTH) -> list[tuple[int, int]]:
    """The longest stretch of ``same`` (begin, end) with that share, then those left and right of it."""
    out, todo = [], [(0, len(same))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo < width:
            continue
        total = np.concatenate([[0.0], np.cumsum(same[lo:hi] - need)])
        least = np.minimum.accumulate(total)
        begin = len(least) - np.searchsorted(least[::-1], total + 1e-9, "right")
        size = np.arange(len(total)) - begin
        j = int(size.argmax())
        i = int(begin[j])
        own = np.flatnonzero(same[lo + i:lo + j])
        if j - i < width or not len(own):
            continue
        a, b = lo + i + int(own[0]), lo + i + int(own[-1]) + 1
        if b - a >= width:
            out.append((a, b))
        todo += [(lo, lo + i), (lo + j, hi)]
    return sorted(out)


def common_subsequence(x: np.ndarray, y: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the longest common subsequence of ``x`` and ``y`` with low <= i - j <= high."""
    order = np.argsort(y, kind="stable")
    held = y[order]
    left, right = [], []
    for lo in range(0, len(x), 128):
        part = x[lo:lo + 128]
        begin, end = np.searchsorted(held, part, "left"), np.searchsorted(held, part, "right")
        many = end - begin
        i = lo + np.repeat(np.arange(len(part)), many)
        j = order[np.repeat(begin - np.cumsum(many) + many, many) + np.arange(many.sum())]
        ok = (i - j >= low) & (i - j <= high)
        left.append(i[ok])
        right.append(j[ok])
    i, j = np.concatenate(left), np.concatenate(right)
    down = np.lexsort((-j, i))
    i, j = i[down], j[down]
    least: list[int] = []
    last: list[int] = []
    before = np.full(len(j), -1)
    for k, q in enumerate(j.tolist()):
        n = bisect_left(least, q)
        if n:
            before[k] = last[n - 1]
        least[n:n + 1], last[n:n + 1] = [q], [k]
    path, k = [], last[-1] if last else -1
    while k >= 0:
        path.append(k)
        k = before[k]
    return i[path[::-1]], j[path[::-1]]


def passages(one: np.ndarray, two: np.ndarray, at: list[dict]) -> list[tuple[int, int, int, int, float]]:
    """(begin, end) in ``one``, (begin, end) in ``two`` and similarity of a candidate's verified stretches."""
    out = []
    covered = np.zeros(len(one), bool)
    for r in at:
        lo, hi = max(r["lo"], r["shift"], 0), min(r["hi"] + 1, len(one), len(two) + r["shift"])
        if hi - lo < WIDTH:
            continue
        same = (one[lo:hi] == two[lo - r["shift"]:hi - r["shift"]]).astype(float)
        for s, e in stretches(same):
            m = float(same[s:e].sum())
            out.append((lo + s, lo + e, lo + s - r["shift"], lo + e - r["shift"], m / (2 * (e - s) - m)))
            covered[lo + s:lo + e] = True
    low, high = min(r["shift"] for r in at) - DRIFT, max(r["shift"] for r in at) + DRIFT
    lo, hi = max(min(r["lo"] for r in at), 0), min(max(r["hi"] for r in at) + 1, len(one))
    start, stop = max(lo - high, 0), min(hi - low, len(two))
    if min(hi - lo, stop - start) < WIDTH or not (np.isin(one[lo:hi], two[start:stop]) & ~covered[lo:hi]).any():
        return out
    i, j = common_subsequence(one[lo:hi], two[start:stop], low - lo + start, high - lo + start)
    if not len(i):
        return out
    i, j = i + lo, j + start
    # A column of the alignment is a common shingle or one that only one text has.
    column = i - i[0] + j - j[0] - np.arange(len(i))
    same = np.zeros(column[-1] + 1)
    same[column] = 1
    for s, e in stretches(same, SIMILARITY):
        s, e = np.searchsorted(column, s), np.searchsorted(column, e - 1)
        a, b = one[i[s]:i[e] + 1], two[j[s]:j[e] + 1]
        if min(len(a), len(b)) < WIDTH or covered[i[s:e + 1]].all():
            continue
        a, b = np.unique(a), np.unique(b)
        m = len(np.intersect1d(a, b, assume_unique=True))
        if m >= SIMILARITY * (len(a) + len(b) - m):
            out.append((int(i[s]), int(i[e]) + 1, int(j[s]), int(j[e]) + 1, m / (len(a) + len(b) - m)))
    return out


def _verify(found: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, left in chunks(batches, "ta", 1 << 19):
            (p, _, fp), (q, _, fq) = Words(left).shingles(short=False), Words([t or b"" for t in x.column("tb").cast(pa.binary()).to_pylist()]).shingles(short=False)
            out = []
            for i, r in enumerate(x.select(["a", "b", "at"]).to_pylist()):
                for s, e, t, u, similarity in passages(p[fp[i]:fp[i + 1]], q[fq[i]:fq[i + 1]], r["at"]):
                    out.append({"id": r["a"], "start_word": s, "n_words": e - s + SHINGLE - 1, "source_id": r["b"], "source_start": t, "source_n_words": u - t + SHINGLE - 1, "similarity": similarity})
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([("id", pa.int64()), ("start_word", pa.int64()), ("n_words", pa.int64()), ("source_id", pa.int64()), ("source_start", pa.int64()), ("source_n_words", pa.int64()), ("similarity", pa.float64())]))
    return found.mapInArrow(run, "id long, start_word long, n_words long, source_id long, source_start long, source_n_words long, similarity double")


def numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame | None]:
    """Documents (id long, t) under numbers that order them by id, and the names (n, name) of the numbers.

    Ids that are there once each are such numbers themselves; then there are no names.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("name"), text_or_empty(text_col).alias("t"))
    if docs.select(F.col(id_col).cast("long").alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR name IS NULL").isEmpty():
        return rows.select(F.col("name").alias("id"), "t"), None
    rows = rows.withColumn("digest", F.sha2("t", 256))
    names = stage(dense_index(rows.select("name", "digest").distinct(), [F.col("name").asc_nulls_last(), "digest"], out="n", start=0), "numbers")
    named = names.select(F.col("name").alias("own"), F.col("digest").alias("d"), "n")
    # Rows equal in id and text collapse before the shuffle, so that neither a popular id nor a popular text is a hot key.
    once = rows.groupBy("name", "digest").agg(F.min("t").alias("t"))
    texts = once.join(named, once["name"].eqNullSafe(named["own"]) & (once["digest"] == named["d"]))
    return stage(texts.select(F.col("n").alias("id"), "t"), "documents"), names.select("n", "name")


def shared_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hashes: int = HASHES, enough: int = ENOUGH) -> DataFrame:
    """(id, start_word, n_words, source_id, source_start, source_n_words, similarity): passages that the source, of smaller id, has too."""
    rows, names = numbered(docs, id_col, text_col)
    copies = stage(_copies(rows), "copies")
    found = stage(candidates(rows, hashes, enough, copies), "candidates")
    a, b = rows.select(F.col("id").alias("a"), F.col("t").alias("ta")), rows.select(F.col("id").alias("b"), F.col("t").alias("tb"))
    out = stage(_verify(found.join(a, "a").join(b, "b").select("a", "b", "at", "ta", "tb")).distinct(), "passages")
    own = copies.select(F.col("id").alias("copy"), F.col("same").alias("id")).join(out, "id").select(F.col("copy").alias("id"), *out.columns[1:])
    # Of a copy's rows those with its original are its own; the original's rows never have it as a source.
    out = out.unionByName(own)
    if names is None:
        return out
    out = out.join(names.select(F.col("n").alias("id"), F.col("name").alias("own")), "id").join(names.select(F.col("n").alias("source_id"), F.col("name").alias("source")), "source_id")
    return out.select(F.col("own").alias("id"), "start_word", "n_words", F.col("source").alias("source_id"), "source_start", "source_n_words", "similarity")


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents share with another, by compact windows, verified."""
    out = shared_passages(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), F.col("source_id").alias("source_doc_id"), "start_word", "n_words", "source_start", "source_n_words", "similarity")
