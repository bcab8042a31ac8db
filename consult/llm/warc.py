"""WARC archives and a merged capture index (operator 5).

Writing: payloads are grouped by length and SHA-1; of equal payloads of at
least ``REVISIT_BYTES`` bytes the record with the largest id is the response,
the others are revisits that carry its id and no payload. Each record is one
string whose separator, CR LF CR LF, is the line end of Spark's text writer, so
archives are committed, retried and stored like any other Spark output
(gzip-compressed, about ``RECORDS`` records a file).

Reading: each archive is one row of Spark's binary reader; its task walks the
records by their Content-Length, checks the digest of every payload that is
there, and emits the index entries of that archive sorted by URL key and
timestamp: a run.

Merging: an entry carries its run and its place there. Runs are merged in rounds
of at most ``FAN_IN`` runs to one. In a round, range partitions over (group of
runs, URL key, timestamp, id) split the key space, a hot URL included, about
``SLICE`` entries each; a task gets the slices of its runs in their own order,
merges them with a tournament of losers, and gives the entries their places in
the longer run. The last round has one group, so the history is in order across
partitions, and nothing is joined after it: sizes that revisits take from their
responses are looked up before.

Defined results: a null payload is empty; a null URL has an empty key; rows
that share the largest id of equal payloads are all responses; of two equal
(key, timestamp, id) either comes first; an empty table gives no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from consult.functions.prefix import dense_index
from consult.llm.common import scratch, stage, text_or_empty

REVISIT_BYTES = 1_000
#: Records of one archive, index entries of one merge task, about; runs that are merged to one in a round.
RECORDS, SLICE, FAN_IN = 2_000, 100_000, 64
#: Tasks over which the copies of one payload are spread.
SALTS = 16
END = "\r\n"


def decide(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """``pages`` (id, url, ts, payload) with bytes, digest, record_type and refers_to.

    Only large payloads can be revisits: the others do not take part in the lookup,
    which is salted, as one payload may be that of many pages."""
    rows = pages.select("id", "url", "ts", text_or_empty("payload").alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    none = F.lit(None).cast(rows.schema["id"].dataType)
    small = rows.where(F.col("bytes") < revisit_bytes).select("*", F.lit("response").alias("record_type"), none.alias("refers_to"))
    large = rows.where(F.col("bytes") >= revisit_bytes).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    groups = large.groupBy(F.col("digest").alias("g_digest"), F.col("bytes").alias("g_bytes")).agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    groups = groups.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("g_salt"))
    joined = large.join(groups, (large["digest"] == groups["g_digest"]) & (large["bytes"] == groups["g_bytes"]) & (large["salt"] == groups["g_salt"]), "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    large = joined.select("id", "url", "ts", "payload", "bytes", "digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"))
    return large.unionByName(small)


def _urn(c: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))


def record(d: DataFrame) -> Column:
    """One WARC record, without the line ends that follow it."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), d["bytes"].cast("string"), F.lit(END + END))
    block = F.when(d["record_type"] == "revisit", http).otherwise(F.concat(http, d["payload"]))
    url = F.regexp_replace(d["url"], r"[\r\n\s]", "%20")
    head = [("WARC-Type", d["record_type"]), ("WARC-Record-ID", _urn(d["id"])), ("WARC-Date", F.date_format(d["ts"], "yyyy-MM-dd'T'HH:mm:ss'Z'")),
            ("WARC-Target-URI", url), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), d["digest"])), ("WARC-Refers-To", F.when(d["record_type"] == "revisit", _urn(d["refers_to"]))),
            ("Content-Type", F.lit("application/http; msgtype=response"))]
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v, F.lit(END))) for k, v in head]
    return F.concat(F.lit(f"WARC/1.1{END}"), F.concat_ws("", *lines), F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END + END), block)


def write_archives(pages: DataFrame, path: str) -> None:
    """WARC files of ``pages`` (id, url, ts, payload) below ``path``."""
    d = decide(pages)
    d.select(record(d).alias("value")).write.option("lineSep", END * 2).option("compression", "gzip").option("maxRecordsPerFile", RECORDS).text(path)


def url_key(url: str) -> str:
    """Host labels reversed, then path and query, lower case: captures of one site sort together."""
    rest = url.split("://", 1)[-1].split("#", 1)[0].lower()
    host, slash, path = rest.partition("/")
    return ",".join(reversed(host.split(":")[0].split("."))) + ")/" + path if host else ""


def parse(raw: bytes) -> Iterator[dict]:
    """The records of an archive: headers, offset, length, block."""
    at, sep = 0, (END * 2).encode()
    while at < len(raw):
        stop = raw.index(sep, at)
        head = dict(x.split(": ", 1) for x in raw[at:stop].decode().split(END)[1:])
        body = stop + len(sep)
        end = body + int(head["Content-Length"])
        yield {"head": head, "offset": at, "length": end - at, "block": raw[body:end]}
        at = end + len(sep)


FIELDS = "url_key string, ts string, id string, file string, offset long, length long, url string, record_type string, refers_to string, digest string, payload_bytes long, place long"
_ARROW = pa.schema([(f.split()[0], pa.int64() if f.endswith("long") else pa.string()) for f in FIELDS.split(", ")])


def _entry(file: str, r: dict) -> dict:
    h = r["head"]
    payload = r["block"].partition((END * 2).encode())[2]
    digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = h["WARC-Type"]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"{file}: the payload at {r['offset']} does not have its digest")
    own = [h.get(k, "")[len("<urn:record:"):-1] or None for k in ("WARC-Record-ID", "WARC-Refers-To")]
    return {"url_key": url_key(h.get("WARC-Target-URI", "")), "ts": h.get("WARC-Date", ""), "id": own[0], "file": file, "offset": r["offset"], "length": r["length"], "url": h.get("WARC-Target-URI"),
            "record_type": kind, "refers_to": own[1], "digest": digest, "payload_bytes": len(payload) if kind == "response" else None}


def _order(e: dict) -> tuple:
    return e["url_key"], e["ts"], len(e["id"]), e["id"]


def index_runs(spark, path: str) -> DataFrame:
    """Index entries of the archives below ``path``; those of one file are a sorted run, in the order of ``place``."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, raw in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                raw = raw.as_py()
                got = [_entry(file, r) for r in parse(gzip.decompress(raw) if file.endswith(".gz") else raw)]
                yield pa.RecordBatch.from_pylist([{**e, "place": i} for i, e in enumerate(sorted(got, key=_order))], _ARROW)

    return files.mapInArrow(run, FIELDS)


class LoserTree:
    """Merges sorted lists: inner nodes keep the loser of their match, so the next entry costs one path."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.at = [0] * self.k
        self.head = [self._peek(i) for i in range(self.k)]
        self.loser = [-1] * self.k
        self.winner = self._play(1) if self.k > 1 else 0

    def _peek(self, i: int) -> tuple:
        return (0, self.key(self.runs[i][self.at[i]])) if self.at[i] < len(self.runs[i]) else (1, ())

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        a, b = (a, b) if self.head[a] <= self.head[b] else (b, a)
        self.loser[node] = b
        return a

    def __iter__(self) -> Iterator:
        for _ in range(sum(map(len, self.runs))):
            i = self.winner
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            self.head[i] = self._peek(i)
            node = (i + self.k) // 2
            while node >= 1 and self.k > 1:
                if self.head[self.loser[node]] < self.head[i]:
                    i, self.loser[node] = self.loser[node], i
                node //= 2
            self.winner = i


def _merge_round(runs: DataFrame, groups: int, parts: int) -> DataFrame:
    """Runs (numbered in ``run``) of every group of neighbours merged to one; ``place`` is an entry's place there."""
    schema = pa.schema([pa.field("run", pa.int64()), *_ARROW])
    key = ["url_key", "ts", F.length("id"), "id"]
    grouped = runs.withColumn("grp", F.floor(F.col("run") / groups))
    spread = grouped.repartitionByRange(parts, "grp", *key).sortWithinPartitions("grp", "run", "place")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = (e for b in batches for e in b.to_pylist())
        for group, own in itertools.groupby(entries, key=lambda e: e["grp"]):
            slices = [list(s) for _, s in itertools.groupby(own, key=lambda e: e["run"])]
            merged = iter(LoserTree(slices, _order))
            while held := [{**e, "run": group} for e in itertools.islice(merged, 4096)]:
                yield pa.RecordBatch.from_pylist(held, schema)

    # Partitions are ranges of (group, key), so partition and place in it are the order of the merged run.
    return spread.mapInArrow(merge, f"run long, {FIELDS}").withColumn("place", F.monotonically_increasing_id())


def merge_runs(runs: DataFrame) -> DataFrame:
    """All entries in the order of (url_key, ts, id), partition after partition."""
    files = stage(dense_index(runs.select("file").distinct(), ["file"], out="run", start=0), "files")
    runs = stage(runs.join(files.withColumnRenamed("file", "of"), F.col("file") == F.col("of")).drop("of"), "runs")
    left, parts = files.count(), max(1, -(-runs.count() // SLICE))
    while left > FAN_IN:
        runs, left = stage(_merge_round(runs, FAN_IN, parts), "runs"), -(-left // FAN_IN)
    return _merge_round(runs, FAN_IN, parts).drop("run", "place")


def capture_history(spark, path: str) -> DataFrame:
    """The merged index of the archives below ``path``; a revisit takes its payload's size from the response it names."""
    entries = stage(index_runs(spark, path), "entries")
    sizes = entries.where("record_type = 'response'").groupBy(F.col("id").alias("r_id"), F.col("digest").alias("r_digest")).agg(F.max("payload_bytes").alias("r_bytes"))
    salted = sizes.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("r_salt"))
    again = entries.where("record_type = 'revisit'").withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    looked = again.join(salted, (F.col("refers_to") == F.col("r_id")) & (F.col("digest") == F.col("r_digest")) & (F.col("salt") == F.col("r_salt")), "left")
    looked = looked.withColumn("payload_bytes", F.coalesce("payload_bytes", "r_bytes")).select(*entries.columns)
    return merge_runs(entries.where("record_type <> 'revisit'").unionByName(looked))


def op5_warc(spark, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back through the merged index. Pages have no capture time; the id, in seconds, stands in."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = scratch(spark, "warc")
    write_archives(pages.select(F.col("page_id").alias("id"), "url", F.timestamp_seconds(F.coalesce("page_id", F.lit(0))).alias("ts"), F.col("html").alias("payload")), path)
    h = capture_history(spark, path)
    return h.select(F.expr("try_cast(id AS bigint)").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", F.expr("try_cast(refers_to AS bigint)").alias("refers_to"), "url_key", F.col("ts").alias("captured"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n, url FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to,
       array_to_string(list_reverse(string_split(split_part(split_part(u, '/', 1), ':', 1), '.')), ',') || ')/' || CASE WHEN strpos(u, '/') > 0 THEN substr(u, strpos(u, '/') + 1) ELSE '' END AS url_key,
       strftime(to_timestamp(page_id) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS captured
FROM (SELECT *, lower(split_part(split_part(url, '://', 2), '#', 1)) AS u FROM g)
"""
