"""WARC archives of pages and the merge of their capture index.

Writing: a page is a response record, or a revisit record where a later page (larger
id) has the same payload of at least 1000 bytes. Every task sorts its records by URL
key and time and writes them as gzip files of bounded length, through Spark's text
writer with the record end as line separator (a payload is text, so its bytes are
kept).

Reading: every archive is parsed by its content lengths, digests are computed anew, and
its index entries, which form a sorted run, are cut at common splitters. One task per
range merges the segments of all runs with a loser tree; the ranges follow one
another, so captures get one global order of (URL key, time, page id).

Null html is an empty payload, a null url an empty one; a null page_id is kept (time
zero, never referred to). Equal ids with equal payload are of one record type. Other
columns are ignored. An empty table gives no archives and no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagelake.llm.spread import small
from triagelake.session import materialise, scratch_path, ship_package

LEAST_PAYLOAD = 1000
RECORDS_PER_FILE, ENTRIES_PER_RANGE = 2000, 5000
#: Keys that splitters are chosen from; they only set how even the ranges are.
SPLITTER_SAMPLE = 5000
#: Time of page 0; a page is taken to be captured one second after the page before it.
FIRST_CAPTURE = "2024-01-01 00:00:00"
END = "\r\n"


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, then the path: com,example)/path."""
    rest = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.substring(rest, F.length(host) + 1, F.length(rest)))


def capture_time(page_id: Column) -> Column:
    return F.unix_timestamp(F.lit(FIRST_CAPTURE).cast("timestamp")) + F.coalesce(page_id, F.lit(0))


def _line(value: Column) -> Column:
    """On one header line."""
    value = F.replace(value, F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _unlined(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def captures(pages: DataFrame) -> DataFrame:
    """Pages with payload, its length and digest, key, time, record type and refers_to."""
    payload = F.coalesce("html", F.lit(""))
    base = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"), F.sha1(payload.cast("binary")).alias("payload_digest"),
        url_key(F.col("url")).alias("url_key"), capture_time(F.col("page_id").cast("bigint")).alias("captured"))
    # only payloads that repeat are looked up
    repeated = base.where(F.col("payload_bytes") >= LEAST_PAYLOAD).groupBy("payload_digest", "payload_bytes").agg(
        F.max("page_id").alias("_last"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    found = base.join(small(repeated, "repeated"), ["payload_digest", "payload_bytes"], "left")
    refers = F.when(F.col("_last") != F.coalesce("page_id", F.lit(-(1 << 63))), F.col("_last"))
    return found.withColumn("refers_to", refers).drop("_last").withColumn(
        "record_type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit"))


def record(c: DataFrame) -> Column:
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END * 2))
    block = F.concat(http, F.when(F.col("record_type") == "response", F.col("payload")).otherwise(""))
    name = lambda x: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(x).cast("string"), F.lit("none")), F.lit(">"))
    revisit = F.concat(
        F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), name("refers_to"), F.lit(END))
    fields = [
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"), F.lit("\r\nWARC-Record-ID: "), name("page_id"),
        F.lit("\r\nWARC-Target-URI: "), _line(F.col("url")), F.lit("\r\nX-Url-Key: "), _line(F.col("url_key")),
        F.lit("\r\nWARC-Date: "), F.date_format(F.timestamp_seconds("captured"), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("\r\nX-Captured: "), F.col("captured").cast("string"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit("\r\nX-Payload-Length: "), F.col("payload_bytes").cast("string"), F.lit(END),
        F.when(F.col("record_type") == "revisit", revisit).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END * 2), block,
    ]
    return F.concat(*fields)


def write_archives(found: DataFrame, path: str) -> None:
    rows = found.sortWithinPartitions("url_key", "captured", "page_id").select(record(found).alias("value"))
    rows.write.option("lineSep", END * 2).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


ENTRY = "url_key string, captured bigint, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_start bigint, archive string"
_ENTRY = pa.struct([
    ("url_key", pa.string()), ("captured", pa.int64()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_start", pa.int64()), ("archive", pa.string())])
Entry = tuple


def _page(name: bytes | None) -> int | None:
    number = name.decode()[len("<urn:page:"):-1] if name else "none"
    return None if number == "none" else int(number)


def entries(archive: bytes, name: str) -> Iterator[Entry]:
    """Index entries of an archive, in its order; each payload is checked against its digest."""
    data = memoryview(zlib.decompress(archive, 47))
    at = 0
    while at < len(data):
        end = data.obj.find(b"\r\n\r\n", at)
        head = dict(line.split(b": ", 1) for line in data[at:end].tobytes().split(b"\r\n")[1:])
        block = end + 4
        stop = block + int(head[b"Content-Length"])
        kind, digest, size = head[b"WARC-Type"].decode(), head[b"WARC-Payload-Digest"][5:].decode(), int(head[b"X-Payload-Length"])
        if kind == "response":
            payload = data[data.obj.find(b"\r\n\r\n", block) + 4:stop]
            size, found = len(payload), hashlib.sha1(payload).hexdigest()
            if found != digest:
                raise ValueError(f"{name}: the payload at {at} has digest {found}, its header {digest}")
        yield (
            _unlined(head[b"X-Url-Key"].decode()), int(head[b"X-Captured"]), _page(head[b"WARC-Record-ID"]), size, digest, kind,
            _page(head.get(b"WARC-Refers-To")), at, name)
        at = stop + 4


def order_of(entry: Entry) -> tuple:
    return entry[0], entry[1], -1 if entry[2] is None else entry[2]


def merged(runs: list[list[Entry]]) -> Iterator[Entry]:
    """k-way merge of sorted runs with a tree of losers: inner nodes keep the loser of
    their match, so a step replays one path of log k matches."""
    k = len(runs)
    if not k:
        return
    heads = [0] * k
    keys = [(0, order_of(r[0])) if r else (1,) for r in runs]  # (1,) is behind all
    tree, winners = [0] * k, [0] * (2 * k)
    winners[k:] = range(k)
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], tree[node] = (a, b) if keys[a] <= keys[b] else (b, a)
    top = winners[1] if k > 1 else 0
    while keys[top] != (1,):
        yield runs[top][heads[top]]
        heads[top] += 1
        keys[top] = (0, order_of(runs[top][heads[top]])) if heads[top] < len(runs[top]) else (1,)
        node = (top + k) // 2
        while node:
            if keys[tree[node]] < keys[top]:
                tree[node], top = top, tree[node]
            node //= 2


def splitters(found: DataFrame) -> list[tuple]:
    """Ascending keys that cut all captures in ranges of about ``ENTRIES_PER_RANGE``."""
    key = found.select("url_key", "captured", F.coalesce("page_id", F.lit(-1)).alias("page_id"))
    n = key.count()
    every = max(1, n // SPLITTER_SAMPLE)
    sample = sorted(tuple(r) for r in key.where(F.pmod(F.xxhash64("page_id", "url_key"), F.lit(every)) == 0).limit(4 * SPLITTER_SAMPLE).collect())
    ranges = 1 + n // ENTRIES_PER_RANGE
    return sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []


def read_index(spark: SparkSession, path: str, cuts: list[tuple]) -> DataFrame:
    """All captures of the archives with range and position, which give the global order."""
    from bisect import bisect_left

    ship_package(spark)
    segment = pa.schema([("range", pa.int32()), ("run", pa.string()), ("segment", pa.list_(_ENTRY))])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                run = list(entries(content.as_py(), name.as_py().rpartition("/")[2]))
                keys = [order_of(e) for e in run]
                if keys != sorted(keys):
                    raise ValueError(f"{name}: the run is not in order")
                edges = [0, *(bisect_left(keys, c) for c in cuts), len(run)]
                parts = [(i, a, b) for i, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
                rows = [[dict(zip((f.name for f in _ENTRY), e)) for e in run[a:b]] for _, a, b in parts]
                yield pa.RecordBatch.from_arrays([
                    pa.array([i for i, _, _ in parts], pa.int32()), pa.array([name.as_py()] * len(parts), pa.string()), pa.array(rows, pa.list_(_ENTRY))], schema=segment)

    target = pa.schema([("range", pa.int32()), ("position", pa.int64()), *((f.name, f.type) for f in _ENTRY)])

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("run")
        lists = [[tuple(e.values()) for e in s] for s in table["segment"].to_pylist()]
        rows = list(merged(lists))
        columns = list(zip(*rows))
        made = [pa.array([table["range"][0].as_py()] * len(rows), pa.int32()), pa.array(range(len(rows)), pa.int64())]
        return pa.table([*made, *(pa.array(c, f.type) for c, f in zip(columns, _ENTRY))], schema=target)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("path", "content")
    cut = files.mapInArrow(runs, f"range int, run string, segment array<struct<{ENTRY.replace(' ', ':').replace(',:', ', ')}>>")
    return cut.groupBy("range").applyInArrow(merge, f"range int, position bigint, {ENTRY}")


def archived(pages: DataFrame) -> DataFrame:
    """Writes the archives, reads them back and gives every capture its global place."""
    spark = pages.sparkSession
    found = captures(pages)
    path = scratch_path(spark, "warc")
    write_archives(found, path)
    index = materialise(read_index(spark, path, splitters(found)), "captures")
    # a row per range
    sizes = index.groupBy("range").count()
    before = sizes.select("range", F.coalesce(F.sum("count").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return index.join(small(before, "ranges"), "range").withColumn("place", F.col("_before") + F.col("position")).drop("_before")
