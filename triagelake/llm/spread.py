"""Spark helpers of this subpackage: small tables, chunks of documents, packed rows,
connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.session import materialise

#: Rows up to which a table that is written already is sent to every task.
SMALL_ROWS = 20_000


def small(df: DataFrame, name: str, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` written once, and marked for broadcast where it has ``rows`` rows at most."""
    df = materialise(df.coalesce(1), name)
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def folded(docs: DataFrame, *used: str) -> DataFrame:
    """The columns ``used`` and all others as one struct, _row, so that no name of theirs
    meets one that an operator adds on its way."""
    rest = [docs[f"`{c}`"] for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(*rest or [F.lit(0).alias("none")]).alias("_row"))


def unfolded(names: list[str], *used: str) -> list[Column]:
    """The columns ``names`` of a folded table, as they were."""
    return [F.col(c) if c in used else F.col("_row").getField(c).alias(c) for c in names]


def total_bytes(df: DataFrame, text: str) -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]


#: Bytes of text in a chunk, and hashes in a bucket; both only set how many there are.
CHUNK_BYTES, BUCKET_HASHES = 4 << 20, 1 << 20
#: A packed row: to, from (bucket and chunk, or the other way round), kind and three columns.
PACKED_ROW = "_to int, _from int, kind int, a binary, b binary, c binary"
_PACKED = pa.schema([("_to", pa.int32()), ("_from", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary())])


def in_chunks(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """``columns`` of ``df`` with _to, the chunk of a row by its id and text, dealt out
    by it. Plans that contain this more than once share one exchange."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("_to"), *columns).repartition(parts, "_to")


# Many small values travel as one row: little-endian integers, written byte plane by
# byte plane, so that the planes of high bytes of sorted values compress to nothing.


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def unpacked(data: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    planes = np.frombuffer(data, np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


Sends = Iterator[tuple]


def packed_rows(rows: Sends) -> pa.Table:
    rows = list(rows)
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_PACKED)], schema=_PACKED)


def emit(chunks: DataFrame, work: Callable[[pa.Table], Sends], answers: DataFrame | None = None) -> DataFrame:
    """Packed rows that ``work`` makes of each chunk, and of its answers where there are any."""
    if answers is None:
        return chunks.groupBy("_to").applyInArrow(lambda t: packed_rows(work(t)), PACKED_ROW)
    return chunks.groupBy("_to").cogroup(answers.groupBy("_to")).applyInArrow(lambda t, more: packed_rows(work(t, more)), PACKED_ROW)


def answer(rows: DataFrame, work: Callable[[pa.Table], Sends]) -> DataFrame:
    """Packed rows that ``work`` makes of the rows sent to each bucket."""
    return rows.groupBy("_to").applyInArrow(lambda t: packed_rows(work(t)), PACKED_ROW)


def received(table: pa.Table, column: str, dtype, kind: int | None = None) -> list[np.ndarray]:
    rows = table if kind is None else table.filter(pc.equal(table["kind"], kind))
    return [unpacked(x, dtype) for x in rows[column].to_pylist()]


def cuts(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The buckets of ascending keys (the bucket is in the high half), with their places."""
    buckets = (keys >> np.uint64(32)).astype(np.int64)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(buckets)) + 1, [len(keys)]])
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            yield int(buckets[a]), slice(int(a), int(b))


def bucketed(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Keys of 64 bits: a bucket by the high half of the hash, and the low half. A bucket
    has about as many hashes at any size of the data, so its 32 bits tell as much."""
    return ((hashes >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (hashes & np.uint64(0xFFFFFFFF))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 21, rows: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column``, of strings, has about ``limit`` bytes in each, and ``rows`` rows at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column(batch.schema.get_field_index(column))
        sizes = np.nan_to_num(np.asarray(pc.binary_length(text).to_numpy(zero_copy_only=False), np.float64))
        part = (np.cumsum(sizes) - sizes) // limit
        edges = sorted({0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), *range(0, batch.num_rows, rows), batch.num_rows})
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()  # workers are kept for later tasks


def components(edges: DataFrame, name: str, rounds: int = 100) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of ``edges`` (a, b: long).

    Large-star and small-star steps in turn: each links a node's larger (smaller)
    neighbours with the smallest of them, until nothing changes; the number of rounds
    grows with the logarithm of the longest chain. Neighbours are never collected: a
    hub is a key of an aggregation and of a join, which Spark splits."""
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-edges")

    def print_of(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    before = print_of(edges)
    for _ in range(rounds):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(least, "a")
        edges = materialise(
            tied.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct(),
            f"{name}-round")
        now = print_of(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
