"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into two segments of 32 bits. Of two fingerprints that differ
in at most three bits, one segment differs in at most one. The table holds every
distinct fingerprint under both segments; probes enumerate the 33 values around each
segment. Fingerprints that meet under a key are compared over all bits inside the
task, and only a spanning forest of the links found leaves it, so a group of k
copies gives fewer than k rows. Links are joined to components by min-label stars.

Null and empty texts have fingerprint zero and link like any other; texts of fewer
words than a shingle are one shingle; repeated shingles count as often as they
occur; rows with equal ids keep a row each; a null id is never the smallest of a
component that has ids. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm.spread import components, slices
from triagelake.llm.words import with_single_blanks, words_of, xxh64
from triagelake.session import materialise, ship_package

SHINGLE_WORDS = 3
MAX_DIFFERENCE = 3
HASH_SEED = 42
#: Fingerprints of one key that are compared as a whole; larger groups are cut by bytes first.
DENSE = 2048


#: Of a byte: its eight bits, each as a byte of a word.
_SPREAD = np.array([sum((v >> k & 1) << 8 * k for k in range(8)) for v in range(256)], np.uint64)


def bit_majorities(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per range of ``hashes``: the bits that are set in over half of it; zero for none."""
    sizes = np.diff(bounds)
    blocks = -(-sizes // 255)  # a byte counts up to 255
    first = np.repeat(bounds[:-1] - 255 * (np.cumsum(blocks) - blocks), blocks) + 255 * np.arange(blocks.sum())
    out = np.zeros(len(sizes), np.uint64)
    if len(first):
        sums = np.add.reduceat(_SPREAD[hashes.view(np.uint8).reshape(-1, 8)], first, axis=0)
        counts = sums.view(np.uint8).reshape(-1, 64)
        full = np.flatnonzero(sizes)
        counts = np.add.reduceat(counts, (np.cumsum(blocks) - blocks)[full], axis=0, dtype=np.int64)
        out[full] = np.packbits(2 * counts > sizes[full, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints_of(texts: pa.Array, words: int = SHINGLE_WORDS) -> np.ndarray:
    w = with_single_blanks(words_of(texts, lower=True))
    n = np.diff(w.bounds)
    shingles = np.where(n > 0, np.maximum(n - words + 1, 1), 0)
    bounds = np.concatenate([[0], np.cumsum(shingles)])
    first = np.arange(bounds[-1]) + np.repeat(w.bounds[:-1] - bounds[:-1], shingles)
    last = np.minimum(first + words, np.repeat(w.bounds[1:], shingles)) - 1
    return bit_majorities(xxh64(w.data, w.starts[first], w.ends[last], HASH_SEED), bounds)


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, text_hash: str | None = None) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long. Where ``text_hash`` names a
    column, xxhash64 of the text stands there."""
    ship_package(docs.sparkSession)
    more = [F.xxhash64("text").alias(text_hash)] if text_hash else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = pa.array(fingerprints_of(batch.column("text"), words).view(np.int64))
            columns = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != "text"} | {"fp": found}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    target = "doc_id bigint, " + (f"{text_hash} bigint, " if text_hash else "") + "fp bigint"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *more, "text").mapInArrow(run, target)


def near_pairs(keys: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of index pairs (i < j) of distinct fingerprints with at most ``most``
    differing bits. Above ``DENSE`` fingerprints, those that agree in one of eight bytes
    are compared (fewer than eight bits can't touch all of them), byte by byte."""
    n = len(keys)
    if n <= DENSE or most > 7:
        for a in range(0, n, DENSE):
            left = keys[a:a + DENSE]
            for b in range(a, n, DENSE):
                i, j = np.nonzero(np.bitwise_count(left[:, None] ^ keys[None, b:b + DENSE]) <= most)
                ahead = i + a < j + b
                yield i[ahead] + a, j[ahead] + b
        return
    lanes = keys.view(np.uint8).reshape(n, 8)
    seen = np.zeros((n, 8), bool)  # constant bytes tell nothing apart
    for byte in np.argsort([-len(np.unique(lanes[:, k])) for k in range(8)])[:most + 1]:
        seen[:, byte] = True
        order = np.argsort(lanes[:, byte], kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(lanes[order, byte])) + 1):
            for a in range(0, len(group), DENSE):
                for b in range(a, len(group), DENSE):
                    left, right = group[a:a + DENSE], group[b:b + DENSE]
                    i, j = np.nonzero(np.bitwise_count(keys[left][:, None] ^ keys[right][None]) <= most)
                    ahead = left[i] < right[j]
                    yield left[i[ahead]], right[j[ahead]]


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of the graph of ``pairs`` on n nodes: (node, smallest node)."""
    root = np.arange(n)
    for i, j in pairs:
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]


def link_edges(distinct: DataFrame, most: int = MAX_DIFFERENCE) -> DataFrame:
    """(a, b): edges that connect the fingerprints ``fp`` linked by up to ``most`` bits;
    not every link is an edge, every edge is a link or a chain of links."""
    ship_package(distinct.sparkSession)
    radius = most // 2
    if radius > 1:
        raise ValueError("two segments with balls of radius one reach three bits")
    masks = [0] + ([1 << k for k in range(32)] if radius else [])
    high = F.shiftrightunsigned("fp", 32)
    low = F.col("fp").bitwiseAND(F.lit((1 << 32) - 1))
    segments = F.array(high, low + F.lit(1 << 32))  # bit 32 tells the segments apart
    table = distinct.select("fp", F.explode(segments).alias("key"))
    counted = table.groupBy("key").agg(F.count("*").alias("n"))
    # a probe's own key is met by itself; only keys that others have too are of use
    probes = table.select("fp", F.col("key").alias("own"), F.explode(F.array(*[F.col("key").bitwiseXOR(F.lit(m)) for m in masks])).alias("key"))
    # merged: a size guessed after an explode is that of a row a fingerprint, not of 66, and would be sent to all tasks
    met = probes.join(counted.hint("merge"), "key").where("key <> own OR n > 1").select("key", "fp")
    # the fingerprints of the table that a probe of another segment value meets
    asked = met.select("key").distinct()
    members = met.unionByName(table.join(asked.hint("merge"), "key", "left_semi").select("key", "fp"))
    target = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_k, rest_f = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def links(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
            a, b = [], []
            cuts = np.flatnonzero(np.diff(k)) + 1
            for group in np.split(f, cuts):
                group = np.unique(group.view(np.uint64))
                if len(group) > 1:
                    i, j = forest(len(group), near_pairs(group, most))
                    a.append(group[i])
                    b.append(group[j])
            a = np.concatenate([*a, np.zeros(0, np.uint64)]).view(np.int64)
            b = np.concatenate([*b, np.zeros(0, np.uint64)]).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=target)

        for batch in batches:
            k = np.concatenate([rest_k, batch.column(0).to_numpy()])
            f = np.concatenate([rest_f, batch.column(1).to_numpy()])
            if len(k):
                whole = int(np.searchsorted(k, k[-1]))  # the last key may go on
                if whole:
                    yield links(k[:whole], f[:whole])
                rest_k, rest_f = k[whole:], f[whole:]
        if len(rest_k):
            yield links(rest_k, rest_f)

    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # dealt out by a hash of the key: by the key itself, as both parts of the union may lie already, the exchange
    # is dropped, and where their partitions are then put together differently, a key's members are apart
    return members.repartition(parts, F.xxhash64("key")).sortWithinPartitions("key").mapInArrow(run, "a bigint, b bigint")


def classed(prints: DataFrame, most: int = MAX_DIFFERENCE) -> DataFrame:
    """(fp, n_same, root, component_id) per distinct fingerprint of ``prints`` (doc_id, fp);
    root is the smallest fingerprint of the component, as a signed long."""
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_same"))
    linked = components(link_edges(distinct.select("fp"), most), "simhash")
    rooted = distinct.join(linked, distinct["fp"] == linked["node"], "left").select("fp", "least", "n_same", F.coalesce("root", "fp").alias("root"))
    tops = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(tops, "root").select("fp", "n_same", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, most: int = MAX_DIFFERENCE) -> DataFrame:
    """(doc_id, fp, component_id, n_same): a row per row of ``docs``; component_id is the
    smallest doc_id reachable over links, n_same the rows with the same fingerprint."""
    prints = materialise(fingerprints(docs, words), "fingerprints")
    return prints.join(classed(prints, most).drop("root"), "fp").select("doc_id", "fp", "component_id", "n_same")


def representatives(docs: DataFrame, words: int = SHINGLE_WORDS, most: int = MAX_DIFFERENCE) -> DataFrame:
    """(doc_id, text_hash): per component the least id (null last) and of rows with that
    id the least hash of a text."""
    prints = materialise(fingerprints(docs, words, "text_hash"), "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    firsts = prints.groupBy("fp").agg(F.min(rank).alias("first"))
    tops = classed(prints, most).join(firsts, "fp").groupBy("root").agg(F.min("first").alias("first"))
    return tops.select("first.doc_id", "first.text_hash")


def with_hex(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_same")
