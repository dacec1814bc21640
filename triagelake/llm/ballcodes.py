"""Vector codes by ball k-means: a codebook for each part of the vectors.

Components become integers floor(scale * x); vectors are cut into equal consecutive
parts, and each part position has a codebook that starts at that part of the vectors
with the smallest ids. All arithmetic is on integers, so results depend on neither
partitions nor retries.

Each entry of a codebook is the centre of a ball. Its radius is the largest distance
of its members, taken while their sums are built and widened by the way the entry
moved; entries farther than twice that radius can hold none of the ball's members and
are no neighbours. A part whose distance d to its entry is under half the way to the
nearest neighbour lies in the stable core and stays without any comparison; otherwise
it lies in the ring between two neighbours and is compared exactly with the entries up
to distance 2d alone. The nearest entry is always among them, ties included.

A round is one pass that assigns (every task holds the codebooks, parts x entries x
width integers, whatever the data) and one that sums: a task adds its rows up before
anything is shuffled. Only the sums, parts x entries x (width + 1) rows, reach the
driver. Assignments are written after each round, which cuts the lineage.

Null vectors and vectors with a null or non-finite component are dropped. The width is
that of the smallest id; vectors of another width, and those whose squared distances
could pass 63 bits, come back with null code and error. Where the width is no multiple
of the parts, zeros are added at the end. A null id comes after all ids, rows with one
id are ordered by their components and coded one by one. With fewer vectors than
entries a codebook has as many entries as there are vectors. Empty tables give no
rows. Columns other than vec_id, embedding and label are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.session import materialise, ship_package

ENTRIES, PARTS, ROUNDS, SCALE = 256, 4, 4, 1024
#: Rows and components that are worked on together in a task.
AT_ONCE, VALUES_AT_ONCE = 1 << 16, 1 << 22
_CELLS = pa.schema([("cell", pa.int32()), ("place", pa.int32()), ("total", pa.int64()), ("radius", pa.int64())])


def largest(width: int) -> int:
    """Components up to which squared distances over ``width`` of them fit in a long."""
    return min(math.isqrt(((1 << 63) - 1) // (4 * max(1, width))), (1 << 31) - 1)


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and the integer components x (null where they don't fit) of the
    vectors that are whole."""
    values = F.col("embedding").cast("array<double>")
    whole = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    fits = F.forall(values, lambda v: F.abs(v * scale) < F.lit(float(largest(1))))
    x = F.when(fits, F.transform(values, lambda v: F.floor(v * scale).cast("int")))
    return vectors.where(F.col("embedding").isNotNull() & whole).select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", x.alias("x"))


@dataclass
class Balls:
    """The entries of one part, each with all entries by their distance from it."""

    entries: np.ndarray  # k x width
    order: np.ndarray  # k x k, nearest first
    far: np.ndarray  # their squared distances, ascending
    neighbours: np.ndarray  # how many of them the entry's ball can meet

    @classmethod
    def around(cls, entries: np.ndarray, reach: np.ndarray | None) -> Balls:
        between = _squared(entries, entries, entries.shape[1])
        order = np.argsort(between, axis=1, kind="stable")
        far = np.take_along_axis(between, order, 1)
        if reach is None:
            return cls(entries, order, far, np.full(len(entries), len(entries)))
        return cls(entries, order, far, np.array([np.searchsorted(f, 4 * int(r), "right") for f, r in zip(far, reach)]))

    def assign(self, points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of each point that now stands at entry ``at``."""
        at = at.astype(np.int64)
        apart = points - self.entries[at]
        near = np.einsum("ij,ij->i", apart, apart)
        order = np.argsort(at, kind="stable")
        edges = np.searchsorted(at[order], np.arange(len(self.entries) + 1))
        out = at.copy()
        for i in np.flatnonzero(np.diff(edges)):
            mine = order[edges[i]:edges[i + 1]]
            ring = np.searchsorted(self.far[i, :self.neighbours[i]], 4 * near[mine], "right")
            outside = ring > 1  # all others are in the stable core
            mine, ring = mine[outside], ring[outside]
            level = np.ceil(np.log2(ring)).astype(np.int64)  # rings by powers of two
            for step in np.unique(level):
                some = mine[level == step]
                candidates = np.sort(self.order[i, :ring[level == step].max()])  # ties go to the lower index
                distance = _squared(points[some], self.entries[candidates], points.shape[1])
                best = distance.argmin(axis=1)
                out[some], near[some] = candidates[best], distance[np.arange(len(some)), best]
        return out, near


def _squared(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` and ``b``; doubles where they hold
    every sum exactly, integers otherwise."""
    bound = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if 4 * width * bound * bound < 1 << 53:
        a, b = a.astype(np.float64), b.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T)).astype(np.int64)
    return np.stack([((a - row) ** 2).sum(1) for row in b], axis=1)


def _tables(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.Table]:
    held, rows, limit = [], 0, max(1, min(AT_ONCE, VALUES_AT_ONCE // max(1, width)))
    for batch in batches:
        for at in range(0, batch.num_rows, limit):
            held.append(batch.slice(at, limit))
            rows += held[-1].num_rows
            if rows >= limit:
                yield pa.Table.from_batches(held)
                held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _parts(table: pa.Table, shape: tuple[int, int, int]) -> np.ndarray:
    """parts x rows x width, with zeros added where the width is no multiple."""
    parts, _, width = shape
    x = table["x"].combine_chunks()
    x = x.flatten().to_numpy().reshape(len(table), -1).astype(np.int64)
    out = np.zeros((len(table), parts * width), np.int64)
    out[:, :x.shape[1]] = x
    return out.reshape(len(table), parts, width).transpose(1, 0, 2)


def _codes(table: pa.Table, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(table["code"].to_pylist()), np.uint8).reshape(-1, parts).T


def assigned(rows: DataFrame, codebooks: np.ndarray, reach: np.ndarray | None) -> DataFrame:
    """The rows with the codes and squared distances of their nearest entries."""
    parts = len(codebooks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [Balls.around(c, None if reach is None else reach[p]) for p, c in enumerate(codebooks)]
        for table in _tables(batches, parts * codebooks.shape[2]):
            found = [b.assign(x, a) for b, x, a in zip(balls, _parts(table, codebooks.shape), _codes(table, parts))]
            codes = np.stack([f[0] for f in found], 1).astype(np.uint8)
            near = np.stack([f[1] for f in found], 1)
            offsets = np.arange(len(table) + 1, dtype=np.int32) * parts
            made = {"code": pa.array([c.tobytes() for c in codes], pa.binary()),
                    "near": pa.ListArray.from_arrays(pa.array(offsets), pa.array(near.reshape(-1)))}
            out = pa.table({n: made.get(n, table[n]) for n in ("vec_id", "label", "x", "code", "near")})
            yield from out.combine_chunks().to_batches()

    return rows.mapInArrow(work, rows.schema)


def totals(rows: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums and counts of the members of each entry, and its largest squared distance."""
    parts, k, width = shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, k, width + 1), np.int64)  # the last place counts
        radius = np.zeros((parts, k), np.int64)
        for table in _tables(batches, parts * width):
            near = table["near"].combine_chunks().flatten().to_numpy().reshape(-1, parts)
            for p, (x, code) in enumerate(zip(_parts(table, shape), _codes(table, parts))):
                order = np.argsort(code, kind="stable")
                used, first = np.unique(code[order], return_index=True)
                sums[p, used, :width] += np.add.reduceat(x[order], first, axis=0)
                sums[p, used, width] += np.diff(np.append(first, len(order)))
                radius[p, used] = np.maximum(radius[p, used], np.maximum.reduceat(near[order, p], first))
        cell, place = np.nonzero(sums.reshape(parts * k, width + 1))
        flat = [cell.astype(np.int32), place.astype(np.int32), sums.reshape(parts * k, -1)[cell, place], radius.reshape(-1)[cell]]
        yield from pa.table([pa.array(c) for c in flat], schema=_CELLS).to_batches()

    cells = rows.select("x", "code", "near").mapInArrow(work, "cell int, place int, total long, radius long")
    found = cells.groupBy("cell", "place").agg(F.sum("total").alias("total"), F.max("radius").alias("radius")).toArrow()
    sums, radius = np.zeros((parts * k, width + 1), np.int64), np.zeros(parts * k, np.int64)
    cell, place = found["cell"].to_numpy(), found["place"].to_numpy()
    sums[cell, place] = found["total"].to_numpy()
    np.maximum.at(radius, cell, found["radius"].to_numpy())
    sums = sums.reshape(parts, k, width + 1)
    return sums[..., :width], sums[..., width], radius.reshape(parts, k)


def _widened(radius: np.ndarray, moved: np.ndarray) -> np.ndarray:
    """Squares of radius + way, rounded up, from the squares of both."""
    root = np.vectorize(lambda v: math.isqrt(int(v)) + 1, otypes=[np.int64])
    return np.minimum(root(radius) + root(moved), math.isqrt(1 << 61)) ** 2


@dataclass
class Compressed:
    codes: DataFrame  #: vec_id, label, code (a byte a part), error
    codebooks: np.ndarray  #: parts x entries x width of a part

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS, scale: int = SCALE) -> Compressed:
    """Codes of all vectors and the codebooks they refer to."""
    if not 0 < entries <= 256:
        raise ValueError("a code holds one byte a part: 1 to 256 entries")
    spark = vectors.sparkSession
    ship_package(spark)
    rows = materialise(scaled(vectors, scale), "vectors-scaled")
    first = [F.col("vec_id").asc_nulls_last(), F.col("x").asc()]
    start = rows.where("x IS NOT NULL").orderBy(*first).select(F.size("x")).first()
    dim = start[0] if start else 0
    most = largest(dim)
    codable = F.coalesce((F.size("x") == dim) & F.forall("x", lambda v: (v <= most) & (v >= -most)), F.lit(False))
    seeds = rows.where(codable).orderBy(*first).limit(entries).select("x").collect()
    k, width = len(seeds), -(-dim // parts)
    codebooks = np.zeros((k, parts * width), np.int64)
    codebooks[:, :dim] = np.array([s.x for s in seeds], np.int64).reshape(k, dim)
    codebooks = np.ascontiguousarray(codebooks.reshape(k, parts, width).transpose(1, 0, 2))
    others = rows.where(~codable).select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("bigint").alias("error"))
    coded = rows.where(codable).select("*", F.lit(bytes(parts)).alias("code"), F.lit(None).cast("array<bigint>").alias("near"))
    reach = None
    for turn in range(rounds + 1 if k else 0):
        coded = materialise(assigned(coded, codebooks, reach), f"vectors-coded-{turn}")
        if turn == rounds:
            break
        sums, counts, radius = totals(coded, codebooks.shape)
        moved = np.where(counts[..., None] > 0, np.floor_divide(sums, np.maximum(counts, 1)[..., None]), codebooks)
        reach = _widened(radius, ((moved - codebooks) ** 2).sum(-1))
        codebooks = moved
    error = F.aggregate("near", F.lit(0).cast("bigint"), lambda a, v: a + v)
    return Compressed(coded.select("vec_id", "label", "code", error.alias("error")).unionByName(others), codebooks)


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error, the sum over rows of an equal label (nulls are equal;
    null where it passes a long). Sums are built before the join, which the optimizer
    splits where one label holds very many rows."""
    sums = codes.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def restored(codes: DataFrame, codebooks: np.ndarray, scale: int = SCALE) -> DataFrame:
    """vec_id and the vector its code stands for (zeros that were added included)."""
    books = [[[v / scale for v in entry] for entry in book] for book in codebooks.tolist()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [None if c is None else [v for p, e in enumerate(c) for v in books[p][e]] for c in batch.column("code").to_pylist()]
            yield pa.record_batch([batch.column("vec_id"), pa.array(values, pa.list_(pa.float64()))], ["vec_id", "vector"])

    return codes.select("vec_id", "code").mapInArrow(work, "vec_id long, vector array<double>")
