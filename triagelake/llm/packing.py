"""Best-fit packing into fixed-length sequences by a grouping genetic algorithm.

A document is its token ids and one end id; longer ones than a sequence are cut into
whole sequences, behind a first piece with the rest. Pieces are dealt out in
the order of their lengths, one by one, to shards of bounded size, so each holds the mix
of lengths, however the rows are ordered. Every shard is worked on by several islands: populations of solutions
(lists of bins), started by best fit over differently shaken orders. A crossover
injects whole well-filled bins of one parent into the other, drops the bins there
that hold the same pieces, and best-fits the displaced ones; a mutation empties the
worst bins. Between epochs an island's elite migrates to the next island of its shard.
An island stops at the lower bound. The bins of a shard's best solution that hold its
slack are then opened and packed anew together with those of other shards, in as many
groups as their pieces fill. Once a level opens over half of its pieces (lengths that
leave room in nearly every bin), the levels after it open the worst bins of each group
only: groups hold one mix, so what they can still gain is the rest of each. The last
level is one group.

Null and empty texts are a piece of the end id alone; repeated ids and rows are packed
like others (a row each); a null id is kept; other columns are ignored; an empty table
gives no rows. The result is stored once, so it is read back the same.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm import tokens
from triagelake.llm.spread import slices
from triagelake.session import materialise, ship_package

SEQUENCE, END_ID = 2048, 0
SHARD_PIECES = 2000
ISLANDS, EPOCHS, POPULATION, GENERATIONS = 2, 2, 4, 6
#: The worst bins of a shard, which hold this share of its slack, are opened again; so
#: many at most after a level that has opened over half of its pieces.
SLACK_OPENED, MOST_OPENED = 0.95, 64
SEED = 11

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
_PIECE = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]


def pieces(docs: DataFrame, size: int = SEQUENCE, tokenizer: str = tokens.TOKENIZER) -> DataFrame:
    """A row per piece with row, a number of its own: input partition and place there."""
    ship_package(docs.sparkSession)
    target = pa.schema([*_PIECE, ("row", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, first, done = tokens.encoder(tokenizer), TaskContext.get().partitionId() << 40, 0
        for batch in slices(batches, "text"):
            ids, bounds = encoder.encode(batch.column("text"))
            rows = []
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                own = np.append(ids[a:b], np.uint32(END_ID))
                cut = list(range(len(own) % size, len(own), size)) if len(own) > size else []
                edges = sorted({0, *cut, len(own)})
                for k, (x, y) in enumerate(zip(edges, edges[1:])):
                    rows.append((doc, k, x, y - x, zlib.crc32(own[x:y].astype("<u4").tobytes()), first + done))
                    done += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), target)], schema=target)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, PIECE + ", row bigint")


def dealt(own: DataFrame, shards: int) -> DataFrame:
    """``own`` with group: shards in turn along the lengths, from a hashed one on in each range."""
    parts = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranked = own.repartitionByRange(parts, "length", "row").sortWithinPartitions("length", "row").withColumn("_at", F.monotonically_increasing_id())
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.pmod(F.xxhash64(F.shiftright("_at", 33)), F.lit(shards))
    return ranked.withColumn("group", F.pmod(place, F.lit(shards)).cast("bigint")).drop("_at", "row")


# -- the algorithm, on one shard --------------------------------------------------------

Bins = list[list[int]]


def best_fit(bins: Bins, items: list[int], length: list[int], size: int) -> None:
    """Put items, in their order, each where the least room is left after it."""
    room = sorted((size - sum(length[i] for i in b), k) for k, b in enumerate(bins))
    for i in items:
        at = bisect_left(room, (length[i], -1))
        if at < len(room):
            left, k = room.pop(at)
        else:
            left, k = size, len(bins)
            bins.append([])
        bins[k].append(i)
        if left > length[i]:
            insort(room, (left - length[i], k))


def fitness(bins: Bins, length: list[int], size: int) -> tuple[int, float]:
    """Fewer bins, then more unevenly filled ones (room in one bin is of more use)."""
    return len(bins), -sum((sum(length[i] for i in b) / size) ** 2 for b in bins)


def crossover(into: Bins, source: Bins, length: list[int], size: int, rng) -> Bins:
    filled = sorted(source, key=lambda b: -sum(length[i] for i in b))
    injected = [b for b in filled[:len(filled) // 2 + 1] if rng.random() < 0.5]
    taken = {i for b in injected for i in b}
    kept = [list(b) for b in into if taken.isdisjoint(b)]
    displaced = [i for b in into if not taken.isdisjoint(b) for i in b if i not in taken]
    out = kept + [list(b) for b in injected]
    best_fit(out, sorted(displaced, key=lambda i: -length[i]), length, size)
    return out


def mutated(bins: Bins, length: list[int], size: int, rng) -> Bins:
    order = sorted(range(len(bins)), key=lambda k: sum(length[i] for i in bins[k]))
    gone = {*order[:3], *rng.integers(0, len(bins), 3).tolist()}
    out = [list(b) for k, b in enumerate(bins) if k not in gone]
    loose = [i for k in gone for i in bins[k]]
    best_fit(out, sorted(loose, key=lambda i: -length[i] * rng.uniform(0.9, 1.1)), length, size)
    return out


def evolve(length: list[int], size: int, elites: list[Bins], seed: int) -> Bins:
    rng = np.random.default_rng(seed)
    least = -(-sum(length) // size)
    score = lambda b: fitness(b, length, size)
    population = list(elites)
    for shake in [0.0, *rng.uniform(0.02, 0.3, POPULATION - 1)][:max(1, POPULATION - len(elites))]:
        if any(len(b) <= least for b in population):
            break
        bins: Bins = []
        noise = 1 + shake * rng.uniform(-1, 1, len(length))
        best_fit(bins, sorted(range(len(length)), key=lambda i: -length[i] * noise[i]), length, size)
        population.append(bins)
    for _ in range(GENERATIONS):
        population.sort(key=score)
        if len(population[0]) <= least or len(population) < 2:
            break
        a, b = population[0], population[int(rng.integers(1, len(population)))]
        children = [crossover(a, b, length, size, rng), crossover(b, a, length, size, rng), mutated(a, length, size, rng)]
        population = sorted([*population, *children], key=score)[:POPULATION]
    return min(population, key=score)


# -- shards, islands and levels as Spark jobs --------------------------------------------

_NUMBERS = [("group", pa.int64()), ("island", pa.int32()), ("bin", pa.int32()), ("immigrant", pa.int32())]
_POPULATION = pa.schema([*_PIECE, *_NUMBERS])
_POPULATION_DDL = PIECE + ", group bigint, island int, bin int, immigrant int"
_ORDER = [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]


def _bins(table: pa.Table) -> Bins:
    out: dict[int, list[int]] = {}
    for i, k in enumerate(table["bin"].to_pylist()):
        out.setdefault(k, []).append(i)
    return list(out.values())


def _numbered(bins: Bins, n: int) -> np.ndarray:
    out = np.zeros(n, np.int32)
    for k, b in enumerate(bins):
        out[b] = k
    return out


def _island(table: pa.Table, size: int) -> pa.Table:
    """One epoch of an island; its own elite and an immigrant stand in rows of their own."""
    solutions = [table.filter(pc.equal(table["immigrant"], k)).sort_by(_ORDER) for k in (0, 1)]
    own = solutions[0]
    elites = [_bins(t) for t in solutions if t.num_rows and t["bin"].null_count == 0]
    island = own["island"][0].as_py()
    bins = evolve(own["length"].to_pylist(), size, elites, SEED + 1000 * island + len(elites))
    columns = {"bin": pa.array(_numbered(bins, own.num_rows))}
    return pa.table([columns.get(f.name, own[f.name]) for f in _POPULATION], schema=_POPULATION)


_PLACED = pa.schema([*_PIECE, ("group", pa.int64()), ("bin", pa.int32()), ("offset", pa.int64()), ("open", pa.bool_())])
_PLACED_DDL = PIECE + ", group bigint, bin int, offset bigint, open boolean"


def _champion(table: pa.Table, size: int, last: bool, most: int | None) -> pa.Table:
    """Places of the best island's solution; the worst bins (``most`` at most) are left open for the next level."""
    best = None
    for k in sorted(set(table["island"].to_pylist())):
        t = table.filter(pc.equal(table["island"], k)).sort_by(_ORDER)
        length = t["length"].to_pylist()
        bins = _bins(t)
        if best is None or fitness(bins, length, size) < best[0]:
            best = fitness(bins, length, size), t, bins, length
    _, t, bins, length = best
    fill = np.array([sum(length[i] for i in b) for b in bins])
    opened = np.zeros(len(bins), bool)
    if not last:
        worst = np.argsort(fill, kind="stable")
        slack = size - fill[worst]
        ahead = np.cumsum(slack) - slack
        opened[worst[(slack > 0) & (ahead < SLACK_OPENED * slack.sum())][:most]] = True
    offset = np.zeros(len(length), np.int64)
    for b in bins:
        at = 0
        for i in b:
            offset[i] = at
            at += length[i]
    number = _numbered(bins, len(length))
    made = {"bin": pa.array(number), "offset": pa.array(offset), "open": pa.array(opened[number] if len(bins) else [], pa.bool_())}
    return pa.table([made.get(f.name, t[f.name] if f.name not in made else None) for f in _PLACED], schema=_PLACED)


def _level(grouped: DataFrame, size: int, last: bool, most: int | None) -> DataFrame:
    islands = grouped.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))).withColumns(
        {"bin": F.lit(None).cast("int"), "immigrant": F.lit(0)})
    for epoch in range(EPOCHS):
        if epoch:
            migrants = islands.withColumns({"island": (F.col("island") + 1) % ISLANDS, "immigrant": F.lit(1)})
            islands = islands.unionByName(migrants)
        islands = islands.groupBy("group", "island").applyInArrow(lambda t: _island(t, size), _POPULATION_DDL)
        islands = islands.select(*(f.name for f in _POPULATION))
    return islands.groupBy("group").applyInArrow(lambda t: _champion(t, size, last, most), _PLACED_DDL)


def pack(docs: DataFrame, size: int = SEQUENCE, tokenizer: str = tokens.TOKENIZER) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    own = materialise(pieces(docs, size, tokenizer), "pieces")
    out, level, most, held = None, 0, None, own.count()
    shards = max(1, -(-held // SHARD_PIECES))
    grouped = materialise(dealt(own, shards), "dealt")
    while True:
        last = shards == 1
        placed = materialise(_level(grouped.select(*(n for n, _ in _PIECE), "group"), size, last, most), f"packed-{level}")
        closed = placed.where("NOT open").select(
            *(n for n, _ in _PIECE),
            F.struct(F.lit(level).alias("level"), "group", "bin").alias("at"), "offset")
        out = closed if out is None else out.unionByName(closed)
        opened = placed.where("open")
        left = 0 if last else opened.count()
        if not left:
            break
        if 2 * left > held:
            most = MOST_OPENED
        # fewer groups at every level, so that it ends
        held, shards, level = left, min(-(-left // SHARD_PIECES), -(-shards // 2)), level + 1
        grouped = opened.withColumn("group", F.pmod(F.xxhash64(F.lit(level), "group", "bin"), F.lit(shards)))
    # level, group and bin make one number
    number = F.col("at.level").cast("bigint") * F.lit(1 << 58) + F.col("at.group") * F.lit(1 << 14) + F.col("at.bin")
    return out.select(*(n for n, _ in _PIECE), number.alias("sequence_id"), "offset")
