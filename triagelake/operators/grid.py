"""Grid for exact scoring of every query against every corpus row.

Neither side is collected or broadcast. Queries are hashed into blocks of bounded
size, the corpus into runs, so that there are as many cells as cores to use. A cell is
one query block and one run: its task holds the queries, streams the run batch by
batch, scores each batch with numpy and keeps what can still reach a result. A cell
emits once, at its end, a few rows per query, so output grows with the number of runs,
not with the corpus; a corpus row is sent once per query block, a query row once per
run. Where answers are many, blocks and runs are weighed against each other so that
the least is moved.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.session import ship_package

# a block of 1024-element vectors in two views is 80 MB of doubles
QUERY_BLOCK_ROWS = 5_000
# corpus rows below which a further run is of no use
SMALL_RUN_ROWS = 2_000
# queries below which a further block is of no use, but for memory
SMALL_BLOCK_ROWS = 100
# answers that cost as much to move as a corpus row of two views of 32 doubles
ANSWERS_A_ROW = 16
# doubles in one score matrix inside a task (64 MB)
SCORE_CELLS = 8_000_000
# similarities are compared after rounding, so that the order does not depend on
# how a matrix product sums
SCORE_DECIMALS = 9


class Cell(Protocol):
    """One query block against a run; rows of a batch come in the order of their keys."""

    def add(self, batch: pa.Table) -> None: ...

    def result(self) -> pa.Table: ...


def _sizes(
    queries: DataFrame, corpus: DataFrame, query_rows: int, runs: int | None, answers: int = 0
) -> tuple[Column, Column]:
    """Numbers of query blocks and of runs, as scalar subqueries inside the job.

    b blocks and r runs move the corpus b times and the queries with their answers r
    times. With b * r = cores that is least where both cost the same; it then grows with
    the tables, until the blocks are as many as the cores by their bounded size alone."""
    cores = queries.sparkSession.sparkContext.defaultParallelism
    blocks = F.greatest(F.ceil(F.count("*") / query_rows), F.lit(1)).cast("int")
    n_query = queries.agg(blocks).scalar()
    if runs is not None:
        return n_query, F.lit(runs)
    useful = F.greatest(F.ceil(F.count("*") / SMALL_RUN_ROWS), F.lit(1)).cast("int")
    n_corpus = corpus.agg(useful).scalar()
    most = F.least(n_corpus, F.greatest(F.ceil(F.lit(cores) / n_query), F.lit(1)).cast("int"))
    if not answers:
        return n_query, most
    asked, known = (F.greatest(df.agg(F.count("*")).scalar(), F.lit(1)).cast("double") for df in (queries, corpus))
    even = F.round(F.sqrt(cores * known / (asked * (1 + answers / ANSWERS_A_ROW)))).cast("int")
    n_runs = F.least(most, F.greatest(even, F.lit(1)))
    spread = F.least(F.ceil(F.lit(cores) / n_runs), F.ceil(asked / SMALL_BLOCK_ROWS)).cast("int")
    return F.greatest(n_query, spread), n_runs


def on_grid(
    queries: DataFrame, corpus: DataFrame, query_key: str, key: str,
    make_cell: Callable[[pa.Table], Cell], schema: str,
    query_rows: int = QUERY_BLOCK_ROWS, runs: int | None = None, sized_by: DataFrame | None = None, stored: bool = False,
    answers: int = 0,
) -> DataFrame:
    """Run ``make_cell(query block)`` on every run of the corpus. ``runs`` sets their number,
    otherwise ``answers``, the rows that a cell may emit or carry a query, helps to choose it.
    With ``stored`` the corpus is a table whose files are the runs: it stays where it
    is, and the queries, one block that the caller has counted, are sent to its tasks."""
    ship_package(queries.sparkSession)
    if stored:
        return _on_stored(queries, corpus, key, make_cell, schema, query_rows)
    n_query, n_runs = _sizes(sized_by if sized_by is not None else queries.select(query_key), corpus.select(key), query_rows, runs, answers)

    def placed(df: DataFrame, side: int, own: str, by: str, other: str) -> DataFrame:
        # fresh column ids: both sides may stem from one table
        fields = F.struct(*[F.col(c).alias(c) for c in df.columns]).alias("_left" if side == 0 else "_right")
        return (
            df.select(fields, F.col(by).alias("_by"), F.lit(side).alias("_side"), n_query.alias("_nq"), n_runs.alias("_nr"))
            .withColumn(own, F.pmod(F.xxhash64("_by"), F.col("_nq" if own == "_q" else "_nr")).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col("_nr" if other == "_r" else "_nq") - 1)))
            .drop("_nq", "_nr")
        )

    left, right = placed(queries, 0, "_q", query_key, "_r"), placed(corpus, 1, "_r", key, "_q")
    rows = left.unionByName(right, allowMissingColumns=True).select("_q", "_r", "_side", "_by", "_left", "_right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asked, cell = None, [], None
        for batch in batches:
            place = np.stack([batch.column(n).to_numpy() for n in ("_q", "_r", "_side")], axis=1)
            edges = [0, *(np.flatnonzero((np.diff(place, axis=0) != 0).any(axis=1)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(edges, edges[1:]):
                if hi == lo:
                    continue
                if at != tuple(place[lo, :2]):
                    if cell is not None:
                        yield from cell.result().to_batches()
                    at, asked, cell = tuple(place[lo, :2]), [], None
                part = batch.slice(lo, hi - lo)
                if place[lo, 2] == 0:
                    asked.append(_fields(part, "_left"))
                elif asked:
                    cell = cell or make_cell(pa.concat_tables(asked).combine_chunks())
                    cell.add(_fields(part, "_right"))
        if cell is not None:
            yield from cell.result().to_batches()

    return rows.repartition("_q", "_r").sortWithinPartitions("_q", "_r", "_side", "_by").mapInArrow(run, schema)


def _on_stored(
    queries: DataFrame, corpus: DataFrame, key: str, make_cell: Callable[[pa.Table], Cell], schema: str, query_rows: int
) -> DataFrame:
    block = queries.limit(query_rows + 1).toArrow()
    if len(block) > query_rows:
        raise ValueError(f"more than {query_rows} queries: not a block")
    sent = queries.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = make_cell(sent.value.combine_chunks()) if len(sent.value) else None
        for batch in batches:
            if cell is not None and batch.num_rows:
                cell.add(sorted_by(pa.Table.from_batches([batch]), key))
        if cell is not None:
            yield from cell.result().to_batches()

    # as many runs as cores, put together without moving rows: what leaves them is bounded
    return corpus.coalesce(corpus.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, schema)


def _fields(batch: pa.RecordBatch, name: str) -> pa.Table:
    column = batch.column(batch.schema.get_field_index(name))
    return pa.Table.from_arrays(column.flatten(), names=[f.name for f in column.type])


class Heads:
    """The k best rows of every query over the batches seen: score, key and what comes along.
    Equal scores are ordered by key, in whatever order batches come. Gathered rows wait until
    they are as many as the heads themselves, or until ``settle``."""

    def __init__(self, n: int, k: int):
        self.n, self.k, self.row, self.score, self.key, self.more = n, k, np.zeros(0, np.int64), np.zeros(0), np.zeros(0, object), None
        self.waiting, self.n_waiting, self.bars = [], 0, np.full(n, -np.inf)

    def add(self, rows: np.ndarray, score: np.ndarray, key: np.ndarray, *more: np.ndarray) -> None:
        self.waiting.append((rows, score, key, *more))
        self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        kept = self.more if self.more is not None else [m[:0] for m in self.waiting[0][3:]]
        row, score, keys, *more = (np.concatenate(x) for x in zip((self.row, self.score, self.key, *kept), *self.waiting))
        order = _ties_by_key(np.lexsort((-score, row)), row, score, keys)
        start = np.searchsorted(row[order], np.arange(self.n))
        order = order[np.arange(len(order)) - start[row[order]] < self.k]
        self.row, self.score, self.key, self.more = row[order], score[order], keys[order], [m[order] for m in more]
        self.waiting, self.n_waiting = [], 0
        start = np.searchsorted(self.row, np.arange(self.n + 1))
        full = np.diff(start) >= self.k
        self.bars[full] = self.score[start[1:][full] - 1]

    def bar(self, part: slice) -> np.ndarray:
        """What a row of each query must reach to get in."""
        return self.bars[part].copy()

    def offer(self, part: slice | np.ndarray, scores: np.ndarray, keys: np.ndarray, *more: np.ndarray) -> None:
        self.gather(part, scores, keys, *more)
        self.settle()

    def gather(
        self, part: slice | np.ndarray, scores: np.ndarray, keys: np.ndarray, *more: np.ndarray,
        near: float = 0.0, exact: Callable[[np.ndarray, np.ndarray], tuple] | None = None,
    ) -> None:
        """Scores of some queries, a range or their places, against the rows of ``keys``. With
        ``exact`` they are only known to be within ``near`` of those that count, which it gives
        for the (rows, columns) that can get in, with what comes along."""
        bars = self.bars[part]
        taken = exact or (lambda rows, cols: (scores[rows, cols], *(m[rows, cols] for m in more)))
        rows, cols = np.nonzero(scores >= bars[:, None] - near)
        if rows.size > self.k * len(scores):
            rows, cols = best_columns(scores, self.k, near, exact)
        if not rows.size:
            return
        found, *along = taken(rows, cols)
        inside = found >= bars[rows]
        places = np.arange(part.start, part.stop) if isinstance(part, slice) else part
        self.waiting.append((places[rows[inside]], found[inside], keys[cols[inside]], *(m[inside] for m in along)))
        self.n_waiting += int(np.count_nonzero(inside))
        if self.n_waiting > self.n * self.k:
            self.settle()


def _ties_by_key(order: np.ndarray, row: np.ndarray, score: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The order with runs of equal row and score sorted by key; only those are compared."""
    same = (np.diff(row[order]) == 0) & (np.diff(score[order]) == 0)
    if not same.any():
        return order
    tied = np.flatnonzero(np.append(same, False) | np.append(False, same))
    run = np.cumsum(~np.append(False, same))[tied]
    rank = np.unique(keys[order[tied]].astype(str), return_inverse=True)[1]
    order[tied] = order[tied][np.lexsort((rank, run))]
    return order


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = pc.list_flatten(column.combine_chunks()).to_numpy(zero_copy_only=False)
    return values.astype(np.float64, copy=False).reshape(len(column), -1)


def sorted_by(table: pa.Table, key: str) -> pa.Table:
    return table.take(pc.sort_indices(table, [(key, "ascending")]))


def query_slices(n_queries: int, n_corpus: int):
    step = max(1, SCORE_CELLS // max(1, n_corpus))
    for lo in range(0, n_queries, step):
        yield slice(lo, min(lo + step, n_queries))


def best_columns(
    scores: np.ndarray, k: int, near: float = 0.0, exact: Callable[[np.ndarray, np.ndarray], tuple] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best columns of every row, best first; equal scores
    go to the lower column. ``near`` and ``exact`` are those of ``Heads.gather``."""
    n = scores.shape[1]
    if n > k:
        floor = np.partition(scores, n - k, axis=1)[:, n - k]
        rows, cols = np.nonzero(scores >= floor[:, None] - 2 * near)  # k rows reach floor - near for certain
    else:
        rows, cols = np.nonzero(np.ones(scores.shape, dtype=bool))
    found = exact(rows, cols)[0] if exact else scores[rows, cols]
    order = np.lexsort((cols, -found, rows))
    rows, cols = rows[order], cols[order]
    start = np.searchsorted(rows, np.arange(scores.shape[0]))
    keep = np.arange(rows.size) - start[rows] < k
    return rows[keep], cols[keep]


def equal_codes(left: pa.ChunkedArray, right: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Integer codes that agree where values agree; NULL never agrees."""
    both = pd.concat([left.to_pandas(), right.to_pandas()], ignore_index=True)
    codes = pd.factorize(both)[0]
    a, b = codes[: len(left)], codes[len(left):]
    return np.where(a < 0, -1, a), np.where(b < 0, -2, b)
