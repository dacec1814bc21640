"""BM25 and the hybrid of vector and lexical scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagelake import constants as C
from triagelake.functions import scalars as S
from triagelake.functions import text as X
from triagelake.operators import grid, retrieval
from triagelake.session import materialise, ship_package


def tokenised(df: DataFrame, text: str) -> DataFrame:
    return df.select("key", X.tokens(F.col(text)).alias("words"))


@dataclass
class Lexicon:
    """A corpus tokenised once: what every reader of its words needs, stored."""

    docs: DataFrame  #: key, length, words (term, tf)
    idf: DataFrame  #: term, idf


_COUNTED = "key string, length int, words array<struct<term:string,tf:int>>"


def counted(docs: DataFrame) -> DataFrame:
    """key, number of words, and every different word with how often it occurs. Texts
    stay where they are; a batch is counted at once."""
    ship_package(docs.sparkSession)
    kind = pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("words")
            length = pc.fill_null(pc.list_value_length(lists), 0)
            words = pc.list_flatten(lists).dictionary_encode()
            doc = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            size = max(1, len(words.dictionary))
            pairs, times = np.unique(doc * size + words.indices.to_numpy(zero_copy_only=False), return_counts=True)
            bounds = np.searchsorted(pairs, np.arange(batch.num_rows + 1) * size).astype(np.int32)
            inner = pa.StructArray.from_arrays([words.dictionary.take(pa.array(pairs % size)), pa.array(times.astype(np.int32))], fields=list(kind.value_type))
            yield pa.record_batch([batch.column("key"), length, pa.ListArray.from_arrays(pa.array(bounds), inner)], ["key", "length", "words"])

    return docs.select("key", "words").mapInArrow(work, _COUNTED)


def lexicon(docs: DataFrame) -> Lexicon:
    """``docs`` (key, words) counted and stored (a job), with the inverse frequencies. A
    negative idf becomes a share of the mean."""
    known = materialise(counted(docs), "term-counts")
    n = known.agg(F.count("*")).scalar()
    df = materialise(known.select(F.inline("words")).groupBy("term").agg(F.count("*").alias("df")), "document-frequency")
    raw = df.select("term", (F.log(n - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("raw_idf"))
    floor = raw.agg(C.BM25_EPSILON * F.avg("raw_idf")).scalar()
    return Lexicon(known, raw.select("term", F.when(F.col("raw_idf") < 0, floor).otherwise(F.col("raw_idf")).alias("idf")))


def query_terms(queries: DataFrame, corpus: Lexicon) -> DataFrame:
    """query_key, term, weight = idf times the number of times the query says it.
    A term occurs once per query here, and AQE splits what is still skewed."""
    said = counted(queries).select(F.col("key").alias("query_key"), F.inline("words"))
    return said.join(corpus.idf, "term").select("query_key", "term", (F.col("tf") * F.col("idf")).alias("weight"))


def _numbered(queries: DataFrame, corpus: Lexicon) -> tuple[DataFrame, DataFrame]:
    """A number for every term of a query (term, id), stored, and the queries' terms by
    number (query_key, terms, weights)."""
    weighted = materialise(query_terms(queries, corpus), "query-terms")
    numbers = materialise(weighted.select("term").distinct().withColumn("id", F.monotonically_increasing_id()), "term-numbers")
    terms = weighted.join(numbers, "term").groupBy("query_key").agg(F.collect_list(F.struct("id", "weight")).alias("_t"))
    return numbers, terms.select("query_key", F.col("_t.id").alias("terms"), F.col("_t.weight").alias("weights"))


def _norm(corpus: Lexicon) -> Column:
    """The length part of the term-frequency denominator."""
    mean = corpus.docs.agg(F.avg("length")).scalar()
    return (C.BM25_K1 * (1 - C.BM25_B + C.BM25_B * F.col("length") / mean)).alias("norm")


#: A score must be this far below a bar to be left out unrounded.
_MARGIN = 1e-8
#: Contributions that are summed up at once.
_AT_ONCE = 1 << 22
#: A posting costs about as much as so many cells of a matrix product.
_CELLS_A_POSTING = 512
#: Looking one value up costs about as much as adding so many postings.
_POSTINGS_A_LOOKUP = 4


class Scorer:
    """BM25 of a block of queries against batches of documents; terms are numbers.

    Terms that many queries and many documents of a batch share are summed up by a matrix
    product, all others posting by posting. The largest value of a term in a batch bounds what it can add there. Of a query whose
    list is full, the terms whose bounds together stay under the bar can lift no
    document into the list by themselves: the other terms and the product come first, and
    what is left only where the sum can still reach the bar. Nothing that could get in is
    left out, so the lists are exact."""

    def __init__(self, terms: pa.ChunkedArray, weights: pa.ChunkedArray, k: int):
        terms, weights = terms.combine_chunks(), weights.combine_chunks()
        self.n = len(terms)
        ids = pc.list_flatten(terms).to_numpy(zero_copy_only=False)
        self.query = pc.list_parent_indices(terms).to_numpy(zero_copy_only=False).astype(np.int64)
        self.weight = pc.list_flatten(weights).to_numpy(zero_copy_only=False)
        self.vocabulary, self.term = np.unique(ids, return_inverse=True)
        self.heads = grid.Heads(self.n, k)
        self.scored = 0  #: postings that were added to a score one by one

    def add(self, words: pa.ChunkedArray, norm: np.ndarray, keys: np.ndarray) -> None:
        lists, size = words.combine_chunks(), len(self.vocabulary)
        flat = pc.list_flatten(lists)
        id_, tf = (pc.struct_field(flat, f).to_numpy(zero_copy_only=False) for f in ("id", "tf"))
        doc = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.searchsorted(self.vocabulary, id_)
        known = self.vocabulary[np.minimum(at, size - 1)] == id_ if size else np.zeros(len(id_), bool)
        term, doc, tf = at[known], doc[known], tf[known]
        order = np.lexsort((doc, term))
        term, doc, tf = term[order], doc[order], tf[order]
        value = tf * (C.BM25_K1 + 1) / (tf + norm[doc])
        start = np.searchsorted(term, np.arange(size + 1))
        most = np.zeros(size)
        held = np.flatnonzero(np.diff(start))
        most[held] = np.maximum.reduceat(value, start[held]) if len(held) else 0.0
        bar = self.heads.bar(slice(0, self.n))
        bound = np.maximum(self.weight, 0.0) * most[self.term]
        by_bound = np.lexsort((bound, self.query))
        entries = np.searchsorted(self.query, np.arange(self.n + 1))
        total = np.concatenate([[0.0], np.cumsum(bound[by_bound])])
        spare = total[1:] - total[entries[:-1]][self.query] < bar[self.query] - _MARGIN  # in the order of by_bound
        column, cells = self._in_common(start, term, doc, value, len(keys))
        alone = column[self.term[by_bound]] < 0
        rest = np.bincount(self.query[by_bound][spare & alone], bound[by_bound][spare & alone], self.n)
        postings = _Postings(start, term * len(keys) + doc, doc, value, len(keys))
        for part in grid.query_slices(self.n, len(keys)):
            inside = slice(entries[part.start], entries[part.stop])
            mine, first, single = by_bound[inside], ~spare[inside], alone[inside]
            weights = np.zeros((part.stop - part.start, len(cells)))
            shared = mine[~single]  # rows of one key have their words twice
            np.add.at(weights, (self.query[shared] - part.start, column[self.term[shared]]), self.weight[shared])
            self._score(part, (weights @ cells).ravel(), mine[single & first], mine[single & ~first], postings, bar, rest, keys)

    def _in_common(self, start: np.ndarray, term: np.ndarray, doc: np.ndarray, value: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The terms that a product sums up at less cost than their postings, those with the
        most postings first as far as the matrix may grow: their rows (-1: none) and the matrix."""
        size = len(self.vocabulary)
        work = np.diff(start) * np.bincount(self.term, minlength=size)
        most = grid.SCORE_CELLS // max(1, self.n, width)
        found = np.argsort(-work, kind="stable")[:most]
        found = found[work[found] * _CELLS_A_POSTING > self.n * width]
        column = np.full(size, -1)
        column[found] = np.arange(len(found))
        cells = np.zeros((len(found), width))
        held = np.flatnonzero(column[term] >= 0) if size else np.zeros(0, np.int64)
        np.add.at(cells, (column[term[held]], doc[held]), value[held])
        return column, cells

    def _score(self, part: slice, sums: np.ndarray, entries: np.ndarray, others: np.ndarray, postings: _Postings, bar: np.ndarray, rest: np.ndarray, keys: np.ndarray) -> None:
        n, width = part.stop - part.start, postings.width

        def add_all(entries: np.ndarray) -> None:
            for some in _groups(postings.sizes(self.term[entries])):
                some = entries[some]
                which, place = postings.of(self.term[some])
                pair = (self.query[some] - part.start)[which] * width + postings.doc[place]
                self.scored += len(pair)
                sums[:] += np.bincount(pair, self.weight[some][which] * postings.value[place], n * width)

        add_all(entries)
        bar, rest = bar[part], rest[part]
        open_ = np.flatnonzero(bar <= 0)  # any document may get in, those without a common word too
        if len(open_):
            scores = retrieval._rounded(sums.reshape(n, width)[open_])
            rows, cols = grid.best_columns(scores, self.heads.k)
            inside = scores[rows, cols] >= bar[open_][rows]
            rows, cols = rows[inside], cols[inside]
            self.heads.add(open_[rows] + part.start, scores[rows, cols], keys[cols])
        near = sums.reshape(n, width) >= (bar - rest - _MARGIN)[:, None]
        near[open_] = False
        pair = np.flatnonzero(near)
        row = pair // width
        at = np.searchsorted(self.query[others], np.arange(part.start, part.stop + 1))
        if np.diff(at)[row].sum() * _POSTINGS_A_LOOKUP > postings.sizes(self.term[others]).sum():
            add_all(others)
            others = others[:0]
        score = sums[pair]
        if len(others) and len(pair):
            for some in _groups(np.diff(at)[row]):
                which, entry = _expanded(at[row[some]], np.diff(at)[row[some]])
                entry = others[entry]
                value = postings.lookup(self.term[entry], (pair[some] % width)[which])
                self.scored += int(np.count_nonzero(value))
                score[some] += np.bincount(which, self.weight[entry] * value, len(some))
        score = retrieval._rounded(score)
        inside = score >= bar[row]
        self.heads.add(row[inside] + part.start, score[inside], keys[pair[inside] % width])


@dataclass
class _Postings:
    """The documents of a batch by term: ascending in (term, document)."""

    start: np.ndarray
    place: np.ndarray  #: term * width + document
    doc: np.ndarray
    value: np.ndarray
    width: int

    def sizes(self, terms: np.ndarray) -> np.ndarray:
        return self.start[terms + 1] - self.start[terms]

    def of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _expanded(self.start[terms], self.sizes(terms))

    def lookup(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        wanted = terms * self.width + docs
        at = np.minimum(np.searchsorted(self.place, wanted), max(0, len(self.place) - 1))
        return np.where(self.place[at] == wanted, self.value[at], 0.0) if len(self.place) else np.zeros(len(wanted))


def _expanded(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which range, and the place in it, of all places of the ranges."""
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[which]


def _groups(sizes: np.ndarray) -> list[np.ndarray]:
    """Items in groups of bounded total size (a larger one stands alone)."""
    if not len(sizes):
        return []
    part = np.cumsum(sizes) // _AT_ONCE
    return np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(part)) + 1)


def bm25_top_k(queries: DataFrame, docs: DataFrame, k: int, corpus: Lexicon | None = None, **block_rows: int) -> DataFrame:
    """Best k documents per query (documents without a common word score 0):
    query_key, key, score, rk. ``queries`` and ``docs`` hold key and words; who has the
    lexicon of ``docs`` already gives it.

    Joining queries and documents on common words would emit almost all pairs.
    Here queries meet the documents batch by batch, and only k rows per query and run
    leave the task. Documents travel with the numbers of the words that queries have."""
    corpus = corpus or lexicon(docs)
    numbers, terms = _numbered(queries, corpus)
    asking = queries.select(F.col("key").alias("query_key")).join(terms, "query_key", "left").select(
        "query_key", _or_none("terms", "array<bigint>").alias("terms"), _or_none("weights", "array<double>").alias("weights"))
    used = corpus.docs.select("key", F.inline("words")).join(numbers, "term").groupBy("key").agg(F.collect_list(F.struct("id", "tf")).alias("words"))
    known = corpus.docs.select("key", _norm(corpus)).join(used, "key", "left").select("key", "norm", _or_none("words", "array<struct<id:bigint,tf:int>>").alias("words"))

    class Cell:
        def __init__(self, left: pa.Table):
            self.left, self.scorer = left, Scorer(left["terms"], left["weights"], k)

        def add(self, right: pa.Table) -> None:
            self.scorer.add(right["words"], right["norm"].to_numpy(), right["key"].to_numpy())

        def result(self) -> pa.Table:
            h = self.scorer.heads
            return pa.table({"query_key": self.left["query_key"].take(pa.array(h.row)), "key": pa.array(h.key, pa.string()), "score": pa.array(h.score)})

    hits = grid.on_grid(
        asking, known, "query_key", "key", Cell,
        "query_key string, key string, score double", sized_by=queries.select("key"), **block_rows,
    )
    w = Window.partitionBy("query_key").orderBy(F.desc("score"), "key")
    return hits.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k)


def _or_none(x: str, kind: str) -> Column:
    return F.coalesce(F.col(x), F.array().cast(kind))


_BOTH = "query_key string, key string, bm25 double"
#: Words of pairs that are looked up at once.
_WORDS_AT_ONCE = 1 << 20


def bm25_of_pairs(pairs: DataFrame, queries: DataFrame, docs: DataFrame, corpus: Lexicon | None = None) -> DataFrame:
    """Adds bm25 to given (query_key, key) rows. A pair meets its document's words as one
    row of numbers, and so its query's: bounded by the candidates per query."""
    corpus = corpus or lexicon(docs)
    wanted = pairs.select("query_key", "key")
    numbers, asked = _numbered(queries, corpus)
    used = corpus.docs.select("key", "words", _norm(corpus)).join(wanted.select("key").distinct(), "key", "left_semi")
    # rows of one key and norm are one: their words add up
    known = used.select("key", "norm", F.inline("words")).join(numbers, "term").groupBy("key", "norm").agg(
        F.collect_list("id").alias("id"), F.collect_list("tf").alias("tf"))
    scored = wanted.join(known, "key").join(asked, "query_key").mapInArrow(_scores_of_pairs, _BOTH)
    scored = scored.groupBy("query_key", "key").agg(F.sum("bm25").alias("bm25"))
    return pairs.join(scored, ["query_key", "key"], "left").withColumn(
        "bm25", S.round_half_up(F.coalesce("bm25", F.lit(0.0)), grid.SCORE_DECIMALS)
    )


def _scores_of_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = sum(_lengths(batch.column(n)) for n in ("id", "terms"))
        part = np.cumsum(size) // _WORDS_AT_ONCE
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            some = batch.slice(lo, hi - lo)
            yield pa.record_batch([some.column("query_key"), some.column("key"), pa.array(_sums(some), pa.float64())], ["query_key", "key", "bm25"])


def _lengths(lists: pa.ListArray) -> np.ndarray:
    return pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def _sums(batch: pa.RecordBatch) -> np.ndarray:
    """The score of every row: its words are found among its query's by row and number."""
    def flat(name: str) -> np.ndarray:
        return pc.list_flatten(batch.column(name)).to_numpy(zero_copy_only=False)

    def rows(name: str) -> np.ndarray:
        return np.repeat(np.arange(batch.num_rows), _lengths(batch.column(name)))

    vocabulary, code = np.unique(flat("terms"), return_inverse=True)
    at = np.searchsorted(vocabulary, flat("id"))
    known = np.append(vocabulary, -1)[at] == flat("id")
    row, tf = rows("id")[known], flat("tf")[known]
    asked, place = np.unique(rows("terms") * len(vocabulary) + code, return_inverse=True)
    weight = np.bincount(place, flat("weights"), len(asked))
    wanted = row * len(vocabulary) + at[known]
    at = np.searchsorted(asked, wanted)
    hit = np.append(asked, -1)[at] == wanted
    row, tf, norm = row[hit], tf[hit], batch.column("norm").to_numpy(zero_copy_only=False)
    return np.bincount(row, weight[at[hit]] * tf * (C.BM25_K1 + 1) / (tf + norm[row]), batch.num_rows)


def min_max(x: str, by: str = "query_key") -> Column:
    """Rescale to [0, 1] inside a query's candidates; a flat range gives 0."""
    w = Window.partitionBy(by)
    lo, hi = F.min(x).over(w), F.max(x).over(w)
    return F.when(hi - lo < 1e-9, 0.0).otherwise((F.col(x) - lo) / (hi - lo))


def hybrid_top(
    candidates: DataFrame, queries: DataFrame, corpus: DataFrame, text: str = "text_noco",
    k: int = C.FINAL_K, share: float = 0.5, words: Lexicon | None = None,
) -> DataFrame:
    """Re-rank fused candidates by rescaled rrf and BM25: adds bm25, score, rk."""
    scored = bm25_of_pairs(candidates, tokenised(queries, text), tokenised(corpus, text), words)
    mixed = share * min_max("rrf") + (1 - share) * min_max("bm25")
    mixed = scored.withColumn("score", S.round_half_up(mixed, grid.SCORE_DECIMALS))
    return retrieval.keep_best(mixed, k)
