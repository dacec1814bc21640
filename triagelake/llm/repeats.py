"""Substring dedup by fixed-block anchors.

A repeat of ``window`` words holds a whole block of the text where it stands first, if
the blocks are the non-overlapping runs of (window + 1) / 2 words of every text. All
blocks are the reference index, all rolling runs of that length probe it. Hits are
extended to the windows around them, which are compared by a 96-bit key over the
whole window; windows whose sequence also starts in a document with a smaller id are
marked, and the marks of one text merge to maximal repeats, which are cut.

Texts are dealt out in chunks. A chunk sends its distinct keys to hash buckets, packed
in one row for each bucket, and gets back those that matter to it: a sequence that
stands in very many texts is one key of a chunk, and no pair of texts is ever made.

Null texts have no words. Rows with one id don't remove each other's words; a null id
comes after all ids. A text without repeats stays as it is. Columns named like those
added are replaced, others are carried along. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from triagelake.llm import spread
from triagelake.llm.spread import bucketed, cuts, packed, received
from triagelake.llm.words import Words, words_of
from triagelake.session import ship_package

WINDOW_WORDS = 13
LAST = np.iinfo(np.int64).max


def _probes(w: Words, window: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key of the run of words from each word on, whether it counts, whether it is a block."""
    size = (window + 1) // 2
    runs, whole = w.windows(w.hashes(), size)
    text = w.text_of[:len(runs)]
    whole &= np.diff(w.bounds)[text] >= window
    block = (np.arange(len(runs)) - w.bounds[:-1][text]) % size == 0
    return bucketed(runs, buckets), whole, block & whole


def _send_probes(table: pa.Table, window: int, buckets: int) -> spread.Sends:
    keys, whole, block = _probes(words_of(table["text"]), window, buckets)
    keys, block = keys[whole], block[whole]
    order = np.argsort(keys)
    keys, block = keys[order], block[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] + np.uint64(1)))
    if not len(first):
        return
    block = np.logical_or.reduceat(block, first)
    again = np.diff(np.append(first, len(keys))) > 1
    keys = keys[first]
    chunk = table["_to"][0].as_py()
    for bucket, at in cuts(keys):
        flags = np.packbits(block[at]).tobytes(), np.packbits(again[at]).tobytes()
        yield bucket, chunk, 0, packed(keys[at].astype(np.uint32)), *flags


def _hits(table: pa.Table) -> spread.Sends:
    """Back to every chunk: its keys that are a block somewhere and stand in two places."""
    keys = received(table, "a", np.uint32)
    sizes = [len(k) for k in keys]
    bits = lambda column: np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(table[column].to_pylist(), sizes)])
    all_keys, block, again = np.concatenate(keys), bits("b"), bits("c")
    order = np.argsort(all_keys, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], np.diff(all_keys[order]) > 0]))
    counts = np.diff(np.append(first, len(order)))
    hit = (np.maximum.reduceat(block[order], first) > 0) & ((counts > 1) | (np.maximum.reduceat(again[order], first) > 0))
    mask = np.empty(len(order), bool)
    mask[order] = np.repeat(hit, counts)
    ends = np.cumsum(sizes)
    for k, chunk, a, b in zip(keys, table["_from"].to_pylist(), ends - sizes, ends):
        if mask[a:b].any():
            yield chunk, table["_to"][0].as_py(), 0, packed(k[mask[a:b]]), b"", b""


def _joined(table: pa.Table, column: str, kind: int) -> np.ndarray:
    """32-bit values of the answers, with their buckets in the high half, ascending."""
    rows = table.filter(pc.equal(table["kind"], kind)).sort_by("_from")
    parts = [unp.astype(np.uint64) | np.uint64(bucket << 32) for unp, bucket in zip(received(rows, column, np.uint32), rows["_from"].to_pylist())]
    return np.concatenate([*parts, np.zeros(0, np.uint64)])


def _among(keys: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    if not len(ascending):
        return np.zeros(len(keys), bool)
    return ascending[np.minimum(np.searchsorted(ascending, keys), len(ascending) - 1)] == keys


class _Candidates:
    """Windows of a chunk around its hits: place, text, key (64 and 32 bits)."""

    def __init__(self, table: pa.Table, answers: pa.Table, window: int, buckets: int):
        self.words = w = words_of(table["text"])
        keys, whole, _ = _probes(w, window, buckets)
        hit = whole & _among(keys, _joined(answers, "a", 0))
        size = (window + 1) // 2
        self.ids = pc.fill_null(table["doc_id"], pa.scalar(LAST, pa.int64())).to_numpy()
        n = max(0, len(w.starts) - window + 1)
        near = np.concatenate([[0], np.cumsum(hit)])
        reach = window - size + 1
        text = w.text_of
        inside = text[:n] == text[window - 1:] if n else np.zeros(0, bool)
        self.at = np.flatnonzero(inside & (near[reach:reach + n] > near[:n]))
        if not len(self.at):
            self.key = np.zeros(0, np.uint64)
            self.check = np.zeros(0, np.uint32)
        else:
            self.key = bucketed(w.windows(w.hashes(), window)[0][self.at], buckets)
            self.check = w.windows(w.hashes(1), window, 1)[0][self.at].astype(np.uint32)
        self.id = self.ids[text[self.at]] if len(self.at) else np.zeros(0, np.int64)
        self.order = np.lexsort((self.id, self.check, self.key))
        k, c = self.key[self.order], self.check[self.order]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
        self.first = np.flatnonzero(new)
        self.run = np.cumsum(new) - 1
        self.least = self.id[self.order][self.first]


def _send_windows(table: pa.Table, answers: pa.Table, window: int, buckets: int) -> spread.Sends:
    if not table.num_rows or not answers.num_rows:
        return
    c = _Candidates(table, answers, window, buckets)
    key, check = c.key[c.order][c.first], c.check[c.order][c.first]
    chunk = table["_to"][0].as_py()
    for bucket, at in cuts(key):
        yield bucket, chunk, 1, packed(key[at].astype(np.uint32)), packed(check[at]), packed(c.least[at])


def _owners(table: pa.Table) -> spread.Sends:
    """Back to every chunk: windows that a smaller id has in another chunk, as places in
    what it sent, and that id."""
    keys, checks, ids = (received(table, x, t) for x, t in (("a", np.uint32), ("b", np.uint32), ("c", np.int64)))
    sizes = [len(k) for k in keys]
    key = np.concatenate(keys).astype(np.uint64) << np.uint64(32) | np.concatenate(checks)
    own = np.concatenate(ids)
    order = np.argsort(key, kind="stable")
    first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
    least = np.empty(len(own), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(own[order], first), np.diff(np.append(first, len(order))))
    ends = np.cumsum(sizes)
    for chunk, a, b in zip(table["_from"].to_pylist(), ends - sizes, ends):
        at = np.flatnonzero(least[a:b] < own[a:b])
        if len(at):
            yield chunk, table["_to"][0].as_py(), 1, b"", packed(at.astype(np.uint32)), packed(least[a:b][at])


def _removed(c: _Candidates, answers: pa.Table, window: int) -> np.ndarray:
    """Whether each word of the chunk lies in a window that is to go."""
    least = c.least.copy()
    of_bucket = {bucket: at for bucket, at in cuts(c.key[c.order][c.first])}
    rows = answers.filter(pc.equal(answers["kind"], 1))
    for bucket, places, ids in zip(rows["_from"].to_pylist(), received(rows, "b", np.uint32), received(rows, "c", np.int64)):
        at = of_bucket[bucket].start + places.astype(np.int64)
        least[at] = np.minimum(least[at], ids)
    out = np.zeros(len(c.words.starts) + 1, np.int32)
    gone = c.at[c.order][least[c.run] < c.id[c.order]]
    out[gone] += 1
    np.subtract.at(out, gone + window, 1)
    return np.cumsum(out)[:-1] > 0


def _cut(table: pa.Table, answers: pa.Table, window: int, buckets: int, target: pa.Schema) -> pa.Table:
    c = _Candidates(table, answers, window, buckets)
    w, gone = c.words, _removed(c, answers, window)
    counts = np.diff(np.concatenate([[0], np.cumsum(gone)])[w.bounds])
    texts = table["text"].combine_chunks()
    changed = {}
    for i in np.flatnonzero(counts).tolist():
        a, b = w.bounds[i], w.bounds[i + 1]
        edge = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=0, append=0)).tolist()
        places = np.append(w.starts[a:b], w.offsets[i + 1])
        at, parts = w.offsets[i], []
        for x, y in zip(edge[::2], edge[1::2]):
            parts.append(w.data[at:places[x]].tobytes())
            at = places[y]
        changed[i] = b"".join([*parts, w.data[at:w.offsets[i + 1]].tobytes()]).decode()
    if changed:
        values = texts.to_pylist()
        for i, text in changed.items():
            values[i] = text
        texts = pa.array(values, target.field("text").type)
    made = {"text": texts, "n_words": pa.array(np.diff(w.bounds)), "n_removed": pa.array(counts.astype(np.int64))}
    return pa.table([(made[f.name] if f.name in made else table[f.name]).cast(f.type) for f in target], schema=target)


def cut_repeats(docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` with repeats cut out of text, plus n_words (before) and n_removed."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    docs = spread.folded(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")).drop("n_words", "n_removed"), "doc_id", "text")
    size = spread.total_bytes(docs, "text")
    n_chunks, buckets = 1 + size // spread.CHUNK_BYTES, 1 + size // (6 * spread.BUCKET_HASHES)
    chunks = spread.in_chunks(docs, docs.columns, n_chunks)
    hits = spread.answer(spread.emit(chunks, lambda t: _send_probes(t, window, buckets)), _hits)
    owners = spread.answer(spread.emit(chunks, lambda t, more: _send_windows(t, more, window, buckets), hits), _owners)
    schema = StructType([*docs.schema.fields, StructField("n_words", LongType()), StructField("n_removed", LongType())])
    target = to_arrow_schema(schema)

    def finish(table: pa.Table, more: pa.Table) -> pa.Table:
        return _cut(table, more, window, buckets, target) if table.num_rows else target.empty_table()

    cut = chunks.groupBy("_to").cogroup(hits.unionByName(owners).groupBy("_to")).applyInArrow(finish, schema)
    return cut.select(*spread.unfolded(names, "doc_id", "text"), "n_words", "n_removed")


def kept_digest(text: str = "text"):
    """SHA-256 of the words left, joined by one space."""
    one_line = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.sha2(F.trim(one_line), 256)
