"""Language identification by nearest centroids.

A text is lower-cased, everything but letters becomes a blank, and its byte trigrams
are hashed to ``BUCKETS`` places: log counts times inverse document frequency,
normalised. Document frequencies are counted over all training texts. Each language
has several centroids: spherical k-means over a bounded sample of its training texts
(``SAMPLE`` per language, those with the smallest id hashes). A text gets the language
of the centroid with the highest cosine; where it is further from it than nearly all
of that centroid's own texts were, it is marked as rejected.

Null texts and texts without a letter are ``und`` with score 0, and so are all texts
when nothing was learned. Equal similarities go to the language first in order. Null
languages are not learned from. A null id counts as the empty text in the split.
Other columns are ignored, equal rows are scored alike, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagelake.llm.spread import slices, small
from triagelake.llm.words import buffer_of
from triagelake.session import ship_package

BUCKETS, CENTROIDS, SAMPLE = 4096, 4, 1000
FOLDS, HELD_OUT = 4, 2
#: Rejected beyond this quantile of a centroid's own distances, times the slack.
QUANTILE, SLACK = 0.995, 1.25
#: Distinct languages that are learned at most; more are an error, as centroids go to every task.
MOST_LANGUAGES = 1000

_KEEP = np.full(256, 32, np.uint8)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def gram_counts(texts: list[str | None]) -> np.ndarray:
    """(texts, BUCKETS) counts of hashed byte trigrams."""
    data, offsets = buffer_of(pa.array([f" {t.lower()} " if t else None for t in texts], pa.large_string()))
    n = len(texts)
    if len(data) < 3:
        return np.zeros((n, BUCKETS), np.float32)
    data = _KEEP[data].astype(np.uint32)
    grams = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    place = ((grams * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)  # the high 12 bits
    text = np.repeat(np.arange(n), np.diff(offsets))
    fine = (text[:-2] == text[2:]) & ~((data[:-2] == 32) & (data[1:-1] == 32) | (data[1:-1] == 32) & (data[2:] == 32))
    return np.bincount(text[:-2][fine] * BUCKETS + place[fine], minlength=n * BUCKETS).reshape(n, BUCKETS).astype(np.float32)


def vectors(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    x = np.log1p(gram_counts(texts)) * idf
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.maximum(norm, 1e-12)[:, None]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def document_frequencies(train: DataFrame) -> np.ndarray:
    """Training texts that hold each place, and in the last place their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in slices(batches, "text", rows=1024):
            total[:-1] += (gram_counts(batch.column("text").to_pylist()) > 0).sum(axis=0)
            total[-1] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS + 1)), pa.array(total)], names=["place", "n"])

    found = train.select("text").mapInArrow(run, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS + 1, np.int64)
    for place, n in found.collect():  # a row per place
        out[place] = n
    return out


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 15) -> tuple[np.ndarray, np.ndarray]:
    """Centroids, started from the texts furthest apart, and each text's centroid."""
    picked = [int(np.argmax(x @ x.mean(axis=0)))]
    nearest = x @ x[picked[0]]
    while len(picked) < min(k, len(x)) and nearest.min() < 1 - 1e-6:
        picked.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, x @ x[picked[-1]])
    c = x[picked]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        sums = np.stack([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1), 1e-12)[:, None]
    return c, np.argmax(x @ c.T, axis=1)


def learn(train: DataFrame) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """(idf, language of each centroid, centroids, largest own distance) from (doc_id, text, lang)."""
    ship_package(train.sparkSession)
    counted = document_frequencies(train)
    idf = (np.log((1 + counted[-1]) / (1 + counted[:-1])) + 1).astype(np.float32)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = train.select("doc_id", "lang").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= SAMPLE).select("doc_id", "lang")
    sample = train.join(small(picked.distinct(), "language-sample"), ["doc_id", "lang"], "left_semi")

    def cluster(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text"])[:SAMPLE]
        x = vectors(rows["text"].tolist(), idf)
        x = x[x.any(axis=1)]
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": [], "reach": []})
        c, own = spherical_kmeans(x, CENTROIDS)
        distance = 1 - np.einsum("ij,ij->i", x, c[own])
        reach = [float(np.quantile(distance[own == j], QUANTILE)) * SLACK if (own == j).any() else 0.0 for j in range(len(c))]
        return pd.DataFrame({"lang": [key[0]] * len(c), "centroid": c.tolist(), "reach": reach})

    rows = sample.select("doc_id", "text", "lang").groupBy("lang").applyInPandas(cluster, "lang string, centroid array<float>, reach double")
    found = sorted(rows.limit(MOST_LANGUAGES * CENTROIDS + 1).collect())
    if len(found) > MOST_LANGUAGES * CENTROIDS:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return idf, [r.lang for r in found], np.array([r.centroid for r in found], np.float32).reshape(-1, BUCKETS), np.array([r.reach for r in found])


def identify(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected); texts of fold ``held_out`` are not learned from."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang").withColumn("held_out", fold(F.col("doc_id"), folds) == held_out)
    idf, langs, centroids, reach = learn(docs.where("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang"))
    target = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", rows=1024):
            texts = batch.column("text").to_pylist()
            known = np.array([has_letter(t) for t in texts], bool) & bool(langs)
            cosine = vectors(texts, idf) @ centroids.T if langs else np.zeros((len(texts), 1))
            best = np.argmax(cosine, axis=1)
            score = np.where(known, np.clip(cosine[np.arange(len(texts)), best], 0, 1), 0.0)
            pred = [langs[b] if k else "und" for b, k in zip(best, known)]
            far = ~known | (1 - score > (reach[best] if langs else 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score.astype(float)), pa.array(far)], schema=target)

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean")
