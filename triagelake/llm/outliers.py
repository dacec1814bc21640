"""Quality rules: robust multivariate outliers per language and source.

Each text has counts (words, symbols, repeated lines and word runs). Its statistic
vector holds four rates, shrunk towards usual ones where a text is short, on a log
scale and rounded to a lattice of 1/32, so that the whole corpus becomes a table of
lattice cells with their counts per language and source. On these counts a minimum
covariance determinant is estimated (several starts, concentration steps until the
determinant stands still, then one reweighted estimate), and a text is rejected where
its Mahalanobis distance is beyond a quantile of chi-square. Cells are few however
long the corpus is, and no group of rows ever meets in one task.

A language and source with under ``MIN_GROUP`` texts takes the estimate of its language,
a language with fewer that of all texts. Texts that fail the base rule are left out
of the estimates. Null texts are empty (so they fail the base rule); null languages
and sources count as the empty string; equal rows are judged alike; columns named like
those added are replaced, others are carried along. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from triagelake.llm.spread import folded, slices, small, unfolded
from triagelake.llm.words import buffer_of, words_of
from triagelake.session import materialise, ship_package

MIN_WORDS, MAX_REPEAT_PERCENT, RUN_WORDS = 20, 30, 8
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
AXES = ["x_length", "x_symbols", "x_lines", "x_repeats"]
LATTICE = 32.0
#: Words of usual text that every text is taken to have besides its own.
PRIOR_WORDS, PRIOR_LENGTH = 50.0, 5.0
MIN_GROUP = 500
#: Share of the texts that the determinant is minimised over.
COVERAGE = 0.75
#: Least standard deviations: differences below them are no sign of junk.
LEAST_DEVIATION = np.array([0.08, 0.25, 0.35, 0.60])
#: Chi-square tail beyond which a text is rejected.
TAIL = 1e-6
STARTS, SEED = 12, 7


def counts_of(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    w = words_of(texts)
    n, words = len(texts), len(w.starts)
    inside = np.zeros(len(w.data) + 1, np.int32)
    inside[w.starts] += 1
    inside[w.ends] -= 1
    points = (np.cumsum(inside)[:-1] > 0) & ((w.data & 0xC0) != 0x80)
    per_text = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[w.offsets])
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    runs, whole = w.windows(w.hashes(), RUN_WORDS)
    at = np.flatnonzero(whole)
    covered = np.zeros(words + 1, np.int32)
    if len(at):
        text = w.text_of[at]
        order = np.lexsort((runs[at], text))
        same = (np.diff(runs[at][order]) == 0) & (np.diff(text[order]) == 0)
        twice = np.zeros(len(at), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        covered[at[twice]] += 1
        np.subtract.at(covered, at[twice] + RUN_WORDS, 1)
    repeated = np.concatenate([[0], np.cumsum(np.cumsum(covered)[:-1] > 0)])
    lines = np.zeros(n, np.int64)
    for i, text in enumerate(texts.to_pylist()):
        if text and "\n" in text:
            seen: set[str] = set()
            for line in text.split("\n"):
                if line in seen:
                    lines[i] += bool(line.strip(" \t\n\x0b\x0c\r"))
                seen.add(line)
    return {
        "n_words": np.diff(w.bounds), "word_chars": per_text(points), "n_symbols": per_text(symbol[w.data]),
        "n_dup_lines": lines, "n_repeat_words": np.diff(repeated[w.bounds]),
    }


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with the base counts of text."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(docs.sparkSession)
    docs = docs.drop(*COUNTS)
    schema = StructType([*docs.schema.fields, *(StructField(c, LongType()) for c in COUNTS)])
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = counts_of(batch.column("text"))
            columns = [*batch.columns, *(pa.array(made[c].astype(np.int64)) for c in COUNTS)]
            yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(columns, target)], schema=target)

    return docs.mapInArrow(run, schema)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def with_vector(counted: DataFrame) -> DataFrame:
    """The statistic vector, in units of 1/32."""
    words, chars = F.col("n_words") + PRIOR_WORDS, F.col("word_chars") + PRIOR_WORDS * PRIOR_LENGTH
    axes = [
        F.log(chars / words), F.log1p(100 * F.col("n_symbols") / chars),
        F.log1p(100 * F.col("n_dup_lines") / words), F.log1p(100 * F.col("n_repeat_words") / words),
    ]
    return counted.withColumns({
        "base_failed": base_failed(), "_lang": F.coalesce("lang", F.lit("")), "_source": F.coalesce("source", F.lit("")),
        **{name: F.round(x * LATTICE).cast("int") for name, x in zip(AXES, axes)},
    })


# -- estimates on counted cells -------------------------------------------------------


def chi2_tail(x: float, df: int) -> float:
    """P(X > x) for an even number of degrees of freedom."""
    half = x / 2
    return math.exp(-half) * sum(half**k / math.factorial(k) for k in range(df // 2))


def chi2_quantile(tail: float, df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_tail(mid, df) > tail else (low, mid)
    return high


def _moments(x: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mean = weight @ x / weight.sum()
    y = x - mean
    return mean, (y * weight[:, None]).T @ y / weight.sum() + np.diag(LEAST_DEVIATION**2)


def _distances(x: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    y = x - mean
    return np.einsum("ij,jk,ik->i", y, np.linalg.inv(cov), y)


def _concentrated(x, weight, mean, cov, steps: int):
    """Concentration steps: moments of the nearest ``COVERAGE`` of the rows, again and again."""
    best, most = math.inf, COVERAGE * weight.sum()
    for _ in range(steps):
        d = _distances(x, mean, cov)
        order = np.argsort(d, kind="stable")
        taken = np.zeros(len(x))
        ahead = np.cumsum(weight[order])
        taken[order] = np.clip(most - (ahead - weight[order]), 0, weight[order])  # the last cell in part
        mean, cov = _moments(x, taken)
        now = np.linalg.slogdet(cov)[1]
        if now > best - 1e-10:
            break
        best = now
    return best, mean, cov


def mcd(x: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Reweighted minimum covariance determinant of rows ``x`` that stand ``weight`` times."""
    p = x.shape[1]
    order = np.argsort(x, axis=0, kind="stable")
    middle = np.array([x[o, k][np.searchsorted(np.cumsum(weight[o]), weight.sum() / 2)] for k, o in enumerate(order.T)])
    starts = [(middle, np.diag(LEAST_DEVIATION**2)), _moments(x, weight)]
    rng = np.random.default_rng(SEED)
    for _ in range(STARTS):
        at = rng.choice(len(x), p + 1, p=weight / weight.sum())
        starts.append(_moments(x[at], np.ones(p + 1)))
    tried = sorted((_concentrated(x, weight, *s, 2) for s in starts), key=lambda t: t[0])[:3]
    _, mean, cov = min((_concentrated(x, weight, m, c, 100) for _, m, c in tried), key=lambda t: t[0])
    cov = cov * (COVERAGE / (1 - chi2_tail(chi2_quantile(1 - COVERAGE, p), p + 2)))
    near = weight * (_distances(x, mean, cov) <= chi2_quantile(0.025, p))
    return _moments(x, near) if near.sum() > p else (mean, cov)


MODEL = "level int, _lang string, _source string, mean array<double>, inverse array<double>"


def fit(vectors: DataFrame) -> DataFrame:
    """Models per (language, source), per language and for all; the first two from ``MIN_GROUP`` texts on."""
    ship_package(vectors.sparkSession)
    cells = materialise(
        vectors.where("NOT base_failed").groupBy("_lang", "_source", *AXES).agg(F.count("*").alias("n")), "cells")
    anyone = F.lit("")
    levels = [(0, F.col("_lang"), F.col("_source")), (1, F.col("_lang"), anyone), (2, anyone, anyone)]
    rolled = None
    for level, lang, source in levels:
        part = cells.select(F.lit(level).alias("level"), lang.alias("_lang"), source.alias("_source"), *AXES, "n")
        part = part.groupBy("level", "_lang", "_source", *AXES).agg(F.sum("n").alias("n"))
        rolled = part if rolled is None else rolled.unionByName(part)

    def estimate(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        weight = cells["n"].to_numpy(float)
        if key[0] < 2 and weight.sum() < MIN_GROUP:
            return pd.DataFrame(columns=["level", "_lang", "_source", "mean", "inverse"])
        cells = cells.sort_values(AXES)
        mean, cov = mcd(cells[AXES].to_numpy(float) / LATTICE, cells["n"].to_numpy(float))
        return pd.DataFrame({"level": [key[0]], "_lang": [key[1]], "_source": [key[2]], "mean": [mean.tolist()], "inverse": [np.linalg.inv(cov).ravel().tolist()]})

    return small(rolled.groupBy("level", "_lang", "_source").applyInPandas(estimate, MODEL), "models")


def judge(vectors: DataFrame, models: DataFrame) -> DataFrame:
    """Adds distance (squared, null for texts that fail the base rule) and kept."""
    of = lambda level, *keys: models.where(F.col("level") == level).select(*keys, F.struct("mean", "inverse").alias(f"_m{level}"))
    found = vectors.withColumn("level", F.lit(2)).join(of(0, "_lang", "_source"), ["_lang", "_source"], "left")
    found = found.join(of(1, "_lang"), "_lang", "left").join(of(2, "level"), "level", "left")
    found = found.withColumn("_m", F.coalesce("_m0", "_m1", "_m2"))
    y = [F.col(x) / LATTICE - F.col("_m.mean")[i] for i, x in enumerate(AXES)]
    p = len(AXES)
    squared = sum(y[i] * y[j] * F.col("_m.inverse")[i * p + j] for i in range(p) for j in range(p))
    return found.withColumn("distance", F.when(~F.col("base_failed"), F.coalesce(squared, F.lit(0.0)))).withColumn(
        "kept", ~F.col("base_failed") & (F.col("distance") <= chi2_quantile(TAIL, p))).drop("level", "_m", "_m0", "_m1", "_m2", "_lang", "_source", *AXES)


def judged(docs: DataFrame, stored: bool = True) -> DataFrame:
    """``docs`` with counts, base_failed, distance and kept. ``stored`` writes the counts
    and leaves the text out; else it is read twice and carried along unshuffled."""
    made = [*COUNTS, "base_failed", "distance", "kept"]
    names = [c for c in docs.columns if c not in made]
    docs, read = folded(docs.drop(*made), "text", "lang", "source"), ["lang", "source"]
    slim = with_vector(with_counts(docs if stored else docs.select("text", *read))).drop("text")
    if stored:
        slim, names = materialise(slim, "statistics"), [c for c in names if c != "text"]
    found = judge(slim if stored else with_vector(with_counts(docs)), fit(slim))
    return found.select(*unfolded(names, "text", *read), *made)
