"""Mixing of sources to target weights by Poisson replication.

Every source has a mean repetition rate: the documents it is due, over those it has.
A document's number of copies is the inverse of that Poisson distribution at a
uniform value hashed from (doc_id, seed); copies are exploded and put in a global
order by a second hash. All in DataFrame functions.

A null source is a source of its own. A source missing from ``weights``, or of weight
zero, leaves the mixture. Rows with equal ids draw alike; a null id draws like the
text "null". An empty table gives no rows. Columns named like those added here are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagelake.llm.spread import folded, small, unfolded

SEED = "mix-1"
#: Target weight of a source as a power of its share; 1 leaves the mixture as it is, 0 evens it out.
EXPONENT = 0.5
#: Above this mean a distribution function starts 12 deviations below it, not at 0, where
#: exp(-mean) comes near to zero; what lies before is below 2**-100.
LARGEST_MEAN = 500.0


def uniform(key: Column, salt: str) -> Column:
    """In [0, 1): 52 bits of md5, which any engine can replay."""
    digits = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":" + salt))), 1, 13)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(2**52))


def tempered_weights(docs: DataFrame, exponent: float = EXPONENT) -> DataFrame:
    """(source, n, weight): the sources' shares to a power; weights need not add up to 1."""
    return docs.groupBy("source").agg(F.count("*").alias("n")).withColumn("weight", F.pow(F.col("n").cast("double"), F.lit(exponent)))


def repetition_rates(sizes: DataFrame, epochs: float = 1.0) -> DataFrame:
    """(source, rate) from (source, n, weight): ``epochs`` times the documents of these sources in all."""
    everything = Window.partitionBy()  # a row per source
    rate = F.col("weight") / F.sum("weight").over(everything) * F.sum("n").over(everything) * F.lit(epochs) / F.col("n")
    return sizes.select("source", "weight", F.round(rate, 9).alias("rate")).where("weight > 0").select("source", "rate")


def poisson_table(rates: DataFrame) -> DataFrame:
    """(source, rate, first, cdf): the distribution function at first, first + 1, ... until
    it is flat in doubles."""
    mean = F.col("rate")
    far = mean > LARGEST_MEAN
    reach = 12 * F.sqrt(mean) + 24
    first = F.when(far, F.floor(mean - reach)).otherwise(F.lit(0)).cast("int")
    p = F.when(far, F.lit(1.0)).otherwise(F.exp(-mean))
    start = F.struct(p.alias("p"), F.array(p).alias("cdf"))
    steps = F.sequence(first + 1, F.ceil(mean + reach).cast("int"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(state["cdf"], F.array(F.element_at(state["cdf"], -1) + p)).alias("cdf"))

    sums = rates.select("source", "rate", first.alias("first"), F.aggregate(steps, start, step)["cdf"].alias("cdf"))
    whole = F.element_at("cdf", -1)
    return sums.withColumn("cdf", F.when(far, F.transform("cdf", lambda c: c / whole)).otherwise(F.col("cdf")))


def replicate(docs: DataFrame, weights: DataFrame | None = None, *, epochs: float = 1.0, seed: str = SEED) -> DataFrame:
    """``docs`` with a row per copy, plus rate, n_copies, copy (from 0) and shuffle_key.
    ``weights`` holds (source, weight); by default the tempered shares. The rows come
    dealt out and sorted by shuffle_key, which is a hash, so files written from them
    are a global shuffle. The table of rates has a row per source."""
    sizes = tempered_weights(docs)
    if weights is not None:
        given = weights.groupBy("source").agg(F.max("weight").cast("double").alias("weight"))
        sizes = sizes.drop("weight").alias("s").join(given.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source"))).select("s.source", "n", "weight")
    table = small(poisson_table(repetition_rates(small(sizes, "sizes"), epochs)), "rates").withColumnsRenamed({"source": "_source", "first": "_first"})
    made = ["rate", "n_copies", "copy", "shuffle_key"]
    names = [c for c in docs.columns if c not in made]
    docs = folded(docs.drop(*made), "doc_id", "source")
    drawn = F.size(F.filter("cdf", lambda c: c <= F.col("_u")))
    counted = (
        docs.join(table, docs["source"].eqNullSafe(table["_source"]))
        .withColumn("_u", uniform(F.col("doc_id"), seed))
        .withColumn("n_copies", F.col("_first").cast("bigint") + drawn)
        .where("n_copies > 0")
    )
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_copies") - 1)))
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("/"), F.col("copy").cast("string"), F.lit(":" + seed)))
    out = copies.withColumn("shuffle_key", key).repartition("shuffle_key").sortWithinPartitions("shuffle_key")
    return out.select(*unfolded(names, "doc_id", "source"), *made)
