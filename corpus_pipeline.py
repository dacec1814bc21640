"""From raw documents to packed training sequences, stage by stage.

Every stage gets the documents that the one before it kept, with all their columns,
and all but the last return the columns of documents. Rows whose texts the stages
leave alone pass through unchanged; n_chars follows a text that is cut."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.llm import mixing, outliers, packing, repeats, simhash
from triagelake.llm.spread import folded, unfolded
from triagelake.session import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or lie too far out go."""
    used = "text", "lang", "source"
    return outliers.judged(folded(docs, *used), stored=False).where("kept").select(*unfolded(docs.columns, *used))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates one document stays: the one with the smallest
    id (null last), and of rows with one id the one with the least hash of its text."""
    number = F.col("doc_id").cast("bigint")
    key = [F.coalesce(number, F.lit(0)).alias("_id"), number.isNull().alias("_no_id")]
    stay = simhash.representatives(docs).select(*key, F.col("text_hash").alias("_text"))
    names = ["_id", "_no_id", "_text"]
    keyed = docs.select(*key, F.xxhash64("text").alias("_text"), F.struct(*docs.columns).alias("_row")).join(stay, names, "left_semi")
    # rows with one id and one text: any of them, by their other columns; the join has dealt the keys out
    return keyed.groupBy(*names).agg(F.min_by("_row", F.xxhash64("_row")).alias("_row")).select("_row.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats are cut out of the texts; documents of which nothing is left go."""
    cut = repeats.cut_repeats(folded(docs, "doc_id", "text")).where("n_removed = 0 OR n_removed < n_words")
    n_chars = [c for c in docs.columns if c == "n_chars"]
    for c in n_chars:
        old, kind = F.col("_row").getField(c), docs.schema[c].dataType
        cut = cut.withColumn(c, F.when(F.col("n_removed") > 0, F.length("text").cast(kind)).otherwise(old))
    return cut.select(*unfolded(docs.columns, "doc_id", "text", *n_chars))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often as the mixture has them, in shuffled order."""
    return mixing.replicate(folded(docs, "doc_id", "source")).select(*unfolded(docs.columns, "doc_id", "source"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules), ("simhash_dedup", simhash_dedup), ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources), ("pack_sequences", pack_sequences),
]
#: SimHash, robust estimates and tokenisation have no SQL form; tests replay the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
