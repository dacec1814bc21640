"""Scoring newly arriving tickets against a fixed index."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from triagelake import constants as C
from triagelake.operators import enrichment, grid, retrieval, voting
from triagelake.session import job_scratch, materialise


def score_batch(tickets: DataFrame, index: DataFrame, scaler: Column | None = None) -> DataFrame:
    """Predictions of a batch; the same operators as the nightly job. Without a scaler
    the change features are compared raw. ``index`` is a stored table: tickets that fit
    in one block, which is counted, are sent to it and it is not moved; more tickets
    meet it on the grid."""
    block = tickets.limit(grid.QUERY_BLOCK_ROWS + 1).count() <= grid.QUERY_BLOCK_ROWS
    candidates = retrieval.rrf_top(tickets, index, stored=block)
    ranked = retrieval.rerank(candidates, tickets, index, scaled=False, scaler=scaler, one_block=block)
    return voting.predictions(voting.vote(voting.by_target(retrieval.final_neighbours(ranked))), tickets)


def score_new_tickets(
    spark: SparkSession, source: str, schema: StructType, index: DataFrame, sink: str, checkpoint: str,
    keep_keys_for: str = "7 days", scaled: bool = True, files_per_trigger: int | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Read arriving Parquet files, drop tickets with too little text and repeated
    keys, score each micro-batch and store it under its batch id.

    The watermark is on arrival time, so no ticket is ever late; it only bounds how
    long keys are remembered. A batch that is run again after a failure overwrites
    its own folder, so results are kept once, and what a batch stores on its way is
    removed at its end.

    Before the first batch the index is stored once with the columns that scoring
    reads, and the scaler is fitted once. ``trigger`` goes to Spark (by default all
    that is there is read, then the query ends); ``files_per_trigger`` bounds a batch."""
    names = ["key", "vec_a", "vec_b", *voting.TARGETS, *C.METADATA_WEIGHTS, *C.CHANGE_FEATURES]
    index = materialise(index.select(*names), "stream-index")
    scaler = retrieval.fitted_scaler(index) if scaled else None
    options = {"maxFilesPerTrigger": files_per_trigger} if files_per_trigger else {}
    tickets = (
        spark.readStream.schema(schema).options(**options).parquet(source)
        .where(enrichment.valid_input(F.col("summary_clean"), F.col("description_clean")))
        .withColumn("arrived_at", F.current_timestamp())
        .withWatermark("arrived_at", keep_keys_for)
        .dropDuplicatesWithinWatermark(["key"])
        .drop("arrived_at")
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        # read the micro-batch once, score from the stored copy
        batch.write.mode("overwrite").parquet(f"{sink}/tickets/batch_id={batch_id}")
        stored = batch.sparkSession.read.schema(batch.schema).parquet(f"{sink}/tickets/batch_id={batch_id}")
        with job_scratch(batch.sparkSession):
            score_batch(stored, index, scaler).write.mode("overwrite").parquet(f"{sink}/scores/batch_id={batch_id}")

    return (
        tickets.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
