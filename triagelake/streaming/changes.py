"""Change features of tickets kept up to date while change events arrive.

The state of a ticket is small: whether its priority rose or fell between events that
are settled, the rank of the last of them, the first assignee so far, and the priority
events that are still open. An event is settled once the watermark has passed it, since
no earlier one can come any more; until then it waits, so events may arrive in any order
within the allowed delay. A timer settles what waits for tickets that get no further
events. After each batch the tickets it touched are written with the features as they
stand, open events included: read by their last batch they equal the features that the
batch operator computes from all events, however those were cut into batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from triagelake.functions import scalars as S
from triagelake.operators.features import EVENT_ORDER
from triagelake.session import ship_package

FEATURES = "key string, was_escalated int, was_deescalated int, first_assignee string"
_EVENT = "at: long, author: string, to_string: string, from_string: string, rank: int"
_STATE = (
    "up int, down int, last int, any int, at long, author string, to_string string, from_string string, assigned int, "
    f"timer long, open array<struct<{_EVENT}>>")
_NOTHING = (0, 0, None, 0, None, None, None, None, 0, 0, ())
_FEATURES = Row("key", "was_escalated", "was_deescalated", "first_assignee")
#: Stands for a missing time, which comes after all others; no watermark reaches it.
_NEVER = (1 << 63) - 1
#: A state store that keeps state on disk; the processor needs it.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _order(event: tuple) -> tuple:
    """By time, author, new and old value; missing ones last."""
    return tuple((v is None, "" if v is None else v) if i else v for i, v in enumerate(event[:4]))


def moves(last: int | None, any_: bool, ranks: list[int | None]) -> tuple[int, int]:
    """Whether a rank rises and falls against the one right before; unknown ones don't count."""
    up = down = 0
    for rank in ranks:
        if any_ and last is not None and rank is not None:
            up, down = up | (rank > last), down | (rank < last)
        last, any_ = rank, True
    return int(up), int(down)


class ChangeProcessor(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", _STATE)

    def _read(self) -> tuple[list, list[tuple]]:
        """What is settled, and the events that wait."""
        *settled, waiting = self.state.get() or _NOTHING
        return settled, [tuple(e) for e in waiting]

    def _settle(self, state: list, waiting: list[tuple], watermark: int) -> tuple[list[tuple], int, int]:
        """Take the events before the watermark into the settled part; those that still
        wait, and whether the priority rose and fell, open events included."""
        waiting.sort(key=_order)
        n = sum(1 for e in waiting if e[0] < watermark * 1000)
        done, rest = waiting[:n], waiting[n:]
        if done:
            up, down = moves(state[2], bool(state[3]), [e[4] for e in done])
            state[:4] = [state[0] | up, state[1] | down, done[-1][4], 1]
        up, down = moves(state[2], bool(state[3]), [e[4] for e in rest])
        return rest, state[0] | up, state[1] | down

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        state, waiting = self._read()
        for _, _, at, author, to, from_, rank, kind in rows:
            event = (_NEVER if at is None else at, author, to, from_, rank)
            if kind == "PRIORITY":
                waiting.append(event)
            elif to is not None and (not state[8] or _order(event) < _order(tuple(state[4:8]))):
                state[4:9] = [*event[:4], 1]
        watermark = timerValues.getCurrentWatermarkInMs()
        rest, up, down = self._settle(state, waiting, watermark)
        latest = max((e[0] for e in rest if e[0] < _NEVER), default=None)
        if latest is not None:
            due = max(latest // 1000 + 1, watermark + 1)
            if due > state[9]:  # else one that is set comes late enough
                self.handle.registerTimer(due)
                state[9] = due
        self.state.update((*state, rest))
        yield _FEATURES(key[0], up, down, state[6] if state[8] else None)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        state, waiting = self._read()
        rest, _, _ = self._settle(state, waiting, timerValues.getCurrentWatermarkInMs())
        self.state.update((*state, rest))
        yield from ()

    def close(self) -> None:
        pass


def change_stream(events: DataFrame, delay: str = "7 days") -> DataFrame:
    """Features of the tickets that each batch of typed change events touches. Events
    more than ``delay`` behind the latest time seen are too late and left out; one
    without a time is never late and comes after all others."""
    ship_package(events.sparkSession)
    kind = F.upper("field")
    wanted = events.where(kind.isin("PRIORITY", "ASSIGNEE")).select(
        "key", F.col("created").cast("timestamp").alias("_time"), F.unix_micros(F.col("created").cast("timestamp")).alias("at"),
        *EVENT_ORDER[1:], S.category_rank(F.col("to_string")).cast("int").alias("rank"), kind.alias("kind"))
    keyed = wanted.where(F.col("key").isNotNull()).withWatermark("_time", delay).groupBy("key")
    return keyed.transformWithState(ChangeProcessor(), FEATURES, "Update", "EventTime")


def watch_changes(
    spark: SparkSession, source: str, schema: StructType, sink: str, checkpoint: str, delay: str = "7 days",
    files_per_trigger: int | None = None, trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Follow arriving Parquet files of typed change events; each batch writes its folder
    anew, so one that is run again counts once."""
    options = {"maxFilesPerTrigger": files_per_trigger} if files_per_trigger else {}
    features = change_stream(spark.readStream.schema(schema).options(**options).parquet(source), delay)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    writer = features.writeStream.foreachBatch(store).outputMode("update").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    name, value = STATE_STORE
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)  # a query keeps the settings that it was started with
    try:
        return writer.start()
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def current(spark: SparkSession, sink: str) -> DataFrame:
    """The features of every ticket by the last batch that touched it."""
    rows = spark.read.schema(f"{FEATURES}, batch_id long").option("basePath", sink).parquet(sink)
    names = [c for c in rows.columns if c not in ("key", "batch_id")]
    last = rows.groupBy("key").agg(F.max_by(F.struct(*names), "batch_id").alias("_f"))
    return last.select("key", "_f.*")
