"""Features kept on a stream equal those of all events at once."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from triagelake.operators import features
from triagelake.streaming import changes

SCHEMA = "key string, created timestamp, author string, field string, from_string string, to_string string"


def events(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(200):
        key = "HOT" if i % 3 == 0 else f"T-{rng.randint(0, 12)}"
        day = None if i % 41 == 0 else f"2024-01-{rng.randint(1, 28):02d} {rng.randint(0, 23):02d}:00:00"
        rows.append((key, day, rng.choice(["u", "v", None]), rng.choice(["priority", "Priority", "assignee", "status"]),
                     rng.choice(["Minor", None]), rng.choice(["Minor", "Major", "Critical", "unknown", None])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA.replace("created timestamp", "created string")).withColumn("created", F.col("created").cast("timestamp"))


def due(spark, rows):
    df = frame(spark, rows)
    return {r.key: (r.was_escalated, r.was_deescalated, r.first_assignee) for r in features.change_features(df).collect()}


def run(spark, tmp_path, rows, cuts, delay):
    for i, some in enumerate(cuts):
        frame(spark, some).coalesce(1).write.parquet(str(tmp_path / "in" / f"f{i}"))
        changes.watch_changes(spark, str(tmp_path / "in" / "*"), frame(spark, rows[:1]).schema, str(tmp_path / "out"), str(tmp_path / "state"), delay).awaitTermination()
    return {r.key: (r.was_escalated, r.was_deescalated, r.first_assignee) for r in changes.current(spark, str(tmp_path / "out")).collect()}


@pytest.mark.parametrize("seed, n", [(1, 3), (2, 1)])
def test_any_cut_and_order_within_the_delay(spark, tmp_path, seed, n):
    rows = events(seed)
    random.Random(seed).shuffle(rows)
    got = run(spark, tmp_path, rows, [rows[i::n] for i in range(n)], "60 days")
    want = due(spark, rows)
    assert got == {k: want[k] for k in got} and set(got) == {r[0] for r in rows if r[3].lower() != "status"}


def test_settled_events_are_let_go(spark, tmp_path):
    """In order of time with a short delay: state settles batch by batch, results stay exact."""
    rows = sorted((r for r in events(3) if r[1]), key=lambda r: r[1])
    got = run(spark, tmp_path, rows, [rows[:70], rows[70:140], rows[140:]], "1 hours")
    want = due(spark, rows)
    assert got == {k: want[k] for k in got}


def test_an_event_without_a_time_is_never_late(spark, tmp_path):
    rows = [("K", "2024-01-01 00:00:00", "u", "priority", None, "Minor"), ("K", "2024-06-01 00:00:00", "u", "priority", None, "Minor"),
            ("K", "2024-12-01 00:00:00", "u", "assignee", None, "ann"), ("K", None, "u", "priority", None, "Major"), ("K", None, "u", "assignee", None, "bob")]
    got = run(spark, tmp_path, rows, [rows[:2], rows[2:3], rows[3:]], "1 days")
    assert got == due(spark, rows) == {"K": (1, 0, "ann")}


class Store:
    """A state store that counts what is asked of it."""

    def __init__(self):
        self.kept, self.calls, self.timers = {}, 0, []

    def getValueState(self, name, schema):
        return Value(self, name)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)


class Value:
    def __init__(self, store, name):
        self.store, self.name = store, name

    def get(self):
        self.store.calls += 1
        return self.store.kept.get(self.name)

    def update(self, value):
        self.store.calls += 1
        self.store.kept[self.name] = value


class Times:
    def __init__(self, watermark):
        self.watermark = watermark

    def getCurrentWatermarkInMs(self):
        return self.watermark


def test_a_ticket_asks_the_store_three_times_a_batch():
    store, processor = Store(), changes.ChangeProcessor()
    processor.init(store)
    row = Row("key", "_time", "at", "author", "to_string", "from_string", "rank", "kind")

    def batch(watermark, *rows):
        store.calls = 0
        got = list(processor.handleInputRows(("K",), iter(rows), Times(watermark)))
        assert store.calls <= 3
        return [tuple(r) for r in got]

    assert batch(0, row("K", None, 5_000_000, "u", "Minor", None, 2, "PRIORITY"), row("K", None, 6_000_000, "u", "ann", None, None, "ASSIGNEE")) == [("K", 0, 0, "ann")]
    assert batch(0, row("K", None, 4_000_000, "u", "Major", None, 3, "PRIORITY"), row("K", None, 4_000_000, "u", "bob", None, None, "ASSIGNEE")) == [("K", 0, 1, "bob")]
    assert store.timers == [5001]  # the one set covers the earlier event
    assert list(processor.handleExpiredTimer(("K",), Times(5001), None)) == [] and store.kept["state"][-1] == []
    assert batch(5001, row("K", None, None, "u", "Blocker", None, 5, "PRIORITY")) == [("K", 1, 1, "bob")] and store.timers == [5001]
