"""Intake: every event once, split by an event-time frontier that outlives restarts."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_operators import rows
from tremora import schemas
from tremora.operators import impact, ingest
from tremora.sources import feeds
from tremora.streaming import intake, jobs

NOW = {"availableNow": True}
DDL = "event_id string, event_time string, ingested_at string, note int"


class World:
    def __init__(self, spark, tmp_path):
        self.spark, self.path = spark, tmp_path
        self.seen = intake.seen_table(spark, str(tmp_path / "seen"), 4)
        self.frontier = intake.frontier_table(spark, str(tmp_path / "frontier"))
        self.kept, self.late = str(tmp_path / "kept"), str(tmp_path / "late")

    def take(self, data, number):
        intake.take_in(self.spark.createDataFrame(data, DDL), number, self.seen, self.frontier,
                       jobs.folder_feed(self.kept), jobs.folder_feed(self.late), ["note"])

    def read(self, path):
        return rows(self.spark.read.schema(f"{DDL}, batch int").parquet(path),
                    "event_id", "note", "batch")


def clock(minute):
    return (datetime(2024, 1, 1, 10) + timedelta(minutes=minute)).isoformat()


BATCHES = [
    [("A", clock(0), None, 2), ("A", clock(1), None, 1), ("B", clock(5), None, 3)],
    [],
    [("C", clock(60), None, 4), ("A", clock(61), None, 5), ("OLD", clock(-30), None, 6),
     ("SOON", clock(-4), None, 7)],
    [("LATE", clock(20), None, 8), ("OLD", clock(70), None, 9), ("NOTIME", "?", None, 10),
     ("AHEAD", "2030-01-01T00:00:00", clock(62), 11)],
    [("EDGE", clock(52), None, 12), ("PAST", clock(51), None, 13), ("LATE", clock(90), None, 14)],
]
KEPT = [("A", 1, 0), ("AHEAD", 11, 3), ("B", 3, 0), ("C", 4, 2), ("NOTIME", 10, 3),
        ("SOON", 7, 2)]


def test_every_event_goes_to_one_feed_once(spark, tmp_path):
    world = World(spark, tmp_path)
    for number, data in enumerate(BATCHES):
        world.take(data, number)
    # the frontier before batch 4 is minute 70, of the repeated report of OLD
    assert world.read(world.kept) == KEPT
    assert world.read(world.late) == [("EDGE", 12, 4), ("LATE", 8, 3), ("OLD", 6, 2), ("PAST", 13, 4)]
    assert rows(world.seen.current()) == sorted(
        (name,) for name in {r[0] for data in BATCHES for r in data})


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    world = World(spark, tmp_path)
    for number, data in enumerate(BATCHES):
        world.take(data, number)
        before = world.read(world.kept), world.read(world.late) if number > 1 else None
        world.take(data, number)
        assert before == (world.read(world.kept), world.read(world.late) if number > 1 else None)
    world.seen.compact(4)
    world.frontier.compact(4)
    world.take([("A", clock(0), None, 20), ("NEW", clock(85), None, 21)], 5)
    assert world.read(world.kept) == sorted(KEPT + [("NEW", 21, 5)])


def test_a_hot_id_is_one_row(spark, tmp_path):
    world = World(spark, tmp_path)
    world.take([("hot", clock(0), None, k) for k in range(3000)], 0)
    world.take([("hot", clock(1), None, k) for k in range(3000)] + [("x", clock(1), None, 1)], 1)
    assert world.read(world.kept) == [("hot", 0, 0), ("x", 1, 1)]


def test_the_job_from_a_feed_over_restarts(spark, tmp_path):
    raw, state = str(tmp_path / "raw"), str(tmp_path / "state")
    world = World(spark, tmp_path)

    def event(name, minute, number):
        return (name, "zone", 40.0, 29.0, 6.0, 9.0, clock(minute), "s", clock(minute + 1))
    for k, data in enumerate(([event("A", 0, 1), event("B", 40, 2)],
                              [event("A", 41, 3), event("OLD", 3, 4)], [event("C", 45, 5)])):
        sent = spark.createDataFrame(data, schemas.EVENT)
        feeds.encode(sent, F.col("event_id")).write.mode("append").parquet(raw)
        stream = ingest.valid(jobs.decoded_events(
            feeds.read_stream(spark, "parquet", {"path": raw})))
        intake.intake_job(stream, world.seen, world.frontier, jobs.folder_feed(world.kept),
                          jobs.folder_feed(world.late), ["event_time"], state, NOW,
                          compact_every=1).awaitTermination()
    shape = "event_id string, event_time string, batch int"
    assert rows(spark.read.schema(shape).parquet(world.kept)) == [
        ("A", clock(0), 0), ("B", clock(40), 0), ("C", clock(45), 2)]
    assert rows(spark.read.schema(shape).parquet(world.late)) == [("OLD", clock(3), 1)]


@pytest.mark.parametrize("trigger", [{"processingTime": "1 second"}, jobs.SCORE_TRIGGER])
def test_processing_time_triggers(spark, tmp_path, trigger):
    from tests.test_operators import districts_df, events_df
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    events, table = events_df(spark, 4), districts_df(spark, 5)
    feeds.encode(events, F.col("event_id")).write.parquet(raw)
    query = jobs.score_job(feeds.read_stream(spark, "parquet", {"path": raw}), table, "parquet",
                           {"path": out}, str(tmp_path / "state"), trigger)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    got = feeds.decode(spark.read.schema(feeds.KEY_VALUE).parquet(out), schemas.SCORED)
    columns = ["event_id", "district_key", "dynamic_priority_score"]
    assert rows(got, *columns) == rows(impact.score_pairs(events, table), *columns)
