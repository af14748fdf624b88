"""Intake of raw events: each event once, however late or often it is sent, split by lateness.

Spark's own stream de-duplication forgets an id after the watermark and drops what comes later than
that. Here no event is lost: the ids seen are a keyed table filed in buckets, of which a batch
reads those that it touches, and lateness only decides which of two feeds an event goes to.

The frontier is the latest event time of all batches before, kept as a table, so that a restart goes
on from it. Event times ahead of their own intake count as of the intake: one clock in the
future must not make all that follows late. A replayed batch sees the tables as they were before
it, and replaces its own rows and folders.
"""

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tremora import fixed
from tremora.session import written
from tremora.streaming.ledger import Ledger

Publish = Callable[[DataFrame, int], None]

SEEN = T.StructType([T.StructField("event_id", T.StringType())])
FRONTIER = T.StructType([T.StructField("feed", T.StringType()),
                         T.StructField("reached", T.TimestampType())])


def seen_table(spark: SparkSession, path: str, buckets: int = 64) -> Ledger:
    return Ledger(spark, path, SEEN, ("event_id",), "event_id", buckets)


def frontier_table(spark: SparkSession, path: str) -> Ledger:
    return Ledger(spark, path, FRONTIER, ("feed",), "feed", 1)


def with_clock(events: DataFrame) -> DataFrame:
    """``_at``, the event time or else the intake (null where neither can be read), and ``_known``,
    the part of it that the frontier believes. Unlike the wall clock both stay on a replay."""
    at, taken = (F.try_to_timestamp(F.col(c)) for c in ("event_time", "ingested_at"))
    return events.withColumns({"_at": F.coalesce(at, taken), "_known": F.least(at, taken)})


def unseen(batch: DataFrame, batch_id: int, seen: Ledger, position: list[str]) -> DataFrame:
    """The first report of each event that no batch before held, by ``position``.

    The rank is cut to 1 inside each map task; of the ids seen only the buckets of this batch are
    read (at most as many numbers reach the driver as there are buckets).
    """
    first = W.partitionBy("event_id").orderBy(*position)
    ones = (batch.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n"))
    touched = [r.b for r in batch.select(seen.bucket().alias("b")).distinct().collect()]
    known = seen.history(batch_id).where(F.col("bucket").isin(touched)).select("event_id")
    return ones.join(known, "event_id", "left_anti")


def reached_before(frontier: Ledger, feed: str, batch_id: int) -> datetime | None:
    row = frontier.latest(batch_id).where(F.col("feed") == feed).agg(F.max("reached")).first()
    return row[0]


def take_in(batch: DataFrame, batch_id: int, seen: Ledger, frontier: Ledger, kept: Publish,
            late: Publish, position: list[str], feed: str = "events",
            delay: str = fixed.WATERMARK) -> None:
    """One micro-batch of valid events: new ones to ``kept``, or to ``late`` if they are older than
    ``delay`` before the frontier. An event without a readable time is never late."""
    if batch.isEmpty():
        return
    rows = written(with_clock(batch), "intake")
    before = reached_before(frontier, feed, batch_id)
    fresh = written(unseen(rows, batch_id, seen, position), "fresh-events")
    seen.append(fresh, batch_id)
    is_late = F.lit(False) if before is None else F.coalesce(
        F.col("_at") < F.lit(before) - F.expr(f"INTERVAL {delay}"), F.lit(False))
    plain = [c for c in fresh.columns if c not in ("_at", "_known")]
    kept(fresh.where(~is_late).select(*plain), batch_id)
    late(fresh.where(is_late).select(*plain), batch_id)
    reached = rows.agg(F.greatest(F.max("_known"), F.lit(before).cast("timestamp")).alias("reached"))
    frontier.append(reached.select(F.lit(feed).alias("feed"), "reached"), batch_id)


def intake_job(events: DataFrame, seen: Ledger, frontier: Ledger, kept: Publish, late: Publish,
               position: list[str], checkpoint: str, trigger: dict,
               delay: str = fixed.WATERMARK, compact_every: int = 100) -> StreamingQuery:
    """``events`` is a decoded stream of valid events; ``position`` names the columns that tell
    which of two reports in a batch came first (for Kafka partition and offset)."""
    def step(batch: DataFrame, batch_id: int) -> None:
        take_in(batch, batch_id, seen, frontier, kept, late, position, delay=delay)
        for book in (seen, frontier):
            book.compact_every(compact_every, batch_id)
    return (events.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())
