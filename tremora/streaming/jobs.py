"""The three continuous jobs. Sources and sinks are any Spark format, Kafka included."""

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tremora import fixed, schemas
from tremora.operators import districts, impact, ingest, risk
from tremora.plans import recommend
from tremora.session import written
from tremora.sources import feeds
from tremora.streaming.ledger import Ledger

SCORE_TRIGGER = {"processingTime": "10 seconds"}
RISK_TRIGGER = {"processingTime": "15 seconds"}
RECOMMEND_TRIGGER = {"processingTime": "20 seconds"}

# batches between two foldings of a keyed table's history
COMPACT_EVERY = 100
# buckets of one day's pairs
PAIR_BUCKETS = 8
# a batch that touches more days than this reads its buckets of every day
MOST_DAYS = 1000

Publish = Callable[[DataFrame, int], None]


def folder_feed(path: str) -> Publish:
    """Feed as Parquet, one folder per batch; a replay replaces its folder."""
    def publish(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    return publish


def format_feed(fmt: str, options: dict[str, str]) -> Publish:
    """Feed through any batch writer (Kafka: at least once, so consumers drop repeats)."""
    def publish(rows: DataFrame, batch_id: int) -> None:
        feeds.write_batch(rows, fmt, options)
    return publish


# --- job 1: events to scored pairs ------------------------------------------------------------

def decoded_events(raw: DataFrame) -> DataFrame:
    return feeds.decode(raw, schemas.EVENT)


def scored_stream(raw: DataFrame, district_table: DataFrame, drop_repeats: bool = False
                  ) -> DataFrame:
    """Raw (key, value) stream to messages of scored pairs, in the very operators of the batch job.

    Late events are scored like any other. With ``drop_repeats`` re-sent events go, but so do
    events older than the watermark: use it only where the feed is in order.
    """
    events = ingest.with_event_time(ingest.valid(decoded_events(raw)))
    if drop_repeats:
        events = ingest.drop_repeats(events)
    return impact.pair_messages(events.drop("event_time_ts"), district_table)


def score_job(raw: DataFrame, district_table: DataFrame, fmt: str, options: dict[str, str],
              checkpoint: str, trigger: dict = SCORE_TRIGGER, drop_repeats: bool = False
              ) -> StreamingQuery:
    out = scored_stream(raw, district_table, drop_repeats)
    return feeds.append_stream(out, fmt, options, checkpoint, trigger).start()


def quarantine_job(raw: DataFrame, fmt: str, options: dict[str, str], checkpoint: str,
                   trigger: dict = SCORE_TRIGGER) -> StreamingQuery:
    """The records job 1 cannot score, with their text."""
    parsed = feeds.decode(raw.withColumn("text", F.col("value").cast("string")),
                          schemas.EVENT, keep=("text",))
    return feeds.append_stream(ingest.quarantined(parsed), fmt, options, checkpoint,
                               trigger).start()


# --- job 2: scored pairs to live risk ---------------------------------------------------------

LIVE_RISK = T.StructType([
    *[T.StructField(c, T.StringType()) for c in
      ("province_key", "district_key", "province", "district")],
    *[T.StructField(c, T.DoubleType()) for c in
      ("live_event_impact_score", "baseline_risk_score", "dynamic_priority_score")],
    *[T.StructField(c, T.StringType()) for c in
      ("triggering_event_id", "strongest_event_id")],
    T.StructField("live_risk_score", T.DoubleType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
])


def live_risk_table(spark: SparkSession, path: str) -> Ledger:
    return Ledger(spark, path, LIVE_RISK, tuple(risk.DISTRICT_KEYS), "district_key", 1)


def update_live_risk(scored: DataFrame, batch_id: int, table: Ledger, publish: Publish,
                     steps=fixed.RISK_LEVEL_STEPS) -> None:
    """One micro-batch: state first, then the changes against the state before this batch."""
    if scored.isEmpty():
        return
    now = F.lit(datetime.now(timezone.utc))
    updates = risk.with_live_risk(risk.district_worst_case(scored), now, steps)
    table.append(updates, batch_id)
    changes = risk.changed(table.of_batch(batch_id), table.latest(batch_id))
    publish(feeds.encode(changes, F.col("district_key"), schemas.CHANGE_COLUMNS), batch_id)


def risk_job(scored: DataFrame, table: Ledger, publish: Publish, checkpoint: str,
             trigger: dict = RISK_TRIGGER, compact_every: int = COMPACT_EVERY,
             steps=fixed.RISK_LEVEL_STEPS) -> StreamingQuery:
    """``scored`` is the decoded stream of job 1's feed; ``steps`` the limits of the risk levels,
    as ``risk.steps_of`` takes them from a district table."""
    def step(batch: DataFrame, batch_id: int) -> None:
        update_live_risk(batch, batch_id, table, publish, steps)
        table.compact_every(compact_every, batch_id)
    return (scored.writeStream.foreachBatch(step)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


# --- live risk that fades ---------------------------------------------------------------------

def current_live_risk(table: Ledger, faded: Ledger, before: int | None = None) -> DataFrame:
    """The live table with its fading: of a district's last event and last decay the later one.
    ``before`` leaves out the decays from that number on."""
    rows = table.current().unionByName(
        (faded.current() if before is None else faded.latest(before)).select(*LIVE_RISK.names))
    last = W.partitionBy(*risk.DISTRICT_KEYS).orderBy(F.desc("updated_at"))
    return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def decay_live_risk(now: datetime, number: int, table: Ledger, faded: Ledger, publish: Publish,
                    hours: float = fixed.DECAY_HOURS, steps=fixed.RISK_LEVEL_STEPS) -> None:
    """Let every district's live risk fade up to ``now``, without any new event, and publish those
    that change their level.

    Decays are a table of their own, so that this job and job 2 never write the same one. A decay
    starts from the last: whatever the schedule, the product of the steps is the whole.
    """
    at = F.lit(now)
    before = written(current_live_risk(table, faded, number).where(F.col("updated_at") < at),
                     "before-decay")
    if before.isEmpty():
        return
    after = risk.decayed(before, at, hours, steps).withColumn("updated_at", at)
    faded.append(after, number)
    old = before.select(*risk.DISTRICT_KEYS, F.col("risk_level").alias("_level"))
    moved = faded.of_batch(number).join(old, risk.DISTRICT_KEYS).where(
        F.col("risk_level") != F.col("_level"))
    publish(feeds.encode(moved, F.col("district_key"), schemas.CHANGE_COLUMNS), number)


def decay_job(ticks: DataFrame, table: Ledger, faded: Ledger, publish: Publish, checkpoint: str,
              trigger: dict, compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """``ticks`` is any stream with a ``timestamp`` (Spark's ``rate`` source); the latest one of a
    batch is its time, also when the batch is replayed."""
    def step(batch: DataFrame, batch_id: int) -> None:
        now = batch.agg(F.max("timestamp")).first()[0]
        if now is not None:
            decay_live_risk(now, batch_id, table, faded, publish)
            faded.compact_every(compact_every, batch_id)
    return (ticks.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(**trigger).start())


# --- job 3: scored pairs to recommendations ---------------------------------------------------

_RECOMMENDATION_TEXT = {
    "event_id", "event_name", "event_time", "province", "district", "province_key",
    "district_key", "facility_name", "facility_category", "facility_access_type",
    "facility_province", "facility_district",
}
_RECOMMENDATION_WHOLE = {"facility_id": T.LongType(), "district_priority_rank": T.IntegerType(),
                         "facility_activation_rank": T.IntegerType()}
RECOMMENDATION_COLUMNS = [
    "event_id", "event_name", "event_time", "event_magnitude", "event_depth_km",
    "event_latitude", "event_longitude", "province", "district", "province_key",
    "district_key", "district_latitude", "district_longitude", "district_priority_rank",
    "event_impact_score", "base_risk_score", "dynamic_priority_score", "facility_id",
    "facility_name", "facility_category", "facility_access_type", "facility_province",
    "facility_district", "facility_latitude", "facility_longitude",
    "facility_activation_rank", "facility_activation_score", "affected_area_access_score",
    "facility_safety_score", "multimodal_score", "local_support_score",
    "assignment_distance_km",
]
RECOMMENDATION = T.StructType([
    T.StructField(c, T.StringType() if c in _RECOMMENDATION_TEXT
                  else _RECOMMENDATION_WHOLE.get(c, T.DoubleType()))
    for c in RECOMMENDATION_COLUMNS
])


EVENT_DAY = T.StructType([T.StructField("event_id", T.StringType()),
                          T.StructField("day_filed", T.StringType())])


def scored_table(spark: SparkSession, path: str) -> Ledger:
    """All pairs, filed by the day of the event and, within it, by a hash of the event."""
    return Ledger(spark, path, schemas.SCORED, ("event_id", "province_key", "district_key"),
                  "event_id", PAIR_BUCKETS, "event_time")


def days_table(pairs: Ledger) -> Ledger:
    """Under which days the pairs of an event are filed: several, if its time was corrected."""
    return Ledger(pairs.spark, f"{pairs.path}/days", EVENT_DAY, ("event_id", "day_filed"),
                  "event_id")


def recommendation_table(spark: SparkSession, path: str) -> Ledger:
    """Keyed by event: a new batch replaces all rows of the events it touches."""
    return Ledger(spark, path, RECOMMENDATION, ("event_id",), "event_id")


def current_recommendations(table: Ledger) -> DataFrame:
    return table.current().where(F.col("district_key").isNotNull())


def update_recommendations(scored: DataFrame, batch_id: int, pairs: Ledger, pool: DataFrame,
                           table: Ledger, publish: Publish) -> None:
    """One micro-batch: file its pairs, then redo every event it touched from all its pairs.

    An event's districts may arrive over several batches, so its top ten must not be taken from
    one batch alone.
    """
    if scored.isEmpty():
        return
    # a source may deliver a pair twice; two rows of one pair would both be its last
    pairs.append(pairs.one_per_key(scored), batch_id, dealt=True)
    known_top = top_of_touched(batch_id, pairs)
    touched = pairs.of_batch(batch_id).select("event_id").distinct()
    # ten rows per touched event, written once as they serve twice
    top = written(known_top, "top-districts")
    # an event that lost its last facility in reach leaves one empty row, which hides older ones
    table.append(touched.join(recommend.assignments(top, pool), "event_id", "left"), batch_id)
    rows = table.of_batch(batch_id).where(F.col("district_key").isNotNull())
    key = F.concat_ws(":", F.col("event_id"), F.col("facility_id").cast("string"))
    publish(feeds.encode(rows, key), batch_id)


def pairs_of_touched(batch_id: int, pairs: Ledger) -> DataFrame:
    """All pairs of the events that a batch touched."""
    touched, buckets, named = _parts_of_touched(batch_id, pairs)
    return pairs.latest(batch_id + 1, buckets, named).join(touched, "event_id", "left_semi")


def top_of_touched(batch_id: int, pairs: Ledger) -> DataFrame:
    """The first ten districts of the events that a batch touched, from all their pairs.

    Only keys and scores move to find the last batch of a pair and the ten places; the whole rows
    are read where they lie and joined to the winners.
    """
    touched, buckets, named = _parts_of_touched(batch_id, pairs)
    known = pairs.latest(batch_id + 1, buckets, named).join(touched, "event_id", "left_semi")
    found = districts.top_districts(
        known.select(*pairs.keys, "batch", "dynamic_priority_score", "event_impact_score"),
        sieve=False)
    places = written(found.drop("dynamic_priority_score", "event_impact_score"), "top-places")
    rows = pairs.within(batch_id + 1, buckets, named)
    return (rows.join(places, [*pairs.keys, "batch"])
            .withColumnRenamed("final_risk_score", "base_risk_score"))


def _parts_of_touched(batch_id: int, pairs: Ledger
                      ) -> tuple[DataFrame, list[int], list[str] | None]:
    """The events that a batch touched, and the buckets and days that hold all their pairs (None:
    every day). From those parts alone a batch costs what its events cost, however long the history.

    A narrow table of the days of each event finds them, so an event whose time was corrected is
    still read whole. The driver sees bucket numbers (64 at most) and days (``MOST_DAYS``).
    """
    days = days_table(pairs)
    filed = pairs.filed(batch_id).select("event_id", "bucket", F.col("day").alias("day_filed"))
    days.append(filed.select("event_id", "day_filed").distinct(), batch_id)
    touched = filed.select("event_id").distinct()
    ours = _numbers(filed.select("bucket"))
    theirs = _numbers(touched.select(days.bucket().alias("bucket")))
    found = (days.within(batch_id + 1, theirs).join(touched, "event_id", "left_semi")
             .select("day_filed").distinct().limit(MOST_DAYS + 1).collect())
    named = [r.day_filed for r in found] if len(found) <= MOST_DAYS else None
    return touched, ours, named


def _numbers(buckets: DataFrame) -> list[int]:
    return [r.bucket for r in buckets.distinct().collect()]


def recommend_job(scored: DataFrame, pairs: Ledger, pool: DataFrame, table: Ledger,
                  publish: Publish, checkpoint: str, trigger: dict = RECOMMEND_TRIGGER,
                  compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    def step(batch: DataFrame, batch_id: int) -> None:
        update_recommendations(batch, batch_id, pairs, pool, table, publish)
        for book in (pairs, days_table(pairs), table):
            book.compact_every(compact_every, batch_id)
    return (scored.writeStream.foreachBatch(step)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def scored_feed_stream(spark: SparkSession, fmt: str, options: dict[str, str],
                       columns: list[str] = schemas.SCORED_COLUMNS) -> DataFrame:
    """Job 1's feed as typed rows, the input of jobs 2 and 3; ``risk.COLUMNS`` are what job 2 uses."""
    return scored_messages(_feed_stream(spark, fmt, options), columns)


def scored_messages(raw: DataFrame, columns: list[str] = schemas.SCORED_COLUMNS) -> DataFrame:
    """(key, value) messages of job 1's feed as typed rows. A job that uses some ``columns`` alone
    spares the others' numbers and texts; the keys must be among them."""
    return usable_scores(feeds.decode(raw, schemas.scored(columns)))


def scored_quarantine_job(spark: SparkSession, source: str, source_options: dict[str, str],
                          fmt: str, options: dict[str, str], checkpoint: str,
                          trigger: dict = RISK_TRIGGER) -> StreamingQuery:
    """The messages of job 1's feed that jobs 2 and 3 leave out, with their text."""
    raw = _feed_stream(spark, source, source_options).withColumn(
        "text", F.col("value").cast("string"))
    parsed = feeds.decode(raw, schemas.SCORED, keep=("text",))
    return feeds.append_stream(parsed.where(~_is_scored()).select("text"), fmt, options,
                               checkpoint, trigger).start()


def usable_scores(scored: DataFrame) -> DataFrame:
    """Rows with all their keys; what could not be decoded has none."""
    return scored.where(_is_scored())


def _is_scored() -> Column:
    test = F.lit(True)
    for name in ("event_id", "province_key", "district_key"):
        test = test & F.col(name).isNotNull()
    return test


def _feed_stream(spark: SparkSession, fmt: str, options: dict[str, str]) -> DataFrame:
    return feeds.read_stream(spark, fmt, options, None if fmt == "kafka" else feeds.KEY_VALUE)
