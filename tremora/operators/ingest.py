"""From raw feed records to clean, unique events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremora import fixed
from tremora.functions.scores import to_number


def _filled(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def _truthy_number(name: str) -> Column:
    """A number that is given and not zero."""
    return F.nullif(to_number(F.col(name)), F.lit(0.0))


def normalize_feed(decoded: DataFrame, now: Column | None = None,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Agency records (``schemas.FEED``) to the event layout.

    ``now`` stamps the records (and times those without a date); pass a literal where a rerun has
    to give the same rows.
    """
    now = F.current_timestamp() if now is None else now
    stamp = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return decoded.select(
        *keep,
        F.coalesce(_filled("eventID"), _filled("id")).alias("event_id"),
        F.coalesce(F.col("location"), F.lit(fixed.DEFAULT_EVENT_NAME)).alias("event_name"),
        to_number(F.col("latitude")).alias("latitude"),
        to_number(F.col("longitude")).alias("longitude"),
        F.coalesce(_truthy_number("magnitude"), _truthy_number("ml"), F.lit(0.0))
        .alias("magnitude"),
        F.coalesce(to_number(F.col("depth")), F.lit(fixed.DEFAULT_DEPTH_KM)).alias("depth_km"),
        F.coalesce(_filled("date"), stamp).alias("event_time"),
        F.lit(fixed.FEED_SOURCE).alias("source"),
        stamp.alias("ingested_at"),
    )


_NUMBERS = ("latitude", "longitude", "magnitude", "depth_km")


def nan_to_null(events: DataFrame) -> DataFrame:
    return events.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double"))
                               for c in _NUMBERS})


def _complete() -> Column:
    test = F.col("event_id").isNotNull()
    for name in _NUMBERS:
        test = test & F.col(name).isNotNull()
    return test


def valid(events: DataFrame) -> DataFrame:
    """Events that can be scored."""
    return nan_to_null(events).where(_complete())


def quarantined(events: DataFrame) -> DataFrame:
    """The rest: undecodable or incomplete records, kept for inspection."""
    return nan_to_null(events).where(~_complete())


def strong_enough(events: DataFrame, least: float = fixed.MIN_MAGNITUDE) -> DataFrame:
    return events.where(~(F.col("magnitude") < least))


def first_reports(events: DataFrame, position: str) -> DataFrame:
    """One row per event: its earliest report by feed position.

    The rank is cut to 1 inside each map task before the shuffle, so an event that was re-sent a
    billion times costs the reducer one row per task.
    """
    first = W.partitionBy("event_id").orderBy(position)
    return (events.withColumn("_n", F.row_number().over(first))
            .where("_n = 1").drop("_n"))


def drop_repeats(stream: DataFrame, time: str = "event_time_ts",
                 delay: str = fixed.WATERMARK) -> DataFrame:
    """The same for a stream; state is kept only as long as the watermark allows."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(["event_id"])


def with_event_time(events: DataFrame) -> DataFrame:
    """Event time as a timestamp; where it cannot be read, the time of intake."""
    return events.withColumn("event_time_ts", F.coalesce(
        F.try_to_timestamp(F.col("event_time")), F.try_to_timestamp(F.col("ingested_at")),
        F.current_timestamp()))


def recent(events: DataFrame, delay: str = fixed.WATERMARK) -> DataFrame:
    """Optional late-data policy: drop events older than ``delay`` when they were taken in."""
    taken_in = F.try_to_timestamp(F.col("ingested_at"))
    return events.where(F.col("event_time_ts") >= taken_in - F.expr(f"INTERVAL {delay}"))
