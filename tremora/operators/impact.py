"""What an event does to a district."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremora import fixed, schemas
from tremora.functions import geo, scores
from tremora.operators.pairing import theta_join
from tremora.session import task_count
from tremora.sources import feeds


def event_side(events: DataFrame) -> DataFrame:
    sided = (
        events.withColumnsRenamed({"latitude": "event_latitude", "longitude": "event_longitude"})
        .withColumns({
            "severity": scores.severity(F.col("magnitude")),
            "event_strength": scores.event_strength(F.col("magnitude"), F.col("depth_km")),
        })
    )
    return geo.with_unit(sided, "event_latitude", "event_longitude", "_e")


def district_side(districts: DataFrame) -> DataFrame:
    sided = districts.select(
        "province", "district", "province_key", "district_key",
        F.col("latitude").alias("district_latitude"),
        F.col("longitude").alias("district_longitude"),
        "final_risk_score",
    )
    return geo.with_unit(sided, "district_latitude", "district_longitude", "_d")


def spread(events: DataFrame, tasks: int = 0) -> DataFrame:
    """Hash events by id over all tasks, one row each, before they fan out to districts.

    Every later step per event (ranks, top lists, arrays) finds this partitioning in place, so
    the pairs themselves are never shuffled. The number is given so that adaptive execution does
    not merge partitions that are small now but fan out a thousandfold. The same holds for a
    micro-batch, whose few files would else be one task. A later step that sorts the pairs gives the
    number of ``tasks`` that keeps each of them small, if that is more.
    """
    # twice the shuffle setting: with the same number Spark would take an earlier shuffle by
    # event for this one, and merge its partitions
    return events.repartition(max(2 * task_count(events.sparkSession), tasks), "event_id")


def distance() -> Column:
    return geo.chord_km(geo.chord("_e", "_d"))


def with_impact(pairs: DataFrame) -> DataFrame:
    return (
        pairs.withColumn("distance_to_epicenter_km", distance())
        .withColumn("event_impact_score", scores.impact(F.col("event_strength"),
                                                        F.col("distance_to_epicenter_km")))
        .withColumn("dynamic_priority_score",
                    scores.dynamic_priority(F.col("event_impact_score"),
                                            F.col("final_risk_score")))
    )


def score_pairs(events: DataFrame, districts: DataFrame,
                rows: int = fixed.BROADCAST_ROWS) -> DataFrame:
    """Every event with every district: the scored feed is defined as that product.

    Only events move, one row each, while the district table fits. Reports that need less than
    the product (top lists, worst cases) do not start from here; they bound the pairs first.
    """
    return _pairs(event_side(events), district_side(districts), rows).select(
        *schemas.SCORED_COLUMNS)


def _pairs(events: DataFrame, districts: DataFrame, rows: int) -> DataFrame:
    return with_impact(theta_join(spread(events), districts, None, "event_id",
                                  ["province_key", "district_key"], rows))


_OF_EVENT, _OF_DISTRICT = schemas.SCORED_COLUMNS[:8], schemas.SCORED_COLUMNS[8:14]
_NUMBERS = schemas.SCORED_COLUMNS[14:]


def pair_messages(events: DataFrame, districts: DataFrame,
                  rows: int = fixed.BROADCAST_ROWS) -> DataFrame:
    """``score_pairs`` as (key, value) messages, the very text that ``feeds.encode`` makes of them.

    What a pair has from its event and its district becomes text once for each of those, before
    they meet; of a pair only four numbers do.
    """
    pairs = _pairs(event_side(events).withColumn("_event", feeds.opening(_OF_EVENT)),
                   district_side(districts).withColumn("_district", feeds.opening(_OF_DISTRICT)),
                   rows)
    return feeds.encode_parts(pairs, F.col("district_key"), ["_event", "_district"],
                              [*_OF_EVENT, *_OF_DISTRICT], _NUMBERS)
