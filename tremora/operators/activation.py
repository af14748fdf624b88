"""Safety and activation score of a facility in an event, ranks and the top three."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremora import fixed, schemas
from tremora.functions import geo, scores
from tremora.operators.access import POOL_COLUMNS
from tremora.operators.facilities import candidate_order
from tremora.operators.ranks import can_be_among, rank_by_score


def with_event_impact(pairs: DataFrame) -> DataFrame:
    """Distance to the epicentre and impact of the event at the facility (rows of ``access``)."""
    return (
        pairs.withColumn("distance_to_epicenter_km", geo.chord_km(geo.chord("_e", "_f")))
        .withColumn("facility_event_impact_score", scores.impact(
            F.col("event_strength"), F.col("distance_to_epicenter_km")))
        .drop("event_strength", *[f"{side}_{axis}" for side in ("_e", "_f") for axis in "xyz"])
    )


def with_safety(pairs: DataFrame) -> DataFrame:
    return (
        with_event_impact(pairs)
        .withColumn("event_safety_score", 100 - F.col("facility_event_impact_score"))
        .withColumn("facility_safety_score", scores.weighted_sum({
            "event_safety_score": fixed.EVENT_SAFETY_WEIGHT,
            "historical_hazard_safety_score": fixed.HAZARD_SAFETY_WEIGHT,
            "fault_distance_safety_score": fixed.FAULT_SAFETY_WEIGHT,
        }))
    )


def with_activation(pairs: DataFrame) -> DataFrame:
    return with_safety(pairs).withColumn(
        "facility_activation_score", scores.weighted_sum(fixed.ACTIVATION_WEIGHTS))


def rank_facilities(activated: DataFrame, bounded: bool = False) -> DataFrame:
    """Place of each eligible facility of an event by activation score."""
    return rank_by_score(activated, "event_id", "facility_activation_score", "activation_rank",
                         ties=candidate_order(), bounded=bounded)


def with_facility(rows: DataFrame, pool: DataFrame) -> DataFrame:
    """Add the pool's other columns to ranked rows, by facility."""
    others = [c for c in pool.columns if c not in rows.columns]
    return rows.join(pool.select("id", "copy", *others), ["id", "copy"])


def ranking_columns(ranked: DataFrame, events: DataFrame, pool: DataFrame) -> DataFrame:
    """The ranking with the attributes of events and facilities. Those of facilities come from the
    pool alone, so that the ranks sort no more columns than they need."""
    narrow = ranked.drop(*[c for c in POOL_COLUMNS if c not in ("id", "copy")])
    about = events.select(
        "event_id", "event_name", F.col("magnitude").alias("event_magnitude"),
        F.col("depth_km").alias("event_depth_km"), "event_latitude", "event_longitude")
    return with_facility(narrow.join(about, "event_id"), pool).select(
        *schemas.RANKING_COLUMNS)


def top_facilities(activated: DataFrame, top: int = fixed.TOP_FACILITIES, sieve: bool = False
                   ) -> DataFrame:
    """The first three facilities of each event by (activation, access), with their rank.

    First all that reach the third best score stay, ties included; Spark makes that cut before
    any shuffle. The full rank of such a facility depends on those alone. That cut sorts what it
    gets; with ``sieve`` the many that reach no proven bound are left out before. It is meant for
    rows that come partitioned by event, others it would shuffle.
    """
    event = W.partitionBy("event_id")
    best = F.desc("facility_activation_score")
    if sieve:
        activated = can_be_among(activated, "event_id", "facility_activation_score", top,
                                 ["id", "copy"])
    return (
        activated.withColumn("_r", F.rank().over(event.orderBy(best)))
        .where(F.col("_r") <= top).drop("_r")
        .withColumn("activation_rank",
                    F.row_number().over(event.orderBy(best, *candidate_order())))
        .withColumn("facility_order", F.row_number().over(event.orderBy(
            best, F.desc("affected_area_access_score"), F.asc("activation_rank"))))
        .where(F.col("facility_order") <= top)
    )
