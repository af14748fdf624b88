"""Facilities against the ten worst districts of each event."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremora import fixed
from tremora.functions import geo, scores
from tremora.operators.pairing import fits_broadcast, numbers

EVENT_COLUMNS = ["event_id", "event_name", "magnitude", "depth_km", "event_latitude",
                 "event_longitude"]
_PLACES = range(fixed.TOP_DISTRICTS)
# what a pair needs of the pool; names and the like are joined to the ranked rows afterwards
POOL_COLUMNS = ["id", "copy", "is_named", "facility_type_score", "multimodal_score",
                "local_support_score", "historical_hazard_safety_score",
                "fault_distance_safety_score"]


def _known(column: Column) -> Column:
    # candidates and ranked districts have coordinates; telling Spark spares a null test per use
    return F.coalesce(column, F.lit(0.0))


def events_with_districts(top: DataFrame) -> DataFrame:
    """One row per event: where its (at most ten) top districts are, and their share of weight.

    The districts become plain columns ``_t0_x .. _t9_share``, so that the distances to all ten
    are compiled code and not a loop over an array. An event with fewer repeats its first one,
    with no share.
    """
    km = fixed.MAX_PRIORITY_DISTANCE_KM
    weight = F.greatest(F.col("dynamic_priority_score"), F.lit(0.0)).alias("weight")
    placed = geo.with_unit(top, "district_latitude", "district_longitude", "_t")
    rows = placed.groupBy("event_id").agg(
        *[F.first(c).alias(c) for c in EVENT_COLUMNS[1:]],
        F.sum(weight).alias("_weights"),
        F.sort_array(F.collect_list(F.struct(
            "district_order", "district_latitude", "district_longitude", weight,
            F.col("_t_x").alias("x"), F.col("_t_y").alias("y"), F.col("_t_z").alias("z"),
        ))).alias("_top"),
    )
    cells = geo.around_sql("d.district_latitude", "d.district_longitude", km)
    around = F.expr(f"array_distinct(flatten(transform(_top, d -> {cells})))")
    columns = {}
    for i in _PLACES:
        here = F.get("_top", F.lit(i))
        place = F.coalesce(here, F.get("_top", F.lit(0)))
        for axis in "xyz":
            columns[f"_t{i}_{axis}"] = _known(place[axis])
        columns[f"_t{i}_share"] = _known(F.when(here.isNull(), 0.0).when(
            F.col("_weights") > 0, here["weight"] / F.col("_weights")
        ).otherwise(1 / F.size("_top")))
    columns["event_strength"] = _known(
        scores.event_strength(F.col("magnitude"), F.col("depth_km")))
    epicentre = geo.unit(F.col("event_latitude"), F.col("event_longitude"))
    columns.update({f"_e_{axis}": _known(v) for axis, v in zip("xyz", epicentre)})
    return rows.withColumns({**columns, "_cells": around}).drop("_top", "_weights")


def access(events: DataFrame, pool: DataFrame, rows: int = fixed.BROADCAST_ROWS,
           salts: int = fixed.SALTS) -> DataFrame:
    """(event, eligible facility) rows with distances and proximity to the top districts.

    Rows carry ids and numbers only; names and attributes are joined to what is left of them.

    A facility counts only within 100 km of one of the districts, so an event looks it up in the
    grid cells around its districts; each facility has one cell and shows up once. With
    the pool broadcast (behind a count) the event rows stay where they are. A larger pool is
    shuffled by cell, the events of a cell dealt over ``salts`` parts.

    All trigonometry is done beforehand, once per event and facility. What is left per pair must
    compile to one method below 8000 bytes, or the JVM interprets it and is ten times slower.
    """
    km = fixed.MAX_PRIORITY_DISTANCE_KM
    looking = events.withColumn("_cell", F.explode("_cells")).drop(
        "_cells", *EVENT_COLUMNS[1:])
    place = F.col("latitude"), F.col("longitude")
    placed = pool.select(*POOL_COLUMNS, geo.cell_of("latitude", "longitude", km).alias("_at"), *[
        _known(value).alias(f"_f_{axis}") for axis, value in zip("xyz", geo.unit(*place))])
    here = F.col("_cell") == F.col("_at")
    if fits_broadcast(pool, rows):
        pairs = looking.join(F.broadcast(placed), here)
    else:
        looking = looking.withColumn("_part", F.pmod(F.xxhash64("event_id"), F.lit(salts)))
        placed = placed.withColumn(
            "_salt", F.explode(numbers(salts)))
        pairs = looking.join(placed, here & (F.col("_part") == F.col("_salt"))).drop(
            "_part", "_salt")

    pairs = pairs.where(reduce(lambda a, b: a | b, [
        geo.product(f"_t{i}", "_f") >= geo.product_limit(km) for i in _PLACES]))
    # sums over the ten districts, in angles, with all factors that are common taken out
    pairs = pairs.withColumns({f"_c{i}": geo.chord(f"_t{i}", "_f") for i in _PLACES})
    pairs = pairs.withColumns({f"_a{i}": geo.half_angle(F.col(f"_c{i}")) for i in _PLACES})

    def average(value) -> Column:
        return reduce(lambda a, b: a + b, [
            value(F.col(f"_a{i}")) * F.col(f"_t{i}_share") for i in _PLACES])

    fading = -geo.KM_PER_HALF_ANGLE / fixed.DISTANCE_DECAY_KM
    return pairs.withColumns({
        "nearest_priority_district_km": geo.chord_km(F.least(*[f"_c{i}" for i in _PLACES])),
        "affected_area_access_score": average(lambda angle: F.exp(angle * fading)) * 100,
        "weighted_priority_distance_km": average(lambda angle: angle) * geo.KM_PER_HALF_ANGLE,
    }).drop("_cell", "_at", *[f"_{part}{i}" for i in _PLACES for part in "ca"],
            *[f"_t{i}_{part}" for i in _PLACES for part in ("x", "y", "z", "share")])
