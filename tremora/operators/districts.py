"""Which districts need help first, per event."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremora import fixed, schemas
from tremora.functions import geo, scores
from tremora.operators import impact, pyramid
from tremora.operators.pairing import fits_broadcast
from tremora.operators.ranks import can_be_among, rank_by_score
from tremora.session import written


def priority_order() -> list[Column]:
    """One order for every top list of districts: score, then impact, then the keys."""
    return [F.desc("dynamic_priority_score"), F.desc("event_impact_score"),
            F.asc("district_key"), F.asc("province_key")]


def rank_districts(scored: DataFrame, bounded: bool = False) -> DataFrame:
    """Dense rank of all districts of each event, and whether it is among the first ten."""
    ranked = rank_by_score(scored, "event_id", "dynamic_priority_score", "event_priority_rank",
                           bounded=bounded)
    return (
        ranked.withColumn("is_priority_district",
                          F.col("event_priority_rank") <= fixed.TOP_DISTRICTS)
        .withColumnRenamed("final_risk_score", "base_risk_score")
    )


def rank_districts_of_events(events: DataFrame, districts: DataFrame,
                             rows: int = fixed.BROADCAST_ROWS) -> DataFrame:
    """The same straight from events and districts. A counted district table bounds the rows of
    an event, and its pairs are in one task already, so nothing but the events is shuffled."""
    return rank_districts(impact.score_pairs(events, districts, rows),
                          bounded=fits_broadcast(districts, rows))


def _first_ten(rated: DataFrame, top: int) -> DataFrame:
    """Ten rows per event, with their position and dense rank.

    Spark cuts to ``top`` rows per event inside each map task, so nothing but the winners moves.
    The dense rank of a winner depends on higher scores only, and all of those are winners too.
    """
    per_event = W.partitionBy("event_id")
    return (
        rated.withColumn("district_order",
                         F.row_number().over(per_event.orderBy(*priority_order())))
        .where(F.col("district_order") <= top)
        .withColumn("event_priority_rank", F.dense_rank().over(
            per_event.orderBy(F.desc("dynamic_priority_score"))))
        .withColumnRenamed("final_risk_score", "base_risk_score")
    )


def top_districts(scored: DataFrame, top: int = fixed.TOP_DISTRICTS, sieve: bool = True
                  ) -> DataFrame:
    """The first ten districts of each event, from a table of scored pairs. Without ``sieve`` pairs
    are read once and all are sorted: for rows that are narrow, or dear to read."""
    rated = scored.where(F.col("dynamic_priority_score").isNotNull())
    if not sieve:
        return _first_ten(rated, top)
    return _first_ten(can_be_among(rated, "event_id", "dynamic_priority_score", top,
                                   ["province_key", "district_key"]), top)


#: Shares of the districts below the limits of the risk bands, finer towards the riskiest.
_BANDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99)
_ANYWHERE = 2 * pyramid.LEVELS[-1]


def _bounded_events(events: DataFrame, side: DataFrame, top: int, rows: int) -> DataFrame:
    """Events with ``_bound``, a priority that ``top`` districts are proven to reach.

    An impact is never negative, so the riskiest districts of all prove 0.4 of the least risk
    among them; the riskiest districts of the event's own cells prove more, by their impact.
    """
    riskiest = (side.select("final_risk_score").orderBy(F.desc("final_risk_score")).limit(top)
                .agg(F.when(F.count(F.lit(1)) == top, F.min("final_risk_score")).alias("r")))
    start = F.coalesce(riskiest.scalar() * fixed.BASE_RISK_WEIGHT, F.lit(float("-inf")))
    unit = [F.col(f"_d_{axis}").alias(axis) for axis in "xyz"]
    table = pyramid.champions(side, "district_latitude", "district_longitude", "final_risk_score",
                              unit, top)
    found, names = pyramid.with_champions(events, table, "event_latitude", "event_longitude", rows)

    def proven(member: Column) -> Column:
        km = geo.chord_km(pyramid.squared_chord(member, "_e"))
        return scores.dynamic_priority(scores.impact(F.col("event_strength"), km), member["_w"])
    bounds = [start, *[F.array_min(F.transform(name, proven)) for name in names]]
    return found.withColumn("_bound", F.greatest(*bounds) if names else start).drop(*names)


def _limits(side: DataFrame) -> list[float]:
    """The highest risk of each risk band, ascending; a dozen numbers."""
    found = side.agg(F.approx_percentile("final_risk_score", list(_BANDS), 1000).alias("q"),
                     F.max("final_risk_score").alias("top")).first()
    return [] if found.top is None else sorted({*found.q, found.top})


def district_candidates(events: DataFrame, districts: DataFrame, top: int = fixed.TOP_DISTRICTS,
                        rows: int = fixed.BROADCAST_ROWS) -> DataFrame:
    """Pairs (event, district) of which the first ``top`` of every event are the true ones.

    A district needs an impact of ``bound - 0.4 risk`` (over 0.6) to reach an event's bound, and
    so has to lie within a radius that only the event and the risk decide. Districts are dealt
    into bands of risk, an event takes one radius per band, and looks for the band's districts on
    the narrowest grid that the radius fits: one equality, and no pair beyond it is met.
    """
    side = impact.district_side(districts).where(
        "final_risk_score IS NOT NULL AND district_latitude IS NOT NULL "
        "AND district_longitude IS NOT NULL")
    size = side.count() * len(pyramid.LEVELS) * pyramid.MOST_CELLS
    bounded = _bounded_events(impact.spread(impact.event_side(events)), side, top, rows)
    if size > rows:
        # both sides are shuffled by cell then: few files must not fan out in few tasks
        bounded = written(bounded, "bounded-events")
        most = bounded.count() * (len(_BANDS) + 1)
        bounded = bounded.repartition(pyramid.task_count_for(bounded, most, pyramid.FAN_ROWS))
        side = side.repartition(pyramid.task_count_for(side, size, pyramid.FAN_ROWS))
    limits = _limits(side)
    if not limits:
        limits = [0.0]
    need = F.col("_bound") - F.col("_limit") * fixed.BASE_RISK_WEIGHT - 1e-6
    most = F.col("event_strength") * fixed.IMPACT_WEIGHT
    # with slack on both: an impact can exceed the strength by a few units in last place
    radius = F.coalesce(pyramid.reach(most, need), F.lit(_ANYWHERE))
    placed = (bounded.select("*", F.posexplode(F.array(*map(F.lit, limits))).alias("_band", "_limit"))
              .where((need <= 0) | ((most > 0) & (radius >= 0))).withColumn("_km", radius)
              .withColumn("_level", pyramid.level_of("_km")).drop("_limit", "_km"))
    placed = placed.withColumn("_cell", F.element_at(
        pyramid.cells("event_latitude", "event_longitude"), F.col("_level") + 1))
    band = F.expr("CASE " + " ".join(f"WHEN final_risk_score <= {limit!r}D THEN {n}"
                                     for n, limit in enumerate(limits)) + " END")
    listed = (side.withColumn("_band", band)
              .withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(len(pyramid.LEVELS) - 1))))
              .withColumn("_cell", F.explode(pyramid.around(
                  "district_latitude", "district_longitude", "_level"))))
    exact = scores.dynamic_priority(scores.impact(F.col("event_strength"), impact.distance()),
                                    F.col("final_risk_score")) >= F.col("_bound")
    return pyramid.band_join(placed, listed, exact, size, rows).drop("_bound")


def top_districts_of_events(events: DataFrame, districts: DataFrame,
                            top: int = fixed.TOP_DISTRICTS,
                            rows: int = fixed.BROADCAST_ROWS) -> DataFrame:
    """The same straight from events and districts, from candidates instead of the product."""
    pairs = district_candidates(events, districts, top, rows)
    return _first_ten(impact.with_impact(pairs).select(*schemas.SCORED_COLUMNS), top)


_ATTRIBUTES = ["event_id", "event_name", "event_time", "severity", "magnitude", "depth_km",
               "event_latitude", "event_longitude"]


def event_attributes(scored: DataFrame) -> DataFrame:
    """One row per event with its own columns, as its first district has them.

    The pairs of an event seldom differ in them, so the sets that occur are found first, by an
    aggregation that sorts no pairs. Only events with several are looked up in the pairs again.
    """
    sets = written(scored.select(*_ATTRIBUTES).distinct(), "event-attributes").withColumn(
        "_sets", F.count(F.lit(1)).over(W.partitionBy("event_id")))
    settled = sets.where("_sets = 1").drop("_sets")
    several = sets.where("_sets > 1").select(F.col("event_id").alias("_id")).distinct()
    if several.isEmpty():
        return settled
    first = W.partitionBy("event_id").orderBy("district_key", "province_key")
    again = scored.join(several, F.col("event_id").eqNullSafe(F.col("_id")), "left_semi")
    return settled.unionByName(
        again.select(*_ATTRIBUTES, "district_key", "province_key")
        .withColumn("_n", F.row_number().over(first)).where("_n = 1").select(*_ATTRIBUTES))


def attributes_of_events(events: DataFrame) -> DataFrame:
    """The same straight from the events, each of which is one row: no pair is formed."""
    return impact.event_side(events).select(*_ATTRIBUTES)


def require_events(df: DataFrame, event_ids: list[str]) -> None:
    """Raise for ids that have no rows, as a caller asking for named events expects."""
    found = df.where(F.col("event_id").isin(event_ids)).select("event_id").distinct()
    missing = sorted(set(event_ids) - {r.event_id for r in found.collect()})
    if missing:
        raise ValueError(f"no rows for events: {', '.join(missing)}")
