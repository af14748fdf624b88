"""What a facility has around it, and the parts of its safety that no event changes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremora import fixed
from tremora.functions import scores
from tremora.operators.facilities import support_points
from tremora.operators.order_stats import percentiles
from tremora.operators.spatial import counts_around

COUNT_COLUMNS = {
    "hastane": "nearby_hospital_count",
    "itfaiye": "nearby_fire_station_count",
    "polis": "nearby_police_count",
    "akaryakit": "nearby_fuel_station_count",
}


def _centers(facilities: DataFrame) -> DataFrame:
    # duplicate risk keys can list a facility twice; its surroundings are counted once
    return facilities.select(
        F.col("id").alias("center_id"), F.col("latitude").alias("center_lat"),
        F.col("longitude").alias("center_lon")).dropDuplicates(["center_id"])


def _points(pois: DataFrame) -> DataFrame:
    return pois.select(F.col("kategori").alias("near"), F.col("latitude").alias("point_lat"),
                       F.col("longitude").alias("point_lon"))


def min_max(df: DataFrame, column: str, name: str) -> DataFrame:
    """Scale a column to 0-100 over the whole table; what is no number counts as 0."""
    number = F.coalesce(scores.to_number(F.col(column)), F.lit(0.0))
    ends = df.agg(F.struct(F.min(number).alias("low"), F.max(number).alias("high")))
    ends = ends.scalar()
    return df.withColumn(name, scores.scaled(number, ends["low"], ends["high"]))


def with_local_support(facilities: DataFrame, pois: DataFrame,
                       rows: int = fixed.BROADCAST_ROWS) -> DataFrame:
    """Counts of support points within 15 km, their weighted sum, and that sum scaled."""
    kinds = {name: F.col("near") == category for category, name in COUNT_COLUMNS.items()}
    counts = counts_around(_points(support_points(pois)), _centers(facilities),
                           fixed.LOCAL_SUPPORT_RADIUS_KM, kinds, rows)
    joined = (
        facilities.join(counts, F.col("id") == F.col("center_id"), "left").drop("center_id")
        .fillna(0, subset=list(COUNT_COLUMNS.values()))
        .withColumn("local_support_raw", scores.weighted_sum(
            {COUNT_COLUMNS[c]: w for c, w in fixed.SUPPORT_WEIGHTS.items()}))
    )
    return joined


def with_multimodal(facilities: DataFrame, rows: int = fixed.BROADCAST_ROWS) -> DataFrame:
    """How many of the four transport modes lie within 20 km, itself included."""
    modes = list(fixed.FACILITY_TYPE_SCORES)
    near = counts_around(_points(facilities), _centers(facilities), fixed.MULTIMODAL_RADIUS_KM,
                         {f"_{m}": F.col("near") == m for m in modes}, rows)
    count = sum((F.when(F.col(f"_{m}") > 0, 1).otherwise(0) for m in modes), F.lit(0))
    counted = near.select("center_id", count.alias("nearby_transport_mode_count"))
    return (
        facilities.join(counted, F.col("id") == F.col("center_id")).drop("center_id")
        .withColumn("multimodal_score",
                    F.col("nearby_transport_mode_count") / len(modes) * 100)
    )


def with_static_safety(facilities: DataFrame) -> DataFrame:
    """Safety from past hazard and from the distance to a fault, over all facilities."""
    fault = scores.to_number(F.col("fay_mesafe_km"))
    numbered = facilities.withColumn("_fault", fault)
    median = percentiles(numbered, "_fault", [0.5])[0]
    filled = numbered.withColumn("_fault", F.coalesce(F.col("_fault"), F.lit(
        0.0 if median is None else median)))
    hazard = min_max(filled, "hazard_score", "_hazard")
    return (
        min_max(hazard, "_fault", "fault_distance_safety_score")
        .withColumn("historical_hazard_safety_score", 100 - F.col("_hazard"))
        .drop("_hazard", "_fault")
    )
