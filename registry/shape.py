"""One output rule for both engines: distances to 4 decimals, other doubles to 6."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def decimals(name: str) -> int:
    return 4 if name.endswith("_km") else 6


def rounded(column: Column, places: int) -> Column:
    """``round`` of a double, which goes through decimal text for every row.

    A whole number of units, divided by a power of ten, is that very double, and below 1e12 units
    the scaled value is off by less than 0.001. What is near a half, large or no number is left to
    ``round``; adding zero takes the sign from -0.
    """
    scaled = column * 10.0 ** places
    whole = F.rint(scaled)
    plain = (F.abs(scaled) < 1e12) & (F.abs(scaled - whole) < 0.499)
    return F.when(plain, whole / 10.0 ** places + 0.0).otherwise(F.round(column, places))


def shown(df: DataFrame, *columns: str) -> DataFrame:
    out = []
    for field in df.select(*columns).schema if columns else df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = rounded(column, decimals(field.name))
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("long")
        out.append(column.alias(field.name))
    return df.select(*out)


DOUBLES = set("""
latitude longitude magnitude depth_km population hazard_score exposure_score
infrastructure_score preparedness_score response_capacity_score final_risk_score avg_criticality
avg_hazard_score event_latitude event_longitude district_latitude district_longitude
distance_to_epicenter_km event_impact_score dynamic_priority_score magnitude_score depth_score
event_strength base_risk_score live_event_impact_score baseline_risk_score live_risk_score
event_magnitude event_depth_km nearest_priority_district_km weighted_priority_distance_km
affected_area_access_score facility_event_impact_score event_safety_score
historical_hazard_safety_score fault_distance_safety_score facility_safety_score
multimodal_score local_support_score facility_activation_score facility_latitude
facility_longitude assignment_distance_km facility_total_assigned_priority low_max medium_max
high_max distance_km scaled
""".split())


def columns_sql(*columns: str) -> str:
    return ", ".join(f"round({c}, {decimals(c)}) AS {c}" if c in DOUBLES else c
                     for c in columns)
