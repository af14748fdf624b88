"""Record layouts, each declared once."""

from pyspark.sql import types as T

_S, _D, _L = T.StringType(), T.DoubleType(), T.LongType()


def _struct(*fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


EVENT = _struct(
    ("event_id", _S), ("event_name", _S),
    ("latitude", _D), ("longitude", _D), ("magnitude", _D), ("depth_km", _D),
    ("event_time", _S), ("source", _S), ("ingested_at", _S),
)

# Numbers are read as text: the feed quotes them at times, and a typed JSON column would turn
# a quoted number into null.
FEED = _struct(
    ("eventID", _S), ("id", _S), ("location", _S), ("latitude", _S), ("longitude", _S),
    ("magnitude", _S), ("ml", _S), ("depth", _S), ("date", _S),
)

DISTRICT = _struct(
    ("province", _S), ("district", _S), ("province_key", _S), ("district_key", _S),
    ("latitude", _D), ("longitude", _D), ("population", _D),
    ("hazard_score", _D), ("exposure_score", _D), ("infrastructure_score", _D),
    ("preparedness_score", _D), ("response_capacity_score", _D), ("final_risk_score", _D),
    ("avg_criticality", _D), ("avg_hazard_score", _D),
)

POI = _struct(
    ("id", _L), ("kategori", _S), ("alt_tur", _S), ("isim", _S),
    ("latitude", _D), ("longitude", _D),
    ("province", _S), ("district", _S), ("province_key", _S), ("district_key", _S),
    ("fay_mesafe_km", _S),
)

RISK = _struct(
    ("province_key", _S), ("district_key", _S), ("hazard_score", _D), ("final_risk_score", _D),
)

SCORED = _struct(
    ("event_id", _S), ("event_name", _S), ("event_time", _S), ("severity", _S),
    ("depth_km", _D), ("magnitude", _D), ("event_latitude", _D), ("event_longitude", _D),
    ("province", _S), ("district", _S), ("province_key", _S), ("district_key", _S),
    ("district_latitude", _D), ("district_longitude", _D),
    ("distance_to_epicenter_km", _D), ("event_impact_score", _D),
    ("final_risk_score", _D), ("dynamic_priority_score", _D),
)
SCORED_COLUMNS = SCORED.fieldNames()


def scored(columns: list[str]) -> T.StructType:
    """Some columns of ``SCORED``."""
    return T.StructType([SCORED[name] for name in columns])



RANKING_COLUMNS = [
    "event_id", "event_name", "event_magnitude", "event_depth_km", "event_latitude",
    "event_longitude", "id", "facility_name", "facility_name_key", "facility_access_type",
    "kategori", "alt_tur", "province", "district", "province_key", "district_key",
    "latitude", "longitude", "distance_to_epicenter_km", "nearest_priority_district_km",
    "weighted_priority_distance_km", "affected_area_access_score",
    "facility_event_impact_score", "event_safety_score", "historical_hazard_safety_score",
    "fault_distance_safety_score", "facility_safety_score", "facility_type_score",
    "nearby_transport_mode_count", "multimodal_score", "nearby_hospital_count",
    "nearby_fire_station_count", "nearby_police_count", "nearby_fuel_station_count",
    "local_support_raw", "local_support_score", "facility_activation_score",
    "activation_rank",
]

MAP_COLUMNS = [
    "event_id", "event_name", "event_magnitude", "event_depth_km", "province", "district",
    "district_priority_rank", "dynamic_priority_score", "event_impact_score",
    "base_risk_score", "district_latitude", "district_longitude", "facility_id",
    "facility_name", "facility_category", "facility_access_type", "facility_province",
    "facility_district", "facility_activation_rank", "facility_activation_score",
    "facility_latitude", "facility_longitude", "assignment_distance_km",
    "assigned_district_count",
]

CHANGE_COLUMNS = [
    "province_key", "district_key", "province", "district", "live_risk_score", "risk_level",
    "triggering_event_id", "dynamic_priority_score", "updated_at",
]
