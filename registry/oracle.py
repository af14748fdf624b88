"""The same results in plain SQL, brute force over the whole tables."""

import re

from registry import derived
from registry.shape import columns_sql
from tremora import fixed, schemas
from tremora.streaming.jobs import RECOMMENDATION_COLUMNS

_VIEWS = dict(events="events", supplier="supplier", nation="nation", customer="customer")


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (f"(12742.0 * asin(sqrt(least("
            f"pow(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
            f" + cos(radians({lat1})) * cos(radians({lat2}))"
            f" * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2), 1.0))))")


def _clip(x: str) -> str:
    return f"least(greatest({x}, 0.0), 100.0)"


MAGNITUDE = _clip("(magnitude - 5.0) / 2.5 * 100")
DEPTH = _clip("100 - depth_km / 40.0 * 100")
STRENGTH = f"({MAGNITUDE} * 0.70 + {DEPTH} * 0.30)"
SEVERITY = ("CASE WHEN magnitude >= 7.0 THEN 'Extreme' WHEN magnitude >= 6.5 THEN 'Major' "
            "WHEN magnitude >= 6.0 THEN 'Moderate' ELSE 'Minor' END")
LEVEL = ("CASE WHEN live_risk_score <= 30 THEN 'Low' WHEN live_risk_score <= 55 THEN 'Medium' "
         "WHEN live_risk_score <= 75 THEN 'High' ELSE 'Very High' END")


def _key(name: str) -> str:
    # the mark left over from lower-casing a dotted capital I becomes a space
    return ("trim(regexp_replace(translate(lower(replace(" + name + ", 'İ', 'i ')), "
            f"'{fixed.FOLD_FROM}', '{fixed.FOLD_TO}'), '[^a-z0-9]+', ' ', 'g'))")


def _any(key: str, words) -> str:
    return f"regexp_matches({key}, '{'|'.join(words)}')"


def _in(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


TYPE_SCORE = ("CASE kategori WHEN 'havalimani' THEN 100 WHEN 'liman' THEN 90 "
              "WHEN 'feribot_iskele' THEN 70 WHEN 'otogar' THEN 65 ELSE 0 END")
ACCESS_TYPE = (f"CASE WHEN {_any('facility_name_key', fixed.MILITARY_WORDS)} THEN 'military' "
               f"WHEN {_any('facility_name_key', fixed.PRIVATE_OR_SPECIAL_WORDS)} "
               f"THEN 'special_or_private' WHEN kategori IN {_in(fixed.FACILITY_TYPE_SCORES)} "
               "THEN 'civilian_or_unknown' ELSE 'unknown' END")


def _scaled(column: str, source: str) -> str:
    low, high = f"(SELECT min({column}) FROM {source})", f"(SELECT max({column}) FROM {source})"
    return (f"CASE WHEN {high} = {low} THEN 0.0 "
            f"ELSE ({column} - {low}) / ({high} - {low}) * 100 END")


_FIELDS = ["eventID", "id", "location", "latitude", "longitude", "magnitude", "ml", "depth",
           "date"]
_POOL_ORDER = "is_named DESC, facility_type_score DESC, id"

# name -> (needed names, text)
_CTES = {
    "fx_report": ((), derived.REPORT.format(**_VIEWS)),
    "fx_event": (("fx_report",), """
        SELECT * EXCLUDE (n) FROM (
            SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY feed_id) AS n
            FROM fx_report WHERE magnitude >= 3.0) WHERE n = 1"""),
    "fx_district": ((), derived.DISTRICT.format(**_VIEWS)),
    "fx_poi": ((), derived.POI.format(**_VIEWS)),
    "fx_feed": ((), derived.FEED.format(**_VIEWS)),
    "decoded": (("fx_feed",), "SELECT feed_id, " + ", ".join(
        f"CASE WHEN json_valid(value) THEN json_extract_string(value, '$.{f}') END AS \"{f}\""
        for f in _FIELDS) + " FROM fx_feed"),
    "normalized": (("decoded",), """
        SELECT feed_id, coalesce(nullif("eventID", ''), nullif(id, '')) AS event_id,
               coalesce(location, 'Bilinmeyen Konum') AS event_name,
               CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
               coalesce(nullif(CAST(magnitude AS DOUBLE), 0), nullif(CAST(ml AS DOUBLE), 0), 0)
                   AS magnitude,
               coalesce(CAST(depth AS DOUBLE), 10.0) AS depth_km,
               date AS event_time, 'AFAD' AS source
        FROM decoded"""),
    "kept": (("normalized",), """
        SELECT * FROM normalized
        WHERE event_id IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
              AND magnitude >= 3.0"""),
    "scored": (("fx_event", "fx_district"), f"""
        SELECT *, event_impact_score * 0.60 + final_risk_score * 0.40 AS dynamic_priority_score
        FROM (SELECT *, {_clip("strength * (100 * exp(-distance_to_epicenter_km / 75.0)) / 100")}
                  AS event_impact_score
              FROM (SELECT e.feed_id, e.event_id, e.event_name, e.event_time,
                           {SEVERITY} AS severity, e.depth_km, e.magnitude,
                           e.latitude AS event_latitude, e.longitude AS event_longitude,
                           d.province, d.district, d.province_key, d.district_key,
                           d.latitude AS district_latitude, d.longitude AS district_longitude,
                           d.final_risk_score, {STRENGTH} AS strength,
                           {km("e.latitude", "e.longitude", "d.latitude", "d.longitude")}
                               AS distance_to_epicenter_km
                    FROM fx_event e CROSS JOIN fx_district d))"""),
    "ranked": (("scored",), """
        SELECT *, final_risk_score AS base_risk_score,
               dense_rank() OVER (PARTITION BY event_id ORDER BY dynamic_priority_score DESC)
                   AS event_priority_rank,
               row_number() OVER (PARTITION BY event_id ORDER BY dynamic_priority_score DESC,
                   event_impact_score DESC, district_key, province_key) AS district_order
        FROM scored"""),
    "topd": (("ranked",), "SELECT * FROM ranked WHERE district_order <= 10"),
    "worst": (("scored",), """
        SELECT province_key, district_key, province, district,
               max(event_impact_score) AS live_event_impact_score,
               max(final_risk_score) AS baseline_risk_score,
               max(dynamic_priority_score) AS dynamic_priority_score,
               max(event_id) AS triggering_event_id,
               arg_max(event_id, (event_impact_score, event_id)) AS strongest_event_id
        FROM scored GROUP BY ALL"""),
    "live": (("worst",), f"""
        SELECT *, {LEVEL} AS risk_level FROM (
            SELECT *, baseline_risk_score * 0.7 + live_event_impact_score * 0.3
                AS live_risk_score FROM worst)"""),
    "named": (("fx_poi",), f"""
        SELECT *, {_key("facility_name")} AS facility_name_key
        FROM (SELECT *, trim(coalesce(isim, '')) AS facility_name FROM fx_poi
              WHERE kategori IN {_in(fixed.FACILITY_TYPE_SCORES)}
                    AND latitude IS NOT NULL AND longitude IS NOT NULL)"""),
    "no_stops": (("named",), f"""
        SELECT * FROM named WHERE NOT (kategori = 'otogar' AND
            {_any("facility_name_key", fixed.EXCLUDED_BUS_STATION_WORDS)})"""),
    "cleaned": (("no_stops",), f"""
        SELECT *, {TYPE_SCORE} AS facility_type_score, {ACCESS_TYPE} AS facility_access_type,
               NOT starts_with(facility_name, 'İsimsiz') AS is_named
        FROM (SELECT * REPLACE ({_key("facility_name")} AS facility_name_key)
              FROM (SELECT * REPLACE (CASE WHEN facility_name = ''
                        THEN concat('İsimsiz ', kategori, ' - OSM ', CAST(id AS VARCHAR))
                        ELSE facility_name END AS facility_name) FROM no_stops))"""),
    "per_place": (("cleaned",), """
        SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (
            PARTITION BY kategori, round_even(latitude * 100, 0), round_even(longitude * 100, 0)
            ORDER BY is_named DESC, id) AS n FROM cleaned) WHERE n = 1"""),
    "per_name": (("per_place",), """
        SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (
            PARTITION BY kategori, province_key, district_key, facility_name_key ORDER BY id)
            AS n FROM per_place WHERE is_named) WHERE n = 1
        UNION ALL SELECT * FROM per_place WHERE NOT is_named"""),
    "prepared": (("per_name", "fx_district"), """
        SELECT f.*,
               coalesce(r.hazard_score, (SELECT avg(hazard_score) FROM fx_district))
                   AS hazard_score,
               coalesce(r.final_risk_score, (SELECT avg(final_risk_score) FROM fx_district))
                   AS final_risk_score
        FROM per_name f LEFT JOIN fx_district r
             ON f.province_key IS NOT DISTINCT FROM r.province_key
                AND f.district_key IS NOT DISTINCT FROM r.district_key"""),
    "support": (("prepared",), f"""
        SELECT *, 3 * nearby_hospital_count + 2 * nearby_fire_station_count
                  + 2 * nearby_fuel_station_count + nearby_police_count AS local_support_raw
        FROM (SELECT f.id,
                     count(*) FILTER (s.kategori = 'hastane') AS nearby_hospital_count,
                     count(*) FILTER (s.kategori = 'itfaiye') AS nearby_fire_station_count,
                     count(*) FILTER (s.kategori = 'polis') AS nearby_police_count,
                     count(*) FILTER (s.kategori = 'akaryakit') AS nearby_fuel_station_count
              FROM prepared f LEFT JOIN fx_poi s
                   ON s.kategori IN {_in(fixed.SUPPORT_WEIGHTS)}
                      AND s.latitude IS NOT NULL AND s.longitude IS NOT NULL
                      AND {km("s.latitude", "s.longitude", "f.latitude", "f.longitude")} <= 15
              GROUP BY f.id)"""),
    "modes": (("prepared",), f"""
        SELECT f.id, count(DISTINCT g.kategori) AS nearby_transport_mode_count,
               count(DISTINCT g.kategori) / 4 * 100 AS multimodal_score
        FROM prepared f JOIN prepared g
             ON {km("g.latitude", "g.longitude", "f.latitude", "f.longitude")} <= 20
        GROUP BY f.id"""),
    "faults": (("prepared",), """
        SELECT *, coalesce(number, (SELECT median(number) FROM (
                   SELECT TRY_CAST(fay_mesafe_km AS DOUBLE) AS number FROM prepared)), 0) AS fault
        FROM (SELECT *, TRY_CAST(fay_mesafe_km AS DOUBLE) AS number FROM prepared)"""),
    "pool": (("faults", "support", "modes"), f"""
        SELECT f.*, s.* EXCLUDE (id), m.* EXCLUDE (id),
               {_scaled("local_support_raw", "support")} AS local_support_score,
               100 - ({_scaled("hazard_score", "faults")}) AS historical_hazard_safety_score,
               {_scaled("fault", "faults")} AS fault_distance_safety_score
        FROM faults f JOIN support s ON f.id = s.id JOIN modes m ON f.id = m.id"""),
    "near": (("topd", "pool"), f"""
        SELECT event_id, id, min(d) AS nearest_priority_district_km,
               CASE WHEN sum(w) = 0 THEN avg(100 * exp(-d / 75.0))
                    ELSE sum(w * (100 * exp(-d / 75.0))) / sum(w) END
                   AS affected_area_access_score,
               CASE WHEN sum(w) = 0 THEN avg(d) ELSE sum(w * d) / sum(w) END
                   AS weighted_priority_distance_km
        FROM (SELECT t.event_id, f.id, greatest(t.dynamic_priority_score, 0) AS w,
                     {km("t.district_latitude", "t.district_longitude",
                         "f.latitude", "f.longitude")} AS d
              FROM topd t CROSS JOIN pool f)
        GROUP BY event_id, id HAVING min(d) <= 100"""),
    "activated": (("near", "pool", "fx_event"), f"""
        SELECT *, affected_area_access_score * 0.50 + facility_safety_score * 0.25
                  + facility_type_score * 0.15 + multimodal_score * 0.05
                  + local_support_score * 0.05 AS facility_activation_score
        FROM (SELECT *, event_safety_score * 0.50 + historical_hazard_safety_score * 0.30
                        + fault_distance_safety_score * 0.20 AS facility_safety_score
        FROM (SELECT *, 100 - facility_event_impact_score AS event_safety_score
        FROM (SELECT *, {_clip("strength * (100 * exp(-distance_to_epicenter_km / 75.0)) / 100")}
                  AS facility_event_impact_score
        FROM (SELECT n.*, f.* EXCLUDE (id), e.event_name, e.magnitude AS event_magnitude,
                     e.depth_km AS event_depth_km, e.latitude AS event_latitude,
                     e.longitude AS event_longitude, {STRENGTH} AS strength,
                     {km("f.latitude", "f.longitude", "e.latitude", "e.longitude")}
                         AS distance_to_epicenter_km
              FROM near n JOIN pool f ON n.id = f.id JOIN fx_event e
                   ON n.event_id = e.event_id))))"""),
    "ranking": (("activated",), f"""
        SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY
                   facility_activation_score DESC, {_POOL_ORDER}) AS activation_rank
        FROM activated"""),
    "topf": (("ranking",), """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY
                   facility_activation_score DESC, affected_area_access_score DESC,
                   activation_rank) AS facility_order FROM ranking)
        WHERE facility_order <= 3"""),
    "assigned": (("topd", "topf"), f"""
        SELECT * EXCLUDE (n) FROM (
            SELECT *, row_number() OVER (PARTITION BY event_id, province_key, district_key
                ORDER BY assignment_distance_km, facility_order) AS n
            FROM (SELECT t.event_id, t.event_name, t.event_time, t.magnitude AS event_magnitude,
                         t.depth_km AS event_depth_km, t.event_latitude, t.event_longitude,
                         t.province, t.district, t.province_key, t.district_key,
                         t.district_latitude, t.district_longitude,
                         t.event_priority_rank AS district_priority_rank, t.event_impact_score,
                         t.base_risk_score, t.dynamic_priority_score, f.id AS facility_id,
                         f.facility_name, f.kategori AS facility_category,
                         f.facility_access_type, f.province AS facility_province,
                         f.district AS facility_district, f.latitude AS facility_latitude,
                         f.longitude AS facility_longitude,
                         f.activation_rank AS facility_activation_rank,
                         f.facility_activation_score, f.affected_area_access_score,
                         f.facility_safety_score, f.multimodal_score, f.local_support_score,
                         {km("f.latitude", "f.longitude",
                             "t.district_latitude", "t.district_longitude")}
                             AS assignment_distance_km,
                         t.district_order, f.facility_order
                  FROM topd t JOIN topf f ON t.event_id = f.event_id))
        WHERE n = 1"""),
    "summary": (("assigned",), """
        SELECT *, row_number() OVER (PARTITION BY event_id, facility_id ORDER BY
                      dynamic_priority_score DESC, district_order)
                      AS assignment_rank_within_facility,
               count(district) OVER (PARTITION BY event_id, facility_id)
                   AS assigned_district_count,
               sum(dynamic_priority_score) OVER (PARTITION BY event_id, facility_id)
                   AS facility_total_assigned_priority
        FROM assigned"""),
    # three arrivals of reports; the frontier is what the arrivals before have reached
    "strong_report": (("fx_report",), """
        SELECT *, feed_id % 3 AS batch, CAST(event_time AS TIMESTAMP) AS clock
        FROM fx_report WHERE magnitude >= 3.0"""),
    "taken_in": (("strong_report",), """
        SELECT *, (SELECT max(b.clock) FROM strong_report b WHERE b.batch < a.batch) AS reached
        FROM strong_report a WHERE feed_id = (SELECT arg_min(c.feed_id, (c.batch, c.feed_id))
                                              FROM strong_report c WHERE c.event_id = a.event_id)"""),
    # three arrivals of whole events, told apart by the number of their first report
    "arrival": (("scored",), """
        SELECT feed_id % 3 AS batch, province_key, district_key, province, district,
               max(event_impact_score) AS live_event_impact_score,
               max(final_risk_score) AS baseline_risk_score,
               max(dynamic_priority_score) AS dynamic_priority_score,
               max(event_id) AS triggering_event_id,
               arg_max(event_id, (event_impact_score, event_id)) AS strongest_event_id
        FROM scored GROUP BY ALL"""),
    "arrival_live": (("arrival",), f"""
        SELECT *, {LEVEL} AS risk_level FROM (
            SELECT *, baseline_risk_score * 0.7 + live_event_impact_score * 0.3
                AS live_risk_score FROM arrival)"""),
    "aged": (("live",), f"""
        SELECT * REPLACE ({LEVEL.replace("live_risk_score", "faded")} AS risk_level),
               faded AS decayed_risk
        FROM (SELECT *, baseline_risk_score * 0.7 + live_event_impact_score * exp(
                     -CAST(CAST(substr(district_key, 2) AS BIGINT) % 48 AS DOUBLE) / 24.0) * 0.3
                     AS faded FROM live)"""),
}


def _with(names, **other) -> str:
    """The tables that ``names`` need; ``other`` gives some of them another text."""
    order = []

    def visit(name):
        for needed in _CTES[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)
    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({other.get(n, _CTES[n][1]).strip()})" for n in order)


# an arrival of pairs brings a third of the districts; what is known after the first and second
for _last in (0, 1):
    _later = [n for n in _CTES if n in ("near", "activated", "ranking", "topf", "ranked", "topd",
                                        "assigned")]
    _word = re.compile(rf"\b({'|'.join(['scored', *_later])})\b")
    _CTES[f"scored_{_last}"] = (("scored",), f"""
        SELECT * FROM scored WHERE CAST(substr(district_key, 2) AS BIGINT) % 3 <= {_last}""")
    for _name in _later:
        _CTES[f"{_name}_{_last}"] = (
            tuple(_word.sub(rf"\1_{_last}", n) for n in _CTES[_name][0]),
            _word.sub(rf"\1_{_last}", _CTES[_name][1]))


def sql(source: str, columns: str, where: str = "", also: tuple[str, ...] = ()) -> str:
    return (f"{_with((source, *also))}\nSELECT {columns_sql(*columns.split())} FROM {source}"
            f"{' WHERE ' + where if where else ''}")


LIVE_COLUMNS = ("province_key district_key province district live_event_impact_score "
                "baseline_risk_score dynamic_priority_score triggering_event_id "
                "strongest_event_id live_risk_score risk_level")
POI_COLUMNS = "id kategori facility_name facility_name_key province_key district_key"
PREPARED_COLUMNS = (POI_COLUMNS + " facility_type_score facility_access_type latitude longitude "
                    "hazard_score final_risk_score")
SUMMARY_COLUMNS = " ".join([*RECOMMENDATION_COLUMNS, "assignment_rank_within_facility",
                            "assigned_district_count", "facility_total_assigned_priority"])
TOP_COLUMNS = ("event_id event_name event_time severity province_key district_key "
               "district_order event_priority_rank event_impact_score base_risk_score "
               "dynamic_priority_score")
EVENT_COLUMNS = "feed_id event_id event_name latitude longitude magnitude depth_km event_time"


def all_sql() -> dict[str, str]:
    district = " ".join(schemas.DISTRICT.fieldNames())
    scored = " ".join(schemas.SCORED_COLUMNS)
    return {
        "load_districts": sql("fx_district", district),
        "refresh_districts": sql("fx_district", district),
        "csv_scan": _with(("fx_poi",)) + """
            SELECT CASE WHEN reject IS NULL THEN id END AS id,
                   CASE WHEN reject IS NULL THEN kategori END AS kategori,
                   CASE WHEN reject IS NULL THEN round(latitude, 6) END AS latitude, reject
            FROM (SELECT *, CASE WHEN id % 17 = 0 THEN 'no number: id'
                                 WHEN id % 13 = 0 THEN 'no number: latitude' END AS reject
                  FROM fx_poi)""",
        "haversine_pairs": _with(("fx_poi", "fx_district")) + f"""
            SELECT p.id, round({km("p.latitude", "p.longitude", "d.latitude", "d.longitude")}, 4)
                AS distance_km
            FROM fx_poi p JOIN fx_district d ON p.district_key = d.district_key
                 AND p.province_key = d.province_key WHERE p.latitude IS NOT NULL""",
        "event_strength": _with(("fx_event",)) + f"""
            SELECT event_id, {SEVERITY} AS severity, round({MAGNITUDE}, 6) AS magnitude_score,
                   round({DEPTH}, 6) AS depth_score, round({STRENGTH}, 6) AS event_strength
            FROM fx_event""",
        "severity_counts": _with(("fx_event",)) + f"""
            SELECT {SEVERITY} AS severity, count(*) AS events FROM fx_event GROUP BY 1""",
        "event_district_impact": sql("scored", scored),
        "event_priority_rank": _with(("ranked",)) + f"""
            SELECT {columns_sql("event_id", "province_key", "district_key",
                                "dynamic_priority_score", "event_priority_rank")},
                   event_priority_rank <= 10 AS is_priority_district FROM ranked""",
        "event_priority_rank_in_bands": _with(("ranked",)) + f"""
            SELECT {columns_sql("event_id", "province_key", "district_key",
                                "dynamic_priority_score", "event_priority_rank")},
                   event_priority_rank <= 10 AS is_priority_district FROM ranked""",
        "top_priority_districts": sql("topd", TOP_COLUMNS),
        "top_priority_districts_of_pairs": sql("topd", TOP_COLUMNS),
        "event_attributes": _with(("fx_event",)) + f"""
            SELECT event_id, event_name, event_time, {SEVERITY} AS severity,
                   round(magnitude, 6) AS magnitude, round(depth_km, 4) AS depth_km,
                   round(latitude, 6) AS event_latitude, round(longitude, 6) AS event_longitude
            FROM fx_event""",
        "event_attributes_of_pairs": _with(("fx_event",)) + f"""
            SELECT event_id, event_name, event_time, {SEVERITY} AS severity,
                   round(magnitude, 6) AS magnitude, round(depth_km, 4) AS depth_km,
                   round(latitude, 6) AS event_latitude, round(longitude, 6) AS event_longitude
            FROM fx_event""",
        "district_worst_case": sql("worst", LIVE_COLUMNS.replace(
            "live_risk_score risk_level", "")),
        "district_worst_case_of_pairs": sql("worst", LIVE_COLUMNS.replace(
            "live_risk_score risk_level", "")),
        "live_risk": sql("live", LIVE_COLUMNS),
        "json_decode_events": _with(("decoded",)) + " SELECT feed_id, " + ", ".join(
            f'"{f}" AS raw_{f.lower()}' for f in _FIELDS) + " FROM decoded",
        "normalized_events": sql("kept", EVENT_COLUMNS + " source"),
        "quarantined_events": sql(
            "normalized", EVENT_COLUMNS,
            "event_id IS NULL OR latitude IS NULL OR longitude IS NULL"),
        "event_dedup": _with(("kept",)) + f"""
            SELECT {columns_sql(*EVENT_COLUMNS.split())} FROM (
                SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY feed_id) AS n
                FROM kept) WHERE n = 1""",
        "first_reports": sql("fx_event", EVENT_COLUMNS),
        "candidate_filter": sql(
            "fx_poi", "id kategori latitude longitude",
            f"kategori IN {_in(fixed.FACILITY_TYPE_SCORES)} AND latitude IS NOT NULL "
            "AND longitude IS NOT NULL"),
        "support_filter": sql(
            "fx_poi", "id kategori latitude longitude",
            f"kategori IN {_in(fixed.SUPPORT_WEIGHTS)} AND latitude IS NOT NULL "
            "AND longitude IS NOT NULL"),
        "normalize_text": _with(("fx_poi",)) + f"""
            SELECT id, {_key("coalesce(isim, '')")} AS name_key FROM fx_poi""",
        "otogar_keyword_filter": sql("no_stops", POI_COLUMNS),
        "facility_names": sql("cleaned", POI_COLUMNS + " is_named"),
        "facility_access_type": sql(
            "cleaned", "id kategori facility_type_score facility_access_type"),
        "facility_geo_dedup": sql("per_place", POI_COLUMNS + " is_named"),
        "facility_name_dedup": sql("per_name", POI_COLUMNS + " is_named"),
        "facility_risk_join": _with(("cleaned", "fx_district")) + """
            SELECT f.id, f.province_key, f.district_key,
                   round(coalesce(r.hazard_score, (SELECT avg(hazard_score) FROM fx_district)),
                         6) AS hazard_score,
                   round(coalesce(r.final_risk_score,
                         (SELECT avg(final_risk_score) FROM fx_district)), 6)
                         AS final_risk_score
            FROM cleaned f LEFT JOIN fx_district r
                 ON f.province_key = r.province_key AND f.district_key = r.district_key""",
        "prepared_facilities": sql("prepared", PREPARED_COLUMNS),
        "local_support": sql(
            "pool", "id nearby_hospital_count nearby_fire_station_count nearby_police_count "
            "nearby_fuel_station_count local_support_raw local_support_score"),
        "multimodal": sql("pool", "id nearby_transport_mode_count multimodal_score"),
        "min_max_scaled": _with(("fx_poi",)) + f""",
            numbers AS (SELECT id, coalesce(TRY_CAST(fay_mesafe_km AS DOUBLE), 0) AS n
                        FROM fx_poi)
            SELECT id, round({_scaled("n", "numbers")}, 6) AS scaled FROM numbers""",
        "facility_pool": sql(
            "pool", "id historical_hazard_safety_score fault_distance_safety_score "
            "local_support_score multimodal_score facility_type_score is_named"),
        "facility_access": sql(
            "activated", "event_id id affected_area_access_score "
            "weighted_priority_distance_km nearest_priority_district_km"),
        "facility_event_impact": sql(
            "activated", "event_id id distance_to_epicenter_km facility_event_impact_score"),
        "facility_safety": sql(
            "activated", "event_id id event_safety_score historical_hazard_safety_score "
            "fault_distance_safety_score facility_safety_score"),
        "eligible_facilities": sql("near", "event_id id nearest_priority_district_km"),
        "facility_activation_rank": sql(
            "ranking", "event_id id facility_activation_score activation_rank"),
        "facility_rankings": sql("ranking", " ".join(schemas.RANKING_COLUMNS)),
        "top_facilities": sql(
            "topf", "event_id id facility_name facility_activation_score "
            "affected_area_access_score activation_rank facility_order"),
        "nearest_facility_assignment": sql("assigned", " ".join(RECOMMENDATION_COLUMNS)),
        "assignment_summary": sql(
            "summary", "event_id province_key district_key facility_id "
            "assignment_rank_within_facility assigned_district_count "
            "facility_total_assigned_priority"),
        "logistics_recommendations": sql("summary", SUMMARY_COLUMNS),
        "map_export": sql("summary", " ".join(schemas.MAP_COLUMNS)),
        "skipped_events": _with(("fx_event", "assigned")) + """
            SELECT event_id FROM fx_event
            WHERE event_id NOT IN (SELECT event_id FROM assigned)""",
        "unreachable_events": _with(("fx_event", "assigned"),
                                    fx_poi=derived.CORNER_POI.format(**_VIEWS)) + """
            SELECT event_id FROM fx_event
            WHERE event_id NOT IN (SELECT event_id FROM assigned)""",
        "scored_quarantine": f"""
            SELECT CASE WHEN taken THEN concat('EVT', CAST(feed_id AS VARCHAR)) ELSE value END
                       AS item, taken
            FROM (SELECT *, feed_id % 41 <> 0 AND feed_id % 7 <> 0 AND feed_id % 5 <> 0 AS taken
                  FROM ({derived.SCORED_TEXT.format(**_VIEWS)}))""",
        "scored_feed": sql("scored", scored),
        "late_event_feed": sql("scored", "event_id province_key district_key"),
        "stream_dedup": _with(("fx_report",)) + """
            SELECT DISTINCT event_id FROM fx_report WHERE magnitude >= 3.0""",
        "unique_event_feed": _with(("taken_in",)) + f"""
            SELECT batch, {columns_sql(*EVENT_COLUMNS.split())} FROM taken_in""",
        "late_event_split": _with(("taken_in",)) + """
            SELECT event_id, batch, coalesce(clock < reached - INTERVAL 10 MINUTE, false) AS is_late
            FROM taken_in""",
        "live_risk_upsert": sql("arrival_live", LIVE_COLUMNS,
                                "batch = (SELECT max(batch) FROM arrival_live)"),
        "risk_change_feed": _with(("arrival_live",)) + f"""
            SELECT batch, {columns_sql("province_key", "district_key", "province", "district",
                "live_risk_score", "risk_level", "triggering_event_id",
                "dynamic_priority_score")}
            FROM (SELECT *, lag(live_risk_score) OVER (
                      PARTITION BY province_key, district_key ORDER BY batch) AS before
                  FROM arrival_live)
            WHERE before IS NULL OR abs(live_risk_score - before) > 1.0""",
        "recommendation_upsert": sql("assigned", " ".join(RECOMMENDATION_COLUMNS)),
        "recommendation_feed": _with(("assigned_0", "assigned_1", "assigned")) + f"""
            SELECT concat(event_id, ':', CAST(facility_id AS VARCHAR)) AS key, batch,
                   {columns_sql(*RECOMMENDATION_COLUMNS)}
            FROM (SELECT 0 AS batch, * FROM assigned_0 UNION ALL BY NAME
                  SELECT 1 AS batch, * FROM assigned_1 UNION ALL BY NAME
                  SELECT 2 AS batch, * FROM assigned)""",
        "risk_level_thresholds": _with(("fx_district",)) + """
            SELECT round(quantile_cont(final_risk_score, 0.25), 6) AS low_max,
                   round(quantile_cont(final_risk_score, 0.5), 6) AS medium_max,
                   round(quantile_cont(final_risk_score, 0.75), 6) AS high_max
            FROM fx_district""",
        "scheduled_decay": _with(("aged",)) + """
            SELECT province_key, district_key, round(decayed_risk, 6) AS live_risk_score,
                   risk_level FROM aged""",
        "risk_decay": _with(("aged",)) + """
            SELECT province_key, district_key, round(decayed_risk, 6) AS live_risk_score,
                   risk_level FROM aged""",
    }
