"""The Spark side of every checked query."""

from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry import derived, oracle
from registry.shape import shown
from tremora import schemas
from tremora.functions import geo, scores, text
from tremora.operators import (activation, assign, districts, enrich, facilities, impact,
                               ingest, risk)
from tremora.plans import pool as pool_plan
from tremora.plans import recommend
from tremora.session import new_folder, written
from tremora.sources import feeds, tables
from tremora.streaming import intake, jobs

NOW = {"availableNow": True}


# --- inputs -----------------------------------------------------------------------------------

def events(spark: SparkSession, sf: str) -> DataFrame:
    """Clean, unique events, each with the feed position of its first report."""
    strong = ingest.strong_enough(ingest.valid(derived.reports(spark, sf)))
    return ingest.first_reports(strong, "feed_id")


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return impact.score_pairs(events(spark, sf), derived.districts(spark, sf))


def risk_table(spark: SparkSession, sf: str) -> DataFrame:
    return derived.districts(spark, sf).select(*schemas.RISK.fieldNames())


def build_pool(spark: SparkSession, sf: str) -> DataFrame:
    return pool_plan.build_pool(derived.pois(spark, sf), risk_table(spark, sf))


_POOLS: dict[tuple[str, str], str] = {}


def pool(spark: SparkSession, sf: str) -> DataFrame:
    """The facility pool as the jobs use it: a table built once and read by every event."""
    key = (spark.sparkContext.applicationId, sf)
    try:
        return spark.read.parquet(_POOLS[key])
    except (KeyError, AnalysisException):  # not built yet, or its folder was cleared
        _POOLS[key] = new_folder(spark, "pool-table")
        build_pool(spark, sf).write.parquet(_POOLS[key])
        return spark.read.parquet(_POOLS[key])


def top(spark: SparkSession, sf: str) -> DataFrame:
    return districts.top_districts_of_events(events(spark, sf), derived.districts(spark, sf))


def _pick(df: DataFrame, columns: str) -> DataFrame:
    return shown(df, *columns.split())


# --- districts and events ---------------------------------------------------------------------

def load_districts(spark, sf):
    path = new_folder(spark, "districts")
    derived.districts(spark, sf).write.parquet(path)
    return shown(tables.load_districts(spark, path))


def refresh_districts(spark, sf):
    csv = new_folder(spark, "districts-csv")
    derived.districts(spark, sf).write.option("header", True).csv(csv)
    return shown(tables.refresh_districts(spark, csv, new_folder(spark, "districts")))


def csv_scan(spark, sf):
    """Points of interest as CSV with damaged numbers in some lines; all lines come back, typed or
    rejected."""
    folder = new_folder(spark, "pois-csv")
    text = derived.pois(spark, sf).select(*[F.col(c).cast("string") for c in schemas.POI.names])
    mark = F.col("id").cast("long")
    text.withColumns({
        "latitude": F.when(mark % 13 == 0, F.lit("north")).otherwise(F.col("latitude")),
        "id": F.when(mark % 17 == 0, F.concat(F.lit("n"), "id")).otherwise(F.col("id")),
    }).write.option("header", True).option("escape", '"').csv(folder)
    scanned = tables.scan_csv(spark, folder, schemas.POI)
    good = tables.accepted(scanned).select(
        F.col("id"), F.col("kategori"), F.round("latitude", 6).alias("latitude"),
        F.lit(None).cast("string").alias("reject"))
    bad = tables.rejected(scanned).select(
        F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("kategori"),
        F.lit(None).cast("double").alias("latitude"), F.col("_reject").alias("reject"))
    return good.unionByName(bad)


def haversine_pairs(spark, sf):
    places = derived.districts(spark, sf).select(
        "province_key", "district_key", F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"))
    pairs = derived.pois(spark, sf).where("latitude IS NOT NULL").join(
        places, ["province_key", "district_key"])
    distance = geo.haversine(F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lon"))
    return shown(pairs.select("id", distance.alias("distance_km")))


def event_strength(spark, sf):
    m, d = F.col("magnitude"), F.col("depth_km")
    return shown(events(spark, sf).select(
        "event_id", scores.severity(m).alias("severity"),
        scores.magnitude_score(m).alias("magnitude_score"),
        scores.depth_score(d).alias("depth_score"),
        scores.event_strength(m, d).alias("event_strength")))


def severity_counts(spark, sf):
    return (events(spark, sf).groupBy(scores.severity(F.col("magnitude")).alias("severity"))
            .agg(F.count(F.lit(1)).alias("events")))


def event_district_impact(spark, sf):
    return shown(scored(spark, sf))


RANK_COLUMNS = ("event_id province_key district_key dynamic_priority_score "
                "event_priority_rank is_priority_district")


def event_priority_rank(spark, sf):
    return _pick(districts.rank_districts_of_events(events(spark, sf),
                                                    derived.districts(spark, sf)), RANK_COLUMNS)


def event_priority_rank_in_bands(spark, sf):
    """The same from a table of pairs, where any event may be hot."""
    return _pick(districts.rank_districts(scored(spark, sf)), RANK_COLUMNS)


def top_priority_districts(spark, sf):
    return _pick(top(spark, sf), oracle.TOP_COLUMNS)


def top_priority_districts_of_pairs(spark, sf):
    """The same from a table of pairs, as job 3 gets them."""
    return _pick(districts.top_districts(scored(spark, sf)), oracle.TOP_COLUMNS)


def event_attributes(spark, sf):
    out = districts.attributes_of_events(events(spark, sf))
    return shown(out).withColumn("depth_km", F.round("depth_km", 4))


def event_attributes_of_pairs(spark, sf):
    """The same from a table of pairs, which is all that job 3 gets."""
    out = districts.event_attributes(scored(spark, sf))
    return shown(out).withColumn("depth_km", F.round("depth_km", 4))


# --- live risk --------------------------------------------------------------------------------

def district_worst_case(spark, sf):
    return shown(risk.worst_case_of_events(events(spark, sf), derived.districts(spark, sf)))


def district_worst_case_of_pairs(spark, sf):
    """The same from a table of pairs, as job 2 gets them."""
    return shown(risk.district_worst_case(scored(spark, sf), sieve=True))


def live_risk(spark, sf):
    return shown(risk.with_live_risk(risk.worst_case_of_events(
        events(spark, sf), derived.districts(spark, sf))))


def risk_level_thresholds(spark, sf):
    return shown(risk.level_thresholds(derived.districts(spark, sf)))


def risk_decay(spark, sf):
    now = F.lit("2024-01-10 00:00:00").cast("timestamp")
    age = F.substr(F.col("district_key"), F.lit(2)).cast("long") % 48
    live = risk.with_live_risk(
        risk.worst_case_of_events(events(spark, sf), derived.districts(spark, sf)),
        now - F.make_dt_interval(hours=age.cast("int")))
    return _pick(risk.decayed(live, now), "province_key district_key live_risk_score risk_level")


def scheduled_decay(spark, sf):
    """The same as ``risk_decay``, by a job that lets the live table fade three times."""
    table = jobs.live_risk_table(spark, new_folder(spark, "live-risk"))
    faded = jobs.live_risk_table(spark, new_folder(spark, "faded"))
    end = datetime(2024, 1, 10, tzinfo=timezone.utc)
    age = F.substr(F.col("district_key"), F.lit(2)).cast("long") % 48
    live = risk.with_live_risk(
        risk.worst_case_of_events(events(spark, sf), derived.districts(spark, sf)),
        F.lit(end) - F.make_dt_interval(hours=age.cast("int")))
    table.append(live, 0)
    publish = jobs.folder_feed(new_folder(spark, "levels"))
    for number, hours in enumerate((30, 7, 0)):
        jobs.decay_live_risk(end - timedelta(hours=hours), number, table, faded, publish)
    return _pick(jobs.current_live_risk(table, faded),
                 "province_key district_key live_risk_score risk_level")


# --- ingestion --------------------------------------------------------------------------------

def json_decode_events(spark, sf):
    out = feeds.decode(derived.feed(spark, sf), schemas.FEED, keep=("feed_id",))
    return out.select("feed_id", *[F.col(f"`{c}`").alias(f"raw_{c.lower()}")
                                   for c in schemas.FEED.fieldNames()])


def _normalized(spark, sf):
    decoded = feeds.decode(derived.feed(spark, sf), schemas.FEED, keep=("feed_id",))
    return ingest.normalize_feed(decoded, keep=("feed_id",))


def _undated_blank(df):
    """Undecodable records have no date and get the time of intake; leave that out of the check."""
    return df.withColumn("event_time", F.when(F.col("event_time") != F.col("ingested_at"),
                                              F.col("event_time")))


def normalized_events(spark, sf):
    kept = ingest.strong_enough(ingest.valid(_normalized(spark, sf)))
    return _pick(kept, oracle.EVENT_COLUMNS + " source")


def quarantined_events(spark, sf):
    return _pick(_undated_blank(ingest.quarantined(_normalized(spark, sf))),
                 oracle.EVENT_COLUMNS)


def event_dedup(spark, sf):
    kept = ingest.strong_enough(ingest.valid(_normalized(spark, sf)))
    return _pick(ingest.first_reports(kept, "feed_id"), oracle.EVENT_COLUMNS)


def first_reports(spark, sf):
    return _pick(events(spark, sf), oracle.EVENT_COLUMNS)


# --- facilities -------------------------------------------------------------------------------

def candidate_filter(spark, sf):
    return _pick(facilities.candidates(derived.pois(spark, sf)),
                 "id kategori latitude longitude")


def support_filter(spark, sf):
    return _pick(facilities.support_points(derived.pois(spark, sf)),
                 "id kategori latitude longitude")


def normalize_text(spark, sf):
    return derived.pois(spark, sf).select("id", text.normalize(F.col("isim")).alias("name_key"))


def otogar_keyword_filter(spark, sf):
    return _pick(facilities.without_stops(facilities.with_name_keys(
        facilities.candidates(derived.pois(spark, sf)))), oracle.POI_COLUMNS)


def facility_names(spark, sf):
    return _pick(facilities.cleaned(derived.pois(spark, sf)), oracle.POI_COLUMNS + " is_named")


def facility_access_type(spark, sf):
    return _pick(facilities.cleaned(derived.pois(spark, sf)),
                 "id kategori facility_type_score facility_access_type")


def facility_geo_dedup(spark, sf):
    return _pick(facilities.one_per_place(facilities.cleaned(derived.pois(spark, sf))),
                 oracle.POI_COLUMNS + " is_named")


def facility_name_dedup(spark, sf):
    return _pick(facilities.one_per_name(facilities.one_per_place(
        facilities.cleaned(derived.pois(spark, sf)))), oracle.POI_COLUMNS + " is_named")


def facility_risk_join(spark, sf):
    joined = facilities.with_district_risk(
        facilities.cleaned(derived.pois(spark, sf)), risk_table(spark, sf))
    return _pick(joined, "id province_key district_key hazard_score final_risk_score")


def prepared_facilities(spark, sf):
    return _pick(facilities.prepare(derived.pois(spark, sf), risk_table(spark, sf)),
                 oracle.PREPARED_COLUMNS)


def _prepared(spark, sf):
    return written(facilities.prepare(derived.pois(spark, sf), risk_table(spark, sf)),
                   "facilities")


def local_support(spark, sf):
    counted = written(enrich.with_local_support(_prepared(spark, sf), derived.pois(spark, sf)),
                      "support")
    return _pick(enrich.min_max(counted, "local_support_raw", "local_support_score"),
                 "id nearby_hospital_count nearby_fire_station_count nearby_police_count "
                 "nearby_fuel_station_count local_support_raw local_support_score")


def multimodal(spark, sf):
    return _pick(enrich.with_multimodal(_prepared(spark, sf)),
                 "id nearby_transport_mode_count multimodal_score")


def min_max_scaled(spark, sf):
    return _pick(enrich.min_max(derived.pois(spark, sf), "fay_mesafe_km", "scaled"), "id scaled")


def facility_pool(spark, sf):
    return _pick(build_pool(spark, sf),
                 "id historical_hazard_safety_score fault_distance_safety_score "
                 "local_support_score multimodal_score facility_type_score is_named")


# --- facilities per event ---------------------------------------------------------------------

def _activated(spark, sf):
    return recommend.activated_facilities(top(spark, sf), pool(spark, sf))


def facility_access(spark, sf):
    return _pick(_activated(spark, sf),
                 "event_id id affected_area_access_score weighted_priority_distance_km "
                 "nearest_priority_district_km")


def facility_event_impact(spark, sf):
    return _pick(_activated(spark, sf),
                 "event_id id distance_to_epicenter_km facility_event_impact_score")


def facility_safety(spark, sf):
    return _pick(_activated(spark, sf),
                 "event_id id event_safety_score historical_hazard_safety_score "
                 "fault_distance_safety_score facility_safety_score")


def eligible_facilities(spark, sf):
    return _pick(_activated(spark, sf), "event_id id nearest_priority_district_km")


def facility_activation_rank(spark, sf):
    ranked = recommend.ranked_facilities(recommend.top_table(top(spark, sf)), pool(spark, sf))
    return _pick(ranked,
                 "event_id id facility_activation_score activation_rank")


def facility_rankings(spark, sf):
    return shown(recommend.facility_rankings(top(spark, sf), pool(spark, sf)))


def top_facilities(spark, sf):
    candidates = pool(spark, sf)
    best = recommend.best_facilities(top(spark, sf), candidates)
    return _pick(activation.with_facility(best, candidates),
                 "event_id id facility_name facility_activation_score "
                 "affected_area_access_score activation_rank facility_order")


def nearest_facility_assignment(spark, sf):
    return _pick(recommend.assignments(top(spark, sf), pool(spark, sf)),
                 " ".join(jobs.RECOMMENDATION_COLUMNS))


def _recommended(spark, sf):
    return recommend.recommendations(top(spark, sf), pool(spark, sf))


def assignment_summary(spark, sf):
    return _pick(_recommended(spark, sf),
                 "event_id province_key district_key facility_id "
                 "assignment_rank_within_facility assigned_district_count "
                 "facility_total_assigned_priority")


def logistics_recommendations(spark, sf):
    return _pick(_recommended(spark, sf), oracle.SUMMARY_COLUMNS)


def map_export(spark, sf):
    return shown(assign.map_export(_recommended(spark, sf)))


def skipped_events(spark, sf):
    first_ten = top(spark, sf)
    return recommend.skipped_events(first_ten, recommend.assignments(first_ten, pool(spark, sf)))


def unreachable_events(spark, sf):
    """All facilities stand in one corner, so that some events have none in reach."""
    candidates = written(pool_plan.build_pool(derived.corner_pois(spark, sf),
                                              risk_table(spark, sf)), "corner-pool")
    first_ten = top(spark, sf)
    return recommend.skipped_events(first_ten, recommend.assignments(first_ten, candidates))


# --- streams ----------------------------------------------------------------------------------

#: Scored feeds as files: their text repeats itself, so that a stronger codec pays.
DENSE = {"compression": "zstd"}


def _arrivals(rows: DataFrame, part, start, parts: int = 3) -> None:
    """Let ``rows`` arrive in parts; ``start(folder)`` runs the job after each and restarts from
    its checkpoint the next time."""
    spark = rows.sparkSession
    folder = new_folder(spark, "arriving")
    kept = written(rows.withColumn("_part", part), "to-arrive")
    for n in range(parts):
        kept.where(F.col("_part") == n).drop("_part").write.mode("append").parquet(folder)
        start(folder).awaitTermination()


def _raw_stream(spark, folder):
    return feeds.read_stream(spark, "parquet", {"path": folder})


def _as_feed(df, keep=()):
    return feeds.encode(df, F.col("event_id"), [c for c in df.columns if c not in keep], keep)


def scored_feed(spark, sf):
    places = derived.districts(spark, sf)
    out, state = new_folder(spark, "scored"), new_folder(spark, "state")

    def start(folder):
        return jobs.score_job(_raw_stream(spark, folder), places, "parquet", {"path": out, **DENSE},
                              state, NOW)
    _arrivals(_as_feed(events(spark, sf).drop("feed_id")), F.lit(0), start, 1)
    read = spark.read.schema(feeds.KEY_VALUE).parquet(out)
    return shown(feeds.decode(read, schemas.SCORED))


def late_event_feed(spark, sf):
    """The first arrival has a clock in the future, the third is an hour late; none may be lost."""
    places = derived.districts(spark, sf)
    out, state = new_folder(spark, "scored"), new_folder(spark, "state")
    part = F.col("feed_id") % 3
    late = events(spark, sf).withColumn("event_time", F.when(part == 0, "2030-01-01T00:00:00").when(
        part == 1, "2024-01-01T12:00:00").otherwise("2024-01-01T11:00:00"))

    def start(folder):
        return jobs.score_job(_raw_stream(spark, folder), places, "parquet", {"path": out, **DENSE},
                              state, NOW)
    _arrivals(_as_feed(late, ("feed_id",)), part, start)
    read = spark.read.schema(feeds.KEY_VALUE).parquet(out)
    keys = ["event_id", "province_key", "district_key"]
    return shown(feeds.decode(read, schemas.scored(keys)))


def stream_dedup(spark, sf):
    """Reports of one quake arrive minutes apart, in three parts."""
    minute = F.regexp_extract("event_id", r"EVT(\d+)", 1).cast("long") % 5
    reports = derived.reports(spark, sf).withColumn(
        "event_time", F.concat(F.lit("2024-01-01T10:0"), minute.cast("string"), F.lit(":00")))
    out, state = new_folder(spark, "unique"), new_folder(spark, "state")

    def start(folder):
        decoded = jobs.decoded_events(_raw_stream(spark, folder))
        unique = ingest.drop_repeats(ingest.with_event_time(
            ingest.strong_enough(ingest.valid(decoded))))
        return feeds.append_stream(unique.select("event_id"), "parquet", {"path": out}, state,
                                   NOW).start()
    _arrivals(_as_feed(reports, ("feed_id",)), F.col("feed_id") % 3, start)
    return spark.read.schema("event_id string").parquet(out)


def _intake_run(spark, sf):
    """Reports of one quake, days apart and out of order, in three arrivals; the job is started
    anew for each."""
    seen = intake.seen_table(spark, new_folder(spark, "seen"))
    frontier = intake.frontier_table(spark, new_folder(spark, "frontier"))
    kept, late, state = (new_folder(spark, name) for name in ("kept", "late", "state"))
    schema = T.StructType([*feeds.KEY_VALUE.fields, T.StructField("feed_id", T.LongType())])

    def start(folder):
        raw = feeds.read_stream(spark, "parquet", {"path": folder}, schema)
        decoded = feeds.decode(raw, schemas.EVENT, keep=("feed_id",))
        strong = ingest.strong_enough(ingest.valid(decoded))
        return intake.intake_job(strong, seen, frontier, jobs.folder_feed(kept),
                                 jobs.folder_feed(late), ["feed_id"], state, NOW)
    _arrivals(_as_feed(derived.reports(spark, sf), ("feed_id",)), F.col("feed_id") % 3, start)
    shape = T.StructType([T.StructField("feed_id", T.LongType()), *schemas.EVENT.fields,
                          T.StructField("batch", T.LongType())])
    return [spark.read.schema(shape).parquet(path) for path in (kept, late)]


def unique_event_feed(spark, sf):
    """Every event once, late ones too, with the whole of its first report."""
    kept, late = _intake_run(spark, sf)
    return _pick(kept.unionByName(late), "batch " + oracle.EVENT_COLUMNS)


def late_event_split(spark, sf):
    """Which of the two feeds an event went to."""
    kept, late = _intake_run(spark, sf)
    return kept.withColumn("is_late", F.lit(False)).unionByName(
        late.withColumn("is_late", F.lit(True))).select("event_id", "batch", "is_late")


def _scored_messages(spark, folder: str, schema: T.StructType, places: DataFrame,
                     columns: list[str] = schemas.SCORED_COLUMNS) -> DataFrame:
    """Job 1's feed of the events that arrive in a folder, taken as its messages are made: each
    pair is encoded and decoded as in a feed, but the product is not kept on disk."""
    arriving = feeds.read_stream(spark, "parquet", {"path": folder}, schema)
    return jobs.scored_messages(impact.pair_messages(arriving, places), columns)


def _live_risk_run(spark, sf):
    table = jobs.live_risk_table(spark, new_folder(spark, "live-risk"))
    out, state = new_folder(spark, "changes"), new_folder(spark, "state")
    numbered, places = events(spark, sf), derived.districts(spark, sf)

    def start(folder):
        stream = _scored_messages(spark, folder, numbered.schema, places, risk.COLUMNS)
        return jobs.risk_job(stream, table, jobs.folder_feed(out), state, NOW)
    _arrivals(numbered, F.col("feed_id") % 3, start)
    return table, out


def live_risk_upsert(spark, sf):
    table, _ = _live_risk_run(spark, sf)
    return shown(table.current().drop("updated_at"))


def risk_change_feed(spark, sf):
    _, out = _live_risk_run(spark, sf)
    read = spark.read.schema("key string, value string, batch long").parquet(out)
    changes = feeds.decode(read, jobs.LIVE_RISK, keep=("batch",))
    return _pick(changes, "batch province_key district_key province district live_risk_score "
                          "risk_level triggering_event_id dynamic_priority_score")


def _recommendation_run(spark, sf):
    pairs = jobs.scored_table(spark, new_folder(spark, "pairs"))
    table = jobs.recommendation_table(spark, new_folder(spark, "recommended"))
    out, state = new_folder(spark, "recommendations"), new_folder(spark, "state")
    candidates = pool(spark, sf)
    # the districts of an event are spread over all three parts: every event arrives three times,
    # each time with a third of the districts
    part = F.pmod(F.substr(F.col("district_key"), F.lit(2)).cast("long"), F.lit(3))
    arriving, places = events(spark, sf), derived.districts(spark, sf)
    thirds = (places.where(part == n) for n in range(3))

    def start(folder):
        stream = _scored_messages(spark, folder, arriving.schema, next(thirds))
        return jobs.recommend_job(stream, pairs, candidates, table, jobs.folder_feed(out),
                                  state, NOW)
    _arrivals(arriving.withColumn("_turn", F.explode(F.sequence(F.lit(0), F.lit(2)))),
              F.col("_turn"), start)
    return table, out


def recommendation_upsert(spark, sf):
    table, _ = _recommendation_run(spark, sf)
    return shown(jobs.current_recommendations(table))


def recommendation_feed(spark, sf):
    """All batches of the feed: each holds what was right with the districts known by then."""
    _, out = _recommendation_run(spark, sf)
    read = spark.read.schema("key string, value string, batch long").parquet(out)
    return shown(feeds.decode(read, jobs.RECOMMENDATION, keep=("key", "batch")))


def scored_quarantine(spark, sf):
    """Which messages of the scored feed jobs 2 and 3 take, and which they leave aside."""
    folder = new_folder(spark, "scored-text")
    (derived.scored_text(spark, sf).select(F.lit("k").alias("key"), "value")
     .write.parquet(folder))
    good, bad = new_folder(spark, "usable"), new_folder(spark, "quarantine")
    usable = jobs.scored_feed_stream(spark, "parquet", {"path": folder}).select("event_id")
    feeds.append_stream(usable, "parquet", {"path": good}, new_folder(spark, "state"),
                        NOW).start().awaitTermination()
    jobs.scored_quarantine_job(spark, "parquet", {"path": folder}, "parquet", {"path": bad},
                               new_folder(spark, "state"), NOW).awaitTermination()
    taken = spark.read.schema("event_id string").parquet(good)
    left = spark.read.schema("text string").parquet(bad)
    return taken.select(F.col("event_id").alias("item"), F.lit(True).alias("taken")).unionAll(
        left.select(F.col("text").alias("item"), F.lit(False).alias("taken")))


QUERIES = {f.__name__: f for f in (
    load_districts, refresh_districts, csv_scan, haversine_pairs, event_strength, severity_counts,
    event_district_impact, event_priority_rank, event_priority_rank_in_bands,
    top_priority_districts, top_priority_districts_of_pairs, event_attributes,
    event_attributes_of_pairs,
    district_worst_case, district_worst_case_of_pairs, live_risk, json_decode_events, normalized_events, quarantined_events,
    event_dedup, first_reports, candidate_filter, support_filter, normalize_text,
    otogar_keyword_filter, facility_names, facility_access_type, facility_geo_dedup,
    facility_name_dedup, facility_risk_join, prepared_facilities, local_support, multimodal,
    min_max_scaled, facility_pool, facility_access, facility_event_impact, facility_safety,
    eligible_facilities, facility_activation_rank, facility_rankings, top_facilities,
    nearest_facility_assignment, assignment_summary, logistics_recommendations, map_export,
    skipped_events, unreachable_events, scored_feed, scored_quarantine, late_event_feed,
    stream_dedup, unique_event_feed, late_event_split, live_risk_upsert, risk_change_feed,
    recommendation_upsert, recommendation_feed, risk_level_thresholds, risk_decay,
    scheduled_decay,
)}
