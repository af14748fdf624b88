import random

import pytest
from pyspark.sql import functions as F

from tests import brute
from tremora import schemas
from tremora.operators import (activation, assign, districts, enrich, facilities, impact,
                               ingest, risk, spatial)
from tremora.operators.ranks import rank_by_score
from tremora.plans import recommend
from tremora.plans.pool import build_pool
from tremora.sources import feeds


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def events_df(spark, n=30, **kw):
    return spark.createDataFrame(brute.events(n, **kw), schemas.EVENT)


def districts_df(spark, n=60, **kw):
    return spark.createDataFrame(brute.districts(n, **kw), brute.DISTRICT_DDL)


# --- ingestion --------------------------------------------------------------------------------

FEED = ['{"eventID":"A","location":"x","latitude":"40","longitude":29,"magnitude":4.5,"depth":7,'
        '"date":"2024-01-01T00:00:00"}',
        '{"id":"B","latitude":40,"longitude":29,"magnitude":0,"ml":5}',
        '{"eventID":"","id":"C","latitude":40,"longitude":29}',
        '{"eventID":"D","longitude":29,"magnitude":6}', 'not json']


def test_normalized_feed(spark):
    raw = spark.createDataFrame([(t,) for t in FEED], "value string")
    now = F.lit("2024-02-02 00:00:00").cast("timestamp")
    events = ingest.normalize_feed(feeds.decode(raw, schemas.FEED), now)
    kept = {r.event_id: r for r in ingest.valid(events).collect()}
    assert set(kept) == {"A", "B", "C"}
    assert (kept["A"].event_name, kept["A"].latitude, kept["A"].depth_km) == ("x", 40.0, 7.0)
    assert (kept["B"].event_name, kept["B"].magnitude, kept["B"].depth_km) == (
        "Bilinmeyen Konum", 5.0, 10.0)
    assert kept["B"].event_time.startswith("2024-02-02T00:00:00")
    assert kept["C"].magnitude == 0.0
    assert {r.event_id for r in ingest.quarantined(events).collect()} == {"D", None}
    assert {r.event_id for r in ingest.strong_enough(ingest.valid(events)).collect()} == {"A", "B"}


def test_nan_is_quarantined(spark):
    bad = list(brute.events(1)[0])
    bad[4] = float("nan")
    events = spark.createDataFrame([tuple(bad)], schemas.EVENT)
    assert ingest.valid(events).count() == 0 and ingest.quarantined(events).count() == 1


def test_first_report_wins_under_a_hot_id(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 50))
        .alias("event_id"), (-F.col("id")).alias("at"))
    got = dict(rows(ingest.first_reports(df, "at")))
    assert got["hot"] == -2997 and len(got) == 51


# --- districts --------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [6, 60])
def test_top_districts_without_the_product(spark, n):
    events, table = events_df(spark), districts_df(spark, n)
    columns = ["event_id", "district_key", "district_order", "event_priority_rank"]
    whole = rows(districts.top_districts(impact.score_pairs(events, table)), *columns)
    assert rows(districts.top_districts_of_events(events, table), *columns) == whole
    # a district table too large to broadcast is joined in blocks
    assert rows(districts.top_districts_of_events(events, table, rows=7), *columns) == whole
    pairs = impact.score_pairs(events, table, rows=7)
    assert pairs.count() == 30 * n
    assert rows(districts.top_districts(pairs), *columns) == whole


def test_scores_of_pairs(spark):
    by_name = {d[3]: d for d in brute.districts(20)}
    pairs = impact.score_pairs(events_df(spark, 5), districts_df(spark, 20))
    for r in pairs.collect():
        d = by_name[r.district_key]
        far = brute.km(r.event_latitude, r.event_longitude, d[4], d[5])
        hit = brute.strength(r.magnitude, r.depth_km) * 2.718281828459045 ** (-far / 75)
        assert abs(r.distance_to_epicenter_km - far) < 1e-6
        assert abs(r.event_impact_score - hit) < 1e-6 and 0 <= r.event_impact_score <= 100
        assert abs(r.dynamic_priority_score - (.6 * hit + .4 * d[6])) < 1e-6


@pytest.mark.parametrize("ties", [False, True])
def test_ranks_in_bands_equal_ranks_in_one_window(spark, ties):
    r = random.Random(5)
    data = [("hot" if i % 3 else f"k{i % 4}", r.choice([0.0, 5.0, 5.5, 99.99, None,
             r.uniform(0, 100)]), i) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, s double, i int")
    order = [F.asc("i")] if ties else None
    split = rank_by_score(df, "k", "s", "r", ties=order)
    plain = rank_by_score(df, "k", "s", "r", ties=order, bounded=True)
    assert rows(split, "i", "r") == rows(plain, "i", "r")


def test_bands_share_scores_that_lie_close_together(spark):
    """All scores within one unit, most of one key: the rows of a band are far fewer than all."""
    df = spark.range(20_000).selectExpr(
        "IF(id % 5 > 0, 'hot', concat('k', id % 7)) k", "50 + pmod(id * 7919, 20000) / 20000 s",
        "cast(id as int) i")
    split = rank_by_score(df, "k", "s", "r")
    assert rows(split, "i", "r") == rows(rank_by_score(df, "k", "s", "r", bounded=True), "i", "r")
    limits = df.agg(F.approx_percentile("s", [n / 64 for n in range(1, 64)], 1280)).first()[0]
    sizes = [r["count"] for r in df.groupBy(F.size(F.filter(
        F.array(*map(F.lit, limits)), lambda x: x < F.col("s")))).count().collect()]
    assert len(sizes) == 64 and max(sizes) < 2 * 20_000 / 64


def test_missing_events_are_reported(spark):
    df = events_df(spark, 2)
    districts.require_events(df, ["E0", "E1"])
    with pytest.raises(ValueError, match="E9"):
        districts.require_events(df, ["E0", "E9"])


# --- live risk --------------------------------------------------------------------------------

def test_worst_case_from_events_equals_worst_case_from_pairs(spark):
    events, table = events_df(spark, 40), districts_df(spark, 50)
    # a district without coordinates has no impact, but stays
    table = table.withColumn("latitude", F.when(F.col("district_key") != table.first(
        ).district_key, F.col("latitude")))
    events = events.unionByName(events.withColumn("event_id", F.concat("event_id", F.lit("b"))))
    columns = ["province_key", "district_key", "province", "district", "live_event_impact_score",
               "baseline_risk_score", "dynamic_priority_score", "triggering_event_id",
               "strongest_event_id"]
    whole = rows(risk.district_worst_case(impact.score_pairs(events, table)), *columns)
    assert rows(risk.worst_case_of_events(events, table), *columns) == whole
    assert rows(risk.worst_case_of_events(events, table, rows=9), *columns) == whole


WORST = ["province_key", "district_key", "province", "district", "live_event_impact_score",
         "baseline_risk_score", "dynamic_priority_score", "triggering_event_id",
         "strongest_event_id"]


@pytest.mark.parametrize("lat,lon", [((-89.9, 89.9), (-180, 180)), ((40, 40.01), (29, 29.01)),
                                     ((-1, 1), (179, 180)), ((88, 90), (-180, 180))])
def test_best_and_worst_anywhere_on_the_globe(spark, lat, lon):
    """Both plans without the product, rounded as sums of equal doubles may differ in the last bit."""
    events = events_df(spark, 60, seed=11, lat=lat, lon=lon)
    table = districts_df(spark, 80, seed=12, lat=lat, lon=lon)
    pairs = impact.score_pairs(events, table)
    assert rows(risk.worst_case_of_events(events, table), *WORST) == rows(
        risk.district_worst_case(pairs), *WORST)
    columns = ["event_id", "district_key", "district_order", "event_priority_rank"]
    assert rows(districts.top_districts_of_events(events, table), *columns) == rows(
        districts.top_districts(pairs), *columns)


def test_worst_case_without_keys_strength_or_events(spark):
    events, table = events_df(spark, 6), districts_df(spark, 8)
    table = table.withColumn("district_key", F.when(F.col("district") != "district 3",
                                                    F.col("district_key")))
    table = table.unionByName(table.limit(2))  # districts listed twice
    weak = events.withColumns({"magnitude": F.lit(3.0), "depth_km": F.lit(90.0)})
    for some in (events, weak, events.unionByName(weak.withColumn("event_id", F.lit("Z")))):
        want = rows(risk.district_worst_case(impact.score_pairs(some, table)), *WORST[2:])
        assert rows(risk.worst_case_of_events(some, table), *WORST[2:]) == want
        assert len(want) == 8
    assert risk.worst_case_of_events(events.limit(0), table).count() == 0
    assert risk.worst_case_of_events(events, table.limit(0)).count() == 0


def test_a_crowd_of_events_is_thinned_before_any_pair(spark):
    """Pairs must not grow with the reports on one spot, nor with copies of a report."""
    table = districts_df(spark, 40)
    few = events_df(spark, 200, seed=3, lat=(40.5, 40.51), lon=(29.0, 29.01))
    many = events_df(spark, 5000, seed=3, lat=(40.5, 40.51), lon=(29.0, 29.01))
    copies = few.crossJoin(spark.range(20)).withColumn(
        "event_id", F.concat("event_id", F.lit("-"), F.col("id"))).drop("id")
    assert risk.skyline(copies).count() == risk.skyline(few).count() < 30
    assert risk.skyline(many).count() < 30
    side = impact.district_side(table).withColumn("_row", F.monotonically_increasing_id())
    assert risk.worst_candidates(side, many).count() < 30 * 40
    assert rows(risk.worst_case_of_events(many, table), *WORST) == rows(
        risk.district_worst_case(impact.score_pairs(many, table)), *WORST)


def test_candidates_of_an_event_are_few_of_all_districts(spark):
    events = events_df(spark, 50, lat=(36, 42), lon=(26, 44))
    table = districts_df(spark, 3000, lat=(36, 42), lon=(26, 44))
    found = districts.district_candidates(events, table)
    assert found.count() < 0.1 * 50 * 3000
    columns = ["event_id", "district_key", "district_order", "event_priority_rank"]
    assert rows(districts.top_districts_of_events(events, table), *columns) == rows(
        districts.top_districts(impact.score_pairs(events, table)), *columns)


def test_no_plan_without_an_equality(spark):
    events, table = events_df(spark, 20), districts_df(spark, 30)
    for df in (districts.top_districts_of_events(events, table),
               districts.top_districts_of_events(events, table, rows=5),
               risk.worst_case_of_events(events, table),
               risk.worst_case_of_events(events, table, rows=5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_change_must_exceed_the_threshold(spark):
    new = spark.createDataFrame([("P", "a", 11.0), ("P", "b", 11.5), ("Q", "a", 1.0)],
                                "province_key string, district_key string, live_risk_score double")
    old = spark.createDataFrame([("P", "a", 10.0), ("P", "b", 10.0)], new.schema)
    assert rows(risk.changed(new, old), "province_key", "district_key") == [("P", "b"), ("Q", "a")]


# --- spatial ----------------------------------------------------------------------------------

@pytest.mark.parametrize("lat,lon,km", [
    ((40, 41.5), (26.5, 31), 15), ((-2, 2), (178, 182), 40), ((86, 90), (-180, 180), 300),
    ((-90, -84), (-180, 180), 150), ((69, 79), (-20, 20), 300), ((-90, 90), (-180, 180), 2500),
])
def test_radius_join_finds_exactly_the_pairs_in_reach(spark, lat, lon, km):
    wrap = lambda x: (x + 180) % 360 - 180
    a = [(i, e[2], wrap(e[3])) for i, e in enumerate(brute.events(150, 1, lat, lon))]
    b = [(i, e[2], wrap(e[3])) for i, e in enumerate(brute.events(80, 2, lat, lon))]
    want = sorted((p[0], c[0]) for p in a for c in b if brute.km(*p[1:], *c[1:]) <= km)
    points = spark.createDataFrame(a, "p int, point_lat double, point_lon double")
    centers = spark.createDataFrame(b, "c int, center_lat double, center_lon double")
    assert want
    assert rows(spatial.radius_join(points, centers, km), "p", "c") == want
    assert rows(spatial.radius_join(points, centers, km, rows=0), "p", "c") == want


# --- facilities -------------------------------------------------------------------------------

def _near_rows(spark, spots, each, seed, lat, lon, spread=0.002):
    r = random.Random(seed)
    points = []
    for _ in range(spots):
        at = r.uniform(*lat), r.uniform(*lon)
        points += [(r.choice("abc"), min(90.0, max(-90.0, at[0] + r.uniform(-spread, spread))),
                    (at[1] + r.uniform(-spread, spread) + 180) % 360 - 180) for _ in range(each)]
    points += [("a", None, 1.0), ("b", 1.0, None)]
    centers = [(k, r.uniform(*lat), r.uniform(*lon)) for k in range(40)]
    return (spark.createDataFrame(points, "near string, point_lat double, point_lon double"),
            spark.createDataFrame(centers, "center_id int, center_lat double, center_lon double"),
            points[:-2], centers)


@pytest.mark.parametrize("lat,lon", [((40, 40.4), (29, 29.6)), ((88.5, 90), (-180, 180)),
                                     ((-0.2, 0.2), (179.8, 180)), ((-90, -89.99), (-180, 180))])
@pytest.mark.parametrize("limit", [100_000, 10])
def test_counts_by_cells_equal_counts_by_pairs(spark, lat, lon, limit):
    points, centers, plain, middles = _near_rows(spark, 60, 8, 4, lat, lon)
    kinds = {name: F.col("near") == name for name in "abc"}
    for km in (15.0, 1.3):
        got = {r.center_id: (r.a, r.b, r.c) for r in
               spatial.counts_around(points, centers, km, kinds, limit).collect()}
        for k, at, on in middles:
            near = [p[0] for p in plain if brute.km(p[1], p[2], at, on) <= km]
            assert got.get(k, (0, 0, 0)) == tuple(near.count(n) for n in "abc")


def test_pairs_grow_with_the_border_alone(spark):
    """A crowd within the radius adds one row of sums, however many its points."""
    counts = []
    for each in (10, 1000):
        points, centers, *_ = _near_rows(spark, 30, each, 5, (40.0, 40.4), (29.0, 29.4), 0.0001)
        sums = spatial.cell_sums(points.dropna(), {"a": F.col("near") == "a"})
        counts.append(sums.count())
    assert max(counts) <= 2 * min(counts) <= 2 * 120


def test_names_and_duplicates(spark):
    data = [
        (1, "otogar", "x", "Durak 5", 40.0, 29.0, "p", "d", "P", "D", "1"),
        (2, "liman", "x", " ", 40.001, 29.001, "p", "d", "P", "D", "1"),
        (3, "liman", "x", "Gemlik", 40.002, 29.002, "p", "d", "P", "D", "1"),
        (4, "liman", "x", "GEMLİK", 40.5, 29.0, "p", "d", "P", "D", "1"),
        (5, "liman", "x", "gemlik", 40.9, 29.0, "p", "d", "P", "D", "1"),
        (6, "liman", "x", "Durak", 41.2, 29.0, "p", "d", None, "D", "1"),
        (7, "liman", "x", None, 41.3, 29.0, "p", "d", "P", "D", "1"),
        (8, "liman", "x", "x", None, 29.0, "p", "d", "P", "D", "1"),
        (9, "hastane", "x", "x", 41.3, 29.0, "p", "d", "P", "D", "1"),
    ]
    pois = spark.createDataFrame(data, schemas.POI)
    cleaned = facilities.cleaned(pois)
    names = {r.id: (r.facility_name, r.facility_name_key) for r in cleaned.collect()}
    assert set(names) == {2, 3, 4, 5, 6, 7}
    assert names[7] == ("İsimsiz liman - OSM 7", "i simsiz liman osm 7")
    placed = facilities.one_per_place(cleaned)
    assert {r.id for r in placed.collect()} == {3, 4, 5, 6, 7}
    final = facilities.one_per_name(placed)
    # "GEMLİK" has another key than "gemlik": its dotted capital leaves a gap
    assert {r.id for r in final.collect()} == {3, 4, 6, 7}
    assert rows(facilities.one_per_name(facilities.one_per_place(final))) == rows(final)


def test_district_risk_join(spark):
    f = spark.createDataFrame([(1, "P", "D"), (2, None, "D"), (3, "X", "Y")],
                              "id int, province_key string, district_key string")
    table = spark.createDataFrame([("P", "D", 10.0, 1.0), (None, "D", 20.0, 2.0),
                                   ("P", "D", 60.0, 3.0)], schemas.RISK)
    got = rows(facilities.with_district_risk(f, table), "id", "copy", "hazard_score",
               "final_risk_score")
    assert got == [(1, 1, 10.0, 1.0), (1, 2, 60.0, 3.0), (2, 1, 20.0, 2.0), (3, 1, 30.0, 2.0)]


def test_scaling(spark):
    df = spark.createDataFrame([("5",), ("n/a",), ("10",)], "x string")
    assert rows(enrich.min_max(df, "x", "y"), "y") == [(0.0,), (50.0,), (100.0,)]
    same = spark.createDataFrame([("5",), ("5",)], "x string")
    assert rows(enrich.min_max(same, "x", "y"), "y") == [(0.0,), (0.0,)]


def risk_rows(n=30):
    return [(f"P{i % 6}", f"D{i}", float(i * 7 % 101), float(i * 3 % 90)) for i in range(n)]


def test_pool_against_brute_force(spark):
    data = brute.pois(400)
    pois = spark.createDataFrame(data, schemas.POI)
    table = spark.createDataFrame(risk_rows(), schemas.RISK)
    pool = {r.id: r for r in build_pool(pois, table).collect()}
    again = {r.id: r for r in build_pool(pois, table, rows=0).collect()}
    assert pool == again and len(pool) > 20
    support = [d for d in data if d[1] in ("hastane", "itfaiye", "polis", "akaryakit")]
    points = {"hastane": 3, "itfaiye": 2, "akaryakit": 2, "polis": 1}
    raw = {}
    for r in pool.values():
        near = [d[1] for d in support if brute.km(d[4], d[5], r.latitude, r.longitude) <= 15]
        raw[r.id] = sum(points[k] for k in near)
        assert r.nearby_hospital_count == near.count("hastane")
        assert r.nearby_fuel_station_count == near.count("akaryakit")
        assert r.local_support_raw == raw[r.id]
        modes = {o.kategori for o in pool.values()
                 if brute.km(o.latitude, o.longitude, r.latitude, r.longitude) <= 20}
        assert r.multimodal_score == len(modes) / 4 * 100
    low, high = min(raw.values()), max(raw.values())
    for r in pool.values():
        assert abs(r.local_support_score - (raw[r.id] - low) / (high - low) * 100) < 1e-9
        # text that is no number takes the median before it is scaled
        number = {"3.5": 3.5, "40": 40.0}.get(r.fay_mesafe_km)
        if number is not None:
            assert r.fault_distance_safety_score == (0.0 if number == 3.5 else 100.0)


# --- recommendations --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def world(spark):
    wide = dict(lat=(38, 43), lon=(24, 36))
    events, table = events_df(spark, 25, **wide), districts_df(spark, 70, **wide)
    pois = spark.createDataFrame(brute.pois(500, **wide), schemas.POI)
    pool = build_pool(pois, spark.createDataFrame(risk_rows(), schemas.RISK))
    top = districts.top_districts_of_events(events, table)
    return events, table, pool, top


def test_rankings_against_brute_force(spark, world):
    _, _, pool, top = world
    tops, facs = {}, {(r.id, r["copy"]): r for r in pool.collect()}
    for r in top.collect():
        tops.setdefault(r.event_id, []).append(r)
    want = {}
    for event, ds in tops.items():
        e = ds[0]
        for key, f in facs.items():
            far = [brute.km(d.district_latitude, d.district_longitude, f.latitude, f.longitude)
                   for d in ds]
            if min(far) > 100:
                continue
            w = [max(d.dynamic_priority_score, 0) for d in ds]
            reach = sum(a * 100 * 2.718281828459045 ** (-b / 75) for a, b in zip(w, far)) / sum(w)
            hit = brute.strength(e.magnitude, e.depth_km) * 2.718281828459045 ** (
                -brute.km(f.latitude, f.longitude, e.event_latitude, e.event_longitude) / 75)
            safe = (.5 * (100 - hit) + .3 * f.historical_hazard_safety_score
                    + .2 * f.fault_distance_safety_score)
            want[event, f.id] = (min(far), reach, .5 * reach + .25 * safe
                                 + .15 * f.facility_type_score + .05 * f.multimodal_score
                                 + .05 * f.local_support_score)
    ranked = recommend.facility_rankings(top, pool)
    assert ranked.columns == schemas.RANKING_COLUMNS
    got = {(r.event_id, r.id): r for r in ranked.collect()}
    assert set(got) == set(want) and len(want) < len(tops) * len(facs)
    for key, (near, reach, score) in want.items():
        assert abs(got[key].nearest_priority_district_km - near) < 1e-6
        assert abs(got[key].affected_area_access_score - reach) < 1e-6
        assert abs(got[key].facility_activation_score - score) < 1e-6
    shuffled = recommend.facility_rankings(top, pool, rows=0)
    assert rows(shuffled, "event_id", "id", "activation_rank") == rows(
        ranked, "event_id", "id", "activation_rank")


def test_every_top_district_is_served_once_by_the_nearest(spark, world):
    _, _, pool, top = world
    activated = recommend.activated_facilities(top, pool)
    best = activation.with_facility(activation.top_facilities(activated), pool).collect()
    by_event = {}
    for f in best:
        by_event.setdefault(f.event_id, []).append(f)
    got = recommend.recommendations(top, pool).collect()
    served = [(r.event_id, r.province_key, r.district_key) for r in got]
    assert len(set(served)) == len(served)
    assert set(served) == {(r.event_id, r.province_key, r.district_key) for r in top.collect()
                           if r.event_id in by_event}
    for r in got:
        far = [brute.km(f.latitude, f.longitude, r.district_latitude, r.district_longitude)
               for f in by_event[r.event_id]]
        assert abs(r.assignment_distance_km - min(far)) < 1e-6
        mates = [x for x in got if (x.event_id, x.facility_id) == (r.event_id, r.facility_id)]
        assert r.assigned_district_count == len(mates)
    assert assign.map_export(recommend.recommendations(top, pool)).columns == schemas.MAP_COLUMNS


def test_zero_weights_and_events_out_of_reach(spark, world):
    _, _, pool, _ = world
    f = pool.first()
    table = spark.createDataFrame(
        [("p", "d0", "P", "D0", f.latitude + .1, f.longitude, 0.0),
         ("p", "d1", "P", "D1", f.latitude - .2, f.longitude, 0.0)], brute.DISTRICT_DDL)
    calm = [("calm", "n", f.latitude, f.longitude, 3.0, 45.0, "2024-01-01T00:00:00", "s", "t")]
    top = districts.top_districts_of_events(spark.createDataFrame(calm, schemas.EVENT), table)
    row = recommend.facility_rankings(top, pool).where(F.col("id") == f.id).first()
    a = brute.km(f.latitude + .1, f.longitude, f.latitude, f.longitude)
    b = brute.km(f.latitude - .2, f.longitude, f.latitude, f.longitude)
    assert abs(row.weighted_priority_distance_km - (a + b) / 2) < 1e-6
    far = table.withColumn("latitude", F.lit(-30.0))
    top = districts.top_districts_of_events(spark.createDataFrame(calm, schemas.EVENT), far)
    recommended = recommend.assignments(top, pool)
    assert recommended.count() == 0
    assert rows(recommend.skipped_events(top, recommended)) == [("calm",)]


def test_facility_ids_must_be_unique(spark):
    twice = spark.createDataFrame(brute.pois(60), schemas.POI)
    twice = twice.unionByName(twice.withColumn("latitude", F.col("latitude") + 2).withColumn(
        "isim", F.concat("isim", F.lit(" x"))))
    with pytest.raises(ValueError, match="facility ids"):
        build_pool(twice, spark.createDataFrame(risk_rows(), schemas.RISK))


def test_pairs_of_events_and_facilities_are_not_shuffled(spark, world):
    events, table, pool, _ = world
    plan = recommend.recommend(events, table, pool)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text
    # the only shuffles are of the events themselves, once per use of the top list
    assert text.count("REPARTITION_BY_NUM") == text.count("Exchange hashpartitioning") == 2


def test_pushdown_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "pois")
    spark.createDataFrame(brute.pois(50), schemas.POI).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = enrich.support_points(spark.read.parquet(path)).select("id") \
        ._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1]
    assert "In(kategori" in pushed and "IsNotNull(latitude)" in pushed and "isim" not in plan


def test_window_cut_before_the_shuffle(spark):
    df = spark.range(10).withColumn("event_id", F.col("id") % 3)
    plan = ingest.first_reports(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
