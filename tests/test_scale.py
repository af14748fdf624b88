"""What a job moves and keeps must not be the product of events and districts."""

import glob
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from registry import queries, shape
from tremora import fixed, schemas
from tremora.operators import (access, activation, districts, facilities, impact, pyramid, ranks,
                               risk)
from tremora.plans import recommend
from tremora.sources import feeds
from tremora.streaming import jobs

NOW = {"availableNow": True}
EVENTS, PLACES = 24, 12


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Source tables of 24 events and 12 districts."""
    folder = str(tmp_path_factory.mktemp("sources"))
    spark.range(EVENTS * 4).selectExpr("id AS event_id", f"id % {EVENTS} AS user_id",
                                       "'click' AS event_type").write.parquet(
        f"{folder}/events.parquet")
    spark.range(1, PLACES + 1).selectExpr(
        "id AS s_suppkey", "concat('place ', id) AS s_name", "CAST(id % 2 AS INT) AS s_nationkey",
        "CAST(id * 700 AS DOUBLE) AS s_acctbal").write.parquet(f"{folder}/supplier.parquet")
    spark.range(2).selectExpr("CAST(id AS INT) AS n_nationkey",
                              "concat('nation ', id) AS n_name").write.parquet(
        f"{folder}/nation.parquet")
    return folder


def recorded(monkeypatch) -> list[int]:
    sizes = []

    def keep(df, name, plain=queries.written):
        out = plain(df, name)
        if name == "to-arrive":
            sizes.append(out.count())
        return out
    monkeypatch.setattr(queries, "written", keep)
    return sizes


@pytest.mark.parametrize("name", ["live_risk_upsert", "risk_change_feed"])
def test_the_scored_feed_is_not_kept_to_feed_job_2(spark, tables, monkeypatch, name):
    sizes = recorded(monkeypatch)
    rows = queries.QUERIES[name](spark, tables).collect()
    assert sizes == [queries.events(spark, tables).count()] and len(rows) >= PLACES


@pytest.mark.parametrize("name", ["recommendation_upsert", "recommendation_feed"])
def test_the_scored_feed_is_not_kept_to_feed_job_3(spark, tables, monkeypatch, name):
    sizes, filed = recorded(monkeypatch), []

    def job(stream, pairs, *rest):
        step = stream.writeStream.foreachBatch(lambda b, n: filed.append(b.count()))
        return step.option("checkpointLocation", rest[-2]).trigger(**NOW).start()
    monkeypatch.setattr(queries.jobs, "recommend_job", job)
    monkeypatch.setattr(queries, "pool", lambda *_: None)
    queries._recommendation_run(spark, tables)
    count = queries.events(spark, tables).count()
    assert sizes == [3 * count] and len(filed) == 3 and sum(filed) == count * PLACES


def test_a_micro_batch_is_dealt_over_tasks(spark, tables, tmp_path):
    raw = str(tmp_path / "raw")
    queries._as_feed(queries.events(spark, tables).drop("feed_id")).coalesce(1).write.parquet(raw)
    out = str(tmp_path / "out")
    jobs.score_job(feeds.read_stream(spark, "parquet", {"path": raw}),
                   queries.derived.districts(spark, tables), "parquet", {"path": out},
                   str(tmp_path / "state"), NOW).awaitTermination()
    scored = feeds.decode(spark.read.parquet(out), schemas.SCORED)
    assert scored.count() == queries.events(spark, tables).count() * PLACES
    assert len(glob.glob(f"{out}/part-*")) > 4


def test_few_rows_stay_and_all_winners_are_among_them(spark):
    chance = random.Random(5)
    rows = [(key, n, chance.choice([None, chance.randint(0, 300) / 4, float("nan")])
             if chance.random() < 0.1 else chance.randint(0, 3000) / 4)
            for key, many in (("a", 2000), ("b", 2000), ("c", 4), (None, 50)) for n in range(many)]
    df = spark.createDataFrame(rows, "event_id string, id long, score double")
    kept = ranks.can_be_among(df, "event_id", "score", 3, ["id"])

    def best(of):
        place = F.rank().over(W.partitionBy("event_id").orderBy(F.desc("score")))
        return sorted(((r.event_id, r.id, str(r.score)) for r in of.withColumn("_r", place).where(
            "_r <= 3").collect()), key=str)
    assert best(kept) == best(df)
    assert kept.where("event_id = 'a'").count() < 400


def test_top_districts_sort_only_what_reaches_a_bound(spark):
    scored = spark.range(3000).selectExpr(
        "concat('E', id % 3) AS event_id", "'P' AS province_key",
        "concat('D', id DIV 3) AS district_key", "CAST(id * 7919 % 1009 AS DOUBLE) AS s").selectExpr(
        "*", "s AS dynamic_priority_score", "s AS event_impact_score")
    kinds = ["event_id", "district_key", "district_order"]
    got = districts.top_districts(scored).select(*kinds).collect()
    assert sorted(got) == sorted(districts.top_districts(scored, sieve=False).select(*kinds).collect())
    assert "_bound" in districts.top_districts(scored)._jdf.queryExecution().optimizedPlan().toString()


def test_facilities_that_reach_no_bound_are_not_sorted(spark):
    """Scores repeat, so that the third best is shared."""
    activated = spark.range(4000).selectExpr(
        "concat('E', id % 4) AS event_id", "id DIV 4 AS id", "1 AS copy",
        "id % 2 = 0 AS is_named", "65 AS facility_type_score", "0D AS multimodal_score",
        "0D AS local_support_score", "1D AS affected_area_access_score",
        "0D AS facility_safety_score", "CAST(id * 7919 % 211 AS DOUBLE) AS facility_activation_score")
    columns = ["event_id", "id", "activation_rank", "facility_order"]
    plain, sieved = (activation.top_facilities(activated, sieve=sieve) for sieve in (False, True))
    assert sorted(sieved.select(*columns).collect()) == sorted(plain.select(*columns).collect())
    kept = ranks.can_be_among(activated, "event_id", "facility_activation_score", 3, ["id", "copy"])
    assert kept.count() < activated.count() / 4


def test_ranks_are_dealt_over_more_tasks_as_the_rows_grow(spark, tables, monkeypatch):
    """All rows stay, with their places and the pool's columns, in tasks that follow from counts."""
    numbers = [f"id * {n} % 11 + 0.5D AS {c}" for n, c in enumerate((
        "multimodal_score", "local_support_score", "historical_hazard_safety_score",
        "fault_distance_safety_score", "local_support_raw"), 3)]
    texts = [f"concat('{c}', id) AS {c}" for c in (
        "facility_name", "facility_name_key", "facility_access_type", "kategori", "alt_tur",
        "province", "district", "province_key", "district_key")]
    counts = [f"id % 3 AS nearby_{c}_count" for c in (
        "transport_mode", "hospital", "fire_station", "police", "fuel_station")]
    pool = spark.range(40).selectExpr(
        "id", "1 AS copy", "id % 2 = 0 AS is_named", "65 AS facility_type_score",
        "40.5D + id % 20 / 50 AS latitude", "28D + id / 50 AS longitude", *numbers, *texts, *counts)
    top = queries.top(spark, tables)
    monkeypatch.setattr(fixed, "SORTED_ROWS", EVENTS * 40 // 90, raising=False)
    ranked = recommend.facility_rankings(top, pool)
    place = F.row_number().over(W.partitionBy("event_id").orderBy(
        F.desc("facility_activation_score"), *facilities.candidate_order()))
    plain = recommend.activated_facilities(top, pool).withColumn("activation_rank", place)
    columns = ["event_id", "id", "activation_rank", *[c for c in access.POOL_COLUMNS
                                                      if c in ranked.columns and c != "id"]]
    assert sorted(ranked.select(columns).collect()) == sorted(plain.select(columns).collect())
    assert ranked.count() > EVENTS and ranked.rdd.getNumPartitions() > 80


def test_ten_places_from_keys_and_scores_alone(spark, tables, tmp_path):
    """A corrected pair counts with its last batch, and whole rows are joined to the winners."""
    scored = queries.scored(spark, tables)
    pairs = jobs.scored_table(spark, str(tmp_path / "pairs"))
    pairs.append(pairs.one_per_key(scored), 0, dealt=True)
    # the first district falls back to nothing, for every event
    worse = scored.where("district_key = 'D12'").withColumns(
        {"dynamic_priority_score": F.lit(-1.0), "event_impact_score": F.lit(0.0)})
    pairs.append(pairs.one_per_key(worse.unionByName(worse)), 1, dealt=True)
    got = jobs.top_of_touched(1, pairs).select(
        "event_id", "district_key", "district_order", "event_priority_rank", "base_risk_score")
    now = scored.where("district_key != 'D12'").unionByName(worse)
    want = districts.top_districts(now).select(*got.columns)
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 10 * want.select(
        "event_id").distinct().count()


def odd_pairs(spark, seed=3, count=6000):
    """Pairs with missing keys, ids and scores, ties and scores that are no numbers."""
    chance = random.Random(seed)

    def pick(value):
        return None if chance.random() < 0.05 else value

    def score():
        return pick(float("nan") if chance.random() < 0.001 else chance.randint(0, 300) / 4)
    rows = [(pick(f"E{chance.randint(0, 9000)}"), pick("P"), pick(f"D{chance.randint(0, 20)}"), "p",
             pick("d"), score(), score(), score()) for _ in range(count)]
    rows += [(f"E{n % 2}", "P", "weak", "p", "d", None, 1.0, None) for n in range(9)]
    rows += [(None, "P", "bare", "p", "d", None, None, None)] * 3
    return spark.createDataFrame(rows, (
        "event_id string, province_key string, district_key string, province string, "
        "district string, event_impact_score double, final_risk_score double, "
        "dynamic_priority_score double"))


def as_text(df) -> list[str]:
    return sorted(str(row) for row in df.collect())


@pytest.mark.parametrize("places", [(1, 8, 64, 512, 4096), (2,)])
def test_worst_case_of_what_reaches_a_bound_is_the_worst_case(spark, monkeypatch, places):
    monkeypatch.setattr(risk, "_ID_PLACES", places)
    pairs = odd_pairs(spark)
    assert as_text(risk.district_worst_case(pairs, sieve=True)) == as_text(
        risk.district_worst_case(pairs))
    none = pairs.limit(0)
    assert risk.district_worst_case(none, sieve=True).count() == 0


def test_worst_case_sorts_only_what_reaches_a_bound(spark, tables):
    """Maxima of text come after a filter by bounds; those of numbers sort nothing."""
    found = queries.district_worst_case_of_pairs(spark, tables)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_most" in plan and plan.count("NestedLoop") == 0
    assert as_text(found) == as_text(queries.district_worst_case(spark, tables))


def test_attributes_of_pairs_need_no_second_look(spark, tables):
    found = districts.event_attributes(queries.scored(spark, tables))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "district_key" not in plan
    want = districts.attributes_of_events(queries.events(spark, tables))
    assert as_text(found) == as_text(want)


def test_attributes_are_those_of_the_first_district(spark, tables):
    """Events whose pairs differ, one of them without an id."""
    pairs = queries.scored(spark, tables).withColumn("event_name", F.when(
        F.col("event_id") < "EVT2", F.concat("event_name", F.lit(" "), "district_key"))
        .otherwise(F.col("event_name")))
    nameless = pairs.where("event_id = 'EVT1-click'").withColumn(
        "event_id", F.lit(None).cast("string"))
    pairs = pairs.unionByName(nameless)
    first = W.partitionBy("event_id").orderBy("district_key", "province_key")
    want = pairs.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    found = districts.event_attributes(pairs)
    assert as_text(found) == as_text(want.select(*found.columns)) and found.count() == EVENTS + 1


@pytest.mark.parametrize("level", [0, len(pyramid.LEVELS) - 1])
def test_a_crowded_cell_is_dealt_over_tasks(spark, monkeypatch, level):
    """Nine of ten rows stand in one cell, next to one without a cell."""
    for name in ("TASK_ROWS", "CROWD_ROWS", "WIDE_CROWD_ROWS"):
        monkeypatch.setattr(pyramid, name, 50)
    placed = spark.range(2001).selectExpr(
        "id", "0 AS _band", f"{level} AS _level",
        "CASE WHEN id = 2000 THEN NULL WHEN id % 10 = 0 THEN id ELSE -1L END AS _cell")
    listed = spark.range(3).selectExpr("id AS place", "0 AS _band", f"{level} AS _level",
                                       "IF(id < 2, -1L, 20L) AS _cell")
    joined = pyramid.band_join(placed, listed, F.col("id") % 3 != F.col("place"), 3, rows=0)
    crowd = [n for n in range(2000) if n % 10]
    want = [(n, place) for n in crowd for place in (0, 1) if n % 3 != place]
    assert sorted((r.id, r.place) for r in joined.collect()) == want and joined.columns == [
        "id", "place"]
    tasks = pyramid._dealt(placed, listed, 3)[0].groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in tasks) < 400


def odd_events_and_places(spark):
    """Texts with quotes and letters, missing values, numbers that are none."""
    nan, none = float("nan"), None
    events = spark.createDataFrame([
        ("E1", 'zone "A"\n\\', 40.1, 27.2, 6.1, 11.0, "2024-01-01T10:00:00"),
        ("E2", "Çağ", none, 27.2, none, none, none), (none,) * 7,
        ("", "", 41.0, 28.0, nan, 5.0, "x"), ("E3", none, 89.9, -179.9, 7.9, 0.0, "t")],
        "event_id string, event_name string, latitude double, longitude double, magnitude double, "
        "depth_km double, event_time string")
    places = spark.createDataFrame([
        ("p", "İl{,}", "P1", "D1", 40.0, 27.0, 55.5), (none,) * 7,
        ("p", "d", none, "D2", none, none, 10.0), ("", "", "", "", 41.0, 28.0, nan)],
        "province string, district string, province_key string, district_key string, "
        "latitude double, longitude double, final_risk_score double")
    return events, places


@pytest.mark.parametrize("rows", [fixed.BROADCAST_ROWS, 2])
def test_messages_are_the_text_of_the_pairs(spark, rows):
    """With what a pair has from its event and its district written before the two meet."""
    events, places = odd_events_and_places(spark)
    pairs = impact.score_pairs(events, places)
    want = feeds.encode(pairs, F.col("district_key"))
    found = impact.pair_messages(events, places, rows)
    assert as_text(found) == as_text(want) and found.count() == 20
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join"):]
    assert "AS _event#" in below and "AS _district#" in below


def test_a_job_decodes_what_it_uses(spark):
    """Some columns of a message are the same as of all its columns, odd ones included."""
    events, places = odd_events_and_places(spark)
    odd = ["no json", '{"event_id":"E9"', '{"event_id":"E9","province_key":"P","district_key":"D",'
           '"magnitude":"much","event_impact_score":"high","province":7}', "[]", "", None,
           '{"event_id":"E9","province_key":"P","district_key":"D"}']
    raw = impact.pair_messages(events, places).unionByName(
        spark.createDataFrame([("k", text) for text in odd], "key string, value string"))
    whole = jobs.scored_messages(raw).select(*risk.COLUMNS)
    found = jobs.scored_messages(raw, risk.COLUMNS)
    assert as_text(found) == as_text(whole) and found.columns == risk.COLUMNS
    assert as_text(risk.district_worst_case(found)) == as_text(risk.district_worst_case(whole))


@pytest.mark.parametrize("name", ["live_risk_upsert", "risk_change_feed"])
def test_job_2_is_given_the_columns_it_uses(spark, tables, monkeypatch, name):
    given = []

    def job(stream, *rest):
        given.append(stream.columns)
        return stream.writeStream.format("noop").option(
            "checkpointLocation", rest[-2]).trigger(**NOW).start()
    monkeypatch.setattr(queries.jobs, "risk_job", job)
    queries._live_risk_run(spark, tables)
    assert given == [risk.COLUMNS] * 3


def test_a_fast_round_is_the_round(spark):
    """Halves, both signs, large ones, numbers that are none."""
    chance = random.Random(11)
    values = [None, 0.0, -0.0, float("nan"), float("inf"), float("-inf"), 1e300, -33787474.9436055,
              5e-7, -5e-7, 4.9e-7, -1e-9, 1e6 + 0.12345649, 67656421.0841595, 47.0396, 2.5e-5]
    values += [n / 2e4 for n in range(-50, 50)] + [n / 2e6 for n in range(-50, 50)]
    values += [chance.uniform(-1, 1) * 10 ** chance.randint(-7, 9) for _ in range(20000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for places in (4, 6):
        both = df.select("x", F.round("x", places).cast("string").alias("want"),
                         shape.rounded(F.col("x"), places).cast("string").alias("found"))
        assert both.where("NOT want <=> found").collect() == []


def test_a_bound_is_proven_by_a_share_of_the_members(spark, monkeypatch):
    """Bounds are taken of few rows; winners, ties and keys with few rows stay whole."""
    read = []

    def keep(df, name, plain=ranks.written):
        read.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df, name)
    monkeypatch.setattr(ranks, "written", keep)
    rows = spark.range(6000).selectExpr(
        "concat('E', id % 3) AS event_id", "id DIV 3 AS id",
        "CAST(id * 7919 % 997 AS DOUBLE) AS score").unionByName(spark.range(4).selectExpr(
            "'few' AS event_id", "id", "CAST(id AS DOUBLE) AS score"))
    kept = ranks.can_be_among(rows, "event_id", "score", 3, ["id"])

    def best(of):
        place = F.rank().over(W.partitionBy("event_id").orderBy(F.desc("score")))
        return as_text(of.withColumn("_r", place).where("_r <= 3"))
    assert best(kept) == best(rows)
    assert kept.where("event_id = 'few'").count() == 4
    assert kept.count() < 1500 and "shiftrightunsigned" in read[0]
    # the share is cut out before the rows are scored, where they meet
    places = spark.range(64).selectExpr("id", "id * 7919 % 97 AS weight")
    met = rows.select("event_id").distinct().crossJoin(places).selectExpr(
        "event_id", "id", "weight * length(event_id) + 0D AS score")
    ranks.can_be_among(met, "event_id", "score", 3, ["id"])
    join = read[-2][read[-2].index("Join"):]
    assert "shiftrightunsigned" in join


@pytest.mark.parametrize("share", [1, 16, 2 ** 40])
def test_ids_of_some_districts_part_the_pairs(spark, monkeypatch, share):
    """Any limits give the worst case, with no district among those that name the ids, too."""
    monkeypatch.setattr(risk, "_ID_SHARE", share)
    pairs = odd_pairs(spark, seed=7)
    assert as_text(risk.district_worst_case(pairs, sieve=True)) == as_text(
        risk.district_worst_case(pairs))


def test_ids_come_from_a_share_of_the_districts(spark, monkeypatch):
    read = []

    def keep(df, name, plain=risk.written):
        out = plain(df, name)
        if name == "event-ids":
            read.append(df._jdf.queryExecution().optimizedPlan().toString())
        return out
    monkeypatch.setattr(risk, "written", keep)
    pairs = spark.range(3200).selectExpr(
        "concat('E', id % 32) AS event_id", "'P' AS province_key", "concat('D', id DIV 32) AS district_key")
    risk._id_band(pairs)
    assert len(read) == 1 and "xxhash64" in read[0]


@pytest.mark.parametrize("most", [0, fixed.BOUND_ROWS])
def test_bounds_move_no_pairs_and_are_found_by_a_number_if_they_fit(spark, tables, monkeypatch, most):
    """Keys that share a number have the lower bound, or none; null keys keep their winners."""
    monkeypatch.setattr(fixed, "BOUND_ROWS", most)
    pairs = queries.scored(spark, tables)
    found = districts.top_districts(pairs)
    want = districts.top_districts(pairs, sieve=False)
    columns = ["event_id", "district_key", "province_key", "district_order", "event_priority_rank"]
    assert as_text(found.select(columns)) == as_text(want.select(columns))
    plan = found._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("BroadcastHashJoin" if most else "ShuffledHashJoin"):].splitlines()
    assert ("xxhash64" in join[0]) == bool(most)
    assert "Exchange" not in plan[:plan.index("BroadcastNestedLoopJoin")].replace(
        "BroadcastExchange", "").split("HashJoin")[0]
    rows = spark.range(4000).selectExpr(
        "CASE id % 4 WHEN 0 THEN NULL ELSE concat('E', id % 4) END AS event_id", "id DIV 4 AS id",
        "CAST(id * 7919 % 997 AS DOUBLE) * IF(id % 4 = 1, 1, 9) AS score")
    if most:
        monkeypatch.setattr(ranks.F, "xxhash64", lambda *c, plain=F.xxhash64: (
            plain(*c) if c == ("id",) else F.length(F.coalesce(*c, F.lit("E0")))))
    kept = ranks.can_be_among(rows, "event_id", "score", 3, ["id"])
    monkeypatch.undo()
    place = F.rank().over(W.partitionBy("event_id").orderBy(F.desc("score")))

    def best(of):
        return as_text(of.withColumn("_r", place).where("_r <= 3"))
    assert best(kept) == best(rows)
