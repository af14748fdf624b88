import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests import brute
from tests.test_operators import districts_df, events_df, risk_rows, rows
from tremora import schemas
from tremora.operators import districts, impact, ingest, risk
from tremora.plans import recommend
from tremora.plans.pool import build_pool
from tremora.sources import feeds, tables
from tremora.streaming import jobs
from tremora.streaming.ledger import Ledger

NOW = {"availableNow": True}


@pytest.fixture(scope="module")
def scored(spark):
    return impact.score_pairs(events_df(spark, 12), districts_df(spark, 24)).cache()


@pytest.fixture(scope="module")
def pool(spark):
    return build_pool(spark.createDataFrame(brute.pois(300), schemas.POI),
                      spark.createDataFrame(risk_rows(), schemas.RISK))


def test_ledger_keeps_the_last_batch_of_a_key(spark, tmp_path):
    book = Ledger(spark, str(tmp_path), spark.range(0).selectExpr(
        "cast(id as string) k", "id v").schema, ("k",), "k", 4)
    put = lambda data, n: book.append(spark.createDataFrame(data, "k string, v long"), n)  # noqa
    assert rows(book.current()) == []
    put([("a", 1), ("b", 1)], 0)
    put([("b", 2), ("c", 2), ("c", 3)], 1)
    state = [("a", 1), ("b", 2), ("c", 2), ("c", 3)]
    assert rows(book.current()) == state
    put([("b", 2), ("c", 2), ("c", 3)], 1)  # replay
    assert rows(book.current()) == state
    assert rows(book.latest(1).select("k", "v")) == [("a", 1), ("b", 1)]
    book.compact(1)
    assert rows(book.current()) == state
    put([("a", 9)], 2)
    assert rows(book.current()) == [("a", 9)] + state[1:]
    assert rows(book.latest(2).select("k", "v")) == state
    assert rows(book.latest(1).select("k", "v")) == [("a", 1), ("b", 1)]


def test_ledger_deletes_what_a_snapshot_holds(spark, tmp_path):
    schema = spark.range(0).selectExpr("cast(id as string) k", "id v").schema
    plain = Ledger(spark, str(tmp_path / "plain"), schema, ("k",), "k", 4)
    book = Ledger(spark, str(tmp_path / "book"), schema, ("k",), "k", 4)
    for n in range(8):
        batch = spark.createDataFrame([("a", n), (f"k{n % 3}", n)], "k string, v long")
        for each in (plain, book):
            each.append(batch, n)
        book.compact_every(2, n)
        assert rows(book.current()) == rows(plain.current())
    # the last snapshot and the one before, and what came after that one
    assert {p.name for p in (tmp_path / "book/snapshot").iterdir()} == {"through=4", "through=6"}
    assert {p.name for p in (tmp_path / "book/log").iterdir()} == {
        "batch=5", "batch=6", "batch=7"}
    for before in (6, 7):  # a replay of the batch that folded last, and of the next
        assert rows(book.latest(before).select("k", "v")) == rows(
            plain.latest(before).select("k", "v"))


def test_a_batch_reads_the_days_of_its_events_alone(spark, tmp_path, scored, pool):
    pairs = jobs.scored_table(spark, str(tmp_path / "pairs"))
    table = jobs.recommendation_table(spark, str(tmp_path / "table"))
    publish = jobs.folder_feed(str(tmp_path / "feed"))
    days = [f"2024-02-{d:02d}" for d in range(1, 21)]
    number = F.substring("event_id", 2, 9).cast("int")
    dated = scored.withColumn("event_time", F.concat(F.element_at(F.array(*map(F.lit, days)),
                                                                  number % 20 + 1),
                                                     F.lit("T10:00:00")))
    jobs.update_recommendations(dated, 0, pairs, pool, table, publish)
    # half of one event's districts anew, and a corrected time for them
    one = dated.where("event_id = 'E0'")
    again = one.where(F.pmod(F.xxhash64("district_key"), F.lit(2)) == 0).withColumn(
        "event_time", F.lit("2024-03-01T10:00:00"))
    jobs.update_recommendations(again, 1, pairs, pool, table, publish)
    known = jobs.pairs_of_touched(1, pairs)
    assert known.count() == one.count() and known.select("district_key").distinct().count() == (
        one.select("district_key").distinct().count())
    assert {r.event_time[:10] for r in known.select("event_time").distinct().collect()} == {
        "2024-02-01", "2024-03-01"}
    plan = known._jdf.queryExecution().executedPlan().toString()
    filters = [f for f in re.findall(r"PartitionFilters: \[(.*?)\], Pushed", plan) if "day#" in f]
    assert filters and all("bucket#" in f and "2024-02-01" in f and "2024-03-01" in f
                           and "2024-02-02" not in f for f in filters)
    files = pairs.within(2, None, ["2024-02-01", "2024-03-01"]).select(
        F.input_file_name().alias("f")).distinct()
    assert {r.f.split("/day=")[1][:10] for r in files.collect()} == {"2024-02-01", "2024-03-01"}


def test_live_risk_batches_and_replay(spark, tmp_path, scored):
    table = jobs.live_risk_table(spark, str(tmp_path / "live"))
    publish = jobs.folder_feed(str(tmp_path / "feed"))
    first = scored.where("event_id IN ('E0', 'E1')")
    second = scored.where("event_id NOT IN ('E0', 'E1')")
    keys = ["province_key", "district_key", "live_risk_score"]
    jobs.update_live_risk(first, 0, table, publish)
    before = rows(table.current(), *keys)
    jobs.update_live_risk(second, 1, table, publish)
    jobs.update_live_risk(second, 1, table, publish)  # replay of the last batch
    after = rows(table.current(), *keys)
    assert after == rows(risk.with_live_risk(risk.district_worst_case(second)), *keys)
    feed = spark.read.schema("key string, value string, batch int").parquet(str(tmp_path / "feed"))
    moved = feeds.decode(feed.where("batch = 1"), jobs.LIVE_RISK)
    old = {k[:2]: k[2] for k in before}
    assert rows(moved, *keys) == [k for k in after if abs(k[2] - old[k[:2]]) > 1.0]
    assert feed.where("batch = 0").count() == len(before)
    jobs.update_live_risk(scored.where("false"), 2, table, publish)
    assert rows(table.current(), *keys) == after


def test_decay_returns_to_the_baseline(spark, scored):
    now = F.lit(datetime(2024, 1, 2))
    live = risk.with_live_risk(risk.district_worst_case(scored), now)
    fresh = risk.decayed(live, now)
    assert rows(fresh, "district_key", "live_risk_score") == rows(
        live, "district_key", "live_risk_score")
    old = risk.decayed(live, F.lit(datetime(2030, 1, 1)))
    for r in old.collect():
        assert abs(r.live_risk_score - 0.7 * r.baseline_risk_score) < 1e-9


def fading(spark, tmp_path, scored, name):
    table = jobs.live_risk_table(spark, str(tmp_path / f"live-{name}"))
    faded = jobs.live_risk_table(spark, str(tmp_path / f"faded-{name}"))
    start = F.lit(datetime(2024, 1, 1, tzinfo=timezone.utc))
    table.append(risk.with_live_risk(risk.district_worst_case(scored), start), 0)
    return table, faded, str(tmp_path / f"levels-{name}")


def test_any_schedule_of_decays_ends_alike(spark, tmp_path, scored):
    def hour(n):
        return datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(hours=n)
    results, feeds_of = [], []
    for name, schedule in (("a", [30]), ("b", [1, 2, 9, 9, 30]), ("c", [29, 30])):
        table, faded, out = fading(spark, tmp_path, scored, name)
        for number, n in enumerate(schedule):
            for _ in range(2):  # replayed
                jobs.decay_live_risk(hour(n), number, table, faded, jobs.folder_feed(out))
        results.append({(r.province_key, r.district_key): (round(r.live_risk_score, 9), r.risk_level)
                        for r in jobs.current_live_risk(table, faded).collect()})
        read = spark.read.schema("key string, value string, batch int").parquet(out)
        feeds_of.append(feeds.decode(read, jobs.LIVE_RISK, keep=("batch",)).collect())
    table, _, _ = fading(spark, tmp_path, scored, "whole")
    whole = risk.decayed(table.current(), F.lit(hour(30)))
    want = {(r.province_key, r.district_key): (round(r.live_risk_score, 9), r.risk_level)
            for r in whole.collect()}
    assert results == [want] * 3
    before = {(r.province_key, r.district_key): r.risk_level for r in table.current().collect()}
    changed = {k for k in want if want[k][1] != before[k]}
    assert changed and {(r.province_key, r.district_key) for r in feeds_of[0]} == changed
    for found in feeds_of[1:]:  # the last message of a district names its level of now
        last = {}
        for r in sorted(found, key=lambda r: r.batch):
            last[r.province_key, r.district_key] = r.risk_level
        assert last == {k: want[k][1] for k in last} and set(last) >= changed


def test_a_new_event_ends_the_fading(spark, tmp_path, scored):
    table, faded, out = fading(spark, tmp_path, scored, "n")
    later = datetime(2024, 1, 3, tzinfo=timezone.utc)
    jobs.decay_live_risk(later, 0, table, faded, jobs.folder_feed(out))
    jobs.update_live_risk(scored, 1, table, jobs.folder_feed(out + "2"))  # stamped with today
    now = jobs.current_live_risk(table, faded)
    assert rows(now, "district_key", "live_risk_score") == rows(
        table.current(), "district_key", "live_risk_score")
    jobs.decay_live_risk(later, 1, table, faded, jobs.folder_feed(out))  # older than the event
    assert rows(jobs.current_live_risk(table, faded), "district_key", "live_risk_score") == rows(
        table.current(), "district_key", "live_risk_score")


def test_decay_job_takes_its_time_from_the_ticks(spark, tmp_path, scored):
    table, faded, out = fading(spark, tmp_path, scored, "j")
    ticks, state = str(tmp_path / "ticks"), str(tmp_path / "state")
    for hours in (5, 12):
        spark.createDataFrame([(datetime(2024, 1, 1, tzinfo=timezone.utc) + timedelta(hours=h), h)
                               for h in (hours - 1, hours)], "timestamp timestamp, value long"
                              ).write.mode("append").parquet(ticks)
        stream = spark.readStream.schema("timestamp timestamp, value long").parquet(ticks)
        jobs.decay_job(stream, table, faded, jobs.folder_feed(out), state, NOW, 1).awaitTermination()
    want = risk.decayed(table.current(), F.lit(datetime(2024, 1, 1, 12, tzinfo=timezone.utc)))
    got = {r.district_key: r.live_risk_score
           for r in jobs.current_live_risk(table, faded).collect()}
    assert all(abs(got[r.district_key] - r.live_risk_score) < 1e-9 for r in want.collect())


def test_an_event_spread_over_batches_gets_its_true_top_ten(spark, tmp_path, scored, pool):
    pairs = jobs.scored_table(spark, str(tmp_path / "pairs"))
    table = jobs.recommendation_table(spark, str(tmp_path / "table"))
    publish = jobs.folder_feed(str(tmp_path / "feed"))
    part = F.pmod(F.xxhash64("district_key"), F.lit(2))
    jobs.update_recommendations(scored.where(part == 0), 0, pairs, pool, table, publish)
    partial = rows(jobs.current_recommendations(table), "event_id", "district_key")
    jobs.update_recommendations(scored.where(part == 1), 1, pairs, pool, table, publish)
    jobs.update_recommendations(scored.where(part == 1), 1, pairs, pool, table, publish)
    whole = recommend.assignments(districts.top_districts(scored), pool)
    columns = ["event_id", "district_key", "facility_id", "district_priority_rank"]
    assert rows(jobs.current_recommendations(table), *columns) == rows(whole, *columns)
    assert rows(whole, "event_id", "district_key") != partial
    feed = spark.read.schema("key string, value string, batch int").parquet(str(tmp_path / "feed"))
    row = feed.where("batch = 1").first()
    got = feeds.decode(spark.createDataFrame([row]), jobs.RECOMMENDATION, keep=("key",)).first()
    assert got.key == f"{got.event_id}:{got.facility_id}"


def test_pairs_that_arrive_twice_count_once(spark, tmp_path, scored, pool):
    pairs = jobs.scored_table(spark, str(tmp_path / "pairs"))
    table = jobs.recommendation_table(spark, str(tmp_path / "table"))
    publish = jobs.folder_feed(str(tmp_path / "feed"))
    jobs.update_recommendations(scored.union(scored), 0, pairs, pool, table, publish)
    whole = recommend.assignments(districts.top_districts(scored), pool)
    columns = ["event_id", "district_key", "facility_id", "district_priority_rank"]
    assert rows(jobs.current_recommendations(table), *columns) == rows(whole, *columns)


def test_score_job_keeps_late_events(spark, tmp_path):
    raw, out, state = (str(tmp_path / x) for x in ("raw", "out", "state"))
    table = districts_df(spark, 3)
    times = [("A", "10:00"), ("B", "12:00"), ("C", "12:01"), ("LATE", "11:00"), ("D", "12:02")]
    for name, clock in times:
        one = events_df(spark, 1).withColumn("event_id", F.lit(name)).withColumn(
            "event_time", F.lit(f"2024-01-01T{clock}:00"))
        feeds.encode(one, F.col("event_id")).write.mode("append").parquet(raw)
        jobs.score_job(feeds.read_stream(spark, "parquet", {"path": raw}), table, "parquet",
                       {"path": out}, state, NOW).awaitTermination()
    got = feeds.decode(spark.read.schema(feeds.KEY_VALUE).parquet(out), schemas.SCORED)
    assert rows(got.select("event_id").distinct()) == sorted((name,) for name, _ in times)
    assert got.count() == 15


def test_text_that_is_no_score_goes_to_quarantine(spark, tmp_path, scored):
    raw, out, bad = (str(tmp_path / x) for x in ("raw", "out", "bad"))
    good = feeds.encode(scored.limit(5), F.col("event_id"))
    broken = spark.createDataFrame([("k", "not json"), (None, '{"event_id":"X"}')],
                                   feeds.KEY_VALUE)
    good.unionByName(broken).write.parquet(raw)
    stream = jobs.scored_feed_stream(spark, "parquet", {"path": raw})
    (stream.writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", str(tmp_path / "s1")).trigger(**NOW).start()
     .awaitTermination())
    assert spark.read.schema(schemas.SCORED).parquet(out).count() == 5
    jobs.scored_quarantine_job(spark, "parquet", {"path": raw}, "parquet", {"path": bad},
                               str(tmp_path / "s2"), NOW).awaitTermination()
    assert {r.text for r in spark.read.parquet(bad).collect()} == {"not json", '{"event_id":"X"}'}


def test_an_event_that_loses_its_facilities_is_emptied(spark, tmp_path, scored, pool):
    pairs = jobs.scored_table(spark, str(tmp_path / "pairs"))
    table = jobs.recommendation_table(spark, str(tmp_path / "table"))
    publish = jobs.folder_feed(str(tmp_path / "feed"))
    one = scored.where("event_id = 'E0'")
    jobs.update_recommendations(one, 0, pairs, pool, table, publish)
    assert jobs.current_recommendations(table).count() == 10
    gone = one.withColumn("district_latitude", F.lit(-40.0))
    jobs.update_recommendations(gone, 1, pairs, pool, table, publish)
    assert jobs.current_recommendations(table).count() == 0


def test_score_job_drops_repeats_and_restarts(spark, tmp_path):
    raw, out, state = (str(tmp_path / x) for x in ("raw", "out", "state"))
    events, table = events_df(spark, 8), districts_df(spark, 5)
    sent = feeds.encode(events, F.col("event_id"))
    broken = spark.createDataFrame([("k", "not json"), ("k", '{"event_id":"X"}')],
                                   feeds.KEY_VALUE)

    def run():
        jobs.score_job(feeds.read_stream(spark, "parquet", {"path": raw}), table, "parquet",
                       {"path": out}, state, NOW, drop_repeats=True).awaitTermination()
    sent.where("key < 'E5'").unionByName(broken).write.mode("append").parquet(raw)
    run()
    sent.write.mode("append").parquet(raw)  # repeats five events
    run()
    got = feeds.decode(spark.read.schema(feeds.KEY_VALUE).parquet(out), schemas.SCORED)
    want = impact.score_pairs(events, table)
    assert rows(got, "event_id", "district_key", "dynamic_priority_score") == rows(
        want, "event_id", "district_key", "dynamic_priority_score")
    bad = str(tmp_path / "bad")
    jobs.quarantine_job(feeds.read_stream(spark, "parquet", {"path": raw}), "parquet",
                        {"path": bad}, str(tmp_path / "state2"), NOW).awaitTermination()
    assert {r.text for r in spark.read.parquet(bad).collect()} == {"not json", '{"event_id":"X"}'}


def test_district_table_from_csv(spark, tmp_path):
    csv, path = tmp_path / "d.csv", str(tmp_path / "table")
    csv.write_text("province,district,province_key,district_key,latitude,longitude,"
                   "final_risk_score\nİzmir,Çeşme,izmir,cesme,38.3,26.3,41.5\n"
                   "a,b,c,d,oops,26.3,\n", encoding="utf-8")
    got = tables.refresh_districts(spark, str(csv), path)
    assert got.schema == schemas.DISTRICT
    first = {r.district: r for r in got.collect()}
    assert first["Çeşme"].final_risk_score == 41.5 and first["Çeşme"].population is None
    assert first["b"].latitude is None and first["b"].final_risk_score is None


def test_kafka_options():
    assert feeds.kafka_source("h:9", "t") == {
        "kafka.bootstrap.servers": "h:9", "subscribe": "t", "startingOffsets": "latest"}
    assert feeds.kafka_sink("h:9", "t") == {"kafka.bootstrap.servers": "h:9", "topic": "t"}


def test_lateness_rule(spark):
    events = events_df(spark, 60).withColumn("ingested_at", F.lit("2024-01-01T10:30:00"))
    kept = ingest.recent(ingest.with_event_time(events))
    assert {r.event_time for r in kept.collect()} == {
        f"2024-01-01T10:{m}:00" for m in range(20, 60)}


def test_new_thresholds_feed_the_levels(spark, scored):
    table = districts_df(spark, 24)
    steps = risk.steps_of(risk.level_thresholds(table))
    assert [name for _, name in steps] == ["Low", "Medium", "High"]
    got = risk.with_live_risk(risk.district_worst_case(scored), steps=steps)
    for r in got.collect():
        name = next((n for most, n in steps if r.live_risk_score <= most), "Very High")
        assert r.risk_level == name


def test_batch_feed_of_any_format(spark, tmp_path):
    publish = jobs.format_feed("json", {"path": str(tmp_path / "feed")})
    publish(feeds.encode(spark.range(3), F.col("id").cast("string")), 0)
    assert sorted(r.value for r in spark.read.json(str(tmp_path / "feed")).collect()) == [
        '{"id":0}', '{"id":1}', '{"id":2}']
