"""Earthquake tables derived from the generic test tables.

One text per table serves both engines: ``{name}`` is a DataFrame in Spark and a view or common
table expression in SQL. Every definition reads its source tables whole.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Reports of quakes: many per quake (a user and event type stand for one), some too weak.
REPORT = """
SELECT event_id AS feed_id,
       concat('EVT', CAST(user_id AS STRING), '-', event_type) AS event_id,
       concat(event_type, ' zone ', CAST(user_id AS STRING)) AS event_name,
       CAST(40 AS DOUBLE) + CAST((event_id * 37) % 1499 AS DOUBLE) / 1000 AS latitude,
       CAST(26.5 AS DOUBLE) + CAST((event_id * 53) % 4493 AS DOUBLE) / 1000 AS longitude,
       CAST(26 + (event_id * 29) % 50 AS DOUBLE) / 10 AS magnitude,
       CAST((event_id * 7) % 500 AS DOUBLE) / 10 AS depth_km,
       concat('2024-01-0', CAST(1 + event_id % 9 AS STRING), 'T10:00:00') AS event_time
FROM {events}
"""

DISTRICT = """
SELECT n_name AS province, s_name AS district,
       concat('P', CAST(s_nationkey AS STRING)) AS province_key,
       concat('D', CAST(s_suppkey AS STRING)) AS district_key,
       CAST(40 AS DOUBLE) + CAST((s_suppkey * 41) % 150 AS DOUBLE) / 100 AS latitude,
       CAST(26.5 AS DOUBLE) + CAST((s_suppkey * 67) % 450 AS DOUBLE) / 100 AS longitude,
       CAST((s_suppkey * 1009) % 500000 AS DOUBLE) AS population,
       CAST((s_suppkey * 17) % 101 AS DOUBLE) AS hazard_score,
       CAST((s_suppkey * 19) % 101 AS DOUBLE) AS exposure_score,
       CAST((s_suppkey * 23) % 101 AS DOUBLE) AS infrastructure_score,
       CAST((s_suppkey * 29) % 101 AS DOUBLE) AS preparedness_score,
       CAST((s_suppkey * 31) % 101 AS DOUBLE) AS response_capacity_score,
       CASE WHEN s_acctbal < 0 THEN CAST(0 AS DOUBLE) ELSE s_acctbal / 100 END
           AS final_risk_score,
       CAST((s_suppkey * 37) % 101 AS DOUBLE) AS avg_criticality,
       CAST((s_suppkey * 41) % 101 AS DOUBLE) AS avg_hazard_score
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
"""

# Groups of fifty points share a place up to a few thousandths of a degree, so that places and
# names repeat; categories, blank and misleading names, bad numbers and unknown districts mix.
POI = """
SELECT c_custkey AS id,
       CASE c_custkey % 10 WHEN 0 THEN 'havalimani' WHEN 1 THEN 'liman'
            WHEN 2 THEN 'feribot_iskele' WHEN 3 THEN 'otogar' WHEN 4 THEN 'hastane'
            WHEN 5 THEN 'itfaiye' WHEN 6 THEN 'polis' WHEN 7 THEN 'akaryakit'
            WHEN 8 THEN 'otogar' ELSE 'okul' END AS kategori,
       c_mktsegment AS alt_tur,
       CASE WHEN c_custkey % 11 = 0 THEN NULL
            WHEN c_custkey % 17 = 0 THEN concat('Hava Üssü ', c_name)
            WHEN c_custkey % 19 = 0 THEN 'Şehir Metro Durağı'
            WHEN c_custkey % 23 = 0 THEN concat('Deniz Uçağı ', c_mktsegment)
            ELSE concat(' Çağ ', c_mktsegment, '  ', CAST(c_custkey % 40 AS STRING))
       END AS isim,
       CASE WHEN c_custkey % 29 = 0 THEN NULL
            ELSE CAST(40 AS DOUBLE) + CAST(((c_custkey - c_custkey % 50) * 31) % 1499
                 + c_custkey % 7 AS DOUBLE) / 1000 END AS latitude,
       CAST(26.5 AS DOUBLE) + CAST(((c_custkey - c_custkey % 50) * 43) % 4493
            + c_custkey % 7 AS DOUBLE) / 1000 AS longitude,
       n_name AS province, s_name AS district,
       CASE WHEN c_custkey % 31 = 0 THEN 'P99'
            ELSE concat('P', CAST(coalesce(s_nationkey, 98) AS STRING)) END AS province_key,
       concat('D', CAST(c_custkey % 120 AS STRING)) AS district_key,
       CASE WHEN c_custkey % 13 = 0 THEN 'n/a'
            ELSE CAST((c_custkey * 7) % 80 AS STRING) END AS fay_mesafe_km
FROM {customer} LEFT JOIN {supplier} ON s_suppkey = c_custkey % 120
     LEFT JOIN {nation} ON s_nationkey = n_nationkey
"""

# Raw feed text: broken JSON, both spellings of id and magnitude, missing fields, repeats.
FEED = """
SELECT k AS feed_id,
       CASE WHEN k % 41 = 0 THEN 'not json'
            ELSE concat('{{"', CASE WHEN k % 3 = 0 THEN 'id' ELSE 'eventID' END, '":"EVT',
                CAST(k - k % 2 AS STRING), '"',
                CASE WHEN k % 5 = 0 THEN ''
                     ELSE concat(',"location":"zone ', CAST(user_id AS STRING), '"') END,
                CASE WHEN k % 37 = 0 THEN ''
                     ELSE concat(',"latitude":', CAST(40 + (k * 37) % 2 AS STRING), '.',
                                 CAST(1 + k % 9 AS STRING)) END,
                ',"longitude":', CAST(26 + (k * 53) % 5 AS STRING), '.5,"',
                CASE WHEN k % 4 = 0 THEN 'ml' ELSE 'magnitude' END, '":',
                CAST(2 + k % 6 AS STRING), '.', CAST(k % 10 AS STRING),
                CASE WHEN k % 7 = 0 THEN ''
                     ELSE concat(',"depth":', CAST(k % 50 AS STRING)) END,
                ',"date":"2024-01-0', CAST(1 + k % 9 AS STRING), 'T10:00:00"}}') END AS value
FROM (SELECT event_id AS k, user_id FROM {events}) AS e
"""

# The same points drawn together into one corner, so that most quakes are out of their reach.
CORNER_POI = f"""
SELECT * REPLACE (CAST(40 AS DOUBLE) + (latitude - 40) / 15 AS latitude,
                  CAST(26.5 AS DOUBLE) + (longitude - 26.5) / 45 AS longitude)
FROM ({POI}) AS p
"""

# Messages of the scored feed: text that is no JSON, keys that lack or are null.
SCORED_TEXT = """
SELECT k AS feed_id,
       CASE WHEN k % 41 = 0 THEN concat('no score ', CAST(k AS STRING))
            ELSE concat('{{"event_id":"EVT', CAST(k AS STRING), '"',
                CASE WHEN k % 7 = 0 THEN '' ELSE ',"province_key":"P1"' END,
                CASE WHEN k % 5 = 0 THEN ',"district_key":null'
                     ELSE ',"district_key":"D1"' END, '}}') END AS value
FROM (SELECT event_id AS k FROM {events}) AS e
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _derive(spark: SparkSession, sf_dir: str, text: str, *sources: str) -> DataFrame:
    return spark.sql(text, **{s: table(spark, sf_dir, s) for s in sources})


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, REPORT, "events")


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, DISTRICT, "supplier", "nation")


def pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, POI, "customer", "supplier", "nation")


def corner_pois(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pois(spark, sf_dir).withColumns({
        "latitude": F.lit(40.0) + (F.col("latitude") - 40) / 15,
        "longitude": F.lit(26.5) + (F.col("longitude") - 26.5) / 45})


def scored_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, SCORED_TEXT, "events")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, FEED, "events")
