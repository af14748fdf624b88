import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests import brute
from tremora.functions import geo, scores, text

SCENARIOS = [("EVT001", 40.84, 28.18, 7.2, 12.0), ("EVT002", 40.72, 29.78, 7.1, 15.0),
             ("EVT003", 40.43, 28.90, 7.0, 10.0)]


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_scenario_strengths_and_distances(spark):
    df = spark.createDataFrame(SCENARIOS, "id string, lat double, lon double, m double, d double")
    got = {r.id: r for r in df.select(
        "id", scores.severity(F.col("m")).alias("s"),
        scores.event_strength(F.col("m"), F.col("d")).alias("x")).collect()}
    assert [round(got[i].x, 6) for i in ("EVT001", "EVT002", "EVT003")] == [82.6, 77.55, 78.5]
    assert {r.s for r in got.values()} == {"Extreme"}
    a, b = df.alias("a"), df.alias("b")
    far = a.join(b, F.col("a.id") < F.col("b.id")).select(
        F.round(geo.haversine(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")), 6))
    assert sorted(r[0] for r in far.collect()) == [75.958035, 81.017027, 135.376242]
    impact = one(spark, scores.impact(F.lit(82.6), F.lit(75.958035)))[0]
    assert round(impact, 4) == 30.0012


def test_missing_values_stay_missing(spark):
    null = F.lit(None).cast("double")
    row = one(spark, scores.magnitude_score(null), scores.depth_score(null),
              scores.severity(null), scores.risk_level(null), scores.impact(null, F.lit(1.0)))
    assert list(row) == [None] * 5


def test_level_limits(spark):
    got = one(spark, *[scores.risk_level(F.lit(x)) for x in (30.0, 30.1, 55.0, 75.0, 75.1)])
    assert list(got) == ["Low", "Medium", "Medium", "High", "Very High"]
    got = one(spark, *[scores.severity(F.lit(x)) for x in (7.0, 6.99, 6.5, 6.0, 5.9)])
    assert list(got) == ["Extreme", "Major", "Major", "Moderate", "Minor"]


def test_numbers_from_text(spark):
    texts = ["12", " 3.5 ", "1e2", "12d", "n/a", "", None, "-4", "NaN"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(scores.to_number(F.col("t"))).collect()]
    assert got == [12.0, 3.5, 100.0, None, None, None, None, -4.0, None]


def test_coordinates_round_half_to_even(spark):
    got = one(spark, scores.round_even_2(F.lit(0.125)), scores.round_even_2(F.lit(0.375)))
    assert list(got) == [0.12, 0.38]


@pytest.mark.parametrize("lat", [(-89.9, 89.9), (88, 90)])
def test_unit_vectors_give_the_haversine_distance(spark, lat):
    rows = [(a[2], a[3], b[2], b[3]) for a, b in zip(
        brute.events(300, 1, lat, (-180, 180)), brute.events(300, 2, lat, (-180, 180)))]
    rows += [(10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    df = geo.with_unit(geo.with_unit(df, "a", "b", "p"), "c", "d", "q")
    for r in df.withColumn("km", geo.chord_km(geo.chord("p", "q"))).collect():
        # near the antipode the arcsine is steep, for this formula as for the other
        assert math.isclose(r.km, brute.km(r.a, r.b, r.c, r.d), rel_tol=1e-7, abs_tol=1e-7)


TEXTS = ["İZMİT Limanı", "Hava Üssü", "ÇAĞRI ÖZEL", "IĞDIR", "MİNİBÜS durağı", "a-b/c  d", "",
         None, "café", "ça", "Ａbc ﬁ", " x ", "\x1cy", "Ⅷ ²", "ΑΣ"]


def test_name_keys(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = [r[0] for r in df.select(text.normalize(F.col("t"))).collect()]
    assert got == [brute.name_key(t) for t in TEXTS]
    assert got[0] == "i zmi t limani" and got[8] == "caf" and got[9] == "ca"


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",),
                                      blacklist_characters="\x00")), min_size=20, max_size=60))
def test_name_keys_of_any_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(text.normalize(F.col("t"))).collect()]
    assert got == [brute.name_key(t) for t in texts]


def test_access_types(spark):
    names = ["5. Ana Üs Komutanlığı", "Deniz Uçağı", "Liman", "Liman"]
    kinds = ["havalimani", "liman", "liman", "okul"]
    df = spark.createDataFrame(list(zip(names, kinds)), "n string, k string")
    got = [r[0] for r in df.select(text.access_type(text.normalize(F.col("n")), F.col("k")))
           .collect()]
    assert got == ["military", "special_or_private", "civilian_or_unknown", "unknown"]
