"""Plain Python versions of the formulas, to test the operators against."""

import math
import random
import re
import unicodedata


def km(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = (math.sin((p2 - p1) / 2) ** 2
         + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2)
    return 2 * 6371.0 * math.asin(min(1.0, math.sqrt(a)))


def strength(magnitude, depth):
    clip = lambda x: min(max(x, 0.0), 100.0)
    return 0.7 * clip((magnitude - 5) / 2.5 * 100) + 0.3 * clip(100 - depth / 40 * 100)


def name_key(text):
    if text is None:
        return ""
    text = unicodedata.normalize("NFKC", text.strip().lower())
    text = text.translate(str.maketrans("çğıöşüâîû", "cgiosuaiu"))
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", text)).strip()


def events(n, seed=1, lat=(40, 41.5), lon=(26.5, 31)):
    r = random.Random(seed)
    return [(f"E{i}", f"quake {i}", r.uniform(*lat), r.uniform(*lon), r.uniform(3, 7.5),
             r.uniform(0, 50), f"2024-01-01T10:{i % 60:02d}:00", "test", "2024-01-01T11:00:00")
            for i in range(n)]


def districts(n, seed=2, lat=(40, 41.5), lon=(26.5, 31)):
    r = random.Random(seed)
    return [(f"province {i % 5}", f"district {i}", f"P{i % 5}", f"D{i}", r.uniform(*lat),
             r.uniform(*lon), float(r.choice([0, 0, 20, 40, 60, 80, 99, 99, r.uniform(0, 100)])))
            for i in range(n)]


def pois(n, seed=3, lat=(40, 41.5), lon=(26.5, 31)):
    r = random.Random(seed)
    kinds = ["havalimani", "liman", "feribot_iskele", "otogar", "hastane", "itfaiye", "polis",
             "akaryakit", "okul"]
    spots = [(r.uniform(*lat), r.uniform(*lon)) for _ in range(max(4, n // 12))]
    rows = []
    for i in range(n):
        at = r.choice(spots)
        rows.append((i, r.choice(kinds), "x", r.choice([None, " ", f"Yer {i % 9}", "Metro", "Ana Üs"]),
                     at[0] + r.uniform(0, .02), at[1] + r.uniform(0, .02), "p", "d",
                     f"P{i % 6}", f"D{i % 30}", r.choice(["n/a", "12d", "3.5", "40", None])))
    return rows


DISTRICT_DDL = ("province string, district string, province_key string, district_key string, "
                "latitude double, longitude double, final_risk_score double")
