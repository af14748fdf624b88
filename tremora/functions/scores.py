"""The scoring formulas as Column expressions. Null in, null out."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremora import fixed


def clip(value: Column, low: float = 0.0, high: float = 100.0) -> Column:
    # least/greatest skip nulls, so a missing value would become a bound without the guard
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def magnitude_score(magnitude: Column) -> Column:
    span = fixed.MAGNITUDE_CEILING - fixed.MAGNITUDE_FLOOR
    return clip((magnitude - fixed.MAGNITUDE_FLOOR) / span * 100)


def depth_score(depth_km: Column) -> Column:
    return clip(100 - depth_km / fixed.DEPTH_LIMIT_KM * 100)


def event_strength(magnitude: Column, depth_km: Column) -> Column:
    return (magnitude_score(magnitude) * fixed.MAGNITUDE_WEIGHT
            + depth_score(depth_km) * fixed.DEPTH_WEIGHT)


def proximity(km: Column) -> Column:
    return 100 * F.exp(-km / fixed.DISTANCE_DECAY_KM)


def impact(strength: Column, km: Column) -> Column:
    """0-100 without a clip: both factors are within 0-100 already."""
    return strength * proximity(km) / 100


def dynamic_priority(impact_score: Column, base_risk: Column) -> Column:
    return impact_score * fixed.IMPACT_WEIGHT + base_risk * fixed.BASE_RISK_WEIGHT


def severity(magnitude: Column) -> Column:
    chain = F.when(magnitude.isNull(), F.lit(None).cast("string"))
    for least, name in fixed.SEVERITY_STEPS:
        chain = chain.when(magnitude >= least, name)
    return chain.otherwise(fixed.SEVERITY_OTHERWISE)


def live_risk(base_risk: Column, impact_score: Column) -> Column:
    return (base_risk * (1 - fixed.LIVE_IMPACT_WEIGHT)
            + impact_score * fixed.LIVE_IMPACT_WEIGHT)


def risk_level(score: Column, steps=fixed.RISK_LEVEL_STEPS) -> Column:
    chain = F.when(score.isNull(), F.lit(None).cast("string"))
    for most, name in steps:
        chain = chain.when(score <= most, name)
    return chain.otherwise(fixed.RISK_LEVEL_OTHERWISE)


def facility_type_score(category: Column) -> Column:
    score = F.lit(0)
    for name, points in fixed.FACILITY_TYPE_SCORES.items():
        score = F.when(category == name, points).otherwise(score)
    return score


def weighted_sum(weights: dict[str, float]) -> Column:
    return reduce(lambda a, b: a + b, [F.col(name) * w for name, w in weights.items()])


def scaled(value: Column, low: Column, high: Column) -> Column:
    """Min-max scaling to 0-100; a constant column scales to 0."""
    return F.when(high == low, 0.0).otherwise((value - low) / (high - low) * 100)


def to_number(text: Column) -> Column:
    """Text to double, null where it is no plain number (``cast`` alone would take '12d')."""
    number = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
    text = text.cast("string")
    return F.when(text.rlike(number), text.try_cast("double"))


def round_even_2(value: Column) -> Column:
    """Two decimals, halves to even on the scaled double."""
    return F.rint(value * 100) / 100
