"""Points of interest to a clean list of facilities that could serve as relief centres."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tremora import fixed
from tremora.functions import scores, text


def in_categories(pois: DataFrame, categories) -> DataFrame:
    """Points of the given categories that have coordinates.

    Spelled out, as ``dropna`` is a test the Parquet scan cannot take over.
    """
    kept = pois.where(F.col("kategori").isin(*categories))
    for c in ("latitude", "longitude"):
        kept = kept.where(F.col(c).isNotNull() & ~F.isnan(c))
    return kept


def candidates(pois: DataFrame) -> DataFrame:
    return in_categories(pois, fixed.FACILITY_TYPE_SCORES)


def support_points(pois: DataFrame) -> DataFrame:
    return in_categories(pois, fixed.SUPPORT_WEIGHTS)


def with_name_keys(pois: DataFrame, nfkc: bool = True) -> DataFrame:
    name = text.strip(F.coalesce(F.col("isim"), F.lit("")))
    return (pois.withColumn("facility_name", name)
            .withColumn("facility_name_key", text.normalize(F.col("facility_name"), nfkc)))


def without_stops(named: DataFrame) -> DataFrame:
    """Drop city stops, platforms and the like that are tagged as bus stations."""
    stop = text.contains_any(F.col("facility_name_key"), fixed.EXCLUDED_BUS_STATION_WORDS)
    return named.where(~((F.col("kategori") == fixed.BUS_STATION) & stop))


def with_placeholder_names(named: DataFrame) -> DataFrame:
    """Give nameless facilities a name from category and id, and its key."""
    placeholder = F.concat(F.lit(fixed.UNNAMED_PREFIX + " "), F.col("kategori"),
                           F.lit(" - OSM "), F.col("id").cast("string"))
    nameless = F.col("facility_name") == ""
    # placeholders need no second look at all the other names: their key is native already
    return named.withColumns({
        "facility_name_key": F.when(nameless, text.normalize(placeholder, nfkc=False))
        .otherwise(F.col("facility_name_key")),
        "facility_name": F.when(nameless, placeholder).otherwise(F.col("facility_name")),
    })


def with_types(named: DataFrame) -> DataFrame:
    return named.withColumns({
        "facility_type_score": scores.facility_type_score(F.col("kategori")),
        "facility_access_type": text.access_type(F.col("facility_name_key"),
                                                 F.col("kategori")),
        "is_named": ~F.col("facility_name").startswith(fixed.UNNAMED_PREFIX),
    })


def one_per_place(facilities: DataFrame) -> DataFrame:
    """One facility per category and 0.01 degree cell: a named one if there is, then lowest id.

    As in all "first of" steps here, the rank is cut to 1 inside each map task before the
    shuffle, so a cell that holds a third of all points still sends one row per task.
    """
    place = W.partitionBy("kategori", scores.round_even_2(F.col("latitude")),
                          scores.round_even_2(F.col("longitude")))
    first = place.orderBy(F.desc("is_named"), F.asc("id"))
    return (facilities.withColumn("_n", F.row_number().over(first))
            .where("_n = 1").drop("_n"))


def one_per_name(facilities: DataFrame) -> DataFrame:
    """One facility per category, district and name key; nameless ones all stay."""
    same_name = W.partitionBy("kategori", "province_key", "district_key", "facility_name_key")
    named = (
        facilities.where("is_named")
        .withColumn("_n", F.row_number().over(same_name.orderBy("id")))
        .where("_n = 1").drop("_n")
    )
    return named.unionByName(facilities.where("NOT is_named"))


def candidate_order() -> list:
    """The order facilities are listed in; it settles all later ties."""
    return [F.desc("is_named"), F.desc("facility_type_score"), F.asc("id"), F.asc("copy")]


def with_district_risk(facilities: DataFrame, risk: DataFrame) -> DataFrame:
    """Add hazard and risk of the district; unknown ones get the mean of the risk table.

    Missing keys match missing keys. The join carries no hint: Spark broadcasts the risk side if
    its size allows and splits skewed keys if not. A district listed twice lists its facilities
    twice; ``copy`` numbers them.
    """
    risk = risk.select(F.col("province_key").alias("_province"),
                       F.col("district_key").alias("_district"),
                       "hazard_score", "final_risk_score")
    means = {c: risk.agg(F.avg(c)).scalar() for c in ("hazard_score", "final_risk_score")}
    same = (F.col("province_key").eqNullSafe(F.col("_province"))
            & F.col("district_key").eqNullSafe(F.col("_district")))
    copies = W.partitionBy("id").orderBy("hazard_score", "final_risk_score")
    return (facilities.join(risk, same, "left").drop("_province", "_district")
            .withColumn("copy", F.row_number().over(copies))
            .withColumns({c: F.coalesce(F.col(c), mean) for c, mean in means.items()}))


def cleaned(pois: DataFrame, nfkc: bool = True) -> DataFrame:
    """All naming steps, before duplicates are removed."""
    return with_types(with_placeholder_names(without_stops(
        with_name_keys(candidates(pois), nfkc))))


def prepare(pois: DataFrame, risk: DataFrame, nfkc: bool = True) -> DataFrame:
    return with_district_risk(one_per_name(one_per_place(cleaned(pois, nfkc))), risk)
