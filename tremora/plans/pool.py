"""The facility pool: all that can be said about facilities before any event."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremora import fixed
from tremora.operators import enrich, facilities
from tremora.session import written
from tremora.sources import tables


def require_unique_ids(pool: DataFrame) -> None:
    """Raise if two facilities share an id: one would get the surroundings of the other."""
    places = F.count_distinct("latitude", "longitude")
    shared = pool.groupBy("id").agg(places.alias("n")).where("n > 1").select("id").take(5)
    if shared:
        raise ValueError(f"facility ids that are not unique: {[r.id for r in shared]}")


def build_pool(pois: DataFrame, risk: DataFrame, nfkc: bool = True,
               rows: int = fixed.BROADCAST_ROWS) -> DataFrame:
    """Prepared, enriched facilities. Build once, keep as a table, use for every event.

    The points of interest are scanned twice: for the candidates and for the support points.
    What comes after the de-duplication is small and is written in between, so that global
    figures (means, medians, extremes) are taken from files and not from a rerun.
    """
    prepared = written(facilities.prepare(pois, risk, nfkc), "facilities")
    require_unique_ids(prepared)
    around = enrich.with_multimodal(enrich.with_local_support(prepared, pois, rows), rows)
    around = written(around, "surroundings")
    scaled = enrich.min_max(around, "local_support_raw", "local_support_score")
    return written(enrich.with_static_safety(scaled), "pool")


def pool_from_csv(spark: SparkSession, poi_csv: str, risk_csv: str, output: str,
                  rejects: str) -> DataFrame:
    """The pool as a table at ``output``, from the two CSV files; lines that cannot be read are
    under ``rejects``. What job 3 is started with: ``jobs.recommend_job(..., pool=...)``."""
    pois = tables.load_pois(spark, poi_csv, f"{rejects}/pois")
    risk = tables.load_risk(spark, risk_csv, f"{rejects}/risk")
    build_pool(pois, risk).write.mode("overwrite").parquet(output)
    return spark.read.parquet(output)
