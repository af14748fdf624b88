"""CSV scans with rejects, and a pool launched from paths."""

from pyspark.sql import functions as F

from tests import brute
from tests.test_operators import risk_rows, rows
from tremora import schemas
from tremora.plans.pool import build_pool, pool_from_csv
from tremora.sources import tables

TEXT = ('﻿kategori,id,isim,latitude,extra\n'
        'liman,1,"Liman, ""Ana""",40.5,x\n'
        'otogar,2,plain,,y\n'
        '\n'
        'polis,3,too few\n'
        'polis,4,too,41,many,fields\n'
        'polis,five,name,41,z\n'
        'polis,6,name,north,z\n'
        'polis,7,"open,41,z\n'
        ',,,,\n')


def test_every_line_is_taken_or_rejected(spark, tmp_path):
    (tmp_path / "a.csv").write_text(TEXT, encoding="utf-8")
    scanned = tables.scan_csv(spark, str(tmp_path), schemas.POI)
    assert scanned.columns == [*schemas.POI.names, "_line", "_reject"]
    good = tables.accepted(scanned)
    assert good.schema == schemas.POI
    assert sorted(((r.id, r.kategori, r.isim, r.latitude, r.province) for r in good.collect()),
                  key=str) == sorted([(1, "liman", 'Liman, "Ana"', 40.5, None),
                                      (2, "otogar", "plain", None, None),
                                      (None, None, None, None, None)], key=str)
    assert rows(tables.rejected(scanned)) == [
        ('polis,3,too few', 'number of fields'), ('polis,4,too,41,many,fields', 'number of fields'),
        ('polis,6,name,north,z', 'no number: latitude'), ('polis,7,"open,41,z', 'number of fields'),
        ('polis,five,name,41,z', 'no number: id')]
    # columns that nobody reads do not hide a damaged line
    assert good.select("id").count() == 3 and tables.rejected(scanned).select("_reject").count() == 5


def test_files_without_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,kategori\n", encoding="utf-8")
    scanned = tables.scan_csv(spark, str(tmp_path), schemas.POI)
    assert tables.accepted(scanned).count() == tables.rejected(scanned).count() == 0
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.csv").write_text("", encoding="utf-8")
    empty = tables.scan_csv(spark, str(tmp_path / "b"), schemas.POI)
    assert tables.accepted(empty).schema == schemas.POI and empty.count() == 0


def test_pool_from_two_files(spark, tmp_path):
    pois = spark.createDataFrame(brute.pois(300), schemas.POI)
    risk = spark.createDataFrame(risk_rows(), schemas.RISK)
    pois.write.option("header", True).option("escape", '"').csv(str(tmp_path / "pois"))
    risk.write.option("header", True).csv(str(tmp_path / "risk"))
    (tmp_path / "pois" / "bad.csv").write_text(
        ",".join(schemas.POI.names) + "\nnot,enough\n", encoding="utf-8")
    pool = pool_from_csv(spark, str(tmp_path / "pois"), str(tmp_path / "risk"),
                         str(tmp_path / "pool"), str(tmp_path / "rejects"))
    want = build_pool(pois.withColumn("isim", F.nullif(F.trim("isim"), F.lit(""))), risk)
    columns = ["id", "facility_name", "local_support_score", "fault_distance_safety_score"]
    assert rows(pool, *columns) == rows(want, *columns)
    assert [r._line for r in spark.read.parquet(str(tmp_path / "rejects" / "pois")).collect()] == [
        "not,enough"]
