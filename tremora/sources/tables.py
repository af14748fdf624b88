"""Static tables: districts, points of interest, risk."""

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremora import schemas


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headed UTF-8 CSV under a declared schema: typed on load, and no pass to infer types.

    Columns bind by name. The scan itself only splits lines into text; numbers are cast after
    it, so that one malformed number becomes a null and not a failed job.
    """
    raw = (spark.read.option("header", True).option("encoding", "UTF-8")
           .option("enforceSchema", False).csv(path))
    present = set(raw.columns)
    return raw.select(*[
        (raw[f.name].try_cast(f.dataType) if f.name in present else _missing(f)).alias(f.name)
        for f in schema
    ])


def _missing(field: T.StructField):
    return F.lit(None).cast(field.dataType)


def load_districts(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema(schemas.DISTRICT).parquet(path)
            .select(*schemas.DISTRICT.fieldNames()))


def refresh_districts(spark: SparkSession, source_csv: str, output_path: str) -> DataFrame:
    """Replace the district table by a CSV; returns what was written."""
    read_csv(spark, source_csv, schemas.DISTRICT).write.mode("overwrite").parquet(output_path)
    return load_districts(spark, output_path)


_SPLIT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_damaged", "escape": '"'}


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every line of headed UTF-8 CSV files: the columns of ``schema``, ``_line``, and ``_reject``,
    the reason why the line cannot be used (null for good ones).

    A line is parsed from its own text and not by the file reader, which leaves out unread
    columns and then takes lines with too few or too many fields for good ones. Rejected are such
    lines, and those with a number that is none; a missing value is no fault. Columns bind by name; one that is
    not in the files is null. Blank lines are no lines.
    """
    lines = spark.read.text(path).where("trim(value) <> ''")
    head = lines.first()
    if head is None:
        return spark.createDataFrame([], schema).select(
            "*", F.lit("").alias("_line"), F.lit("").alias("_reject"))
    names = next(csv.reader([head.value.lstrip("\ufeff")]))
    columns = ", ".join(f"`{name.replace('`', '``')}` string" for name in [*names, "_damaged"])
    parsed = lines.where(F.col("value") != head.value).select(
        F.col("value").alias("_line"),
        F.from_csv("value", F.lit(columns), _SPLIT).alias("_r"))
    present = {f.name: F.col("_r").getField(f.name) for f in schema if f.name in names}
    typed = {name: text.try_cast(schema[name].dataType) for name, text in present.items()}
    reasons = [F.when(F.col("_r._damaged").isNotNull(), F.lit("number of fields"))]
    reasons += [F.when(text.isNotNull() & typed[name].isNull(), F.lit(f"no number: {name}"))
                for name, text in present.items()]
    return parsed.select(*[typed.get(f.name, _missing(f)).alias(f.name) for f in schema],
                         "_line", F.coalesce(*reasons).alias("_reject"))


def accepted(scanned: DataFrame) -> DataFrame:
    return scanned.where("_reject IS NULL").drop("_line", "_reject")


def rejected(scanned: DataFrame) -> DataFrame:
    return scanned.where("_reject IS NOT NULL").select("_line", "_reject")


def load_pois(spark: SparkSession, path: str, rejects: str | None = None) -> DataFrame:
    """Points of interest; the lines that are none go to the folder ``rejects``, if it is given."""
    return _load(spark, path, schemas.POI, rejects)


def load_risk(spark: SparkSession, path: str, rejects: str | None = None) -> DataFrame:
    return _load(spark, path, schemas.RISK, rejects)


def _load(spark: SparkSession, path: str, schema: T.StructType, rejects: str | None) -> DataFrame:
    scanned = scan_csv(spark, path, schema)
    if rejects:
        rejected(scanned).write.mode("overwrite").parquet(rejects)
    return accepted(scanned)
