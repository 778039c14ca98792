"""Lookup tables and name lists."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.functions.text import strip

CODES_SCHEMA = "field string, code string, name_sv string"
AREAS_SCHEMA = "area string, polygon_id int, seq int, lat double, lon double"
RULES_SCHEMA = "data_type string, column_name string, match_value string, new_value string"


def _read(spark: SparkSession, path: str, schema: str, sep: str) -> DataFrame:
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.csv(path, schema=schema, sep=sep, header=True, enforceSchema=False)


def read_codes(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Codes and their names: ``(field, code, name_sv)``, from Parquet or separated text."""
    return _read(spark, path, CODES_SCHEMA, sep).select("field", "code", "name_sv")


def read_areas(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Polygon vertices in order: ``(area, polygon_id, seq, lat, lon)``."""
    return _read(spark, path, AREAS_SCHEMA, sep).select("area", "polygon_id", "seq", "lat", "lon")


def read_rules(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Value rules: ``(data_type, column_name, match_value, new_value)``."""
    return _read(spark, path, RULES_SCHEMA, sep).fillna("").select("data_type", "column_name", "match_value", "new_value")


def read_name_list(spark: SparkSession, path: str) -> DataFrame | None:
    """Names, one per line, stripped, blank lines left out; None if there is no such file."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return lines.select(strip(F.col("value")).alias("name")).where(F.col("name") != "")
