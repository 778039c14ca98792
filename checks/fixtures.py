"""Test tables shaped like monitoring data, derived from the given tables.

``SQL`` holds each derivation as text for the SQL engine that checks results; the functions
give the same tables as DataFrames.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline import model

OBSERVATIONS = """
SELECT
  'DS_' || dt || '_' || cast(year(o_orderdate) AS string) AS dataset_name,
  dt AS data_type_internal,
  cast(l_orderkey AS string) || '-' || cast(l_linenumber AS string) || '-' || cast(l_partkey AS string) || '-'
    || cast(l_suppkey AS string) || '-' || cast(cast(round(l_extendedprice * 100) AS bigint) AS string) AS row_number,
  CASE p_size % 10 WHEN 0 THEN 'Secchi depth' WHEN 1 THEN 'QFLAG Secchi depth' WHEN 2 THEN 'Rock cover'
    WHEN 3 THEN 'Rock cove' WHEN 4 THEN 'Silt cover' WHEN 5 THEN 'Depth distribution (max depth)'
    WHEN 6 THEN 'secchi depth' WHEN 7 THEN 'Secchi depth' ELSE 'Temperature' END AS parameter,
  cast(cast(l_quantity AS int) AS string) AS value,
  CASE l_returnflag WHEN 'A' THEN '' WHEN 'N' THEN 'B' ELSE NULL END AS quality_flag,
  CASE p_type WHEN 'PROMO' THEN 'COVER ' || p_name WHEN 'SMALL' THEN 'cover ' || p_name
    WHEN 'LARGE' THEN NULL ELSE p_name END AS scientific_name,
  CASE p_type WHEN 'ECONOMY' THEN 'COVERED' WHEN 'SMALL' THEN 'x COVER' ELSE p_name END AS reported_scientific_name,
  CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE cast(p_size AS string) END AS bottom_depth_m,
  CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE cast(p_size + 1 AS string) END AS sample_min_depth_m,
  cast(p_size + 2 AS string) AS sample_max_depth_m,
  cast(p_size AS string) AS secchi_depth_m,
  'S' || cast(p_size AS string) AS visit_Secchi_note,
  p_brand AS secchi_comment,
  l_linestatus AS sample_substrate_comnt_rock,
  p_brand AS substrate,
  p_brand AS substrate_extra,
  md5(cast(l_orderkey AS string)) AS shark_sample_id_md5,
  cast((l_suppkey + 5 * l_linenumber) % 30 AS string) AS sample_project_code,
  cast(l_partkey % 30 AS string) AS sample_orderer_code,
  CASE WHEN l_linenumber = 3 THEN NULL ELSE cast(l_orderkey % 30 AS string) END AS sampling_laboratory_code,
  CASE WHEN l_linenumber = 4 THEN '' ELSE cast(l_orderkey % 27 AS string) END AS analytical_laboratory_code,
  ' ' || cast((l_suppkey + l_linenumber) % 26 AS string) || ' ' AS reporting_institute_code,
  CASE l_linenumber % 3 WHEN 0 THEN substring(cast(cast(o_orderdate AS date) AS string), 1, 4)
    WHEN 1 THEN substring(cast(cast(o_orderdate AS date) AS string), 1, 7)
    ELSE cast(cast(o_orderdate AS date) AS string) END AS visit_date,
  CASE WHEN l_linenumber = 4 THEN cast(cast(l_shipdate AS date) AS string) ELSE '' END AS sample_date,
  CASE l_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN '9:5' WHEN 2 THEN '0905' WHEN 3 THEN '09.05'
    WHEN 4 THEN '09:05:30' ELSE '25:61' END AS sample_time,
  CASE WHEN l_partkey % 50 = 49 THEN NULL ELSE 54e0 + cast(l_partkey % 130 AS double) / 10e0 END AS sample_latitude_dd,
  10e0 + cast(l_orderkey % 140 AS double) / 10e0 AS sample_longitude_dd
FROM (
  SELECT *, CASE WHEN l_linenumber <= 2 THEN 'epibenthos' WHEN l_linenumber <= 4 THEN 'physicalchemical'
    WHEN l_linenumber = 5 THEN 'profile' WHEN l_linenumber = 6 THEN 'planktonbarcoding'
    WHEN l_partkey % 2 = 0 THEN 'sealpathology' ELSE 'harbourporpoise' END AS dt
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey) j
"""

AREAS = """
SELECT * FROM (VALUES
  ('RC', 1, 56e0, 12e0), ('RC', 2, 56e0, 16e0), ('RC', 3, 58e0, 16e0),
  ('RC', 4, 58e0, 14e0), ('RC', 5, 62e0, 14e0), ('RC', 6, 62e0, 12e0),
  ('RG', 1, 57e0, 15e0), ('RG', 2, 57e0, 19e0), ('RG', 3, 63e0, 17e0),
  ('RO', 1, 54.05e0, 17.05e0), ('RO', 2, 54.05e0, 19.95e0), ('RO', 3, 56.45e0, 19.95e0), ('RO', 4, 56.45e0, 17.05e0)
) AS t(area, seq, lat, lon)
"""

#: Three areas like the others, with coasts of 20,000 vertices.
DENSE_AREAS = """
SELECT a.area, i + 1 AS seq,
  a.lat + (2.5e0 + 0.4e0 * sin(37e0 * i * 6.283185307179586e0 / 20000e0)) * sin(i * 6.283185307179586e0 / 20000e0) AS lat,
  a.lon + (3.5e0 + 0.6e0 * sin(53e0 * i * 6.283185307179586e0 / 20000e0)) * cos(i * 6.283185307179586e0 / 20000e0) AS lon
FROM (VALUES ('RC', 58e0, 14e0), ('RG', 60e0, 17e0), ('RO', 56e0, 19e0)) AS a(area, lat, lon)
CROSS JOIN (SELECT cast({i} AS int) AS i FROM {series}) AS s
"""

#: A coast of 20,000 vertices within a hundredth of a degree, one of as many within a ten-thousandth, and a coarse area.
CLUSTERED_AREAS = """
SELECT a.area, i + 1 AS seq,
  a.lat + a.size * (1e0 + 0.3e0 * sin(37e0 * i * 6.283185307179586e0 / 20000e0)) * sin(i * 6.283185307179586e0 / 20000e0) AS lat,
  a.lon + a.size * (1e0 + 0.3e0 * sin(53e0 * i * 6.283185307179586e0 / 20000e0)) * cos(i * 6.283185307179586e0 / 20000e0) AS lon
FROM (VALUES ('RC', 58.0011e0, 14.0012e0, 0.004e0), ('RG', 60.00001e0, 16.99998e0, 0.00004e0)) AS a(area, lat, lon, size)
CROSS JOIN (SELECT cast({i} AS int) AS i FROM {series}) AS s
UNION ALL SELECT * FROM (VALUES ('RO', 1, 55.05e0, 11.05e0), ('RO', 2, 55.05e0, 19.95e0), ('RO', 3, 60.45e0, 19.95e0), ('RO', 4, 60.45e0, 11.05e0)) AS t(area, seq, lat, lon)
"""

CODES = """
SELECT f.field, cast(n_nationkey AS string) AS code, n_name || ' SV' AS name_sv
FROM nation CROSS JOIN (VALUES ('sample_project'), ('sample_orderer'), ('sampling_laboratory'),
  ('analytical_laboratory'), ('reporting_institute')) AS f(field)
"""

PACKAGES = """
SELECT DISTINCT 'PKG_' || o_orderstatus || '_' || cast(o_custkey % 40 AS string)
    || CASE WHEN o_custkey % 13 = 0 THEN '' ELSE '_version_' || cast(cast(o_orderdate AS date) AS string) END || '.zip' AS name,
  CASE WHEN year(o_orderdate) >= 1999 AND o_custkey % 40 < 25 THEN 'incoming' ELSE 'stored' END AS slot
FROM {orders}
"""

REMOVALS = """
SELECT DISTINCT 'PKG_' || o_orderstatus || '_' || cast(o_custkey % 40 AS string) || '_version_2099-01-01.zip' AS name
FROM {orders} WHERE o_custkey % 40 IN (3, 7, 39)
UNION ALL SELECT 'ghost_version_1.zip'
UNION ALL SELECT 'PKG_F_13.zip'
"""

MEMBERS = """
SELECT p.name AS package, m.member
FROM (SELECT DISTINCT name FROM packages) p CROSS JOIN (VALUES ('shark_data.txt', 0), ('shark_metadata.txt', 0), ('changelog.txt', 0),
  ('processed_data/data.txt', 0), ('received_data/raw.csv', 0), ('README.txt', 0), ('extra/notes.txt', 1)) AS m(member, opt)
WHERE m.opt = 0 OR length(p.name) % 2 = 0
"""

LOG = """
SELECT 'PKG_' || cast(user_id % 40 AS string) AS package,
  CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warning' WHEN 'purchase' THEN 'info' ELSE 'debug' END AS level,
  CASE user_id % 3 WHEN 0 THEN 'transformation' WHEN 1 THEN 'validation' ELSE 'workflow' END AS log_type,
  event_type || ' ' || cast(event_id AS string) AS msg
FROM {events}
"""

RULES = """
SELECT * FROM (VALUES
  ('sealpathology', 'parameter', 'Temperature', 'Body temperature'),
  ('harbourporpoise', 'parameter', 'Temperature', 'Water temperature'),
  ('epibenthos', 'substrate', 'Brand#2', 'Brand 2'),
  ('epibenthos', 'substrate', 'Brand#4', '')
) AS t(data_type, column_name, match_value, new_value)
"""

_TABLES = {t: t for t in ("lineitem", "orders", "part", "events")}
SQL = {
    "observations": OBSERVATIONS.format(**_TABLES),
    "areas": AREAS,
    "dense_areas": DENSE_AREAS.format(i="r", series="(SELECT unnest(range(20000)) AS r) AS q"),
    "clustered_areas": CLUSTERED_AREAS.format(i="r", series="(SELECT unnest(range(20000)) AS r) AS q"),
    "codes": CODES,
    "packages": PACKAGES.format(**_TABLES),
    "removals": REMOVALS.format(**_TABLES),
    "members": MEMBERS,
    "log": LOG.format(**_TABLES),
    "rules": RULES,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = {t: table(spark, sf_dir, t) for t in ("lineitem", "orders", "part")}
    # the partitioning the join with orders needs anyway, and all cores even for a single file
    tables["lineitem"] = tables["lineitem"].repartition("l_orderkey")
    return tables


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(OBSERVATIONS, **_sources(spark, sf_dir))


def numbered_observations(spark: SparkSession, sf_dir: str, suffix: str, number: Callable[[DataFrame, dict[str, Column]], DataFrame]) -> DataFrame:
    """``observations`` with their ``package``, the data set with a ``suffix``, and the ``_line`` that ``number`` adds.

    What is dealt out and sorted are rows of the given tables; the cells, several times as wide, are made from them afterwards.
    """
    cells, joined = OBSERVATIONS.split("\nFROM (", 1)
    given = spark.sql(joined.rsplit(") j", 1)[0], **_sources(spark, sf_dir))
    texts = dict(reversed(c.rsplit(" AS ", 1)) for c in (cells.split(",\n  ")[0].split("SELECT\n  ")[1], cells.split("AS data_type_internal,\n  ")[1].split(",\n  CASE")[0]))
    made = {"package": F.concat(F.expr(texts["dataset_name"]), F.lit(suffix)), "row_number": F.expr(texts["row_number"])}
    numbered = number(given, made)
    rows = spark.sql(f"{cells}, row_number AS _row_number, package, _line FROM {{numbered}}", numbered=numbered)
    own = [c for c in rows.columns if c not in ("_row_number", "package", "_line")]
    return rows.drop("row_number").withColumnRenamed("_row_number", "row_number").select(*own, "package", "_line")


def areas(spark: SparkSession) -> DataFrame:
    return spark.sql(AREAS)


def dense_areas(spark: SparkSession) -> DataFrame:
    return spark.sql(DENSE_AREAS.format(i="id", series="range(20000)"))


def clustered_areas(spark: SparkSession) -> DataFrame:
    return spark.sql(CLUSTERED_AREAS.format(i="id", series="range(20000)"))


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.explode(F.array(*map(F.lit, model.NAME_SV_FIELDS)))
    return table(spark, sf_dir, "nation").select(
        fields.alias("field"),
        F.col("n_nationkey").cast("string").alias("code"),
        F.concat("n_name", F.lit(" SV")).alias("name_sv"),
    )


def rules(spark: SparkSession) -> DataFrame:
    return spark.sql(RULES)


def packages(spark: SparkSession, sf_dir: str, slot: str | None = None) -> DataFrame:
    found = spark.sql(PACKAGES, orders=table(spark, sf_dir, "orders"))
    return found if slot is None else found.where(F.col("slot") == slot).select("name")


def removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(REMOVALS, orders=table(spark, sf_dir, "orders"))


MEMBER_NAMES = [
    "shark_data.txt",
    "shark_metadata.txt",
    "changelog.txt",
    "processed_data/data.txt",
    "received_data/raw.csv",
    "README.txt",
]


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, MEMBER_NAMES))
    optional = F.when(F.length("package") % 2 == 0, F.array(F.lit("extra/notes.txt"))).otherwise(
        F.array().cast("array<string>")
    )
    found = packages(spark, sf_dir).select(F.col("name").alias("package")).distinct()
    return found.withColumn("member", F.explode(F.concat(names, optional)))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LOG, events=table(spark, sf_dir, "events"))
