"""Every registered query against its SQL, and numbers measured beforehand."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import oracle, queries
from checks.compare import compare, connect
from checks.queries import q_mask_columns, q_mask_parameter_rows, q_replace_with_mask, q_select_removed

QUERIES, SQL = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_anchors(spark, sf_dir):
    masked = q_mask_columns(spark, sf_dir).cache()
    assert masked.where(F.col("bottom_depth_m") == "999").count() == 1409
    assert masked.where(F.col("sample_min_depth_m") == "999").count() == 1107
    assert q_mask_parameter_rows(spark, sf_dir).where(F.col("value") == "999").count() == 866
    names = q_replace_with_mask(spark, sf_dir)
    assert names.where(F.col("scientific_name") == "NA").count() == 83
    assert names.where(F.col("reported_scientific_name") == "NA").count() == 58
    assert q_select_removed(spark, sf_dir).count() == 81
