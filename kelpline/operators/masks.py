"""Masks (which rows) and masked replacement (which cells)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline import model
from kelpline.functions.headers import shown
from kelpline.functions.text import cell


def select_columns_like(columns: Iterable[str], patterns: Iterable[str]) -> list[str]:
    """Existing columns named by a list of names and patterns: whole names, case-sensitive."""
    compiled = [re.compile(p) for p in patterns]
    return [c for c in columns if any(p.fullmatch(shown(c)) for p in compiled)]


def _flag(df: DataFrame, column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(False)) if column in df.columns else F.lit(False)


def mask_reduced_area(df: DataFrame) -> Column:
    """TRUE for rows in area RC or RG."""
    return _flag(df, "location_rc") | _flag(df, "location_rg")


def mask_restricted_area(df: DataFrame) -> Column:
    """TRUE for rows in the reduced area or in area RO."""
    return mask_reduced_area(df) | _flag(df, "location_ro")


def mask_match_in_column(df: DataFrame, column: str, pattern: str) -> Column:
    """TRUE where the pattern occurs in the cell; blank cells and absent columns never match."""
    if column not in df.columns:
        return F.lit(False)
    return (cell(F.col(column)) != "") & cell(F.col(column)).rlike(pattern)


def mask_columns(df: DataFrame, patterns: Iterable[str], value: str, mask: Column) -> DataFrame:
    """Overwrite the cells of the named columns where the mask holds, blank cells included."""
    names = select_columns_like(df.columns, patterns)
    return df.withColumns({c: F.when(mask, F.lit(value)).otherwise(F.col(c)) for c in names})


def mask_parameter_rows(
    df: DataFrame,
    parameters: Iterable[str],
    value: str,
    mask: Column,
    parameter: str = model.PARAMETER,
    target: str = model.VALUE,
) -> DataFrame:
    """Overwrite the value of rows that measure one of the parameters, by exact name."""
    if parameter not in df.columns or target not in df.columns:
        return df
    hit = mask & F.coalesce(F.col(parameter).isin(*dict.fromkeys(parameters)), F.lit(False))
    return df.withColumn(target, F.when(hit, F.lit(value)).otherwise(F.col(target)))


def replace_with_mask(
    df: DataFrame,
    column: str,
    value: str,
    mask: Column,
    data_types: tuple[str, ...],
    data_type: str = model.DATA_TYPE,
) -> DataFrame:
    """Overwrite one column where the mask holds, in rows of the given data types."""
    if column not in df.columns:
        return df
    hit = F.coalesce(F.col(data_type).isin(*data_types), F.lit(False)) & mask
    return df.withColumn(column, F.when(hit, F.lit(value)).otherwise(F.col(column)))


def is_removed_profile(mask: Column, data_type: str = model.DATA_TYPE) -> Column:
    """TRUE for masked rows of profile packages."""
    return (cell(F.col(data_type)) == model.PROFILE) & mask


def remove_profiles(df: DataFrame, mask: Column, data_type: str = model.DATA_TYPE) -> DataFrame:
    """Drop masked rows of profile packages."""
    return df.where(~is_removed_profile(mask, data_type))


def drop_columns(df: DataFrame, columns: Iterable[str] = tuple(model.CLEANUP_COLUMNS)) -> DataFrame:
    """Drop columns; absent ones are ignored."""
    return df.drop(*columns)
