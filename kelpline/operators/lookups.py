"""Joins against lookup tables that are normally small, without assuming it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32


def fits_broadcast(
    table: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measure a lookup table: TRUE if it is within both bounds.

    Reads one row beyond the row bound at most, so a table that turns out to be large
    costs no more than one at the bound.
    """
    size = F.octet_length(F.to_json(F.struct("*")))
    row = table.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return row[0] <= max_rows and row[1] <= max_bytes


def measured(table: DataFrame) -> tuple[DataFrame, bool]:
    """A lookup table and whether it is small; a small one is put in one partition, so that
    grouping or sorting it needs no shuffle."""
    small = fits_broadcast(table)
    return (table.coalesce(1) if small else table), small


def lookup_join(
    df: DataFrame,
    table: DataFrame,
    on: list[str],
    how: str = "left",
    small: bool | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``df`` to a ``table`` that is unique per ``on``.

    A table of checked size is broadcast, so ``df`` keeps its partitioning. A larger one is
    shuffled with every key spread over ``salts`` partitions, so a key that holds a large
    share of ``df`` is not one task; the salt follows from the row, so a recomputed
    task sends the same rows to the same places.
    """
    if small is None:
        small = fits_broadcast(table)
    if small:
        return df.join(F.broadcast(table), on, how)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
    spread = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(spread.hint("merge"), [*on, "_salt"], how).drop("_salt")


def unique_per_key(table: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the least of the others, so that a join never multiplies rows."""
    others = [c for c in table.columns if c not in keys]
    least = F.min(F.struct(*others)).alias("_least")
    return table.groupBy(*keys).agg(least).select(*keys, "_least.*")
