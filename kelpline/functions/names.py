"""Package names: ``<base>_version_<version>.zip``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kelpline import model


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"[.]zip$", "")


def base_name(name: Column) -> Column:
    """The text before the first version marker, the whole stem without one."""
    return F.substring_index(stem(name), model.VERSION_MARKER, 1)


def version(name: Column) -> Column:
    """The text after the first version marker, blank without one."""
    marker = F.instr(stem(name), model.VERSION_MARKER)
    start = marker + F.lit(len(model.VERSION_MARKER))
    rest = F.substring(stem(name), start, F.length(name))
    return F.when(marker > 0, rest).otherwise(F.lit(""))
