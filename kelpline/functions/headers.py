"""Header names as column names.

A header may name anything: names that differ in case only, repeated or blank names, names with dots or back-ticks, or
names the steps use for themselves. ``column_names`` gives each a column name that is safe in Spark, and ``shown`` the name as it stood.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from kelpline import model

# Private characters that stand for those Spark reads in names, and one that tells names apart.
_SAFE = {".": chr(0xE001), "`": chr(0xE002)}
_BLANK, _MARK = chr(0xE003), chr(0xE004)
_BACK = str.maketrans({v: k for k, v in _SAFE.items()} | {_BLANK: None, _MARK: None})
_FORTH = str.maketrans(_SAFE)

#: Names the library uses beside the columns of a table.
OWN_NAMES = {"package", "layout", "target", "cy", "cx"}


class HeaderColumn(NamedTuple):
    """A column: its name in Spark, its name in headers, and which of equal names it is (from 1)."""

    column: str
    name: str
    number: int


def shown(column: str) -> str:
    """The header name of a column."""
    return column.translate(_BACK)


def known_names() -> set[str]:
    """Names with a meaning to some step."""
    found = {
        model.DATA_TYPE, model.LATITUDE, model.LONGITUDE, model.PARAMETER, model.VALUE, "delivery_datatype", "quality_flag",
        "scientific_name", "reported_scientific_name", "visit_date", "sample_date", "reported_visit_date", "reported_sample_date",
        "sample_time", "sample_sweref99tm_x", "sample_sweref99tm_y", *model.CLEANUP_COLUMNS,
    }
    found |= {f"{f}_{end}" for f in model.NAME_SV_FIELDS for end in ("code", "name_sv")}
    found |= {f"location_{a.lower()}" for a in model.RESTRICTING_AREAS}
    literal = [*model.VALUE_COLUMNS, *model.COMMENT_COLUMNS, *model.SAMPLE_DEPTH_COLUMNS]
    return found | {n for n in literal if n.replace("_", "").isalnum()}


def column_names(header: Iterable[tuple[str, int]]) -> list[HeaderColumn]:
    """Columns for the distinct ``(name, number)`` of one or more headers."""
    header, known = list(header), known_names()
    lower = {n.lower(): n for n in known}
    taken = {n.lower() for n, number in header if n in known and number == 1}
    out = []
    for name, number in header:
        if name in known and number == 1:
            out.append(HeaderColumn(name, name, number))
            continue
        column = name.translate(_FORTH) or _BLANK
        if column.startswith("_") or column.lower() in OWN_NAMES or column.lower() in lower:
            column += _MARK
        while column.lower() in taken:
            column += _MARK
        taken.add(column.lower())
        out.append(HeaderColumn(column, name, number))
    return out


def repeated_known(header: list[str]) -> list[str]:
    """Names with a meaning that a header uses twice: which of the two is meant cannot be known."""
    return sorted({n for n in header if header.count(n) > 1} & known_names())
