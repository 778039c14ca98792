"""Text cells, addresses and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kelpline import model

# White space, and the characters of the output encoding beyond ASCII and Latin-1.
WHITE_SPACE = " \t\n\r\u000b\u000c\u001c\u001d\u001e\u001f\u0085\u00a0"
CP1252_EXTRA = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
NO_CHARACTER = "\uffff"
UNMAPPABLE = "[^\\u0000-\\u007f\\u00a0-\\u00ff" + CP1252_EXTRA + "]"


def cell(col: Column) -> Column:
    """The cell as text, NULL read as blank."""
    return F.coalesce(col.cast("string"), F.lit(""))


def strip(col: Column) -> Column:
    """Remove white space at both ends."""
    return F.trim(col, F.lit(WHITE_SPACE))


def is_blank(col: Column) -> Column:
    return strip(cell(col)) == ""


def printable_cell(col: Column) -> Column:
    """A cell fit for one line of separated text: control characters that would end it become blanks."""
    return F.translate(cell(col), "\t\r\n", "   ")


def joined_cells(cells: Column) -> Column:
    """Cells joined by a code point that is no character, for ``separated_line``."""
    return F.array_join(cells, NO_CHARACTER)


def separated_line(joined: Column) -> Column:
    """Joined cells as one line; control characters in cells that would end them become blanks.

    Lines that hold any are rare, so the slow replacement only meets those.
    """
    control = F.contains(joined, F.lit("\t")) | F.contains(joined, F.lit("\r")) | F.contains(joined, F.lit("\n"))
    clean = F.when(control, F.translate(joined, "\t\r\n", "   ")).otherwise(joined)
    return F.replace(clean, F.lit(NO_CHARACTER), F.lit(model.SEPARATOR))


def is_encodable(col: Column) -> Column:
    return ~cell(col).rlike(UNMAPPABLE)


def normalize_url(url: Column) -> Column:
    """Forward slashes, none at the ends, and the secure scheme in front unless it is there."""
    bare = F.regexp_replace(F.translate(strip(cell(url)), "\\", "/"), "^/+|/+$", "")
    return F.when((bare == "") | F.startswith(bare, F.lit("https://")), bare).otherwise(
        F.concat(F.lit("https://"), bare)
    )


def format_refusal(name: Column, data_type: Column) -> Column:
    return F.concat(name, F.lit(" (data type "), cell(data_type), F.lit(" not allowed)"))


def format_log_line(level: Column, msg: Column) -> Column:
    """``<level>: <msg>``; warnings and errors stand out in upper case."""
    lower = F.lower(cell(level))
    shown = F.when(lower.isin("warning", "error"), F.upper(lower)).otherwise(lower)
    return F.concat(shown, F.lit(": "), cell(msg))


def level_rank(level: Column) -> Column:
    """The position of a log level, so that levels compare."""
    lower = F.lower(level)
    rank = F.lit(None).cast("int")
    for i, name in enumerate(model.LOG_LEVELS):
        rank = F.when(lower == name, F.lit(i)).otherwise(rank)
    return rank
