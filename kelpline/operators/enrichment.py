"""Readable names, normalised times and dates, and value rules."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline import model
from kelpline.functions.text import cell, is_blank, strip
from kelpline.functions.times import fix_time, full_date, is_bad_time
from kelpline.operators.lookups import lookup_join, measured, unique_per_key

TIME_COLUMNS = ["sample_time"]
DATE_COLUMNS = ["visit_date", "sample_date"]
MAX_FOLDED_RULES = 200
# a map expression is searched from its start, so it pays for short lists only
MAX_FOLDED_CODES = 1000


def code_column(field: str) -> str:
    return f"{field}_code"


def name_sv_column(field: str) -> str:
    return f"{field}_name_sv"


def _names_of(codes: DataFrame, fields: Iterable[str]) -> dict[str, dict[str, str]] | None:
    """Code to name per field, if the lists are short enough for an expression."""
    wanted = codes.where(F.col("field").isin(*fields)).select("field", "code", "name_sv")
    rows = wanted.limit(MAX_FOLDED_CODES + 1).collect()
    if len(rows) > MAX_FOLDED_CODES:
        return None
    names: dict[str, dict[str, str]] = {f: {} for f in fields}
    # as in the joined form, the least name stays where a code comes twice, and NULL before any
    for r in sorted(rows, key=lambda r: (r.name_sv is not None, r.name_sv), reverse=True):
        if r.code is not None:
            names[r.field][r.code] = r.name_sv
    return names


def add_names_sv(
    df: DataFrame,
    codes: DataFrame,
    fields: Iterable[str] = tuple(model.NAME_SV_FIELDS),
    max_folded: int = MAX_FOLDED_CODES,
) -> DataFrame:
    """Add the Swedish names of code fields; a code without one, or none at all, gives a blank.

    Short code lists become one map expression per field, so the rows are not touched by
    any join. Longer ones are joined, broadcast or salted by their measured size.
    """
    fields = list(fields)
    names = _names_of(codes, fields) if max_folded else None
    if names is not None:
        return df.withColumns({name_sv_column(f): _mapped(df, f, names[f]) for f in fields})
    codes, small = measured(codes)
    for field in fields:
        df = _join_name_sv(df, codes, field, small)
    return df


def _mapped(df: DataFrame, field: str, names: dict[str, str]) -> Column:
    if code_column(field) not in df.columns:
        return F.lit("")
    # folded into a constant map when the plan is optimised
    table = F.from_json(F.lit(json.dumps(names)), "map<string,string>")
    return cell(F.try_element_at(table, strip(cell(F.col(code_column(field))))))


def _join_name_sv(df: DataFrame, codes: DataFrame, field: str, small: bool) -> DataFrame:
    if code_column(field) not in df.columns:
        return df.withColumn(name_sv_column(field), F.lit(""))
    names = unique_per_key(
        codes.where(F.col("field") == field).select(F.col("code").alias("_code"), F.col("name_sv").alias("_name")),
        ["_code"],
    )
    keyed = df.drop(name_sv_column(field)).withColumn("_code", strip(cell(F.col(code_column(field)))))
    joined = lookup_join(keyed, names, ["_code"], small=small)
    return joined.withColumn(name_sv_column(field), cell(F.col("_name"))).drop("_code", "_name")


def add_name_sv(df: DataFrame, codes: DataFrame, field: str, max_folded: int = MAX_FOLDED_CODES) -> DataFrame:
    """Add the Swedish name of one code field."""
    return add_names_sv(df, codes, [field], max_folded)


def unmatched_codes(
    df: DataFrame,
    codes: DataFrame,
    fields: Iterable[str] = tuple(model.NAME_SV_FIELDS),
    package: str = "package",
) -> DataFrame:
    """Log rows for codes without a name: one per package and code, with how many rows use it."""
    present = [f for f in fields if code_column(f) in df.columns]
    pairs = [
        F.struct(F.lit(f).alias("field"), strip(cell(F.col(code_column(f)))).alias("code")) for f in present
    ]
    used = F.explode(F.array(*pairs).cast("array<struct<field:string,code:string>>"))
    counted = (
        df.select(package, used.alias("u"))
        .where(F.col("u.code") != "")
        .groupBy(F.col(package).alias("package"), "u.field", "u.code")
        .agg(F.count("*").alias("n"))
    )
    known = codes.select("field", "code").distinct()
    missing = lookup_join(counted, known, ["field", "code"], how="left_anti")
    return missing.select(
        "package",
        F.lit("warning").alias("level"),
        F.lit("transformation").alias("log_type"),
        F.concat(F.lit("No name for "), F.col("field"), F.lit(" code "), F.col("code"), F.lit(" ("), F.col("n"), F.lit(" rows)")).alias("msg"),
    )


# -- what rows tell the log, carried with them ------------------------------------------------

#: Kind of a note, and what stands between its parts.
_CODE, _TIME, _PART, _NOTE_END = "code", "time", "\x1e", "\x1f"


def row_notes(df: DataFrame, codes: DataFrame, fields: Iterable[str] = tuple(model.NAME_SV_FIELDS), time: str = TIME_COLUMNS[0]) -> Column:
    """What a row gives the log, as one text that is NULL for most: codes without a name, and a time that cannot be read.

    With long code lists all codes of a row are noted; ``note_log`` drops those that have a name.
    """
    names = _names_of(codes, list(fields))
    notes = []
    for f in fields:
        if code_column(f) in df.columns:
            code = strip(cell(F.col(code_column(f))))
            unknown = code != ""
            if names is not None:
                unknown = unknown & ~F.coalesce(F.map_contains_key(F.from_json(F.lit(json.dumps(names[f])), "map<string,string>"), code), F.lit(False))
            notes.append(F.when(unknown, F.concat(F.lit(f"{_CODE}{_PART}{f}{_PART}"), code)))
    if time in df.columns:
        notes.append(F.when(is_bad_time(F.col(time)), F.concat(F.lit(f"{_TIME}{_PART}{time}{_PART}"), cell(F.col(time)))))
    return F.nullif(F.concat_ws(_NOTE_END, *notes), F.lit("")) if notes else F.lit(None).cast("string")


def note_log(notes: DataFrame, codes: DataFrame) -> DataFrame:
    """``package, note, n`` to log rows, one per package and code or spelling."""
    parts = F.split("note", _PART, 3)
    split = notes.select("package", F.get(parts, F.lit(0)).alias("kind"), F.get(parts, F.lit(1)).alias("field"), F.get(parts, F.lit(2)).alias("code"), "n")
    known = codes.select(F.lit(_CODE).alias("kind"), "field", "code").distinct()
    # small tables of counts: the planner measures them while it runs
    split = split.join(known, ["kind", "field", "code"], "left_anti")
    said = F.when(F.col("kind") == _CODE, F.concat(F.lit("No name for "), "field", F.lit(" code "))).otherwise(F.concat(F.lit("Unreadable "), "field", F.lit(" ")))
    return split.select(
        "package",
        F.lit("warning").alias("level"),
        F.lit("transformation").alias("log_type"),
        F.concat(said, "code", F.lit(" ("), "n", F.lit(" rows)")).alias("msg"),
    )


def fix_time_format(df: DataFrame, columns: Iterable[str] = tuple(TIME_COLUMNS)) -> DataFrame:
    """Write times of day as ``HH:MM``; blank and unreadable ones stay."""
    return df.withColumns({c: fix_time(F.col(c)) for c in columns if c in df.columns})


def unreadable_times(df: DataFrame, column: str = TIME_COLUMNS[0], package: str = "package") -> DataFrame:
    """Log rows for times that stayed as they were: one per package and spelling."""
    return (
        df.where(is_bad_time(F.col(column)))
        .groupBy(F.col(package).alias("package"), F.col(column).alias("time"))
        .agg(F.count("*").alias("n"))
        .select(
            "package",
            F.lit("warning").alias("level"),
            F.lit("transformation").alias("log_type"),
            F.concat(F.lit(f"Unreadable {column} "), F.col("time"), F.lit(" ("), F.col("n"), F.lit(" rows)")).alias("msg"),
        )
    )


def add_reported_dates(df: DataFrame, columns: Iterable[str] = tuple(DATE_COLUMNS)) -> DataFrame:
    """Keep dates as reported, before later steps fill them."""
    return df.withColumns({f"reported_{c}": cell(F.col(c)) for c in columns if c in df.columns})


def add_sample_date(df: DataFrame, sample: str = "sample_date", visit: str = "visit_date") -> DataFrame:
    """A blank or absent sample date becomes the visit date."""
    if visit not in df.columns:
        return df
    if sample not in df.columns:
        return df.withColumn(sample, cell(F.col(visit)))
    return df.withColumn(sample, F.when(is_blank(F.col(sample)), cell(F.col(visit))).otherwise(F.col(sample)))


def create_fake_full_dates(df: DataFrame, columns: Iterable[str] = tuple(DATE_COLUMNS)) -> DataFrame:
    """Fill years and months up to whole dates."""
    return df.withColumns({c: full_date(F.col(c)) for c in columns if c in df.columns})


def apply_value_rules(
    df: DataFrame,
    rules: DataFrame,
    data_types: Iterable[str] = tuple(model.RULE_TYPES),
    data_type: str = model.DATA_TYPE,
    max_folded: int = MAX_FOLDED_RULES,
) -> DataFrame:
    """Replace cells by rules ``(data_type, column_name, match_value, new_value)``.

    Each cell is compared as it was on entry. A short rule list becomes one expression per
    column; a longer one is joined column by column.
    """
    chosen = F.col("data_type").isin(*data_types) & F.col("column_name").isin(*df.columns)
    wanted = rules.where(chosen).select(
        "data_type",
        "column_name",
        cell(F.col("match_value")).alias("match_value"),
        cell(F.col("new_value")).alias("new_value"),
    )
    head = sorted(wanted.limit(max_folded + 1).collect(), reverse=True)
    if len(head) <= max_folded:
        # the least new value stays where a key comes twice
        found = {(r.column_name, r.data_type, r.match_value): r.new_value for r in head}
        columns = sorted({c for c, _, _ in found})
        return df.withColumns({c: _folded(c, found, data_type) for c in columns})
    wanted, small = measured(wanted)
    wanted = unique_per_key(wanted, ["data_type", "column_name", "match_value"])
    columns = sorted(r.column_name for r in wanted.select("column_name").distinct().collect())
    entered = df.withColumn("_type", F.col(data_type)).withColumns({f"_was_{c}": cell(F.col(c)) for c in columns})
    for c in columns:
        table = wanted.where(F.col("column_name") == c).select(
            F.col("data_type").alias("_type"), F.col("match_value").alias(f"_was_{c}"), F.col("new_value").alias("_new")
        )
        joined = lookup_join(entered, table, ["_type", f"_was_{c}"], small=small)
        entered = joined.withColumn(c, F.coalesce(F.col("_new"), F.col(c))).drop("_new")
    return entered.select(*df.columns)


def _folded(column: str, rules: dict[tuple[str, str, str], str], data_type: str) -> Column:
    value = F.col(column)
    for (name, kind, match), new in sorted(rules.items(), reverse=True):
        if name == column:
            hit = (F.col(data_type) == kind) & (cell(F.col(column)) == match)
            value = F.when(hit, F.lit(new)).otherwise(value)
    return value


def add_datatype_plankton_barcoding(
    df: DataFrame, data_type: str = model.DATA_TYPE, column: str = "delivery_datatype"
) -> DataFrame:
    """Name the delivery data type of plankton barcoding rows."""
    current = cell(F.col(column)) if column in df.columns else F.lit("")
    hit = F.col(data_type) == model.PLANKTON_BARCODING
    return df.withColumn(column, F.when(hit, F.lit(model.PLANKTON_BARCODING_LABEL)).otherwise(current))
