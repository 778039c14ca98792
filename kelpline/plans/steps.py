"""The fixed order of steps, as plain compositions of operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline import model
from kelpline.operators import enrichment as en
from kelpline.operators import geo
from kelpline.operators import masks as mk
from kelpline.operators.catalog import targets_column
from kelpline.policy import Policy
from kelpline.session import small_methods


def enrich(
    df: DataFrame, codes: DataFrame, rules: DataFrame | None = None, data_types: Iterable[str] | None = None
) -> DataFrame:
    """The steps every package goes through.

    ``data_types`` names the types that occur in ``df`` when the caller knows them: steps for
    other types are then not built at all.
    """
    small_methods(df.sparkSession)
    occurs = (lambda t: True) if data_types is None else set(data_types).__contains__
    df = en.add_names_sv(df, codes)
    df = en.fix_time_format(df)
    df = en.add_reported_dates(df)
    df = en.add_sample_date(df)
    df = en.create_fake_full_dates(df)
    ruled = [t for t in model.RULE_TYPES if occurs(t)]
    if rules is not None and ruled:
        df = en.apply_value_rules(df, rules, ruled)
    if occurs(model.PLANKTON_BARCODING):
        df = en.add_datatype_plankton_barcoding(df)
    return df


def added_columns(policy: Policy, any_type: bool = False) -> dict[str, Column]:
    """Columns the steps add to a package that lacks them, with the condition on its ``header`` and type for that.

    ``any_type`` if rows may be of other types than their package.
    """
    has = lambda c: F.array_contains("header", c)
    found = {en.name_sv_column(f): F.lit(True) for f in model.NAME_SV_FIELDS}
    found |= {f"reported_{c}": has(c) for c in en.DATE_COLUMNS} | {"sample_date": has("visit_date")}
    found["delivery_datatype"] = F.lit(True) if any_type else F.col(model.DATA_TYPE) == model.PLANKTON_BARCODING
    if policy.restricting:
        located = ["sample_sweref99tm_x", "sample_sweref99tm_y", *map(geo.location_column, model.RESTRICTING_AREAS)]
        found |= {c: F.lit(True) for c in located}
    return found


def _locate(df: DataFrame, areas: DataFrame) -> DataFrame:
    return geo.add_locations(geo.add_position_sweref99tm(df), areas)


def _flag(df: DataFrame, applies: Column) -> DataFrame:
    """Both masks, and the located columns only where restriction applies."""
    located = ["sample_sweref99tm_x", "sample_sweref99tm_y", *map(geo.location_column, model.RESTRICTING_AREAS)]
    return df.withColumns(
        {
            "_main": applies & mk.mask_restricted_area(df),
            "_rred": applies & mk.mask_reduced_area(df),
            **{c: F.when(applies, F.col(c)) for c in located},
        }
    )


def _apply_masks(df: DataFrame, mark_removed: bool = False) -> DataFrame:
    main, rred = F.col("_main"), F.col("_rred")
    covers = {
        c: main & mk.mask_match_in_column(df, c, model.COVER_PATTERN)
        for c in ("scientific_name", "reported_scientific_name")
    }
    secchi_flag = (
        main
        & mk.mask_match_in_column(df, "quality_flag", model.NON_BLANK_PATTERN)
        & mk.mask_match_in_column(df, model.PARAMETER, model.SECCHI_PARAMETER_PATTERN)
    )
    df = df.withColumn("_removed", mk.is_removed_profile(main)) if mark_removed else mk.remove_profiles(df, main)
    df = mk.mask_columns(df, model.VALUE_COLUMNS, model.REPLACE_COLUMN_VALUE, main)
    df = mk.mask_columns(df, model.COMMENT_COLUMNS, model.REPLACE_COMMENT_VALUE, main)
    df = mk.mask_parameter_rows(df, model.RESTRICTED_PARAMETERS, model.REPLACE_PARAMETER_VALUE, main)
    for column, mask in covers.items():
        df = mk.replace_with_mask(
            df, column, model.REPLACE_SCIENTIFIC_NAME_VALUE, mask, (model.EPIBENTHOS,)
        )
    df = mk.replace_with_mask(
        df, "quality_flag", model.REPLACE_SECCHI_VALUE, secchi_flag, (model.PHYSICAL_CHEMICAL,)
    )
    df = mk.mask_columns(df, model.SAMPLE_DEPTH_COLUMNS, model.REPLACE_COLUMN_VALUE, rred)
    return df.drop("_main", "_rred")


def restrict(df: DataFrame, areas: DataFrame, policy: Policy, mark_removed: bool = False) -> DataFrame:
    """Positions, areas and masks, where the policy restricts; otherwise ``df`` as it is.

    Both masks are computed once per row; the replacements then fold into one projection. ``mark_removed`` keeps
    the rows that are removed, with TRUE in ``_removed``.
    """
    if not policy.restricting:
        return df
    small_methods(df.sparkSession)
    applies = policy.masks(F.col(model.DATA_TYPE))
    return _apply_masks(_flag(_locate(df, areas), applies), mark_removed)


def publish(
    df: DataFrame,
    codes: DataFrame,
    areas: DataFrame,
    policy: Policy,
    rules: DataFrame | None = None,
    data_types: Iterable[str] | None = None,
) -> DataFrame:
    """Gate, enrich, restrict and clean up the rows of many packages in one plan."""
    allowed = df.where(policy.allows(F.col(model.DATA_TYPE))) if policy.restricting else df
    published = enrich(allowed, codes, rules, data_types)
    published = restrict(published, areas, policy)
    return mk.drop_columns(published)


def publish_to_targets(
    df: DataFrame,
    codes: DataFrame,
    areas: DataFrame,
    policy: Policy,
    environment: str,
    rules: DataFrame | None = None,
) -> DataFrame:
    """``publish`` for every target of an environment, with a ``target`` column.

    Rows are enriched and located once and then copied per target; in a target without
    restriction the gate is open and no cell is masked.
    """
    rows = enrich(df, codes, rules)
    if policy.restricting:
        rows = _locate(rows, areas)
    rows = rows.withColumn("_t", F.explode(targets_column(environment, policy.restricting)))
    if policy.restricting:
        data_type = F.col(model.DATA_TYPE)
        rows = rows.where(~F.col("_t.restrict") | policy.allows(data_type))
        rows = _apply_masks(_flag(rows, F.col("_t.restrict") & policy.masks(data_type)))
    return mk.drop_columns(rows.withColumn("target", F.col("_t.target")).drop("_t"))
