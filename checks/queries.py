"""The registered queries: each takes a session and a table folder and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import archives as ar
from checks import fixtures as fx
from kelpline import model
from kelpline.functions.headers import shown
from kelpline.functions.names import base_name
from kelpline.functions.text import format_log_line, is_blank, normalize_url
from kelpline.operators import catalog as cat
from kelpline.operators import enrichment as en
from kelpline.operators import geo, members, report
from kelpline.operators import masks as mk
from kelpline.plans import steps
from kelpline.plans.archives import publish_archives
from kelpline.policy import Policy
from kelpline.session import scratch_folder, ship_package
from kelpline.sinks import packages as pk
from kelpline.sinks.packages import write_data_table
from kelpline.sinks.stores import copy_to_store, remove_from_store, update_store, write_removal_list
from kelpline.sources import archives as src
from kelpline.sources import trees
from kelpline.sources.tables import read_areas, read_codes, read_name_list, read_rules

Query = Callable[[SparkSession, str], DataFrame]

RESTRICTED = Policy(restrict=True)
GATED = Policy(
    restrict=True,
    only=("epibenthos", "physicalchemical", "profile", "sealpathology"),
    dont=("profile",),
    unrestricted=("harbourporpoise",),
)
PUBLISHING = Policy(restrict=True, dont=("sealpathology",))


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.observations(spark, sf_dir).select(F.col("dataset_name").alias("name"), "data_type_internal").distinct()


def masked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations with both area masks as columns."""
    df = geo.add_locations(fx.observations(spark, sf_dir), fx.areas(spark))
    return df.withColumns({"main": mk.mask_restricted_area(df), "rred": mk.mask_reduced_area(df)})


def typed_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.length("package") % 3 == 0, F.lit("profile")).otherwise(F.lit("epibenthos"))
    return fx.members(spark, sf_dir).withColumn("data_type_internal", kind)


def _distinct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.packages(spark, sf_dir).select("name").distinct()


# -- catalogue -------------------------------------------------------------------------------


def q_base_name(spark, sf):
    return fx.packages(spark, sf).withColumn("base_name", base_name(F.col("name")))


def q_latest_per_base(spark, sf):
    return cat.latest_per_base(fx.packages(spark, sf).select("name"))


def q_replace_latest(spark, sf):
    return cat.replace_latest(fx.packages(spark, sf, "stored"), fx.packages(spark, sf, "incoming"))


def q_append_to_store(spark, sf):
    return cat.append_to_store(fx.packages(spark, sf, "stored"), fx.packages(spark, sf, "incoming"))


def q_store_actions(spark, sf):
    stored = fx.packages(spark, sf, "stored").withColumn("path", F.concat(F.lit("store/"), "name"))
    incoming = fx.packages(spark, sf, "incoming").withColumn("path", F.concat(F.lit("in/"), "name"))
    return cat.store_actions(stored, incoming)


def q_ordered_packages(spark, sf):
    return cat.ordered_packages(_distinct_names(spark, sf))


def q_remove_by_base_name(spark, sf):
    return cat.remove_by_base_name(fx.packages(spark, sf, "stored"), fx.removals(spark, sf))


def q_select_removed(spark, sf):
    return cat.select_removed(fx.packages(spark, sf, "stored"), fx.removals(spark, sf))


def q_merge_removal_names(spark, sf):
    return cat.merge_removal_names(fx.removals(spark, sf), fx.packages(spark, sf, "stored"))


def q_discard_names(spark, sf):
    return cat.discard_names(fx.packages(spark, sf, "stored"), fx.packages(spark, sf, "incoming"))


def q_count_waiting_removals(spark, sf):
    return spark.createDataFrame([(cat.count_waiting_removals(fx.removals(spark, sf)),)], "n long")


def q_publish_gate(spark, sf):
    return cat.publish_gate(datasets(spark, sf), GATED)


def q_filter_not_allowed(spark, sf):
    packages = datasets(spark, sf)
    refused = cat.publish_gate(packages, GATED).where(~F.col("allowed"))
    return cat.filter_not_allowed(packages, refused, GATED)


def q_refused_packages(spark, sf):
    return cat.refused_packages(datasets(spark, sf), GATED)


def q_fan_out_targets(spark, sf):
    return cat.fan_out_targets(fx.packages(spark, sf), "PROD", RESTRICTED)


# -- enrichment ------------------------------------------------------------------------------


def q_add_name_sv(field: str) -> Query:
    def query(spark, sf):
        df = fx.observations(spark, sf).select("row_number", en.code_column(field))
        return en.add_name_sv(df, fx.codes(spark, sf), field)

    return query


def q_add_names_sv_joined(spark, sf):
    """All five names by join, as for long code lists."""
    df = en.add_names_sv(fx.observations(spark, sf), fx.codes(spark, sf), max_folded=0)
    return df.select("row_number", *[en.name_sv_column(f) for f in model.NAME_SV_FIELDS])


def q_fix_time_format(spark, sf):
    return en.fix_time_format(fx.observations(spark, sf).select("row_number", "sample_time"))


def q_unreadable_times(spark, sf):
    return en.unreadable_times(fx.observations(spark, sf), package="dataset_name")


def q_unmatched_codes(spark, sf):
    return en.unmatched_codes(fx.observations(spark, sf), fx.codes(spark, sf), package="dataset_name")


def q_add_reported_dates(spark, sf):
    df = en.add_reported_dates(fx.observations(spark, sf))
    return df.select("row_number", "reported_visit_date", "reported_sample_date")


def q_add_sample_date(spark, sf):
    return en.add_sample_date(fx.observations(spark, sf)).select("row_number", "sample_date")


def q_create_fake_full_dates(spark, sf):
    return en.create_fake_full_dates(fx.observations(spark, sf)).select("row_number", "visit_date", "sample_date")


def q_apply_value_rules(spark, sf):
    return en.apply_value_rules(fx.observations(spark, sf), fx.rules(spark)).select("row_number", "parameter", "substrate")


def q_apply_value_rules_joined(spark, sf):
    df = en.apply_value_rules(fx.observations(spark, sf), fx.rules(spark), max_folded=0)
    return df.select("row_number", "parameter", "substrate")


def q_manual(data_type: str, *columns: str) -> Query:
    def query(spark, sf):
        df = en.apply_value_rules(fx.observations(spark, sf), fx.rules(spark), [data_type])
        return df.select("row_number", *columns)

    return query


def q_add_datatype_plankton_barcoding(spark, sf):
    return en.add_datatype_plankton_barcoding(fx.observations(spark, sf)).select("row_number", "delivery_datatype")


def q_enrich(spark, sf):
    return steps.enrich(fx.observations(spark, sf), fx.codes(spark, sf), fx.rules(spark))


# -- positions -------------------------------------------------------------------------------


def q_add_position_sweref99tm(spark, sf):
    df = geo.add_position_sweref99tm(fx.observations(spark, sf))
    return df.select("row_number", "sample_sweref99tm_x", "sample_sweref99tm_y")


def q_add_locations(spark, sf):
    df = fx.observations(spark, sf).select("row_number", model.LATITUDE, model.LONGITUDE)
    return geo.add_locations(df, fx.areas(spark)).drop(model.LATITUDE, model.LONGITUDE)


def q_mask_areas(spark, sf):
    return masked(spark, sf).select("row_number", "main", "rred")


# -- masks -----------------------------------------------------------------------------------


def q_mask_match_in_column(spark, sf):
    df = fx.observations(spark, sf)
    return df.select(
        "row_number",
        mk.mask_match_in_column(df, "scientific_name", model.COVER_PATTERN).alias("cover"),
        (
            mk.mask_match_in_column(df, "quality_flag", model.NON_BLANK_PATTERN)
            & mk.mask_match_in_column(df, "parameter", model.SECCHI_PARAMETER_PATTERN)
        ).alias("secchi_flag"),
        mk.mask_match_in_column(df, "no_such_column", ".*").alias("absent"),
    )


def q_select_columns_like(spark, sf):
    df = fx.observations(spark, sf)
    return df.select("row_number", *mk.select_columns_like(df.columns, model.SECCHI_COLUMNS))


def q_mask_columns(spark, sf):
    df = masked(spark, sf)
    df = mk.mask_columns(df, model.VALUE_COLUMNS, model.REPLACE_COLUMN_VALUE, F.col("main"))
    df = mk.mask_columns(df, model.COMMENT_COLUMNS, model.REPLACE_COMMENT_VALUE, F.col("main"))
    df = mk.mask_columns(df, model.SAMPLE_DEPTH_COLUMNS, model.REPLACE_COLUMN_VALUE, F.col("rred"))
    names = mk.select_columns_like(df.columns, model.VALUE_COLUMNS + model.COMMENT_COLUMNS + model.SAMPLE_DEPTH_COLUMNS)
    return df.select("row_number", *names, "substrate_extra")


def q_mask_parameter_rows(spark, sf):
    df = mk.mask_parameter_rows(masked(spark, sf), model.RESTRICTED_PARAMETERS, model.REPLACE_PARAMETER_VALUE, F.col("main"))
    return df.select("row_number", "parameter", "value")


def q_replace_with_mask(spark, sf):
    df = masked(spark, sf)
    masks = {
        c: F.col("main") & mk.mask_match_in_column(df, c, model.COVER_PATTERN)
        for c in ("scientific_name", "reported_scientific_name")
    }
    secchi = (
        F.col("main")
        & mk.mask_match_in_column(df, "quality_flag", model.NON_BLANK_PATTERN)
        & mk.mask_match_in_column(df, "parameter", model.SECCHI_PARAMETER_PATTERN)
    )
    for column, mask in masks.items():
        df = mk.replace_with_mask(df, column, model.REPLACE_SCIENTIFIC_NAME_VALUE, mask, (model.EPIBENTHOS,))
    df = mk.replace_with_mask(df, "quality_flag", model.REPLACE_SECCHI_VALUE, secchi, (model.PHYSICAL_CHEMICAL,))
    return df.select("row_number", *masks, "quality_flag")


def q_remove_profiles(spark, sf):
    df = masked(spark, sf)
    return mk.remove_profiles(df, F.col("main")).select("row_number", "data_type_internal")


def q_drop_columns(spark, sf):
    df = mk.drop_columns(fx.observations(spark, sf), ["row_number", "no_such_column"])
    assert "row_number" not in df.columns
    return df.groupBy("dataset_name").agg(
        F.count("*").alias("n"), F.count_distinct("sample_project_code").alias("n_projects")
    )


# -- plans -----------------------------------------------------------------------------------


def q_restrict(spark, sf):
    return steps.restrict(fx.observations(spark, sf), fx.areas(spark), RESTRICTED)


def q_restrict_unrestricted_type(spark, sf):
    policy = Policy(restrict=True, unrestricted=("physicalchemical",))
    return steps.restrict(fx.observations(spark, sf), fx.areas(spark), policy)


def q_publish(spark, sf):
    return steps.publish(fx.observations(spark, sf), fx.codes(spark, sf), fx.areas(spark), PUBLISHING, fx.rules(spark))


def q_publish_targets(spark, sf):
    return steps.publish_to_targets(
        fx.observations(spark, sf), fx.codes(spark, sf), fx.areas(spark), PUBLISHING, "PROD", fx.rules(spark)
    )


# -- members, log, addresses -----------------------------------------------------------------


def q_prune_members(spark, sf):
    return members.prune_members(typed_members(spark, sf), RESTRICTED).select("package", "member")


def q_check_members_left(spark, sf):
    return members.check_members_left(q_prune_members(spark, sf))


def q_log_filter(spark, sf):
    return report.log_filter(fx.log(spark, sf), "warning", "transformation")


def q_live_log(spark, sf):
    return report.live_log(fx.log(spark, sf))


def q_summarize_log(spark, sf):
    return report.summarize_log(fx.log(spark, sf))


def q_format_log_line(spark, sf):
    return fx.log(spark, sf).select("package", format_log_line(F.col("level"), F.col("msg")).alias("line"))


def _rows_where(condition, level: str, text: str) -> report.Validator:
    def validate(df: DataFrame) -> DataFrame:
        counted = df.where(condition).groupBy(F.col("dataset_name").alias("package")).agg(F.count("*").alias("n"))
        msg = F.concat(F.lit(f"{text} in "), F.col("n"), F.lit(" rows"))
        return counted.select("package", F.lit(level).alias("level"), F.lit("validation").alias("log_type"), msg.alias("msg"))

    return validate


def q_run_validators(spark, sf):
    validators = [
        _rows_where(F.col(model.LATITUDE).isNull(), "warning", "No position"),
        _rows_where(is_blank(F.col("sample_time")), "info", "Blank time"),
    ]
    return report.run_validators(fx.observations(spark, sf), validators)


def q_normalize_url(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", normalize_url(F.col("url")).alias("url"))


# -- files -----------------------------------------------------------------------------------


def _staged(spark, paths) -> DataFrame:
    ship_package(spark)
    return src.stage_packages(src.list_packages(spark, paths), scratch_folder(spark))


def q_list_packages(spark, sf):
    return src.list_packages(spark, ar.built_packages(spark, sf)).select("package", "base_name", "version")


def q_read_members(spark, sf):
    return src.read_members(_staged(spark, ar.built_packages(spark, sf)))


def q_package_info(spark, sf):
    info = src.package_info(_staged(spark, ar.built_packages(spark, sf)))
    return info.select("package", "data_type_internal", F.size("header").alias("n_columns"))


def q_read_data_table(spark, sf):
    table = src.read_data_table(_staged(spark, ar.built_packages(spark, sf)))
    return table.drop("layout", "_line", "_type")


def q_read_data_table_tree(spark, sf):
    """The same from unzipped packages, in ranges of a few kilobytes."""
    root = ar.built_tree(spark, sf)
    table = src.read_data_table(trees.stage_trees(spark, root, scratch_folder(spark), range_bytes=50_000))
    return table.drop("layout", "_line", "_type")


def q_failed_packages(spark, sf):
    return src.failed_packages(_staged(spark, ar.built_with_corrupt(spark, sf))).select("msg")


def q_write_packages(spark, sf):
    """Archives written from the table, read back and summed up per package."""
    staged = _staged(spark, ar.built_packages(spark, sf))
    lines = staged.where(F.col("kind") == "line")
    return lines.groupBy("package").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"))


def q_write_data_table(spark, sf):
    folder = scratch_folder(spark)
    write_data_table(ar.package_rows(spark, sf), folder)
    back = spark.read.csv(folder, sep=model.SEPARATOR, header=True, encoding="ISO-8859-1", quote="", inferSchema=False)
    return back.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in back.columns])


def q_publish_archives(spark, sf):
    folder = scratch_folder(spark)
    codes, areas, rules = fx.codes(spark, sf), fx.areas(spark), fx.rules(spark)
    publish_archives(spark, ar.built_packages(spark, sf), folder, codes, areas, PUBLISHING, rules)
    table = src.read_data_table(_staged(spark, folder))
    return table.drop("layout", "_line", "_type")


def _published(spark, sf, paths):
    folder = scratch_folder(spark)
    publish_archives(spark, paths, folder, fx.codes(spark, sf), fx.areas(spark), PUBLISHING, fx.rules(spark))
    return src.read_data_table(_staged(spark, folder)).drop("layout", "_line", "_type")


def q_publish_archives_mixed_headers(spark, sf):
    """Packages of one type with different headers: all are masked by the type they are of."""
    return _published(spark, sf, ar.built_mixed(spark, sf))


def q_publish_archives_two_folders(spark, sf):
    """The later of two archives of one name counts."""
    return _published(spark, sf, ar.built_twice(spark, sf))


def q_publish_archives_repeated_members(spark, sf):
    """Members that are listed twice: the last counts, and the log tells of it."""
    folder = scratch_folder(spark)
    done = publish_archives(spark, ar.built_repeated(spark, sf), folder, fx.codes(spark, sf), fx.areas(spark), PUBLISHING, fx.rules(spark))
    lines = ar.read_by_zipfile(src.list_packages(spark, folder)).groupBy("package", F.col("member").alias("text")).agg(F.count("*").alias("n"))
    told = done.log.where(F.startswith("msg", F.lit("Listed"))).groupBy("package", F.col("msg").alias("text")).agg(F.count("*").alias("n"))
    return lines.unionByName(told)


def q_publish_archives_marked(spark, sf):
    """Tables that begin with a mark of their encoding and have blank lines are typed, gated and masked like others."""
    return _published(spark, sf, ar.built_marked(spark, sf))


def q_publish_archives_untyped(spark, sf):
    """Where restriction applies, packages of unknown type fail and the others are published."""
    folder = scratch_folder(spark)
    done = publish_archives(spark, ar.built_untyped(spark, sf), folder, fx.codes(spark, sf), fx.areas(spark), PUBLISHING, fx.rules(spark))
    written = src.list_packages(spark, folder).select("package", F.lit("written").alias("state"))
    return written.unionByName(done.failed.select("package", F.col("error").alias("state")))


def q_round_trip_ragged(spark, sf):
    """Repeated column names, blank cells beyond the header, folders, and line ends inside cells."""
    columns = [F.col("parameter"), F.col("value"), F.concat(F.lit("n"), "value"), F.concat("value", F.lit("\r"), "value"), F.lit("")]
    folder = ar.built_lines(spark, sf, "parameter\tnote\tnote\tends", columns, {"empty/": b"", "a/b.txt": b"x\ny"})
    out = scratch_folder(spark)
    publish_archives(spark, folder, out, fx.codes(spark, sf), fx.areas(spark), Policy())
    return ar.read_by_zipfile(src.list_packages(spark, out)).groupBy("package", "member", "line").agg(F.count("*").alias("n"))


def q_read_data_table_odd_headers(spark, sf):
    """Names that differ in case only, with dots and back-ticks, blank, and those the library uses."""
    names = ["Secchi_note", "secchi_note", "a.b", "x`y", "", "package", "_line", "Parameter"]
    columns = [F.concat(F.lit(f"{i}-"), "value") for i in range(len(names))]
    staged = _staged(spark, ar.built_lines(spark, sf, "\t".join(names), columns))
    table = src.read_data_table(staged)
    own = [c for c in table.columns if c not in ("package", "layout", "_line", "_type")]
    assert [shown(c) for c in own] == names
    return table.select("package", *[F.col(c).alias(f"c{i}") for i, c in enumerate(own)])


def q_write_package_tables(spark, sf):
    """Text files of each package's own columns."""
    folder = scratch_folder(spark)
    pk.write_package_tables(ar.rendered_packages(spark, sf), folder, in_order=True)
    back = spark.read.option("wholetext", False).text(folder)
    return back.groupBy("package").agg(F.count("*").alias("n"), F.sum(F.length("value")).alias("n_chars"))


def q_write_table_files(spark, sf):
    """The tables again, each as the one file of its package that has the fixed name."""
    folder = scratch_folder(spark)
    written = pk.write_table_files(ar.rendered_packages(spark, sf), folder, scratch_folder(spark), in_order=True)
    back = spark.read.text(f"{folder}/*/{model.DATA_FILE}").withColumn("package", F.element_at(F.split(F.input_file_name(), "/"), -2))
    lines = back.groupBy("package").agg(F.count("*").alias("n"), F.sum(F.length("value")).alias("n_chars"))
    sizes = written.select(F.substring_index("file", "/", 1).alias("package"), F.col("size").alias("n_bytes"))
    return lines.join(sizes, "package")


def _written(df, folder: str) -> str:
    df.write.csv(folder, sep="\t", header=True, emptyValue="")
    return folder


def q_read_codes(spark, sf):
    return read_codes(spark, _written(fx.codes(spark, sf), scratch_folder(spark)))


def q_read_areas(spark, sf):
    """Areas read from a file, met by all positions."""
    areas = read_areas(spark, _written(fx.areas(spark).withColumn("polygon_id", F.lit(1)).select("area", "polygon_id", "seq", "lat", "lon"), scratch_folder(spark)))
    df = fx.observations(spark, sf).select("row_number", model.LATITUDE, model.LONGITUDE)
    return geo.add_locations(df, areas).drop(model.LATITUDE, model.LONGITUDE)


def q_read_rules(spark, sf):
    rules = read_rules(spark, _written(fx.rules(spark), scratch_folder(spark)))
    return en.apply_value_rules(fx.observations(spark, sf), rules).select("row_number", "parameter", "substrate")


def q_publish_log(spark, sf):
    """What the log tells of packages that are refused or cannot be read."""
    done = publish_archives(spark, ar.built_with_corrupt(spark, sf), scratch_folder(spark), fx.codes(spark, sf), fx.areas(spark), PUBLISHING, fx.rules(spark))
    return done.log.where("level = 'error'").select("package", "log_type", "msg")


def q_add_locations_dense(spark, sf):
    """Areas of 20,000 vertices each."""
    df = fx.observations(spark, sf).select("row_number", model.LATITUDE, model.LONGITUDE)
    return geo.add_locations(df, fx.dense_areas(spark)).drop(model.LATITUDE, model.LONGITUDE)


def q_add_locations_clustered(spark, sf):
    """Coasts of 20,000 vertices in a hundredth and in a ten-thousandth of a degree, beside a coarse area."""
    df = fx.observations(spark, sf).select("row_number", model.LATITUDE, model.LONGITUDE)
    return geo.add_locations(df, fx.clustered_areas(spark)).drop(model.LATITUDE, model.LONGITUDE)


def q_write_reports(spark, sf):
    folder = scratch_folder(spark)
    report.write_reports(fx.log(spark, sf), folder)
    return spark.read.parquet(folder)


def q_write_removal_list(spark, sf):
    ship_package(spark)
    folder = scratch_folder(spark)
    write_removal_list(cat.merge_removal_names(fx.removals(spark, sf), fx.packages(spark, sf, "stored")), folder, scratch_folder(spark))
    return read_name_list(spark, f"{folder}/{model.REMOVAL_FILE}")


def _listed(spark, folder: str) -> DataFrame:
    return src.list_packages(spark, folder).select(F.col("package").alias("name"), "path")


def q_update_stores(spark, sf):
    """Archives copied to a data set folder and to a store of newest versions, then some removed."""
    data_sets, store = scratch_folder(spark), scratch_folder(spark)
    incoming = _listed(spark, ar.built_packages(spark, sf))
    copy_to_store(incoming, data_sets, scratch_folder(spark))
    copy_to_store(incoming, store, scratch_folder(spark))
    newer = incoming.withColumn("name", F.regexp_replace("name", "2024-05-01", "2025-01-01"))
    log = update_store(newer, store, scratch_folder(spark))
    removals = datasets(spark, sf).where(F.col("data_type_internal") == "profile").select("name")
    removed = remove_from_store(removals, store, scratch_folder(spark))
    left = _listed(spark, data_sets).withColumn("place", F.lit("data sets")).unionByName(
        _listed(spark, store).withColumn("place", F.lit("store"))
    )
    logged = log.unionByName(removed).select(F.lit("log").alias("place"), F.col("msg").alias("name"))
    return left.select("place", "name").unionByName(logged)


def queries() -> dict[str, Query]:
    found = {name.removeprefix("q_"): f for name, f in globals().items() if name.startswith("q_") and name not in ("q_add_name_sv", "q_manual")}
    found["manual_seal_pathology"] = q_manual(model.SEAL_PATHOLOGY, "parameter")
    found["manual_harbour_porpoise"] = q_manual(model.HARBOUR_PORPOISE, "parameter")
    found["manual_epibenthos"] = q_manual(model.EPIBENTHOS, "parameter", "substrate")
    for field in model.NAME_SV_FIELDS:
        found[f"add_{field.removeprefix('sample_')}_name_sv"] = q_add_name_sv(field)
    return found
