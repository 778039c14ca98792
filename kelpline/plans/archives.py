"""Whole runs over archives: publish to targets, remove from targets."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline import model
from kelpline.functions.headers import HeaderColumn
from kelpline.functions.text import cell, format_refusal
from kelpline.operators import catalog as cat
from kelpline.operators import enrichment as en
from kelpline.operators import members as mb
from kelpline.operators import report
from kelpline.operators.masks import drop_columns
from kelpline.plans import steps
from kelpline.policy import Policy
from kelpline.session import remove_folder, scratch_folder, ship_package
from kelpline.sinks import packages as pk
from kelpline.sinks import stores
from kelpline.sources import archives as src
from kelpline.sources.tables import read_name_list


@dataclass(frozen=True)
class Published:
    """What a run leaves: archives written, packages refused and failed, and the log."""

    archives: DataFrame
    refused: DataFrame
    failed: DataFrame
    log: DataFrame


#: Why a package is not published where restriction applies: nothing tells what to mask.
NO_TYPE = "no data type, so it is unknown what to mask"
#: Columns that go with the rows and are not part of them.
_CARRIED = ("_own", "_was", "_type", "_notes", "_removed")


def _untyped_package(policy: Policy) -> Column:
    """TRUE for packages with lines that no type is known for, where the policy restricts."""
    return F.lit(policy.restricting) & (F.coalesce("data_type_internal", F.lit("")) == "") & F.col("has_lines")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _plans(headers: Mapping[str, list[HeaderColumn]], policy: Policy) -> list[tuple[list[str], list[HeaderColumn]]]:
    """Data types that share their columns and steps, with those columns: one plan each.

    A column of data types may name any type in any row, so only the columns tell such plans apart.
    """
    groups: dict[tuple, list[str]] = {}
    for data_type, columns in sorted(headers.items()):
        groups.setdefault((tuple(columns), data_type in policy.unrestricted), []).append(data_type)
    return [(types, list(alike[0])) for alike, types in groups.items()]


def _typed(table: DataFrame, own: bool) -> DataFrame:
    """The data type each row counts as: its own cell, or if that is blank the type of its package.

    What the cell held is kept aside, since steps may change the type and a blank cell must stay blank.
    """
    kind = F.when(cell(F.col(model.DATA_TYPE)) != "", F.col(model.DATA_TYPE)).otherwise(F.col("_type")) if own else F.col("_type")
    cells = F.col(model.DATA_TYPE) if own else F.lit("")
    return table.withColumns({"_own": cells, "_was": kind, model.DATA_TYPE: kind})


def _untyped(rows: DataFrame, own: bool) -> DataFrame:
    if not own:
        return rows.drop(model.DATA_TYPE, "_own", "_was")
    same = F.col(model.DATA_TYPE).eqNullSafe(F.col("_was"))
    return rows.withColumn(model.DATA_TYPE, F.when(same, F.col("_own")).otherwise(F.col(model.DATA_TYPE))).drop("_own", "_was")


def publish_archives(
    spark: SparkSession,
    paths: str | Iterable[str],
    folder: str,
    codes: DataFrame,
    areas: DataFrame,
    policy: Policy,
    rules: DataFrame | None = None,
    validators: Iterable[report.Validator] = (),
    prune: bool = False,
    data_type: src.TypeRule = src.default_data_type,
) -> Published:
    """Read zip packages, publish their rows and write them again under the same names."""
    table, validators = scratch_folder(spark), list(validators)
    staged = src.stage_packages(src.list_packages(spark, paths), table, data_type)
    done = publish_staged(staged, folder, codes, areas, policy, rules, validators, prune, in_order=True)
    if not validators:
        # the log and the lists need no line again; what validators tell is counted when it is read
        remove_folder(spark, f"{table}/kind=line")
    return done


def publish_staged(
    staged: DataFrame,
    folder: str,
    codes: DataFrame,
    areas: DataFrame,
    policy: Policy,
    rules: DataFrame | None = None,
    validators: Iterable[report.Validator] = (),
    prune: bool = False,
    in_order: bool = False,
) -> Published:
    """Publish packages that are staged already; ``in_order`` if they were archives, whose members are staged line after line.

    Data types with the same columns share one plan; the lines of all are then compressed and
    placed together. A package that cannot be read is reported and left out;
    one without rows is still written.
    """
    spark = staged.sparkSession
    ship_package(spark)
    scratch = scratch_folder(spark)
    failed = src.unreadable(staged)
    # a small table of packages is used by every step below
    src.package_info(staged, failed).write.parquet(f"{scratch}/info")
    info = cat.publish_gate(spark.read.parquet(f"{scratch}/info"), policy)
    untyped = info.where("allowed").where(_untyped_package(policy))
    allowed = info.where("allowed").where(~_untyped_package(policy))
    refused = info.where(~F.col("allowed")).select("package", format_refusal(F.col("package"), F.col("data_type")).alias("msg"))
    error = lambda rows: rows.select("package", F.lit("error").alias("level"), F.lit("workflow").alias("log_type"), "msg")
    unknown = untyped.select("package", F.lit(NO_TYPE).alias("error"), F.concat("package", F.lit(f" -> {NO_TYPE}")).alias("msg"))
    lost = src.failed_packages(staged).unionByName(unknown)
    lines, logs = [], [src.reading_notes(staged, failed), error(refused), error(unknown)]
    for types, columns in _plans(src.union_headers(allowed), policy):
        # the gate is by data type, so the lines of allowed packages are found without a join
        of_types = allowed.where(F.col("data_type_internal").isin(*types))
        own = any(c.column == model.DATA_TYPE for c in columns)
        table = _typed(src.read_data_table(staged, types, columns, of_types, failed), own)
        # a column of types may name others than those of the packages
        rows = steps.enrich(table.withColumn("_notes", en.row_notes(table, codes)), codes, rules, None if own else types)
        if own or types[0] not in policy.unrestricted:
            rows = steps.restrict(rows, areas, policy, mark_removed=True)
        rows = drop_columns(rows)
        left = rows.where(~F.col("_removed")) if "_removed" in rows.columns else rows
        logs += [v(left.drop(*_CARRIED)) for v in validators]
        lines.append(pk.render_lines(_untyped(rows, own), of_types, columns, steps.added_columns(policy, own or model.PLANKTON_BARCODING in types)))
    if not lines:
        none = spark.createDataFrame([], "file string, size long")
        return Published(none, refused, lost, _union(logs))
    files = src.read_files(staged, allowed)
    if prune:
        files = mb.prune_members(files, policy)
        left = files.where((F.col("seq") == 0) & ~F.endswith("member", F.lit("/"))).select("package", "member")
        with_data = left.unionByName(allowed.select("package", F.lit(model.DATA_FILE).alias("member")))
        logs.append(mb.check_members_left(with_data).select("package", "level", "log_type", "msg"))
    written = pk.write_packages(_union(lines), folder, scratch, files, in_order)
    # what the lines had to tell was counted while they were compressed
    logs += [en.note_log(pk.counted_notes(spark, scratch), codes), pk.replaced_characters(spark, scratch)]
    return Published(written, refused, lost, _union(logs))


@dataclass(frozen=True)
class Target:
    """Folders of one environment: the data set folder, and the store of newest versions."""

    datasets: str
    store: str | None = None


def publish_to_environment(
    spark: SparkSession,
    paths: str | Iterable[str],
    environment: str,
    targets: Mapping[str, Target],
    work: str,
    codes: DataFrame,
    areas: DataFrame,
    policy: Policy,
    **options,
) -> dict[str, Published]:
    """Publish to every target of an environment; a following target gets unmasked data.

    The archives are opened once for all targets.
    """
    results = {}
    allow_all = options.pop("allow_all", False)
    staged = src.stage_packages(src.list_packages(spark, paths), scratch_folder(spark), options.pop("data_type", src.default_data_type))
    originals = src.list_packages(spark, paths).select(F.col("package").alias("name"), "path")
    for name, restrict in cat.publish_targets(environment, policy.restricting):
        folder = f"{work.rstrip('/')}/{scratch_folder(spark).rsplit('/', 1)[-1]}/{name}"
        done = publish_staged(staged, folder, codes, areas, policy.with_restrict(restrict), in_order=True, **options)
        archives = done.archives.select(F.col("file").alias("name"), F.concat(F.lit(folder + "/"), "file").alias("path"))
        if allow_all:
            # what was refused is copied as it came
            refused = done.refused.select(F.col("package").alias("name"))
            archives = archives.unionByName(originals.join(refused, "name", "left_semi"))
        results[name] = _copied(done, archives, targets[name])
    return results


def _copied(done: Published, archives: DataFrame, target: Target) -> Published:
    spark = archives.sparkSession
    copied = stores.copy_to_store(archives, target.datasets, scratch_folder(spark))
    replaced = stores.update_store(archives, target.store, scratch_folder(spark))
    return Published(done.archives, done.refused, done.failed, _union([done.log, copied, replaced]))


def copy_to_environment(
    spark: SparkSession,
    paths: str | Iterable[str],
    environment: str,
    targets: Mapping[str, Target],
    policy: Policy,
    allow_all: bool = False,
    data_type: src.TypeRule = src.default_data_type,
) -> dict[str, Published]:
    """Copy packages as they are to every target of an environment, without updating them.

    Packages that may not be published are left out where the target restricts, unless ``allow_all``.
    """
    results = {}
    packages = src.list_packages(spark, paths)
    staged = src.stage_packages(packages, scratch_folder(spark), data_type)
    info = src.package_info(staged).select(F.col("package").alias("name"), model.DATA_TYPE, "data_type", "has_lines")
    originals = packages.groupBy(F.col("package").alias("name")).agg(F.max("path").alias("path"))
    for name, restrict in cat.publish_targets(environment, policy.restricting):
        own = policy.with_restrict(restrict)
        # as they come, packages of unknown type may hold what should be masked
        refused = cat.publish_gate(info, own).where(~F.col("allowed") | _untyped_package(own))
        chosen = cat.ordered_packages(cat.filter_not_allowed(originals, refused, own, allow_all))
        told = refused.select(F.col("name").alias("package"), format_refusal(F.col("name"), F.col("data_type")).alias("msg"))
        log = told.select("package", F.lit("error").alias("level"), F.lit("workflow").alias("log_type"), "msg")
        done = Published(chosen.select(F.col("name").alias("file")), told, src.failed_packages(staged), log)
        results[name] = _copied(done, chosen, targets[name])
    return results


def write_removals(spark: SparkSession, names: DataFrame, environment: str, targets: Mapping[str, Target]) -> None:
    """Leave the removal list, joined with the one that waits, in every target's data set folder."""
    for name in cat.removal_targets(environment):
        folder = targets[name].datasets
        waiting = read_name_list(spark, f"{folder}/{model.REMOVAL_FILE}")
        merged = names.select("name") if waiting is None else cat.merge_removal_names(waiting, names)
        stores.write_removal_list(merged, folder, scratch_folder(spark))


def remove_from_stores(spark: SparkSession, names: DataFrame, environment: str, targets: Mapping[str, Target]) -> DataFrame:
    """Remove listed packages from the stores of all targets; the log of what was done."""
    return _union(
        [stores.remove_from_store(names, targets[t].store, scratch_folder(spark)) for t in cat.removal_targets(environment)]
    )
