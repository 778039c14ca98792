"""The catalogue of packages: gates, versions, removals, targets.

Catalogue joins carry no hint: the adaptive planner broadcasts a side it has measured and
splits a base name that holds a large share of the catalogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelpline import model
from kelpline.functions.names import base_name, version
from kelpline.functions.text import format_refusal
from kelpline.policy import Policy


def with_base(names: DataFrame, name: str = "name") -> DataFrame:
    return names.withColumn("base_name", base_name(F.col(name)))


def describe_packages(names: DataFrame, name: str = "name") -> DataFrame:
    """Package names split into base name and version."""
    return names.withColumns({"base_name": base_name(F.col(name)), "version": version(F.col(name))})


# -- gates -----------------------------------------------------------------------------------


def publish_gate(packages: DataFrame, policy: Policy, data_type: str = model.DATA_TYPE) -> DataFrame:
    """Add ``allowed``: whether the package may be published."""
    return packages.withColumn("allowed", policy.allows(F.col(data_type)))


def refused_packages(
    packages: DataFrame, policy: Policy, name: str = "name", data_type: str = model.DATA_TYPE, display: str = "data_type"
) -> DataFrame:
    """The distinct refusal messages of a run; they name the data type as it is shown, where that is known."""
    told = display if display in packages.columns else data_type
    return (
        publish_gate(packages, policy, data_type)
        .where(~F.col("allowed"))
        .select(format_refusal(F.col(name), F.col(told)).alias("msg"))
        .distinct()
    )


def filter_not_allowed(
    packages: DataFrame, refused: DataFrame, policy: Policy, allow_all: bool = False, name: str = "name"
) -> DataFrame:
    """Packages to copy to the stores: all, or those not refused when restricting."""
    if allow_all or not policy.restricting:
        return packages
    return packages.join(refused.select(name).distinct(), name, "left_anti")


# -- stored versions -------------------------------------------------------------------------


def latest_per_base(packages: DataFrame, name: str = "name") -> DataFrame:
    """The package with the greatest name per base name, aggregated before the shuffle."""
    rest = [c for c in packages.columns if c not in (name, "base_name")]
    top = F.max(F.struct(name, *rest)).alias("_top")
    return with_base(packages, name).groupBy("base_name").agg(top).select("base_name", "_top.*")


def append_to_store(current: DataFrame, incoming: DataFrame, name: str = "name") -> DataFrame:
    """Add packages by full name: the same name is overwritten, other versions stay."""
    rest = [c for c in incoming.columns if c != name]
    fresh = incoming.groupBy(name).agg(F.max(F.struct(*rest)).alias("_top")).select(name, "_top.*") if rest else incoming.distinct()
    return current.join(fresh, name, "left_anti").unionByName(fresh, allowMissingColumns=True)


def replace_latest(current: DataFrame, incoming: DataFrame, name: str = "name") -> DataFrame:
    """The newest incoming package of a base name replaces all its stored versions."""
    latest = latest_per_base(incoming, name)
    kept = with_base(current, name).join(latest.select("base_name"), "base_name", "left_anti")
    return kept.unionByName(latest, allowMissingColumns=True).select("base_name", name, *[c for c in current.columns if c not in ("base_name", name)])


def store_actions(current: DataFrame, incoming: DataFrame, name: str = "name", path: str = "path") -> DataFrame:
    """What turns the stored catalogue into the one ``replace_latest`` gives, as rows
    ``(action, name, path)``: what to copy, and which stored packages it replaces."""
    latest = latest_per_base(incoming, name)
    stale = (
        with_base(current, name)
        .join(latest.select("base_name"), "base_name", "left_semi")
        .join(latest.select(name), name, "left_anti")
    )
    return latest.select(F.lit("copy").alias("action"), name, path).unionByName(
        stale.select(F.lit("remove").alias("action"), name, path)
    )


def ordered_packages(original: DataFrame, updated: DataFrame | None = None, name: str = "name") -> DataFrame:
    """Names in order: the updated packages, or the original ones if none were updated."""
    chosen = original if updated is None or updated.isEmpty() else updated
    return chosen.orderBy(name)


# -- removals --------------------------------------------------------------------------------


def _removal_bases(removals: DataFrame, name: str) -> DataFrame:
    return removals.select(base_name(F.col(name)).alias("base_name")).distinct()


def remove_by_base_name(current: DataFrame, removals: DataFrame, name: str = "name") -> DataFrame:
    """The catalogue without the packages whose base name is listed."""
    return with_base(current, name).join(_removal_bases(removals, name), "base_name", "left_anti")


def select_removed(current: DataFrame, removals: DataFrame, name: str = "name") -> DataFrame:
    """The packages ``remove_by_base_name`` takes away."""
    return with_base(current, name).join(_removal_bases(removals, name), "base_name", "left_semi")


def merge_removal_names(existing: DataFrame, new: DataFrame, name: str = "name") -> DataFrame:
    """Both lists as one, each name once, in order."""
    return existing.select(name).union(new.select(name)).distinct().orderBy(name)


def discard_names(names: DataFrame, chosen: DataFrame, name: str = "name") -> DataFrame:
    """A selection without the chosen names."""
    return names.join(chosen.select(name).distinct(), name, "left_anti")


def count_waiting_removals(removals: DataFrame | None) -> int:
    """How many names wait to be removed; no list and an empty list are both none."""
    return 0 if removals is None else removals.count()


# -- targets ---------------------------------------------------------------------------------


def publish_targets(environment: str, restrict: bool) -> list[tuple[str, bool]]:
    """Targets one publishing run serves, with whether each is restricted."""
    environment = _known(environment)
    follower = model.PUBLISH_FOLLOWERS.get(environment)
    return [(environment, restrict)] + ([(follower, False)] if follower else [])


def removal_targets(environment: str) -> list[str]:
    """Targets one removal run serves; configuration files go the same way."""
    environment = _known(environment)
    follower = model.REMOVE_FOLLOWERS.get(environment)
    return [environment] + ([follower] if follower else [])


def _known(environment: str) -> str:
    environment = environment.strip().upper()
    if environment not in model.ENVIRONMENTS:
        raise KeyError(environment)
    return environment


def targets_column(environment: str, restrict: bool) -> Column:
    rows = [
        F.struct(F.lit(t).alias("target"), F.lit(r).alias("restrict"))
        for t, r in publish_targets(environment, restrict)
    ]
    return F.array(*rows)


def fan_out_targets(packages: DataFrame, environment: str, policy: Policy) -> DataFrame:
    """Each package once per target."""
    return packages.withColumn("_t", F.explode(targets_column(environment, policy.restricting))).select("*", "_t.*").drop("_t")
