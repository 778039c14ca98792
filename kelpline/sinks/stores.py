"""Stores of archives, and removal lists.

A store changes in one step. What a run wants to change, and copies of what comes in, lie in a hidden folder beside the store first; the step is a file
with the number of the version, which only one run can make; names appear and vanish after that. ``list_store`` sees
the store as it was before the step or as it is after, also if a run ends half way: the next one completes it.
"""

from __future__ import annotations

import contextlib
import os
import re
import shutil
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline import model
from kelpline.operators.catalog import select_removed, store_actions
from kelpline.session import ship_package
from kelpline.sinks.placed import BodyFile, discard, local_folder, sums_before, write_placed
from kelpline.sources.archives import list_packages

TEXT_BYTES = 1024 * 1024
RANGE_BYTES = 8 * 1024 * 1024
#: Pieces of text that a task may make; tells the pieces of two tasks apart.
PIECES = 1 << 20


def _sized(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [os.path.getsize(local_folder(p)) for p in batch["path"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["name"], batch["path"], pa.array(sizes, pa.int64())], names=["name", "path", "length"])


def copy_ranges(copies: DataFrame) -> DataFrame:
    """Files ``(name, path)`` cut into ranges, dealt by a hash over as many tasks as the session shuffles to:
    neither many files nor a large one are the work of one task."""
    sized = copies.select("name", "path").mapInArrow(_sized, "name string, path string, length long")
    last = F.greatest(F.lit(0).cast("long"), F.ceil(F.col("length") / RANGE_BYTES) - 1)
    ranges = sized.select("name", "path", "length", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: i * RANGE_BYTES)).alias("offset"))
    ranges = ranges.withColumn("size", F.least(F.lit(RANGE_BYTES).cast("long"), F.col("length") - F.col("offset")))
    return ranges.repartition(int(copies.sparkSession.conf.get("spark.sql.shuffle.partitions")), "name", "offset")


def _copy(copies: DataFrame, folder: str) -> None:
    """Files ``(name, path)`` into a folder; their bytes go from file to file and through no row."""
    ranges = copy_ranges(copies)
    path = F.regexp_replace("path", "^file:/*", "/")
    place = ranges.select(F.col("name").alias("file"), "offset", "size", F.lit(None).cast("binary").alias("content"), path.alias("body"), F.col("offset").alias("at"))
    write_placed(place, folder)


# -- versions of a store ---------------------------------------------------------------------


def _versions(folder: str) -> str:
    """Where the versions of a store are kept: beside it, so that whoever lists the store finds packages only."""
    return f"{os.path.dirname(folder)}/.{os.path.basename(folder)}.versions"


class StoreChanged(RuntimeError):
    """Another run has changed the store since this one read it."""


def _commits(folder: str) -> dict[int, str]:
    """Numbers of the versions that were made, and the runs that made them."""
    found = {}
    with contextlib.suppress(FileNotFoundError):
        for name in os.listdir(_versions(folder)):
            if match := re.fullmatch(r"(\d+)\.commit", name):
                with open(f"{_versions(folder)}/{name}", encoding="utf8") as file:
                    found[int(match[1])] = file.read()
    return found


def _latest(folder: str) -> tuple[int, str | None]:
    commits = _commits(folder)
    number = max(commits, default=0)
    return number, commits.get(number)


def _is_done(folder: str, number: int) -> bool:
    return os.path.exists(f"{_versions(folder)}/{number}.done")


def _mark(folder: str, number: int, kind: str, text: str) -> None:
    """Make a file with its content in one step; fails if it is there."""
    own = f"{_versions(folder)}/.{uuid.uuid4().hex}"
    with open(own, "w", encoding="utf8") as file:
        file.write(text)
    try:
        os.link(own, f"{_versions(folder)}/{number}.{kind}")
    finally:
        os.remove(own)


def _version_folder(folder: str, number: int, run: str) -> str:
    return f"{_versions(folder)}/{number}-{run}"


def _actions(spark: SparkSession, folder: str, number: int, run: str) -> DataFrame:
    return spark.read.schema("action string, name string, path string").parquet(f"file:{_version_folder(folder, number, run)}/actions")


def list_store(spark: SparkSession, folder: str) -> DataFrame:
    """Packages of a store as of its last version: ``(name, path)``."""
    folder = local_folder(folder)
    number, run = _latest(folder)
    there = _listed(spark, folder)
    if run is None or _is_done(folder, number):
        return there
    # the names are still being changed: what the version says counts
    actions = _actions(spark, folder, number, run)
    new = F.concat(F.lit(f"file:{_version_folder(folder, number, run)}/files/"), "name").alias("path")
    return there.join(actions.select("name"), "name", "left_anti").unionByName(actions.where("action = 'copy'").select("name", new))


def _each(folder: str, change: Callable[[str, str], None]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch["name"].to_pylist():
                change(folder, name)
            yield batch

    return run


def _linker(version: str) -> Callable[[str, str], None]:
    def link(folder: str, name: str) -> None:
        own = f"{folder}/.{uuid.uuid4().hex}"
        try:
            os.link(f"{version}/files/{name}", own)
        except OSError:
            # no links on this mount
            shutil.copy2(f"{version}/files/{name}", own)
        os.replace(own, f"{folder}/{name}")
        # two names of one file: nothing was replaced, as when a version is completed twice
        with contextlib.suppress(FileNotFoundError):
            os.remove(own)

    return link


def _remove(folder: str, name: str) -> None:
    with contextlib.suppress(FileNotFoundError):
        os.remove(f"{folder}/{name}")


def _finish(spark: SparkSession, folder: str) -> None:
    """Let the names follow the last version; copies come before removals, so that a base name is never without a package."""
    number, run = _latest(folder)
    if run is None or _is_done(folder, number):
        return
    ship_package(spark)
    actions, version = _actions(spark, folder, number, run), _version_folder(folder, number, run)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for action, change in (("copy", _linker(version)), ("remove", _remove)):
        names = actions.where(F.col("action") == action).select("name").repartition(tasks, "name")
        names.mapInArrow(_each(folder, change), "name string").write.format("noop").mode("overwrite").save()
    with contextlib.suppress(FileExistsError):
        _mark(folder, number, "done", run)


def _tidy(folder: str) -> None:
    """Remove the folders of versions before the last: of runs that were overtaken, and copies that readers may have needed until now."""
    last, _ = _latest(folder)
    with contextlib.suppress(FileNotFoundError):
        for name in os.listdir(_versions(folder)):
            if (match := re.fullmatch(r"(\d+)-.*", name)) and int(match[1]) < last:
                shutil.rmtree(f"{_versions(folder)}/{name}", ignore_errors=True)


def _change(spark: SparkSession, folder: str, wanted: Callable[[DataFrame], DataFrame], scratch: str) -> DataFrame:
    """Carry out what ``wanted`` makes of the listing, ``(action, name, path)``, as the next version."""
    _finish(spark, folder)
    number, run = _latest(folder)[0] + 1, uuid.uuid4().hex
    version = _version_folder(folder, number, run)
    os.makedirs(version)
    try:
        wanted(_listed(spark, folder)).select("action", "name", "path").write.parquet(f"{scratch}/actions")
        actions = spark.read.parquet(f"{scratch}/actions")
        actions.write.parquet(f"file:{version}/actions")
        _copy(actions.where("action = 'copy'").select("name", "path"), f"{version}/files")
        _mark(folder, number, "commit", run)
    except FileExistsError:
        shutil.rmtree(version, ignore_errors=True)
        raise StoreChanged(f"{folder} was changed by another run, nothing was done") from None
    except BaseException:
        shutil.rmtree(version, ignore_errors=True)
        raise
    _finish(spark, folder)
    _tidy(folder)
    return actions


def _store(folder: str | None) -> str | None:
    """The folder of a store; none if it is unset or missing."""
    if not folder or not os.path.isdir(local_folder(folder)):
        return None
    return local_folder(folder)


def _workflow_log(spark: SparkSession, msg: str) -> DataFrame:
    return spark.createDataFrame([("", "info", "workflow", msg)], "package string, level string, log_type string, msg string")


def _action_log(done: DataFrame) -> DataFrame:
    verb = F.when(F.col("action") == "copy", F.lit("Copied package: ")).otherwise(F.lit("Removing old package: "))
    return done.select(
        F.col("name").alias("package"), F.lit("info").alias("level"), F.lit("workflow").alias("log_type"),
        F.concat(verb, "name").alias("msg"),
    )


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    try:
        return list_packages(spark, folder).select(F.col("package").alias("name"), "path")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], "name string, path string")
        raise


def copy_to_store(packages: DataFrame, folder: str, scratch: str) -> DataFrame:
    """Copy packages ``(name, path)`` by full name; the log of what was done."""
    folder = local_folder(folder)
    os.makedirs(folder, exist_ok=True)
    packages.groupBy("name").agg(F.max("path").alias("path")).write.parquet(f"{scratch}/copies")
    copies = packages.sparkSession.read.parquet(f"{scratch}/copies")
    _copy(copies, folder)
    return _action_log(copies.withColumn("action", F.lit("copy")))


def update_store(packages: DataFrame, folder: str | None, scratch: str) -> DataFrame:
    """Put the newest package per base name in place of all its stored versions, as one new version of the store; the log of what was done.

    Raises ``StoreChanged`` if another run changed the store meanwhile.
    """
    spark, target = packages.sparkSession, _store(folder)
    if target is None:
        return _workflow_log(spark, f"No valid store folder, nothing copied: {folder}")
    return _action_log(_change(spark, target, lambda there: store_actions(there, packages), scratch))


def remove_from_store(removals: DataFrame, folder: str | None, scratch: str) -> DataFrame:
    """Remove the stored packages whose base name is listed, as one new version of the store."""
    spark, target = removals.sparkSession, _store(folder)
    if target is None:
        return _workflow_log(spark, f"No valid store folder, nothing removed: {folder}")
    return _action_log(_change(spark, target, lambda there: select_removed(there, removals).withColumn("action", F.lit("remove")), scratch))


def _gatherer(folder: str, run: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted names to pieces of text, put aside; each name after a line feed."""

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, names, size = TaskContext.get().partitionId(), 0, [], 0
        with contextlib.closing(BodyFile(folder, run)) as body:

            def close() -> pa.RecordBatch:
                at = body.put(b"".join(names))
                columns = {"seq": part * PIECES + piece, "size": size, "at": at}
                return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in columns.values()), pa.array([body.path])], names=[*columns, "body"])

            for batch in batches:
                for name in batch["name"].to_pylist():
                    names.append(b"\n" + name.encode("utf-8"))
                    size += len(names[-1])
                    if size >= TEXT_BYTES:
                        yield close()
                        piece, names, size = piece + 1, [], 0
            if names:
                yield close()

    return gather


def write_removal_list(names: DataFrame, folder: str, scratch: str) -> bool:
    """Write the sorted names, one per line, as the removal file; without names there is none."""
    spark, folder, run = names.sparkSession, local_folder(folder), uuid.uuid4().hex
    ship_package(spark)
    names.select("name").where("name is not null").distinct().write.parquet(f"{scratch}/names")
    names = spark.read.parquet(f"{scratch}/names")
    if names.isEmpty():
        return False
    os.makedirs(folder, exist_ok=True)
    try:
        placed = names.repartitionByRange("name").sortWithinPartitions("name")
        placed.mapInArrow(_gatherer(folder, run), "seq long, size long, at long, body string").write.parquet(f"{scratch}/pieces")
        pieces = spark.read.parquet(f"{scratch}/pieces").withColumn("file", F.lit(model.REMOVAL_FILE))
        # sums of pieces per task, then over tasks; the first line feed is left out
        before = sums_before(pieces, ["file"], "seq", ["size"])
        first = F.when(F.col("size_before") == 0, 1).otherwise(0).cast("long")
        parts = before.select(
            "file", F.greatest(F.col("size_before") - 1, F.lit(0)).alias("offset"), (F.col("size") - first).alias("size"),
            F.lit(None).cast("binary").alias("content"), "body", (F.col("at") + first).alias("at"),
        )
        write_placed(parts, folder, run)
    except BaseException:
        discard(folder, run)
        raise
    return True
