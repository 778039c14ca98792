"""Zip packages made from the observations, in the shared scratch folder."""

from __future__ import annotations

import codecs
import functools
import os
import shutil
import warnings
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from kelpline.session import scratch_folder, ship_package, shuffles_removed
from kelpline.sinks.packages import number_lines, render_lines, write_packages, write_table_files
from kelpline.sinks.placed import local_folder, write_placed
from kelpline.sources.archives import list_packages

VERSION = "_version_2024-05-01.zip"
#: Bytes of a member held at once.
PIECE = 1024 * 1024
OTHER_MEMBERS = {
    "shark_metadata.txt": b"metadata\n",
    "processed_data/data.txt": b"",
    "received_data/raw.csv": b"a;b\n1;2\n",
    "README.txt": "Läs mig\n".encode("cp1252"),
}


def package_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.observations(spark, sf_dir).withColumn("package", F.concat("dataset_name", F.lit(VERSION)))


def numbered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with ``_line``, in the order of packages and lines."""
    return fx.numbered_observations(spark, sf_dir, VERSION, lambda rows, made: number_lines(rows, ["row_number"], made=made))


def package_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``package, dataset_name``, found once for all that is written."""
    folder = scratch_folder(spark)
    with shuffles_removed(spark):
        package_rows(spark, sf_dir).select("package", "dataset_name").distinct().write.parquet(folder)
    return spark.read.parquet(folder)


def rendered(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Numbered rows as lines, which keep their order."""
    return render_lines(rows, names.select("package"))


def rendered_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered(numbered_rows(spark, sf_dir), package_names(spark, sf_dir))


def with_members(packages: DataFrame, members: dict[str, bytes]) -> DataFrame:
    member = F.explode(F.array(*[F.struct(F.lit(k).alias("member"), F.lit(v).alias("content")) for k, v in members.items()]))
    return packages.withColumn("m", member).select("package", "m.member", F.lit(0).cast("long").alias("seq"), "m.content")


def _write(spark: SparkSession, sf_dir: str, folder: str) -> None:
    names = package_names(spark, sf_dir)
    files = with_members(names.select("package"), OTHER_MEMBERS)
    write_packages(rendered(numbered_rows(spark, sf_dir), names), folder, scratch_folder(spark), files, in_order=True)


def built_mixed(spark: SparkSession, sf_dir: str) -> str:
    """Archives of which those of odd years name their type in ``delivery_datatype`` only."""
    rows, names = numbered_rows(spark, sf_dir), package_names(spark, sf_dir)
    odd = F.right("dataset_name", F.lit(1)).isin("1", "3", "5", "7", "9")
    other = rows.where(odd).withColumnRenamed("data_type_internal", "delivery_datatype")
    folder = scratch_folder(spark)
    lines = rendered(rows.where(~odd), names.where(~odd)).unionByName(rendered(other, names.where(odd)))
    write_packages(lines, folder, scratch_folder(spark), in_order=True)
    return folder


def built_twice(spark: SparkSession, sf_dir: str) -> list[str]:
    """Two folders with archives of the same names; the values of the first are others."""
    rows, names = numbered_rows(spark, sf_dir), package_names(spark, sf_dir)
    root = scratch_folder(spark)
    write_packages(rendered(rows.withColumn("value", F.lit("old")), names), f"{root}/a", scratch_folder(spark), in_order=True)
    write_packages(rendered(rows, names), f"{root}/b", scratch_folder(spark), in_order=True)
    return [f"{root}/b", f"{root}/a"]


def built_lines(spark: SparkSession, sf_dir: str, header: str, columns: list, members: dict[str, bytes] | None = None) -> str:
    """Archives with a header and lines as they are given."""
    rows = numbered_rows(spark, sf_dir)
    text = F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    names = package_names(spark, sf_dir).select("package")
    lines = rows.select("package", F.col("_line").alias("seq"), text.alias("text"))
    lines = lines.unionByName(names.select("package", F.lit(0).cast("long").alias("seq"), F.lit(header).alias("text")))
    folder = scratch_folder(spark)
    write_packages(lines, folder, scratch_folder(spark), with_members(names, members) if members else None, in_order=True)
    return folder


def _rezip(folder: str):
    """Each archive again, with a table and a readme before those that count."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for package, path in zip(batch["package"].to_pylist(), batch["path"].to_pylist()):
                with zipfile.ZipFile(local_folder(path)) as old, zipfile.ZipFile(f"{folder}/{package}", "w", zipfile.ZIP_DEFLATED) as new:
                    with warnings.catch_warnings():
                        warnings.simplefilter("ignore")
                        new.writestr("shark_data.txt", "data_type_internal\tvalue\nepibenthos\told\n")
                        new.writestr("README.txt", "old\nreadme\n")
                        for name in old.namelist():
                            if name.endswith("/"):
                                new.writestr(name, b"")
                                continue
                            with old.open(name) as source, new.open(name, "w", force_zip64=True) as target:
                                shutil.copyfileobj(source, target, PIECE)
            yield batch.select(["package"])

    return write


def built_repeated(spark: SparkSession, sf_dir: str) -> str:
    """Archives in which two members are listed twice."""
    folder = local_folder(scratch_folder(spark))
    os.makedirs(folder)
    packages = list_packages(spark, built_packages(spark, sf_dir)).select("package", "path")
    packages.mapInArrow(_rezip(folder), "package string").write.format("noop").mode("overwrite").save()
    return folder


def built_tree(spark: SparkSession, sf_dir: str) -> str:
    """Unzipped packages: a folder for each, with its table."""
    folder = scratch_folder(spark)
    lines = rendered_packages(spark, sf_dir).withColumn("package", F.replace("package", F.lit(".zip"), F.lit("")))
    write_table_files(lines, folder, scratch_folder(spark), in_order=True)
    return folder


def built_marked(spark: SparkSession, sf_dir: str) -> str:
    """Archives whose tables begin with the mark of UTF-8 and have blank lines; their other text is ASCII."""
    lines = rendered_packages(spark, sf_dir)
    marked = F.when(F.col("seq") == 0, F.concat(F.lit(codecs.BOM_UTF8.decode("cp1252")), "text")).otherwise(F.col("text"))
    blank = F.when(F.col("seq") % 7 == 3, F.lit("\n\r\n")).otherwise(F.lit(""))
    folder = scratch_folder(spark)
    write_packages(lines.select("package", "seq", F.concat(blank, marked).alias("text")), folder, scratch_folder(spark), in_order=True)
    return folder


def built_untyped(spark: SparkSession, sf_dir: str) -> str:
    """Archives of which those of odd years tell no data type."""
    rows, names = numbered_rows(spark, sf_dir), package_names(spark, sf_dir)
    odd = F.right("dataset_name", F.lit(1)).isin("1", "3", "5", "7", "9")
    folder = scratch_folder(spark)
    untyped = rendered(rows.where(odd).drop("data_type_internal"), names.where(odd))
    lines = rendered(rows.where(~odd), names.where(~odd)).unionByName(untyped)
    write_packages(lines, folder, scratch_folder(spark), in_order=True)
    return folder


def _blocks(body) -> Iterator[list[str]]:
    """Lines of a member, a piece at a time; a line feed at the end ends the last line, and an empty member is one empty line.

    Reading up to the end checks the member's checksum.
    """
    rest, some = b"", False
    while piece := body.read(PIECE):
        rest += piece
        cut = rest.rfind(b"\n") + 1
        if cut:
            yield rest[: cut - 1].decode("cp1252").split("\n")
            rest, some = rest[cut:], True
    if rest or not some:
        yield [rest.decode("cp1252")]


def _members_by_zipfile(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for package, path in zip(batch["package"].to_pylist(), batch["path"].to_pylist()):
            with zipfile.ZipFile("/" + path.removeprefix("file:").lstrip("/")) as archive:
                for name in archive.namelist():
                    with archive.open(name) as body:
                        for lines in _blocks(body):
                            yield pa.RecordBatch.from_pydict({"package": [package] * len(lines), "member": [name] * len(lines), "line": lines})


def read_by_zipfile(packages: DataFrame) -> DataFrame:
    """Lines of all members as Python's own reader finds them; a damaged archive raises."""
    return packages.select("package", "path").mapInArrow(_members_by_zipfile, "package string, member string, line string")


@functools.cache
def _built(app: str, sf_dir: str, spark: SparkSession) -> str:
    ship_package(spark)
    folder = scratch_folder(spark)
    _write(spark, sf_dir, f"{folder}/in")
    return f"{folder}/in"


def built_packages(spark: SparkSession, sf_dir: str) -> str:
    """A folder with one archive per data set, written once per session."""
    return _built(spark.sparkContext.applicationId, sf_dir, spark)


def built_with_corrupt(spark: SparkSession, sf_dir: str) -> list[str]:
    """The archives, and for each data set one more file that is no archive."""
    good = built_packages(spark, sf_dir)
    folder = scratch_folder(spark)
    names = fx.observations(spark, sf_dir).select(F.concat("dataset_name", F.lit("_version_broken.zip")).alias("file")).distinct()
    broken = names.select("file", F.lit(0).cast("long").alias("offset"), F.lit(b"not an archive").alias("content"))
    write_placed(broken, f"{folder}/broken")
    return [good, f"{folder}/broken"]
