"""What a run leaves on the disk while it goes on: shuffles and staged lines go when no plan needs them any more."""

from __future__ import annotations

import os
import time
import zipfile

from pyspark.sql import functions as F

from kelpline import session
from kelpline.plans import archives as plans
from kelpline.policy import Policy
from kelpline.sinks import packages as pk
from kelpline.sources import tables


def _lines(spark, n=40_000):
    rows = spark.range(n, numPartitions=4).select(F.lit("a.zip").alias("package"), (F.col("id") + 1).alias("seq"), F.concat(F.lit("x"), "id").alias("text"))
    return rows.unionByName(spark.createDataFrame([("a.zip", 0, "name")], rows.schema))


def _shuffles(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = [os.path.join(at, name) for folder in folders for at, _, names in os.walk(folder) for name in names]
    # a file may go meanwhile
    return {f: os.path.getsize(f) for f in files if os.path.basename(f).startswith("shuffle_") and os.path.exists(f)}


def test_shuffles_of_written_packages_go(spark, tmp_path):
    before = _shuffles(spark)
    pk.write_packages(_lines(spark).repartition(5, F.xxhash64("seq")), str(tmp_path / "z"), session.scratch_folder(spark))
    for _ in range(50):
        left = sum(size for f, size in _shuffles(spark).items() if f not in before)
        if left < 10_000:
            break
        time.sleep(0.2)
    # that of the lines has several times as much
    assert left < 10_000


def _published(spark, tmp_path, monkeypatch, validators=()):
    """The table in which lines are staged, and what was published."""
    (tmp_path / "in").mkdir()
    with zipfile.ZipFile(tmp_path / "in/a_version_1.zip", "w") as archive:
        archive.writestr("shark_data.txt", "data_type_internal\tvalue\nepibenthos\t1\n\nepibenthos\t2\n")
    folders, real = [], plans.src.stage_packages
    monkeypatch.setattr(plans.src, "stage_packages", lambda packages, folder, *a: folders.append(folder) or real(packages, folder, *a))
    codes = spark.createDataFrame([("sample_project", "7", "Sju")], tables.CODES_SCHEMA)
    areas = spark.createDataFrame([("RC", 1, i, y, x) for i, (y, x) in enumerate([(56.0, 12.0), (56.0, 16.0), (58.0, 16.0)])], tables.AREAS_SCHEMA)
    done = plans.publish_archives(spark, str(tmp_path / "in"), str(tmp_path / "out"), codes, areas, Policy(), validators=validators)
    return folders[0].removeprefix("file:"), done


def test_staged_lines_go_when_archives_are_written(spark, tmp_path, monkeypatch):
    staged, done = _published(spark, tmp_path, monkeypatch)
    assert "kind=header" in os.listdir(staged) and "kind=line" not in os.listdir(staged)
    assert [r.msg for r in done.log.collect() if "Blank" in r.msg] == ["Blank lines left out in 1 lines"]
    assert (done.failed.count(), done.refused.count()) == (0, 0)
    with zipfile.ZipFile(tmp_path / "out/a_version_1.zip") as archive:
        assert len(archive.read("shark_data.txt").split(b"\n")) == 4


def test_staged_lines_stay_for_validators(spark, tmp_path, monkeypatch):
    told = lambda rows: rows.select(F.lit("a").alias("package"), F.lit("info").alias("level"), F.lit("validation").alias("log_type"), F.col("value").alias("msg"))
    _, done = _published(spark, tmp_path, monkeypatch, (told,))
    assert {"1", "2"} <= {r.msg for r in done.log.collect()}


def test_tables_are_put_aside_squeezed(spark, tmp_path, monkeypatch):
    aside, real = [], pk.write_placed

    def placed(parts, folder, run):
        aside.append(sum(os.path.getsize(f"{at}/{name}") for at, _, names in os.walk(f"{folder}/.{run}/bodies") for name in names))
        return real(parts, folder, run)

    monkeypatch.setattr(pk, "write_placed", placed)
    files = {r.file: r["size"] for r in pk.write_table_files(_lines(spark), str(tmp_path / "t"), session.scratch_folder(spark), in_order=True).collect()}
    data = (tmp_path / "t/a.zip/shark_data.txt").read_bytes()
    assert data == "".join(f"{x}\n" for x in ["name", *[f"x{i}" for i in range(40_000)]]).encode()
    assert files == {"a.zip/shark_data.txt": len(data)}
    # not as much again as the files will have
    assert 0 < aside[0] < len(data) / 2


def _files(folder):
    return {str(p.relative_to(folder)): p.read_bytes() for p in sorted(folder.rglob("*.csv"))}


def test_rows_of_data_tables_are_not_shuffled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pk, "FILE_BYTES", 50_000)
    names = ["a:b.zip", "c.zip", None]
    package = F.array(*map(F.lit, names))[(F.col("id") % 3).cast("int")]
    rows = spark.range(30_000, numPartitions=4).select(package.alias("package"), F.concat(F.lit("x"), "id").alias("one"), F.when(F.col("id") % 2 == 0, F.lit("å\t€中")).alias("two"))
    before = _shuffles(spark)
    pk.write_data_table(rows, str(tmp_path / "t"))
    # several files of a package, each with a header; folders are named as Spark names them
    found = _files(tmp_path / "t")
    assert {f.split("/")[0] for f in found} == {"package=a%3Ab.zip", "package=c.zip", "package=__HIVE_DEFAULT_PARTITION__"} and len(found) > 3
    assert all(data.startswith(b"one\ttwo\n") and data.endswith(b"\n") for data in found.values())
    lines = {f: [] for f in ("a%3Ab.zip", "c.zip", "__HIVE_DEFAULT_PARTITION__")}
    for f, data in found.items():
        lines[f.split("/")[0].split("=", 1)[1]] += data.decode("cp1252").split("\n")[1:-1]
    expected = lambda k: sorted(f"x{i}\t" + ("å €?" if i % 2 == 0 else "") for i in range(k, 30_000, 3))
    assert [sorted(v) for v in lines.values()] == [expected(k) for k in range(3)]
    back = spark.read.csv(str(tmp_path / "t"), sep="\t", header=True, encoding="ISO-8859-1", quote="")
    assert back.groupBy("package").count().collect() and back.count() == 30_000
    # only what tells of segments was shuffled
    assert sum(size for f, size in _shuffles(spark).items() if f not in before) < 10_000
    assert not [p for p in os.listdir(tmp_path / "t") if p.startswith(".")]


def test_package_tables_are_put_aside_squeezed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pk, "FILE_BYTES", 50_000)
    seen, real = [], pk._staged_segments
    monkeypatch.setattr(pk, "_staged_segments", lambda lines, *a: seen.append(lines.columns) or real(lines, *a))
    for name, lines, in_order in (("o", _lines(spark), True), ("m", _lines(spark).repartition(5, F.xxhash64("seq")), False)):
        pk.write_package_tables(lines, str(tmp_path / name), in_order)
        found = _files(tmp_path / name)
        assert len(found) > 1 and {f.split("/")[0] for f in found} == {"package=a.zip"}
        # the files follow each other in the order of their names
        assert b"".join(found.values()).decode().split("\n")[:-1] == ["name", *[f"x{i}" for i in range(40_000)]]
    assert len(seen) == 2


def test_data_tables_hold_few_bytes(spark, tmp_path, monkeypatch):
    """Many packages in a task: what is held of all is bounded."""
    monkeypatch.setattr(pk, "HELD_BYTES", 1_000)
    rows = spark.range(5_000, numPartitions=2).select(F.concat(F.lit("p"), F.col("id") % 50).alias("package"), F.col("id").alias("a"))
    pk.write_data_table(rows, str(tmp_path / "t"))
    found = _files(tmp_path / "t")
    assert len(found) == 50 and sorted(int(x) for d in found.values() for x in d.decode().split("\n")[1:-1]) == [*range(5_000)]
