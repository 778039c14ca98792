"""Members by their place in the archive, tables by their fixed name, versions of stores, and what the plans may move."""

import os
import pathlib
import warnings
import zipfile

import pytest
from pyspark.sql import functions as F

from kelpline import model
from kelpline.plans.archives import publish_archives
from kelpline.policy import Policy
from kelpline.session import scratch_folder, setting
from kelpline.sinks import packages as pk
from kelpline.sinks import stores
from kelpline.sources import archives as src
from kelpline.sources import tables


@pytest.fixture
def lookups(spark):
    codes = spark.createDataFrame([("sample_project", "7", "Sju")], tables.CODES_SCHEMA)
    ring = [(56.0, 12.0), (56.0, 16.0), (58.0, 16.0), (58.0, 12.0)]
    areas = spark.createDataFrame([("RC", 1, i, y, x) for i, (y, x) in enumerate(ring)], tables.AREAS_SCHEMA)
    return codes, areas


def make_zip(path, members, method=zipfile.ZIP_DEFLATED):
    path.parent.mkdir(exist_ok=True)
    with zipfile.ZipFile(path, "w", method) as z, warnings.catch_warnings():
        warnings.simplefilter("ignore")
        for name, data in members:
            z.writestr(name, data)


def read_zip(path):
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and len(z.namelist()) == len(set(z.namelist()))
        return {n: z.read(n) for n in z.namelist()}


def staged_from(spark, folder, **options):
    return src.stage_packages(src.list_packages(spark, folder), scratch_folder(spark), **options)


def contents(staged):
    out = {}
    for r in src.read_files(staged).orderBy("package", "member", "seq").collect():
        out[r.package, r.member] = out.get((r.package, r.member), b"") + bytes(r.content)
    return out


def test_one_archive_is_the_work_of_many_tasks(spark, tmp_path):
    members = [(f"d/{i}.bin", bytes([i % 251]) * (1000 + i)) for i in range(60)]
    make_zip(tmp_path / "in" / "a.zip", [(model.DATA_FILE, "v\n1\n"), *members])
    path = f"file:{tmp_path}/in/a.zip"
    directory = spark.createDataFrame([("a.zip", path)], "package string, path string").mapInArrow(src._directories, src.DIRECTORY_SCHEMA)
    rows = src.member_rows(directory).where("kind = 'file'")
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("Exchange", 1)[1]
    found = contents(staged_from(spark, str(tmp_path / "in")))
    assert found == {("a.zip", name): data for name, data in members}


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA])
def test_methods_of_compression(spark, tmp_path, method):
    make_zip(tmp_path / "in" / "a.zip", [("x.bin", os.urandom(3_000_000)), (model.DATA_FILE, "v\n1\n"), ("empty", b""), ("f/", b"")], method)
    staged = staged_from(spark, str(tmp_path / "in"))
    assert src.failed_packages(staged).count() == 0 and [r.v for r in src.read_data_table(staged).collect()] == ["1"]
    assert contents(staged)["a.zip", "x.bin"] == read_zip(tmp_path / "in" / "a.zip")["x.bin"]


def test_repeated_members(spark, tmp_path, lookups):
    """The last of a name counts, as when an archive is unpacked; the others of the run are published."""
    make_zip(tmp_path / "in" / "a.zip", [(model.DATA_FILE, "v\nold\n"), ("n.txt", "one"), ("n.txt", "two and more"), (model.DATA_FILE, "v\nnew\n"), ("n.txt", "3")])
    make_zip(tmp_path / "in" / "b.zip", [(model.DATA_FILE, "v\nb\n")])
    done = publish_archives(spark, str(tmp_path / "in"), str(tmp_path / "out"), *lookups, Policy())
    a = read_zip(tmp_path / "out" / "a.zip")
    assert a["n.txt"] == b"3" and a[model.DATA_FILE].startswith(b"v\t") and b"\nnew" in a[model.DATA_FILE] and b"old" not in a[model.DATA_FILE]
    assert (tmp_path / "out" / "b.zip").exists() and done.failed.count() == 0
    assert sorted(r.msg for r in done.log.collect() if r.package == "a.zip") == [src.AGAIN + "n.txt", src.AGAIN + model.DATA_FILE]


def test_damaged_members_fail_their_package(spark, tmp_path, lookups):
    whole = tmp_path / "in" / "whole.zip"
    make_zip(whole, [(model.DATA_FILE, "v\n1\n"), ("x.bin", b"abc" * 1000)], zipfile.ZIP_STORED)
    data = whole.read_bytes()
    at = data.index(b"abcabc")
    (tmp_path / "in" / "changed.zip").write_bytes(data[: at + 9] + b"Z" + data[at + 10 :])
    (tmp_path / "in" / "cut.zip").write_bytes(data[200:])
    locked = bytearray(data)
    for magic, place in ((b"PK\3\4", 6), (b"PK\1\2", 8)):
        first = data.index(magic)
        locked[first + place] |= 1
    (tmp_path / "in" / "locked.zip").write_bytes(bytes(locked))
    done = publish_archives(spark, str(tmp_path / "in"), str(tmp_path / "out"), *lookups, Policy())
    failed = {r.package: r.error for r in done.failed.collect()}
    assert set(failed) == {"changed.zip", "cut.zip", "locked.zip"} and "CRC" in failed["changed.zip"] and "encrypted" in failed["locked.zip"]
    assert [p.name for p in (tmp_path / "out").iterdir()] == ["whole.zip"]


def test_file_systems_that_are_not_mounted(spark, tmp_path):
    make_zip(tmp_path / "in" / "small.zip", [(model.DATA_FILE, "v\ns\n"), ("n.txt", "a"), ("n.txt", "b")])
    make_zip(tmp_path / "in" / "large.zip", [(model.DATA_FILE, "v\nl\n"), ("x", os.urandom(5000))])
    (tmp_path / "in" / "bad.zip").write_bytes(b"no")
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("fs.viewfs.mounttable.kelp.link./in", f"file://{tmp_path}/in")
    staged = staged_from(spark, "viewfs://kelp/in", row_bytes=2000)
    assert [r.v for r in src.read_data_table(staged).collect()] == ["s"] and contents(staged) == {("small.zip", "n.txt"): b"b"}
    failed = {r.package: r.error for r in src.failed_packages(staged).collect()}
    assert set(failed) == {"large.zip", "bad.zip"} and "more than 2000 bytes" in failed["large.zip"]
    assert any(r.msg == src.AGAIN + "n.txt" for r in src.reading_notes(staged).collect())


def test_archives_through_arrow(tmp_path):
    make_zip(tmp_path / "in" / "a.zip", [(model.DATA_FILE, "v\n1\n")])
    with src._open(f"{pathlib.Path(tmp_path / 'in' / 'a.zip').as_uri()}") as body:
        assert [r["member"] for r in src._directory("a.zip", "", body)] == [model.DATA_FILE]
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(pathlib.Path(tmp_path / "in" / "a.zip").as_uri())
    import pyarrow as pa

    with pa.PythonFile(system.open_input_file(name), mode="r") as body:
        rows = list(src._directory("a.zip", "", body))
    with pa.PythonFile(system.open_input_file(name), mode="r") as body:
        assert src._member_stream(body, rows[0]).read() == b"v\n1\n"


def test_marks_and_blank_lines(spark, tmp_path, lookups):
    header = "delivery_datatype\tscientific_name\tsample_latitude_dd\tsample_longitude_dd"
    rows = "epibenthos\tCOVER röck\t57\t13\r\n"
    folder = tmp_path / "in"
    make_zip(folder / "marked.zip", [(model.DATA_FILE, f"﻿{header}\n\n\n{rows}".encode())])
    make_zip(folder / "plain.zip", [(model.DATA_FILE, f"\n{header}\n{rows}".encode("cp1252"))])
    make_zip(folder / "seal.zip", [(model.DATA_FILE, f"﻿{header}\nSeal Pathology\tx\t57\t13\n".encode())])
    make_zip(folder / "wide.zip", [(model.DATA_FILE, f"{header}\n{rows}".encode("utf-16"))])
    make_zip(folder / "none.zip", [(model.DATA_FILE, "scientific_name\nx\n")])
    make_zip(folder / "more.zip", [(model.DATA_FILE, "\ndelivery_datatype\n\n\nepibenthos\textra\n")])
    make_zip(folder / "hollow.zip", [(model.DATA_FILE, f"﻿{header}\n\n")])
    done = publish_archives(spark, str(folder), str(tmp_path / "out"), *lookups, Policy(restrict=True, dont=("sealpathology",)))
    assert {p.name for p in (tmp_path / "out").iterdir()} == {"marked.zip", "plain.zip", "hollow.zip"}
    for name in ("marked.zip", "plain.zip"):
        lines = [x.split("\t") for x in read_zip(tmp_path / "out" / name)[model.DATA_FILE].decode("cp1252").split("\n")[:-1]]
        assert lines[0][0] == "delivery_datatype" and dict(zip(*lines))["scientific_name"] == "NA"
    assert [r.msg for r in done.refused.collect()] == ["seal.zip (data type Seal Pathology not allowed)"]
    failed = {r.package: r.error for r in done.failed.collect()}
    assert set(failed) == {"wide.zip", "none.zip", "more.zip"} and "UTF-16" in failed["wide.zip"] and "no data type" in failed["none.zip"]
    assert "line 5 has more cells" in failed["more.zip"]
    log = {(r.package, r.msg) for r in done.log.collect()}
    assert {("marked.zip", "Blank lines left out in 2 lines"), ("plain.zip", "Blank lines left out in 1 lines")} <= log
    assert ("marked.zip", "Read as UTF-8, as the data table is marked") in log and ("none.zip", f"none.zip -> {failed['none.zip']}") in log


def test_text_blocks_at_every_cut(monkeypatch):
    import io

    text = "﻿a\tö\r\n\nb\n\n\r\nlast".encode()
    expected = ["a\tö", "", "b", "", "", "last"]
    for size in range(4, len(text) + 2):
        monkeypatch.setattr(src, "PART_BYTES", size)
        told = {}
        assert [line for block in src._text_blocks(io.BytesIO(text), told) for line in block] == expected and len(told) == 1
        assert [line for block in src._text_blocks(io.BytesIO(text + b"\r\n"), {}) for line in block] == expected
    assert list(src._text_blocks(io.BytesIO(b""), {})) == []


def test_tables_by_their_fixed_name(spark, tmp_path):
    n = 40_000
    lines = spark.range(0, n).select(
        F.when(F.col("id") % 2 == 0, "p0").otherwise(F.concat(F.lit("ö"), F.col("id") % 6)).alias("package"),
        F.col("id").alias("seq"), F.concat(F.lit("line "), "id", F.repeat(F.lit("å€"), 20)).alias("text"),
    )
    sizes = {r.file: r["size"] for r in pk.write_table_files(lines, str(tmp_path / "t"), scratch_folder(spark)).collect()}
    pk.write_packages(lines, str(tmp_path / "z"), scratch_folder(spark))
    found = {str(p.relative_to(tmp_path / "t")): p.read_bytes() for p in (tmp_path / "t").rglob("*") if p.is_file()}
    assert {k: len(v) for k, v in found.items()} == sizes and set(found) == {f"{p}/{model.DATA_FILE}" for p in ("p0", "ö1", "ö3", "ö5")}
    for name, data in found.items():
        assert data == read_zip(tmp_path / "z" / name.split("/")[0])[model.DATA_FILE]
    assert found[f"p0/{model.DATA_FILE}"].decode("cp1252").split("\n")[:-1] == [f"line {i}" + "å€" * 20 for i in range(0, n, 2)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_carries_contents(spark, tmp_path, monkeypatch):
    """Bodies are put aside once and copied to their places: what is shuffled are rows of sizes and places."""
    seen = {}
    monkeypatch.setattr(pk, "write_placed", lambda parts, folder, run=None: seen.update(parts=parts) or parts)
    lines = spark.range(0, 1000).select(F.lit("p").alias("package"), F.col("id").alias("seq"), F.col("id").cast("string").alias("text"))
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        scratch = scratch_folder(spark)
        pk.write_packages(lines, str(tmp_path / "out"), scratch)
        plan = plan_of(seen["parts"])
        assert "Exchange" in plan and "comp" in plan
    assert [c for c, kind in spark.read.parquet(f"{scratch}/segments").dtypes if kind == "binary"] == []
    assert seen["parts"].where("content is not null").agg(F.max(F.length("content"))).first()[0] < 200


def test_log_reads_no_lines_again(spark, tmp_path, lookups):
    header = "data_type_internal\tsample_time\tsample_project_code\tsample_latitude_dd\tsample_longitude_dd"
    rows = ["profile\t25:61\t8\t57\t13", "profile\t25:61\t7\t70\t13", "profile\t9:5\t8\t70\t13", "\tx\t\t70\t13"]
    make_zip(tmp_path / "in" / "a_version_1.zip", [(model.DATA_FILE, "\n".join([header, *rows]) + "\n")])
    done = publish_archives(spark, str(tmp_path / "in"), str(tmp_path / "out"), *lookups, Policy(restrict=True))
    assert len(read_zip(tmp_path / "out" / "a_version_1.zip")[model.DATA_FILE].split(b"\n")) == 5
    assert sorted(r.msg for r in done.log.collect()) == [
        "No name for sample_project code 8 (2 rows)", "Unreadable sample_time 25:61 (2 rows)", "Unreadable sample_time x (1 rows)",
    ]
    # of the staged table only the kinds that tell of errors and notes are scanned
    scans = [line for line in plan_of(done.log).split("\n") if "FileScan" in line and "PartitionFilters" in line and "kind" in line]
    assert scans and all("(kind" in s and "= line)" not in s for s in scans)
    assert not any("text#" in s and "= line" in s for s in scans)


def test_log_with_long_code_lists(spark, tmp_path, lookups):
    codes = spark.range(1, 1500).select(F.lit("sample_project").alias("field"), F.col("id").cast("string").alias("code"), F.lit("n").alias("name_sv"))
    make_zip(tmp_path / "in" / "a.zip", [(model.DATA_FILE, "sample_project_code\n7\n9999\n9999\n\n")])
    done = publish_archives(spark, str(tmp_path / "in"), str(tmp_path / "out"), codes, lookups[1], Policy())
    assert "No name for sample_project code 9999 (2 rows)" in {r.msg for r in done.log.collect()}
    assert not any("code 7 " in r.msg for r in done.log.collect())


# -- versions of a store ---------------------------------------------------------------------


@pytest.fixture
def store(spark, tmp_path):
    folder = tmp_path / "store"
    for name in ("a_version_1.zip", "b_version_1.zip", "c_version_1.zip"):
        make_zip(folder / name, [("n", name)])
    new = tmp_path / "new"
    for name in ("a_version_2.zip", "b_version_1.zip", "d_version_1.zip"):
        make_zip(new / name, [("n", "new " + name)])
    return str(folder), src.list_packages(spark, str(new)).select(F.col("package").alias("name"), "path")


OLD = {"a_version_1.zip": b"a_version_1.zip", "b_version_1.zip": b"b_version_1.zip", "c_version_1.zip": b"c_version_1.zip"}
NEW = {"a_version_2.zip": b"new a_version_2.zip", "b_version_1.zip": b"new b_version_1.zip", "c_version_1.zip": b"c_version_1.zip", "d_version_1.zip": b"new d_version_1.zip"}


def seen_by_readers(spark, folder):
    return {r.name: read_zip(r.path.removeprefix("file:"))["n"] for r in stores.list_store(spark, folder).collect()}


def in_folder(folder):
    return {p.name: read_zip(p)["n"] for p in pathlib.Path(folder).iterdir()}


def test_a_store_changes_in_one_step(spark, store, monkeypatch):
    folder, incoming = store
    assert seen_by_readers(spark, folder) == OLD
    # a run that ends while it copies: nothing has changed
    mark = stores._mark
    monkeypatch.setattr(stores, "_mark", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        stores.update_store(incoming, folder, scratch_folder(spark))
    assert seen_by_readers(spark, folder) == OLD == in_folder(folder)
    # one that ends between copies and removals: readers see the new store, and the next run completes it
    monkeypatch.setattr(stores, "_mark", mark)
    monkeypatch.setattr(stores, "_remove", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(Exception, match="lost"):
        stores.update_store(incoming, folder, scratch_folder(spark))
    assert set(in_folder(folder)) == set(OLD) | set(NEW) and seen_by_readers(spark, folder) == NEW
    monkeypatch.undo()
    none = spark.createDataFrame([], "name string")
    assert stores.remove_from_store(none, folder, scratch_folder(spark)).count() == 0
    assert in_folder(folder) == NEW == seen_by_readers(spark, folder)
    # and once more, with nothing left of earlier versions but the last
    stores.remove_from_store(spark.createDataFrame([("c.zip",)], "name string"), folder, scratch_folder(spark))
    assert set(seen_by_readers(spark, folder)) == set(NEW) - {"c_version_1.zip"}
    assert len([p for p in pathlib.Path(stores._versions(folder)).iterdir() if p.is_dir()]) == 1


def test_only_one_run_makes_a_version(spark, store, monkeypatch):
    folder, incoming = store
    copy = stores._copy

    def late(copies, into):
        copy(copies, into)
        monkeypatch.setattr(stores, "_copy", copy)
        # another run is done before this one
        stores.remove_from_store(spark.createDataFrame([("c.zip",)], "name string"), folder, scratch_folder(spark))

    monkeypatch.setattr(stores, "_copy", late)
    with pytest.raises(stores.StoreChanged):
        stores.update_store(incoming, folder, scratch_folder(spark))
    assert set(in_folder(folder)) == set(OLD) - {"c_version_1.zip"}
    stores.update_store(incoming, folder, scratch_folder(spark))
    assert set(in_folder(folder)) == set(NEW) - {"c_version_1.zip"}


def test_large_removal_lists(spark, tmp_path, monkeypatch):
    names = spark.range(0, 3000).select(F.concat(F.lit("ö"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit(".zip")).alias("name"))
    assert stores.write_removal_list(names.union(names).repartition(7), str(tmp_path), scratch_folder(spark))
    assert (tmp_path / model.REMOVAL_FILE).read_bytes() == "\n".join(f"ö{i:06d}.zip" for i in range(3000)).encode()
    assert [p.name for p in tmp_path.iterdir()] == [model.REMOVAL_FILE]
