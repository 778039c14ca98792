"""Packages that differ from what is expected: nothing is lost in silence, and one does not end a run."""

import zipfile

import pytest
from pyspark.sql import functions as F

from kelpline import model
from kelpline.functions.headers import column_names, shown
from kelpline.operators.masks import select_columns_like
from kelpline.plans.archives import Target, copy_to_environment, publish_archives
from kelpline.policy import Policy
from kelpline.session import scratch_folder
from kelpline.sinks import packages as pk
from kelpline.sinks import placed, stores
from kelpline.sources import archives as src
from kelpline.sources import tables


def make_zip(folder, name, lines, newline="\n"):
    folder.mkdir(exist_ok=True)
    with zipfile.ZipFile(folder / name, "w") as z:
        z.writestr(model.DATA_FILE, (newline.join(lines) + newline).encode("cp1252"))


@pytest.fixture
def lookups(spark):
    codes = spark.createDataFrame([("sample_project", "7", "Sju")], tables.CODES_SCHEMA)
    ring = [(56.0, 12.0), (56.0, 16.0), (58.0, 16.0), (58.0, 12.0)]
    areas = spark.createDataFrame([("RC", 1, i, y, x) for i, (y, x) in enumerate(ring)], tables.AREAS_SCHEMA)
    return codes, areas


def read_table(path):
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None
        lines = [line.split("\t") for line in z.read(model.DATA_FILE).decode("cp1252").split("\n")[:-1]]
    return [dict(zip(lines[0], line)) for line in lines[1:]]


POSITION = "sample_latitude_dd\tsample_longitude_dd"


def test_masks_do_not_depend_on_other_packages(spark, tmp_path, lookups):
    """One names its type in its own column, one in the delivery type only; an empty cell stays empty."""
    folder = tmp_path / "in"
    make_zip(folder, "a_version_1.zip", [f"data_type_internal\tscientific_name\t{POSITION}", "epibenthos\tCOVER rock\t57\t13", "\tCOVER sand\t57\t13"])
    make_zip(folder, "b_version_1.zip", [f"delivery_datatype\tscientific_name\t{POSITION}", "Epi Benthos\tCOVER rock\t57\t13"])
    make_zip(folder, "c_version_1.zip", [f"delivery_datatype\tscientific_name\t{POSITION}", "profile\tx\t57\t13", "profile\ty\t70\t13"])
    out = tmp_path / "out"
    publish_archives(spark, str(folder), str(out), *lookups, Policy(restrict=True))
    a = read_table(out / "a_version_1.zip")
    assert [r["scientific_name"] for r in a] == ["NA", "NA"] and [r["data_type_internal"] for r in a] == ["epibenthos", ""]
    b = read_table(out / "b_version_1.zip")
    assert [r["scientific_name"] for r in b] == ["NA"] and "data_type_internal" not in b[0]
    assert [r["scientific_name"] for r in read_table(out / "c_version_1.zip")] == ["y"]


def test_cells_beyond_the_header(spark, tmp_path, lookups):
    folder = tmp_path / "in"
    make_zip(folder, "more.zip", ["a\tb", "1\t2\t3"])
    make_zip(folder, "blank.zip", ["a\tb", "1\t2\t\t"])
    make_zip(folder, "twice.zip", ["value\tvalue", "1\t2"])
    make_zip(folder, "ends.zip", ["a\tb", "1\rx\t2"], newline="\r\n")
    done = publish_archives(spark, str(folder), str(tmp_path / "out"), *lookups, Policy())
    failed = {r.package: r.msg for r in done.failed.collect()}
    assert set(failed) == {"more.zip", "twice.zip"} and "more cells" in failed["more.zip"] and "value more than once" in failed["twice.zip"]
    log = {(r.package, r.level, r.msg) for r in done.log.collect()}
    assert ("blank.zip", "warning", "Blank cells beyond the header in 1 lines") in log
    assert ("ends.zip", "warning", "Line ends inside cells in 1 lines") in log
    assert ("more.zip", "error", failed["more.zip"]) in log
    assert read_table(tmp_path / "out" / "ends.zip")[0]["a"] == "1 x"


def test_refusals_show_the_data_type(spark, tmp_path, lookups):
    folder = tmp_path / "in"
    make_zip(folder, "p.zip", ["delivery_datatype\ta", "Seal Pathology\t1"])
    done = publish_archives(spark, str(folder), str(tmp_path / "out"), *lookups, Policy(restrict=True, dont=("sealpathology",)))
    assert [r.msg for r in done.refused.collect()] == ["p.zip (data type Seal Pathology not allowed)"]
    assert [r.msg for r in done.log.where("level = 'error'").collect()] == ["p.zip (data type Seal Pathology not allowed)"]
    # which type a package is of can be told otherwise
    other = publish_archives(
        spark, str(folder), str(tmp_path / "o2"), *lookups, Policy(restrict=True, dont=("sealpathology",)), data_type=lambda h, r: ("other", "Other")
    )
    assert other.refused.count() == 0


def test_one_name_in_two_folders(spark, tmp_path, lookups):
    make_zip(tmp_path / "a", "x.zip", ["v", "first"])
    make_zip(tmp_path / "b", "x.zip", ["v", "second"])
    done = publish_archives(spark, [str(tmp_path / "a"), str(tmp_path / "b")], str(tmp_path / "out"), *lookups, Policy())
    assert [r["v"] for r in read_table(tmp_path / "out" / "x.zip")] == ["second"]
    assert any("a/x.zip" in r.msg for r in done.log.collect())


def test_names_in_headers():
    names = [("Secchi_note", 1), ("secchi_note", 1), ("a.b", 1), ("x`y", 1), ("", 1), ("package", 1), ("Value", 1), ("value", 1), ("note", 1), ("note", 2), ("_type", 1)]
    found = column_names(names)
    columns = [c.column for c in found]
    assert len({c.lower() for c in columns}) == len(columns) and [shown(c) for c in columns] == [n for n, _ in names]
    assert not any(ch in c for c in columns for ch in ".`") and "value" in columns and "package" not in columns and "" not in columns
    assert [shown(c) for c in select_columns_like(columns, [".*secchi.*", ".*Secchi.*", "note"])] == ["Secchi_note", "secchi_note", "note", "note"]


def test_a_lost_part_is_no_success(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"old content")
    writer = placed.PlacedWriter(str(tmp_path), "run")
    for size, part in ((11, None), (4, b"abc")):
        if part is not None:
            (tmp_path / ".run" / "parts").mkdir(parents=True)
            (tmp_path / ".run" / "parts" / "x.bin").write_bytes(part)
        with pytest.raises(OSError, match="mounted on all executors"):
            writer.commit([placed.Written({"x.bin": size - 1}), None, placed.Written({"x.bin": 1})])
    writer.abort([])
    assert (tmp_path / "x.bin").read_bytes() == b"old content" and [p.name for p in tmp_path.iterdir()] == ["x.bin"]
    parts = spark.createDataFrame([("x.bin", 0, b"ne"), ("x.bin", 2, b"w"), ("a/b.bin", 0, b"")], "file string, offset long, content binary")
    done = placed.write_placed(parts, str(tmp_path)).collect()
    assert {(r.file, r["size"]) for r in done} == {("x.bin", 3), ("a/b.bin", 0)} and (tmp_path / "x.bin").read_bytes() == b"new"
    assert sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*")) == ["a", "a/b.bin", "x.bin"]


def test_a_failed_run_leaves_nothing(spark, tmp_path):
    """A task that fails in the middle, also one that has written: no file, no hidden folder."""
    (tmp_path / "body").write_bytes(b"0123456789")
    out = tmp_path / "out"
    rows = [("x.bin", 0, 10, None, str(tmp_path / "body"), 0), ("x.bin", 10, 10, None, str(tmp_path / "body"), 5)]
    parts = spark.createDataFrame(rows, "file string, offset long, size long, content binary, body string, at long")
    with pytest.raises(Exception, match="shorter than it was"):
        placed.write_placed(parts, str(out))
    assert list(out.iterdir()) == []
    lines = spark.createDataFrame([("p", 0, "a"), ("p", 1, "b")], "package string, seq long, text string")
    with pytest.raises(Exception, match="(?i)divi"):
        pk.write_packages(lines.withColumn("text", F.when(F.col("seq") / (F.col("seq") - 1) > -5, "x")), str(out), scratch_folder(spark))
    assert list(out.iterdir()) == []


def test_copies_are_spread(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(40):
        (folder / f"p{i}.zip").write_bytes(bytes([i]) * (100 + i))
    (folder / "big.zip").write_bytes(b"x" * (3 * stores.RANGE_BYTES + 5))
    packages = src.list_packages(spark, str(folder)).select(F.col("package").alias("name"), "path")
    ranges = stores.copy_ranges(packages)
    assert ranges.where("name = 'big.zip'").count() == 4
    assert ranges.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    stores.copy_to_store(packages, str(tmp_path / "out"), scratch_folder(spark))
    assert {p.name: p.read_bytes() for p in (tmp_path / "out").iterdir()} == {p.name: p.read_bytes() for p in folder.iterdir()}


def test_copy_without_update(spark, tmp_path):
    folder = tmp_path / "in"
    make_zip(folder, "a.zip", ["delivery_datatype", "profile"])
    make_zip(folder, "b.zip", ["delivery_datatype", "epibenthos"])
    targets = {}
    for name in ("PROD", "UTVTST"):
        for kind in ("data", "store"):
            (tmp_path / name / kind).mkdir(parents=True)
        targets[name] = Target(str(tmp_path / name / "data"), str(tmp_path / name / "store"))
    done = copy_to_environment(spark, str(folder), "PROD", targets, Policy(restrict=True, dont=("profile",)))
    assert [p.name for p in (tmp_path / "PROD" / "data").iterdir()] == ["b.zip"]
    assert sorted(p.name for p in (tmp_path / "UTVTST" / "store").iterdir()) == ["a.zip", "b.zip"]
    assert any("not allowed" in r.msg for r in done["PROD"].log.collect())
    copy_to_environment(spark, str(folder), "PROD", targets, Policy(restrict=True, dont=("profile",)), allow_all=True)
    assert (tmp_path / "PROD" / "data" / "a.zip").read_bytes() == (folder / "a.zip").read_bytes()
