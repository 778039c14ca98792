"""Packages, stores and lists on files."""

import pathlib
import random
import zipfile
import zlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from kelpline import job, model
from kelpline.operators import report
from kelpline.plans.archives import Target, publish_archives, publish_to_environment, remove_from_stores, write_removals
from kelpline.policy import Policy
from kelpline.session import scratch_folder
from kelpline.sinks import packages as pk
from kelpline.sinks import stores
from kelpline.sources import archives as src
from kelpline.sources import tables

HEADER = "row_number\tdata_type_internal\tvisit_date\tsample_time\tparameter\tvalue\tstation\tsample_latitude_dd\tsample_longitude_dd"
LINES = [
    "1\tepibenthos\t1999\t9:5\tSilt cover\t10\tÅäö €\t57.0\t13.0",
    "2\tepibenthos\t1999-05\t25:61\tTemperature\t\tx\t60.0\t13.0",
]


def make_zip(folder, name, table, extra=None, newline="\r\n"):
    with zipfile.ZipFile(folder / name, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(model.DATA_FILE, (newline.join(table) + newline).encode("cp1252"))
        for member, data in (extra or {}).items():
            z.writestr(member, data)


@pytest.fixture
def incoming(tmp_path):
    folder = tmp_path / "incoming"
    folder.mkdir()
    extra = {"README.txt": "å".encode("cp1252"), "processed_data/a.txt": b"x" * 3_000_000, "empty.txt": b""}
    make_zip(folder, "Å_version_2020-01-01.zip", [HEADER, *LINES], extra)
    make_zip(folder, "noversion.zip", ["value\tparameter", "3\tSecchi depth"], newline="\n")
    make_zip(folder, "hollow_version_1.zip", [HEADER])
    (folder / "broken_version_1.zip").write_bytes(b"PK no")
    with zipfile.ZipFile(folder / "nodata.zip", "w") as z:
        z.writestr("other.txt", b"1")
    (folder / "notes.txt").write_text("no archive")
    (folder / "upper.ZIP").write_text("no archive either")
    return folder


@pytest.fixture
def lookups(spark):
    codes = spark.createDataFrame([("sample_project", "7", "Sju")], tables.CODES_SCHEMA)
    ring = [(56.0, 12.0), (56.0, 16.0), (58.0, 16.0), (58.0, 12.0)]
    areas = spark.createDataFrame([("RC", 1, i, y, x) for i, (y, x) in enumerate(ring)], tables.AREAS_SCHEMA)
    return codes, areas


def test_listing(spark, incoming, tmp_path):
    found = {r.package: (r.base_name, r.version) for r in src.list_packages(spark, str(incoming)).collect()}
    assert found["Å_version_2020-01-01.zip"] == ("Å", "2020-01-01") and found["noversion.zip"] == ("noversion", "")
    assert set(found) == {"Å_version_2020-01-01.zip", "noversion.zip", "hollow_version_1.zip", "broken_version_1.zip", "nodata.zip"}
    with pytest.raises(AnalysisException):
        src.list_packages(spark, str(tmp_path / "absent"))


def test_reading(spark, incoming):
    staged = src.stage_packages(src.list_packages(spark, str(incoming)), scratch_folder(spark))
    failed = {r.package: r.msg for r in src.failed_packages(staged).collect()}
    assert set(failed) == {"broken_version_1.zip", "nodata.zip"}
    assert failed["nodata.zip"] == "nodata.zip -> ValueError: no shark_data.txt"
    table = src.read_data_table(staged)
    rows = {(r.package, r._line): r for r in table.collect()}
    assert len(rows) == 3 and rows["Å_version_2020-01-01.zip", 1].station == "Åäö €"
    assert rows["noversion.zip", 1].station == "" and rows["noversion.zip", 1].value == "3"
    assert rows["Å_version_2020-01-01.zip", 2].value == ""
    parts = src.read_files(staged).where(F.col("member") == "processed_data/a.txt")
    assert parts.count() == 3 and parts.agg(F.sum(F.length("content"))).first()[0] == 3_000_000


def read_zip(path):
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None
        return {n: z.read(n) for n in z.namelist()}


def test_publish_unrestricted_round_trip(spark, incoming, tmp_path, lookups):
    out = tmp_path / "out"
    done = publish_archives(spark, str(incoming), str(out), *lookups, Policy())
    names = {"Å_version_2020-01-01.zip", "noversion.zip", "hollow_version_1.zip"}
    assert {r.file for r in done.archives.collect()} == names == {p.name for p in out.iterdir()}
    got = read_zip(out / "Å_version_2020-01-01.zip")
    assert got["README.txt"] == "å".encode("cp1252") and got["processed_data/a.txt"] == b"x" * 3_000_000 and got["empty.txt"] == b""
    lines = got[model.DATA_FILE].decode("cp1252").split("\n")
    own = [c for c in HEADER.split("\t") if c != "row_number"]
    header = lines[0].split("\t")
    # own columns first and in order, less the dropped one; no column only another package has
    assert header[: len(own)] == own and "location_rc" not in header and lines[-1] == ""
    first = dict(zip(header, lines[1].split("\t")))
    assert first["station"] == "Åäö €" and first["sample_time"] == "09:05" and first["visit_date"] == "1999-01-01"
    assert first["reported_visit_date"] == "1999" and first["sample_date"] == "1999-01-01" and first["value"] == "10"
    assert len(lines) == 4
    other = read_zip(out / "noversion.zip")[model.DATA_FILE].decode("cp1252").split("\n")
    assert other[0].split("\t")[:2] == ["value", "parameter"] and other[1].split("\t")[:2] == ["3", "Secchi depth"]
    assert len(read_zip(out / "hollow_version_1.zip")[model.DATA_FILE].decode().strip().split("\n")) == 1
    assert done.refused.count() == 0 and done.failed.count() == 2
    assert any("Unreadable sample_time 25:61" in r.msg for r in done.log.collect())


def test_publish_restricted_refuses_masks_and_prunes(spark, incoming, tmp_path, lookups):
    out = tmp_path / "out"
    policy = Policy(restrict=True, only=("epibenthos",))
    done = publish_archives(spark, str(incoming), str(out), *lookups, policy, prune=True)
    assert [p.name for p in out.iterdir()] == ["Å_version_2020-01-01.zip"]
    assert {r.msg for r in done.refused.collect()} == {
        "noversion.zip (data type  not allowed)", "hollow_version_1.zip (data type  not allowed)",
    }
    got = read_zip(out / "Å_version_2020-01-01.zip")
    assert set(got) == {model.DATA_FILE, "empty.txt"}
    lines = [line.split("\t") for line in got[model.DATA_FILE].decode("cp1252").split("\n")[:-1]]
    found = [dict(zip(lines[0], line)) for line in lines[1:]]
    assert [r["value"] for r in found] == ["999", ""] and [r["location_rc"] for r in found] == ["true", "false"]
    assert any("files left" in r.msg for r in done.log.collect())


def test_environment_and_removal(spark, incoming, tmp_path, lookups):
    targets = {}
    for name in ("PROD", "UTVTST", "UTV"):
        for kind in ("data", "store"):
            (tmp_path / name / kind).mkdir(parents=True)
        targets[name] = Target(str(tmp_path / name / "data"), str(tmp_path / name / "store"))
        make_zip(tmp_path / name / "store", "Å_version_2010-01-01.zip", [HEADER])
    results = publish_to_environment(
        spark, str(incoming), "PROD", targets, str(tmp_path / "work"), *lookups, Policy(restrict=True)
    )
    assert set(results) == {"PROD", "UTVTST"}
    stored = sorted(p.name for p in (tmp_path / "PROD" / "store").iterdir())
    # nothing tells what to mask in a package of unknown type: it only goes where nothing is masked
    assert stored == ["hollow_version_1.zip", "Å_version_2020-01-01.zip"]
    assert any(r.package == "noversion.zip" and "no data type" in r.error for r in results["PROD"].failed.collect())
    assert (tmp_path / "UTVTST" / "store" / "noversion.zip").exists() and results["UTVTST"].failed.count() == 2
    prod = read_zip(tmp_path / "PROD" / "data" / "Å_version_2020-01-01.zip")[model.DATA_FILE].decode("cp1252")
    follower = read_zip(tmp_path / "UTVTST" / "data" / "Å_version_2020-01-01.zip")[model.DATA_FILE].decode("cp1252")
    assert "\t999\t" in prod and "\t999\t" not in follower
    messages = {r.msg for r in results["PROD"].log.collect()}
    assert "Removing old package: Å_version_2010-01-01.zip" in messages

    names = spark.createDataFrame([("noversion.zip",), ("Å_version_1.zip",)], "name string")
    write_removals(spark, names, "PROD", targets)
    write_removals(spark, names.limit(1), "PROD", targets)
    assert (tmp_path / "UTV" / "data" / model.REMOVAL_FILE).read_bytes() == "noversion.zip\nÅ_version_1.zip".encode()
    waiting = tables.read_name_list(spark, f"{targets['PROD'].datasets}/{model.REMOVAL_FILE}")
    remove_from_stores(spark, waiting, "PROD", targets)
    assert [p.name for p in (tmp_path / "PROD" / "store").iterdir()] == ["hollow_version_1.zip"]
    assert [p.name for p in (tmp_path / "UTV" / "store").iterdir()] == []


def test_store_that_is_missing_is_only_logged(spark, tmp_path):
    packages = spark.createDataFrame([("a.zip", "/nowhere/a.zip")], "name string, path string")
    for folder in (None, str(tmp_path / "absent")):
        log = stores.update_store(packages, folder, scratch_folder(spark)).collect()
        assert len(log) == 1 and "nothing copied" in log[0].msg


def test_large_package_is_many_segments(spark, tmp_path):
    n = 60_000
    lines = spark.range(1, n + 1).select(
        F.when(F.col("id") % 3 == 0, "big.zip").otherwise(F.concat(F.lit("p"), F.col("id") % 5, F.lit(".zip"))).alias("package"),
        F.col("id").alias("seq"),
        F.concat(F.lit("line "), "id", F.lit("\t"), F.repeat(F.lit("å"), 40)).alias("text"),
    )
    scratch = scratch_folder(spark)
    pk.write_packages(lines, str(tmp_path / "out"), scratch)
    assert spark.read.parquet(f"{scratch}/segments").where(F.col("package") == "big.zip").count() > 2
    got = read_zip(tmp_path / "out" / "big.zip")[model.DATA_FILE].decode("cp1252").split("\n")[:-1]
    assert got == [f"line {i}\t" + "å" * 40 for i in range(3, n + 1, 3)]
    assert len(list((tmp_path / "out").iterdir())) == 6


def test_checksum_shares():
    rng = random.Random(1)
    data = rng.randbytes(100_000)
    cuts = [0, 1, 17, 5000, 5000, 70_001, 100_000]
    total = 0
    for a, b in zip(cuts, cuts[1:]):
        total ^= pk.crc_followed_by(zlib.crc32(data[a:b]), len(data) - b)
    assert total == zlib.crc32(data)
    assert pk.crc_followed_by(zlib.crc32(b"ab"), 0) == zlib.crc32(b"ab")


def test_zip64_records():
    entry = {"member": "d", "raw": 5 << 32, "comp": 4 << 32, "crc": 1, "big": True, "far": True, "start": 1 << 33}
    assert len(pk._local_record(entry)) == pk.LOCAL_HEADER + 1 + pk.LOCAL_EXTRA_64
    assert len(pk._central_record(entry)) == pk.CENTRAL_HEADER + 1 + pk.CENTRAL_EXTRA_64
    assert len(pk._end_record(1, 100, 1 << 33)) == pk.END_RECORD_64 + pk.LOCATOR_64 + pk.END_RECORD
    assert len(pk._end_record(1, 100, 100)) == pk.END_RECORD


def test_name_lists(spark, tmp_path):
    path = tmp_path / "names.txt"
    assert tables.read_name_list(spark, str(path)) is None
    path.write_text("", encoding="utf8")
    assert tables.read_name_list(spark, str(path)).count() == 0
    path.write_text(" a \n\n\tÅ\t\n", encoding="utf8")
    assert [r.name for r in tables.read_name_list(spark, str(path)).collect()] == ["a", "Å"]
    empty = spark.createDataFrame([], "name string")
    assert stores.write_removal_list(empty, str(tmp_path), scratch_folder(spark)) is False
    assert not (tmp_path / model.REMOVAL_FILE).exists()


def test_lookup_readers(spark, tmp_path):
    (tmp_path / "codes.txt").write_text("field\tcode\tname_sv\nsample_project\t7\tSjö\n", encoding="utf8")
    (tmp_path / "areas.txt").write_text("area\tpolygon_id\tseq\tlat\tlon\nRC\t1\t1\t56.5\t12\n", encoding="utf8")
    (tmp_path / "rules.txt").write_text("data_type\tcolumn_name\tmatch_value\tnew_value\nepibenthos\tvalue\t1\t\n", encoding="utf8")
    assert tables.read_codes(spark, str(tmp_path / "codes.txt")).first().name_sv == "Sjö"
    assert tables.read_areas(spark, str(tmp_path / "areas.txt")).first().lat == 56.5
    assert tables.read_rules(spark, str(tmp_path / "rules.txt")).first().new_value == ""


def test_data_table_encoding(spark, tmp_path):
    df = spark.createDataFrame([("p", "Å €", "a\tb\nc"), ("p", "中", "")], "package string, a string, b string")
    pk.write_data_table(df, str(tmp_path / "t"))
    data = b"".join(p.read_bytes() for p in pathlib.Path(tmp_path / "t" / "package=p").glob("*.csv"))
    assert "Å €\ta b c\n".encode("cp1252") in data and b"?\t\n" in data and data.startswith(b"a\tb\n")
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"


def test_reports(spark, tmp_path):
    log = spark.createDataFrame([("p", "error", "transformation", "m"), ("p", "debug", "x", "n")], report.LOG_SCHEMA)
    report.write_reports(log, str(tmp_path / "r"))
    assert sorted(r.report for r in spark.read.parquet(str(tmp_path / "r")).collect()) == ["all", "all", "transformation"]


def test_job(spark, incoming, tmp_path):
    (tmp_path / "codes.txt").write_text("field\tcode\tname_sv\n", encoding="utf8")
    (tmp_path / "areas.txt").write_text("area\tpolygon_id\tseq\tlat\tlon\n", encoding="utf8")
    (tmp_path / "names.txt").write_text("noversion.zip\n", encoding="utf8")
    for folder in ("data", "store"):
        (tmp_path / folder).mkdir()
    common = {
        "environment": "TEST", "reports": str(tmp_path / "reports"),
        "targets": {"TEST": {"datasets": str(tmp_path / "data"), "store": str(tmp_path / "store")}},
    }
    publish = {
        "action": "publish", "packages": str(incoming), "work": str(tmp_path / "work"),
        "codes": str(tmp_path / "codes.txt"), "areas": str(tmp_path / "areas.txt"), **common,
    }
    job.run(spark, publish)
    assert len(list((tmp_path / "store").glob("*.zip"))) == 3
    failed = "".join(p.read_text() for p in (tmp_path / "reports" / "TEST_failed").glob("part-*"))
    assert "nodata.zip -> ValueError" in failed
    job.run(spark, {"action": "remove", "names": str(tmp_path / "names.txt"), **common})
    assert len(list((tmp_path / "store").glob("*.zip"))) == 2 and len(list((tmp_path / "data").glob("*.zip"))) == 3
    with pytest.raises(ValueError):
        job.run(spark, {"action": "other", **common})
