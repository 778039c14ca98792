"""Lines that are in order are written where they lie; others are spread and sorted."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F

from checks import archives as ar
from kelpline import session
from kelpline.sinks import packages as pk
from kelpline.sources import trees


def _lines(spark, n=40_000):
    rows = spark.range(n, numPartitions=4).select(F.lit("a.zip").alias("package"), (F.col("id") + 1).alias("seq"), F.concat(F.lit("x"), "id").alias("text"))
    return rows.unionByName(spark.createDataFrame([("a.zip", 0, "name")], rows.schema))


def _table(path):
    with zipfile.ZipFile(path) as archive:
        assert archive.testzip() is None
        return archive.read("shark_data.txt").decode().split("\n")[:-1]


def test_lines_in_order_meet_no_shuffle_and_others_are_sorted(spark, tmp_path, monkeypatch):
    asked = []
    real = pk._line_segments
    monkeypatch.setattr(pk, "_line_segments", lambda lines, opened, in_order: asked.append(in_order) or real(lines, opened, in_order))
    expected = ["name", *[f"x{i}" for i in range(40_000)]]
    pk.write_packages(_lines(spark), str(tmp_path / "z"), session.scratch_folder(spark), in_order=True)
    assert (_table(tmp_path / "z/a.zip"), asked) == (expected, [True])
    asked.clear()
    mixed = _lines(spark).repartition(5, F.xxhash64("seq"))
    pk.write_packages(mixed, str(tmp_path / "m"), session.scratch_folder(spark), in_order=True)
    assert (_table(tmp_path / "m/a.zip"), asked) == (expected, [True, False])
    asked.clear()
    # two tasks far apart in numbers, one of which holds lines on both sides of the other's
    halves = _lines(spark).where("seq <= 10000 or seq > 30000").coalesce(1).unionByName(_lines(spark).where("seq > 10000 and seq <= 30000").coalesce(1))
    pk.write_packages(halves, str(tmp_path / "h"), session.scratch_folder(spark), in_order=True)
    assert _table(tmp_path / "h/a.zip") == expected


def test_numbered_rows_are_those_of_the_observations(spark, sf_dir):
    rows, numbered = ar.package_rows(spark, sf_dir), ar.numbered_rows(spark, sf_dir)
    again = numbered.drop("_line").select(rows.columns)
    assert again.schema == rows.schema
    assert rows.exceptAll(again).isEmpty() and again.exceptAll(rows).isEmpty()


def test_cells_are_made_behind_the_shuffle_of_numbered_rows(spark, sf_dir):
    def width(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return plan.split("RepartitionByExpression")[1].split("Join")[0].count("md5")

    assert width(ar.numbered_rows(spark, sf_dir)) == 0
    assert width(pk.number_lines(ar.package_rows(spark, sf_dir), ["row_number"])) > 0


def test_members_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(ar, "PIECE", 5)
    blocks = lambda data: [line for block in ar._blocks(io.BytesIO(data)) for line in block]
    assert blocks(b"one\nlonger line\n\nx") == ["one", "longer line", "", "x"]
    assert (blocks(b"a\n"), blocks(b""), blocks(b"\n")) == (["a"], [""], [""])


def test_the_end_of_a_line_is_read_by_few_bytes():
    class Body(io.BytesIO):
        read_bytes = 0

        def read(self, size=-1):
            found = super().read(size)
            self.read_bytes += len(found)
            return found

    body = Body(b"".join(b"%07d\n" % i for i in range(100_000)))
    stream = trees._Lines(body, 804, 1_604)
    found = b""
    while chunk := stream.read():
        found += chunk
    assert (found[:8], found[-8:], len(found)) == (b"0000101\n", b"0000200\n", 800)
    assert body.read_bytes < 64 * 1024


def test_a_session_of_another_make_gets_the_limit_on_methods(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    with session.setting(spark, key, session.HUGE_METHODS):
        session.small_methods(spark)
        assert spark.conf.get(key) == "8000"
    with session.setting(spark, key, "12345"):
        session.small_methods(spark)
        assert spark.conf.get(key) == "12345"


def test_what_a_task_sorts_does_not_grow_with_the_table(spark, tmp_path):
    """In a session of two partitions, 12 MB of rows are sorted and written by more tasks, and the session is as it was."""
    text = F.concat_ws("-", *[F.sha2(F.concat("id", F.lit(f"/{k}")), 256) for k in range(4)])
    rows = spark.range(50_000, numPartitions=4).select(F.lit("a.zip").alias("package"), F.sha2(F.col("id").cast("string"), 256).alias("key"), text.alias("text"))
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    for in_order in (True, False):
        scratch = session.scratch_folder(spark)
        with session.setting(spark, "spark.sql.shuffle.partitions", "2"):
            lines = pk.number_lines(rows, ["key"]).select("package", F.col("_line").alias("seq"), "text")
            pk.write_packages(lines, str(tmp_path / f"{in_order}"), scratch, in_order=in_order)
        assert spark.read.parquet(f"{scratch}/segments").select("body").distinct().count() > 2
        assert spark.conf.get(key, None) is None
        expected = [r.text for r in rows.orderBy("key").select("text").collect()]
        assert _table(tmp_path / f"{in_order}/a.zip") == expected
