"""Published rows to data tables and zip packages."""

from __future__ import annotations

import contextlib
import os
import struct
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpline import model
from kelpline.functions.headers import HeaderColumn, shown
from kelpline.functions.text import NO_CHARACTER, cell, joined_cells, printable_cell, separated_line
from kelpline.operators.lookups import lookup_join, measured
from kelpline.session import many_partitions, scratch_folder, setting, ship_package, shuffles_removed
from kelpline.sinks.placed import BLOCK, BodyFile, discard, is_mounted, local_folder, squeezed, sums_before, write_placed

SEGMENT_BYTES = 1024 * 1024
BLOCK_LINES = 16_384
#: Parts in which the members of a package are placed.
MEMBER_CUTS = 4096
INTERNAL_COLUMNS = ["package", "layout", "_line", "_type", "_notes", "_removed"]
#: With so many headers at most, the order of cells is part of the expressions.
FOLDED_LAYOUTS = 4
#: Bytes of a file of a table that is written on a mount, but for its last segment.
FILE_BYTES = 128 * 1024 * 1024
#: Bytes of lines of all packages that a task holds.
HELD_BYTES = 32 * 1024 * 1024
#: Segments that a task may make of a package; tells those of two tasks apart.
PIECES = 1 << 32
#: As Spark names the folder of a package without a name, and what it does not leave in the name of a folder.
NO_NAME = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = "[\\x01-\\x1f\\x7f\"#%'*/:=?\\\\{}\\[\\]^]"
#: Between the notes of a line.
NOTE_END = "\x1f"

# ---------------------------------------------------------------------------
# Fixed values of the zip and deflate formats.
# ---------------------------------------------------------------------------
LOCAL_HEADER = 30
CENTRAL_HEADER = 46
END_RECORD = 22
END_RECORD_64 = 56
LOCATOR_64 = 20
LOCAL_EXTRA_64 = 20
CENTRAL_EXTRA_64 = 28
LIMIT_32 = 0xFFFFFFFF
LIMIT_16 = 0xFFFF
UTF8_FLAG = 0x800
DEFLATE = 8
DOS_EPOCH_DATE = 33
LAST_BLOCK = b"\x03\x00"
CRC_POLYNOMIAL = 0xEDB88320
FILE_MODE = 0o100644 << 16
FOLDER_MODE = (0o40755 << 16) | 0x10


def write_data_table(df: DataFrame, path: str, package: str = "package") -> None:
    """Write rows as separated text, a folder per package, in the output encoding.

    On a mount, rows are put aside squeezed where they lie, and files are put together of them: rows are wide and in no order, so that a
    shuffle of them would take more disk than their files. Elsewhere small packages are gathered into few files and large ones split over many by the
    adaptive planner.
    """
    spark, columns = df.sparkSession, [c for c in df.columns if c not in (package, "layout", "_line")]
    if is_mounted(path):
        head = (model.SEPARATOR.join(columns) + "\n").encode(model.ENCODING, errors="replace")
        text = F.concat_ws(model.SEPARATOR, *[printable_cell(F.col(c)) for c in columns])
        lines = df.select(_folder_name(F.col(package)).alias("package"), text.alias("text"))

        def segments(opened: Callable, scratch: str) -> DataFrame:
            ship_package(spark)
            with many_partitions(spark), shuffles_removed(spark):
                lines.mapInArrow(_segment_rows(opened), SEGMENT_SCHEMA).write.parquet(f"{scratch}/segments")
            return _segments_of(spark, scratch)

        return _write_in_files(spark, path, package, segments, head)
    cells = df.select(package, *[printable_cell(F.col(c)).alias(c) for c in columns])
    # the encoding is only accepted with this setting
    with setting(spark, "spark.sql.legacy.javaCharsets", "true"), many_partitions(spark), shuffles_removed(spark):
        cells.hint("rebalance", F.col(package)).write.partitionBy(package).csv(
            path,
            sep=model.SEPARATOR,
            header=True,
            encoding=model.JAVA_ENCODING,
            quote="",
            escapeQuotes=False,
            emptyValue="",
            nullValue="",
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )


def _folder_name(package: Column) -> Column:
    return F.coalesce(F.nullif(package.cast("string"), F.lit("")), F.lit(NO_NAME))


def _escaped(name: Column) -> Column:
    """A value as Spark writes it in the name of a folder."""
    one = lambda c: F.when(F.rlike(c, F.lit(ESCAPED)), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))).otherwise(c)
    return F.array_join(F.transform(F.split(name, ""), one), "")


def _write_in_files(spark: SparkSession, path: str, package: str, staged: Callable[[Callable, str], DataFrame], head: bytes = b"") -> None:
    """Segments of tables as files of about ``FILE_BYTES``, a folder per package as Spark names it, each file beginning with ``head``.

    The files of a folder follow each other in the order of their names. Files get their names together.
    """
    folder, scratch = local_folder(path), scratch_folder(spark)
    if os.path.exists(folder):
        raise FileExistsError(f"{folder} exists already")
    run = _run(scratch)
    with _bodies_of(folder, run):
        segments = staged(_segmenter(folder, run, packed=False), scratch)
        sized = sums_before(segments.where("raw > 0"), ["package"], "seq", ["raw"])
        cut = sized.withColumn("_cut", F.floor(F.col("raw_before") / FILE_BYTES))
        begin = F.min("raw_before").over(Window.partitionBy("package", "_cut"))
        file = F.concat(F.lit(f"{package}="), _escaped(F.col("package")), F.format_string("/part-%08d.csv", "_cut"))
        offset = F.col("raw_before") - begin + len(head)
        parts = cut.select(file.alias("file"), offset.alias("offset"), F.col("raw").alias("size"), _no_content(), "body", "at", F.col("comp").alias("stored"))
        if head:
            none = {"body": F.lit(None).cast("string"), "at": F.lit(None).cast("long"), "stored": F.lit(None).cast("long")}
            heads = parts.select("file").distinct().select("file", F.lit(0).cast("long").alias("offset"), F.lit(len(head)).cast("long").alias("size"), F.lit(head).alias("content"))
            parts = parts.unionByName(heads.withColumns(none))
        write_placed(parts, folder, run)


# -- lines -----------------------------------------------------------------------------------


def number_lines(df: DataFrame, order: list[str], package: str = "package", made: dict[str, Column] | None = None) -> DataFrame:
    """Add ``_line``, rising with ``order`` within each package, for rows that do not come from
    archives. ``order`` must tell the rows of a package apart. Columns that are ``made`` of those of ``df``, such as the package, are made behind
    the shuffle."""
    made = made or {}
    placed = df.repartitionByRange(*[made.get(c, F.col(c)) for c in (package, *order)]).withColumns(made).sortWithinPartitions(package, *order)
    return placed.withColumn("_line", F.monotonically_increasing_id() + 1)


def render_lines(
    df: DataFrame, info: DataFrame, read_columns: list[HeaderColumn] | None = None, adds: dict[str, Column] | None = None
) -> DataFrame:
    """Rows to numbered text lines ``(package, seq, text, notes)``, the header being line 0.

    A package gets its own columns in their own order, less those dropped and followed by those
    the steps added. ``info`` has one row per package, with or without rows, with its ``layout``, ``header`` and type;
    without ``read_columns`` every package gets all columns. ``adds`` names columns that steps add to packages that lack
    them, with the condition on ``info`` for that: another package may bring the same column itself. What rows carry in ``_notes`` goes
    with their lines; a row that was ``_removed`` has no text and is left out unless it carries notes.
    """
    columns = [c for c in df.columns if c not in INTERNAL_COLUMNS]
    names = F.array(*[F.lit(shown(c)) for c in columns])
    cells = F.array(*[cell(F.col(c)) for c in columns])
    notes = F.col("_notes") if "_notes" in df.columns else F.lit(None).cast("string")
    head_of = F.lit(0).cast("long").alias("seq")
    if read_columns is None:
        everything = F.lit(model.SEPARATOR.join(map(shown, columns)))
        body = df.select("package", F.col("_line").alias("seq"), joined_cells(cells).alias("text"), notes.alias("notes"))
        head = info.select("package", head_of, everything.alias("text"), F.lit(None).cast("string").alias("notes"))
        return body.withColumn("text", separated_line(F.col("text"))).unionByName(head)
    read = {c.column: c for c in read_columns}
    own = [F.struct(_header_place(read[c]).alias("pos"), F.lit(i).alias("i")) for i, c in enumerate(columns) if c in read]
    # columns that other packages bring come before those that only the steps know
    added = []
    for i, c in sorted(enumerate(columns), key=lambda x: x[1] not in read):
        condition = (adds or {}).get(c, F.lit(c not in read))
        added.append(F.when(condition & ~F.array_contains("header", c) if c in read else condition, F.lit(i)))
    added = F.filter(F.array(*added).cast("array<int>"), lambda i: i.isNotNull())
    kept = F.sort_array(F.filter(F.array(*own), lambda x: x["pos"].isNotNull())) if own else F.array().cast("array<struct<pos:int,i:int>>")
    order = F.concat(F.transform(kept, lambda x: x["i"]), added)
    key = ["layout", "_type"] if "_type" in df.columns else ["layout"]
    typed = info.withColumn("_type", F.col(model.DATA_TYPE)) if "_type" in key else info
    layouts = typed.dropDuplicates(key).select(*key, order.alias("_places"))
    removed = F.col("_removed") if "_removed" in df.columns else F.lit(False)
    rows = df.where(~removed | notes.isNotNull()) if "_removed" in df.columns else df
    blank = F.lit(None).cast("string").alias("notes")
    few = layouts.limit(FOLDED_LAYOUTS + 1).collect()
    if len(few) <= FOLDED_LAYOUTS:
        # few headers: the order of cells is part of the expression, and rows meet no table
        def chosen(of: Callable[[list[int]], Column]) -> Column:
            out = F.lit(None).cast("string")
            for r in few:
                same = F.col("layout") == r["layout"]
                out = F.when(same & F.col("_type").eqNullSafe(r["_type"]) if "_type" in key else same, of(r["_places"])).otherwise(out)
            return of(few[0]["_places"]) if len(few) == 1 else out

        listed = [cell(F.col(c)) for c in columns]
        body = rows.withColumn("text", chosen(lambda places: F.concat_ws(NO_CHARACTER, *[listed[i] for i in places])))
        head = typed.select("package", *key).withColumn("text", chosen(lambda places: F.lit(NO_CHARACTER.join(shown(columns[i]) for i in places))))
    else:
        line = lambda values: joined_cells(F.transform("_places", lambda i: F.get(values, i)))
        layouts, small = measured(layouts)
        body = lookup_join(rows.withColumn("_cells", cells), layouts, key, how="inner", small=small).withColumn("text", line(F.col("_cells")))
        head = lookup_join(typed.select("package", *key), layouts, key, how="inner", small=small).withColumn("text", line(names))
    text = F.when(~removed, separated_line(F.col("text")))
    return body.select("package", F.col("_line").alias("seq"), text.alias("text"), notes.alias("notes")).unionByName(
        head.select("package", head_of, separated_line(F.col("text")).alias("text"), blank)
    )


def _header_place(column: HeaderColumn) -> Column:
    """Where a header names a column, NULL if it does not."""
    places = F.transform("header", lambda c, i: F.when(c == column.name, i))
    return F.get(F.filter(places, lambda i: i.isNotNull()), F.lit(column.number - 1))


def write_package_tables(lines: DataFrame, path: str, in_order: bool = False) -> None:
    """``(package, seq, text)`` as text files, a folder per package with its own columns.

    The files of a folder follow each other in the order of their names; the first begins with the header. Lines that are
    ``in_order``, the headers before all others, are written where they lie; on a mount by way of segments, as those of ``write_table_files``.
    """
    spark = lines.sparkSession
    if is_mounted(path):
        named = lines.select(_folder_name(F.col("package")).alias("package"), "seq", F.coalesce("text", F.lit("")).alias("text"))
        return _write_in_files(spark, path, "package", lambda opened, scratch: _staged_segments(named, opened, scratch, in_order))
    if in_order:
        # headers are few, and the first partition
        heads = lines.where("seq = 0").coalesce(1).sortWithinPartitions("package")
        lines = heads.unionByName(lines.where("seq > 0"))
    else:
        lines = lines.repartitionByRange("package", "seq").sortWithinPartitions("package", "seq")
    placed = lines.select("package", "text")
    with setting(spark, "spark.sql.legacy.javaCharsets", "true"), many_partitions(spark), shuffles_removed(spark):
        placed.write.partitionBy("package").csv(
            path, sep="\x01", header=False, encoding=model.JAVA_ENCODING, quote="", escapeQuotes=False, emptyValue="",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )


def write_table_files(lines: DataFrame, folder: str, scratch: str, in_order: bool = False) -> DataFrame:
    """``(package, seq, text)`` as ``<package>/shark_data.txt`` below ``folder``, and their list ``(file, size)``.

    The bytes are those of the data table in the package's archive. A table of any size is the work of many tasks; files
    get their names together, and a run that fails leaves none. ``in_order`` as in ``write_packages``.
    """
    run = _run(scratch)
    with _bodies_of(folder, run):
        segments = _staged_segments(lines, _segmenter(local_folder(folder), run, packed=False), scratch, in_order)
        sized = sums_before(segments, ["package", "member"], "seq", ["raw"])
        file = F.concat("package", F.lit("/"), "member").alias("file")
        parts = sized.where("raw > 0").select(file, F.col("raw_before").alias("offset"), F.col("raw").alias("size"), _no_content(), "body", "at", F.col("comp").alias("stored"))
        return write_placed(parts, folder, run)


def _no_content() -> Column:
    return F.lit(None).cast("binary").alias("content")


def _segments_of(spark: SparkSession, scratch: str) -> DataFrame:
    return spark.read.parquet(f"{scratch}/segments")


def replaced_characters(spark: SparkSession, scratch: str) -> DataFrame:
    """Log rows for packages with characters the output encoding lacks; question marks replace them. Counted
    when the packages of ``scratch`` were written."""
    counted = _segments_of(spark, scratch).groupBy("package").agg(F.sum("replaced").alias("n")).where("n > 0")
    return counted.select(
        "package",
        F.lit("warning").alias("level"),
        F.lit("transformation").alias("log_type"),
        F.concat(F.lit("Replaced characters in "), F.col("n"), F.lit(" lines")).alias("msg"),
    )


def counted_notes(spark: SparkSession, scratch: str) -> DataFrame:
    """``package, note, n``: the notes that lines carried, counted when the packages of ``scratch`` were written."""
    notes = _segments_of(spark, scratch).select("package", F.explode("notes").alias("x"))
    return notes.groupBy("package", F.col("x.note").alias("note")).agg(F.sum("x.n").alias("n"))


# -- compressed segments ---------------------------------------------------------------------

SEGMENT_SCHEMA = (
    "package string, member string, seq long, raw long, comp long, crc long, replaced long, "
    "notes array<struct<note:string,n:long>>, body string, at long, last long"
)
_SEGMENT_ARROW = pa.schema(
    [
        ("package", pa.string()),
        ("member", pa.string()),
        ("seq", pa.int64()),
        ("raw", pa.int64()),
        ("comp", pa.int64()),
        ("crc", pa.int64()),
        ("replaced", pa.int64()),
        ("notes", pa.list_(pa.struct([("note", pa.string()), ("n", pa.int64())]))),
        ("body", pa.string()),
        ("at", pa.int64()),
        ("last", pa.int64()),
    ]
)
#: Segments listed at once.
LISTED = 1024


class _Segmenter:
    """Stretches of members, put aside in the task's body file; only what is known of them goes on as rows.

    A packed stretch is compressed by itself and ends on a byte, so that stretches put one after the other are one
    valid stream. Others lie there squeezed, since their files will hold all their bytes.
    """

    def __init__(self, folder: str, run: str, packed: bool):
        self.body, self.packed, self.rows = BodyFile(folder, run), packed, []

    def add(self, package: str, member: str, seq: int, data: bytes, replaced: int = 0, notes: Counter | None = None, last: int = 0) -> None:
        content = data
        if self.packed and data:
            packer = zlib.compressobj(6, zlib.DEFLATED, -zlib.MAX_WBITS)
            content = packer.compress(data) + packer.flush(zlib.Z_SYNC_FLUSH)
        elif data:
            content = squeezed(data)
        told = [{"note": k, "n": n} for k, n in sorted(notes.items())] if notes else []
        self.rows.append(
            {
                "package": package, "member": member, "seq": seq, "raw": len(data), "comp": len(content), "crc": zlib.crc32(data),
                "replaced": replaced, "notes": told, "body": self.body.path, "at": self.body.put(content) if content else 0, "last": last,
            }
        )

    def listed(self, all_of_them: bool = False) -> Iterator[pa.RecordBatch]:
        if self.rows and (all_of_them or len(self.rows) >= LISTED):
            yield pa.RecordBatch.from_pylist(self.rows, schema=_SEGMENT_ARROW)
            self.rows = []


def _segmenter(folder: str, run: str, packed: bool) -> Callable[[], contextlib.AbstractContextManager[_Segmenter]]:
    @contextlib.contextmanager
    def opened() -> Iterator[_Segmenter]:
        out = _Segmenter(folder, run, packed)
        with contextlib.closing(out.body):
            yield out

    return opened


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """Package, block of lines, and begin and end in the batch of lines that belong together."""
    packages, seqs = batch["package"].dictionary_encode(), batch["seq"].to_numpy()
    codes, blocks = packages.indices.to_numpy(), seqs // BLOCK_LINES
    new = np.r_[True, (codes[1:] != codes[:-1]) | (blocks[1:] != blocks[:-1]) | (seqs[1:] < seqs[:-1])]
    begins = np.flatnonzero(new).tolist()
    for begin, end in zip(begins, [*begins[1:], len(batch)]):
        yield packages.dictionary[codes[begin]].as_py(), int(blocks[begin]), begin, end


def _encoded(lines: list[str]) -> tuple[bytes, int]:
    """Lines in the output encoding, and how many hold characters that it lacks."""
    text = "\n".join(lines) + "\n"
    try:
        return text.encode(model.ENCODING), 0
    except UnicodeEncodeError:
        replaced = sum(line.encode(model.ENCODING, errors="replace") != line.encode(model.ENCODING, errors="ignore") for line in lines)
        return text.encode(model.ENCODING, errors="replace"), replaced


def _segment_rows(opened: Callable) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lines ``(package, text)`` in any order to segments of their packages; a task holds ``HELD_BYTES`` of them at most."""

    def segment(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = {}
        sizes: Counter[str] = Counter()
        number = TaskContext.get().partitionId() * PIECES
        with opened() as out:

            def close(package: str) -> None:
                nonlocal number
                data, replaced = _encoded(held.pop(package))
                out.add(package, model.DATA_FILE, number, data, replaced)
                number += 1
                del sizes[package]

            for batch in batches:
                packages = batch["package"].dictionary_encode()
                codes = packages.indices.to_numpy()
                order = np.argsort(codes, kind="stable")
                texts, codes = batch["text"].take(pa.array(order)).to_pylist(), codes[order]
                begins = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]][: len(codes)]).tolist()
                for begin, end in zip(begins, [*begins[1:], len(codes)]):
                    package = packages.dictionary[codes[begin]].as_py()
                    held.setdefault(package, []).extend(texts[begin:end])
                    sizes[package] += sum(map(len, texts[begin:end])) + end - begin
                    if sizes[package] >= SEGMENT_BYTES:
                        close(package)
                if sizes.total() >= HELD_BYTES:
                    for package in list(held):
                        close(package)
                yield from out.listed()
            for package in list(held):
                close(package)
            yield from out.listed(True)

    return segment


def _segment_lines(opened: Callable) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sorted lines to segments; a segment ends with its block of lines or at a bounded size."""

    def segment(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, last, lines, size, notes = None, 0, 0, [], 0, Counter()
        with opened() as out:

            def close() -> None:
                nonlocal lines, size, notes
                data, replaced = _encoded(lines) if lines else (b"", 0)
                if lines or notes:
                    out.add(key[0], model.DATA_FILE, first, data, replaced, _single(notes), last)
                lines, size, notes = [], 0, Counter()

            for batch in batches:
                if not len(batch):
                    continue
                seqs, texts, told = batch["seq"], batch["text"].to_pylist(), batch["notes"]
                for package, block, begin, end in _runs(batch):
                    if key != (package, block) or seqs[begin].as_py() < last:
                        close()
                        key = (package, block)
                    for low in range(begin, end, LISTED):
                        high = min(low + LISTED, end)
                        if size >= SEGMENT_BYTES:
                            close()
                        if not lines and not notes:
                            first = seqs[low].as_py()
                        last = seqs[high - 1].as_py()
                        found = [t for t in texts[low:high] if t is not None]
                        lines += found
                        size += sum(map(len, found)) + len(found)
                        if told.null_count < len(told):
                            notes.update(n for n in told[low:high].to_pylist() if n is not None)
                yield from out.listed()
            close()
            yield from out.listed(True)

    return segment


def _single(notes: Counter) -> Counter:
    """Counts of joined notes to counts of each."""
    out: Counter = Counter()
    for joined, n in notes.items():
        for note in joined.split(NOTE_END):
            out[note] += n
    return out


def _segment_parts(opened: Callable) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def segment(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with opened() as out:
            for batch in batches:
                for package, member, seq, content in zip(*(batch[c].to_pylist() for c in ("package", "member", "seq")), batch["content"]):
                    out.add(package, member, seq, content.as_py() or b"")
                    yield from out.listed()
            yield from out.listed(True)

    return segment


def _run(scratch: str) -> str:
    return scratch.rstrip("/").rsplit("/", 1)[-1]


@contextlib.contextmanager
def _bodies_of(folder: str, run: str) -> Iterator[None]:
    """Bodies of a run that fails go with it."""
    folder = local_folder(folder)
    os.makedirs(folder, exist_ok=True)
    try:
        yield
    except BaseException:
        discard(folder, run)
        raise


def _line_segments(lines: DataFrame, opened: Callable, in_order: bool) -> DataFrame:
    ship_package(lines.sparkSession)
    if "notes" not in lines.columns:
        lines = lines.withColumn("notes", F.lit(None).cast("string"))
    placed = lines.select("package", "seq", "text", "notes")
    if not in_order:
        placed = placed.repartition("package", F.floor(F.col("seq") / BLOCK_LINES)).sortWithinPartitions("package", "seq")
    return placed.mapInArrow(_segment_lines(opened), SEGMENT_SCHEMA)


def _staged_segments(lines: DataFrame, opened: Callable, scratch: str, in_order: bool, parts: DataFrame | None = None) -> DataFrame:
    spark = lines.sparkSession

    def stage(lines_in_order: bool) -> None:
        found = _line_segments(lines, opened, lines_in_order)
        with many_partitions(spark), shuffles_removed(spark):
            (found if parts is None else found.unionByName(parts)).write.mode("overwrite").parquet(f"{scratch}/segments")

    stage(in_order)
    if in_order and not _ordered(_segments_of(spark, scratch)):
        # lines of one segment lie between those of another: a join has dealt them anew
        stage(False)
    # a segment without text only tells of lines that were removed
    return _segments_of(spark, scratch).where("raw > 0 or seq = 0").drop("notes", "last")


def _ordered(segments: DataFrame) -> bool:
    """Whether the lines of each segment follow those of the segments before it."""
    tables = segments.where(F.col("member") == model.DATA_FILE).select("package", "seq", "last", F.floor(F.col("seq") / BLOCK).alias("_block"))
    before = F.max("last").over(Window.partitionBy("package", "_block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    within = tables.withColumn("_before", before).where("_before >= seq")
    # and over blocks of numbers, so that no task holds all segments of a large package
    ends = tables.groupBy("package", "_block").agg(F.min("seq").alias("seq"), F.max("last").alias("last"))
    earlier = F.max("last").over(Window.partitionBy("package").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    across = ends.withColumn("_before", earlier).where("_before >= seq")
    return within.select("seq").unionByName(across.select("seq")).isEmpty()


def _advance(crc: int, power: int) -> int:
    """Product of two polynomials over the checksum's field, lowest power in the highest bit."""
    product, bit = 0, 1 << 31
    while bit:
        if crc & bit:
            product ^= power
        bit >>= 1
        power = (power >> 1) ^ CRC_POLYNOMIAL if power & 1 else power >> 1
    return product


# x to the power 2^k: squared from x, for shifts by any number of bits
_POWERS = [1 << 30]
while len(_POWERS) < 67:
    _POWERS.append(_advance(_POWERS[-1], _POWERS[-1]))


def crc_followed_by(crc: int, length: int) -> int:
    """What a checksum contributes to that of the whole when ``length`` bytes follow."""
    k = 3  # bytes to bits
    while length and crc:
        if length & 1:
            crc = _advance(crc, _POWERS[k])
        length >>= 1
        k += 1
    return crc


@F.pandas_udf(T.LongType())
def _crc_share(crc: pd.Series, following: pd.Series) -> pd.Series:
    return pd.Series([crc_followed_by(int(c), int(n)) for c, n in zip(crc, following)], dtype="int64")


# -- zip records -----------------------------------------------------------------------------


def _local_record(e) -> bytes:
    name = e["member"].encode("utf-8")
    raw, comp, extra, needed = e["raw"], e["comp"], b"", 20
    if e["big"]:
        extra, needed = struct.pack("<HHQQ", 1, 16, raw, comp), 45
        raw = comp = LIMIT_32
    fixed = struct.pack(
        "<4sHHHHHLLLHH", b"PK\3\4", needed, UTF8_FLAG, DEFLATE, 0, DOS_EPOCH_DATE, e["crc"], comp, raw, len(name), len(extra)
    )
    return fixed + name + extra


def _central_record(e) -> bytes:
    name = e["member"].encode("utf-8")
    raw, comp, start, extra, needed = e["raw"], e["comp"], e["start"], b"", 20
    if e["far"]:
        extra, needed = struct.pack("<HHQQQ", 1, 24, raw, comp, start), 45
        raw = comp = start = LIMIT_32
    fixed = struct.pack(
        "<4sBBHHHHHLLLHHHHHLL", b"PK\1\2", needed, 3, needed, UTF8_FLAG, DEFLATE, 0, DOS_EPOCH_DATE, e["crc"],
        comp, raw, len(name), len(extra), 0, 0, 0, FOLDER_MODE if name.endswith(b"/") else FILE_MODE, start,
    )
    return fixed + name + extra


def _end_record(count: int, size: int, start: int) -> bytes:
    end = b""
    if _is_large(count, size, start):
        end = struct.pack("<4sQHHLLQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, count, count, size, start)
        end += struct.pack("<4sLQL", b"PK\6\7", 0, start + size, 1)
    count, size, start = min(count, LIMIT_16), min(size, LIMIT_32), min(start, LIMIT_32)
    return end + struct.pack("<4sHHHHLLH", b"PK\5\6", 0, 0, count, count, size, start, 0)


def _is_large(count: int, size: int, start: int) -> bool:
    return count >= LIMIT_16 or size >= LIMIT_32 or start >= LIMIT_32


_PLACED_ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("content", pa.binary())])


def _records(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each entry its local header, the end of its stream and its central record."""
    for batch in batches:
        rows = []
        for e in batch.to_pylist():
            file = e["package"]
            local = _local_record(e)
            rows.append((file, e["start"], local))
            rows.append((file, e["start"] + len(local) + e["comp"] - len(LAST_BLOCK), LAST_BLOCK))
            rows.append((file, e["central_at"], _central_record(e)))
        yield _placed(rows)


def _ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _placed(
            [
                (e["package"], e["directory_at"] + e["directory"], _end_record(e["n"], e["directory"], e["directory_at"]))
                for e in batch.to_pylist()
            ]
        )


def _placed(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(("file", "offset", "content"), r)) for r in rows], schema=_PLACED_ARROW)


PLACED_SCHEMA = "file string, offset long, content binary"


def _entries(sized: DataFrame) -> DataFrame:
    """One row per member: checksum, sizes and places in its archive."""
    members = sized.groupBy("package", "member").agg(
        F.bit_xor("share").alias("crc"),
        F.first("raw_total").alias("raw"),
        (F.first("comp_total") + len(LAST_BLOCK)).alias("comp"),
    )
    name = F.octet_length("member")
    big = (F.col("raw") >= LIMIT_32) | (F.col("comp") >= LIMIT_32)
    # any order of members will do: that of a hash cuts a package of any number of members into even blocks
    ranked = (
        members.withColumn("big", big)
        .withColumn("head", LOCAL_HEADER + name + F.when(F.col("big"), LOCAL_EXTRA_64).otherwise(0))
        .withColumn("span", F.col("head") + F.col("comp"))
        .withColumn("_cut", F.pmod(F.xxhash64("member"), F.lit(MEMBER_CUTS)))
    )
    placed = _before(ranked, "span", "start")
    placed = placed.withColumn("far", F.col("big") | (F.col("start") >= LIMIT_32)).withColumn(
        "central", (CENTRAL_HEADER + name + F.when(F.col("far"), CENTRAL_EXTRA_64).otherwise(0)).cast("long")
    )
    return _before(placed, "central", "central_before").drop("_cut")


def _before(df: DataFrame, value: str, total: str) -> DataFrame:
    """The sum of ``value`` over the earlier members of a package: inside a cut, and over the cuts before."""
    inside = Window.partitionBy("package", "_cut").orderBy("member").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("package").orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    cuts = df.groupBy("package", "_cut").agg(F.sum(value).alias("_sum"))
    bases = cuts.select("package", "_cut", F.coalesce(F.sum("_sum").over(over), F.lit(0).cast("long")).alias("_base"))
    own = F.coalesce(F.sum(value).over(inside), F.lit(0).cast("long"))
    return df.withColumn(total, own).join(bases, ["package", "_cut"]).withColumn(total, F.col(total) + F.col("_base")).drop("_base")


def write_packages(
    lines: DataFrame,
    folder: str,
    scratch: str,
    files: DataFrame | None = None,
    in_order: bool = False,
) -> DataFrame:
    """Write zip packages and list them: ``(file, size)``.

    ``lines(package, seq, text)`` becomes the data table of each package, in order; ``files``
    are the other members, in parts. Blocks of lines are spread by hash, sorted and compressed
    where they lie, and put aside on the mount; from there on only rows of sizes and places move. Places follow from the
    sizes alone, and the checksum of a member is put together from those of its segments; so a package of any size is the work of many tasks.

    ``in_order`` if the lines that a task holds of a package follow each other, with none of another task between them: they are then
    compressed where they lie, without a shuffle. Segments tell whether that is so, and lines that are not in order are spread and sorted after all.
    """
    spark, run = lines.sparkSession, _run(scratch)
    with _bodies_of(folder, run):
        opened = _segmenter(local_folder(folder), run, packed=True)
        parts = None
        if files is not None:
            chosen = files.where(F.col("member") != model.DATA_FILE).select("package", "member", "seq", "content")
            parts = chosen.mapInArrow(_segment_parts(opened), SEGMENT_SCHEMA)
        segments = _staged_segments(lines, opened, scratch, in_order, parts)
        sized = sums_before(segments, ["package", "member"], "seq", ["raw", "comp"])
        share = _crc_share("crc", F.col("raw_total") - F.col("raw_before") - F.col("raw"))
        with shuffles_removed(spark):
            sized.withColumn("share", share).write.parquet(f"{scratch}/sized")
            sized = spark.read.parquet(f"{scratch}/sized")
            _entries(sized).write.parquet(f"{scratch}/entries")
        entries = spark.read.parquet(f"{scratch}/entries")
        return write_placed(_archive_parts(sized, entries), folder, run)


def _archive_parts(sized: DataFrame, entries: DataFrame) -> DataFrame:
    """Where everything goes: segments by reference, and the records of the archives."""
    directories = entries.groupBy("package").agg(
        F.count("*").alias("n"), F.sum("central").alias("directory"), F.sum("span").alias("directory_at")
    )
    starts = entries.select("package", "member", (F.col("start") + F.col("head")).alias("_start"))
    bodies = lookup_join(sized.where("comp > 0"), starts, ["package", "member"], how="inner").select(
        F.col("package").alias("file"), (F.col("_start") + F.col("comp_before")).alias("offset"), F.col("comp").alias("size"), _no_content(), "body", "at"
    )
    records = (
        entries.join(directories.select("package", "directory_at"), "package")
        .withColumn("central_at", F.col("directory_at") + F.col("central_before"))
        .select("package", "member", "crc", "raw", "comp", "start", "big", "far", "central_at")
        .mapInArrow(_records, PLACED_SCHEMA)
    )
    placed = records.unionByName(directories.mapInArrow(_ends, PLACED_SCHEMA))
    none = {"body": F.lit(None).cast("string"), "at": F.lit(None).cast("long")}
    return bodies.unionByName(placed.withColumn("size", F.octet_length("content").cast("long")).withColumns(none))
