"""Zip packages to tables.

The directory of each archive is read first: a row per member, with the place of its bytes. Members are then dealt out, so one archive is
inflated by many tasks, and streamed into one staged table in the shared scratch folder; from there on every read is a Parquet scan that
splits. Archives on mounted folders are opened by path, and so are those on file systems that the caller lets Arrow read; others
come as rows of Spark, one task each and up to ``ROW_BYTES``: a larger one fails by itself.

What cannot be kept as it is gets told: a package whose lines hold more cells than the header names, or that names a column
with a meaning twice, fails; line ends inside cells, blank lines, characters outside the encoding, and members that are listed more than once are counted in
the log. Of members of one name the last listed counts, as when an archive is unpacked.
"""

from __future__ import annotations

import codecs
import hashlib
import io
import zipfile
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline import model
from kelpline.functions.headers import HeaderColumn, column_names, repeated_known
from kelpline.functions.names import base_name, version
from kelpline.operators.lookups import fits_broadcast, lookup_join
from kelpline.session import scratch_folder, setting, ship_package, shuffles_removed

PART_BYTES = 1024 * 1024
BATCH_BYTES = 8 * 1024 * 1024
#: With so many headers at most, the places of cells are part of the expressions.
FOLDED_LAYOUTS = 4
#: An archive that only Spark can read must fit a row.
ROW_BYTES = 1024 * 1024 * 1024
UTF_16_MARKS = (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE)
ENCRYPTED = 1
#: Staged lines are most of what a run writes.
STAGED_CODEC = "zstd"

STAGED_SCHEMA = (
    "kind string, package string, layout long, data_type_internal string, data_type string, member string, "
    "seq long, text string, content binary"
)
_ARROW = pa.schema(
    [
        ("kind", pa.string()),
        ("package", pa.string()),
        ("layout", pa.int64()),
        ("data_type_internal", pa.string()),
        ("data_type", pa.string()),
        ("member", pa.string()),
        ("seq", pa.int64()),
        ("text", pa.string()),
        ("content", pa.binary()),
    ]
)

#: Header and first row to the internal data type and the one that is shown.
TypeRule = Callable[[list[str], list[str]], tuple[str, str]]


def list_packages(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Zip files of folders or by name; the bodies are not read. A missing path raises."""
    chosen = [paths] if isinstance(paths, str) else sorted(set(paths))
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*" + model.ARCHIVE_SUFFIX).load(chosen)
    )
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        name.alias("package"),
        base_name(name).alias("base_name"),
        version(name).alias("version"),
        "path",
        "length",
        # read only where it is used
        "content",
    )


def _open(path: str):
    """An archive by its path: mounted, or on a file system that Arrow knows."""
    if path.startswith("/") or path.startswith("file:"):
        return open("/" + path.removeprefix("file:").lstrip("/"), "rb")
    for hadoop, arrow in (("s3a://", "s3://"), ("s3n://", "s3://")):
        if path.startswith(hadoop):
            path = arrow + path[len(hadoop) :]
    system, name = fs.FileSystem.from_uri(path)
    return pa.PythonFile(system.open_input_file(name), mode="r")


def _text_blocks(stream, told: dict[str, int | None]) -> Iterator[list[str]]:
    """Lines of a text member, some thousands at a time; only line feeds end a line."""
    rest, encoding = stream.read(PART_BYTES), model.ENCODING
    if rest.startswith(UTF_16_MARKS):
        raise ValueError("the data table is marked as UTF-16")
    if rest.startswith(codecs.BOM_UTF8):
        # the mark tells the encoding, and is no part of the first name
        rest, encoding = rest[len(codecs.BOM_UTF8) :], "utf-8"
        told["Read as UTF-8, as the data table is marked"] = None
    while rest:
        cut = rest.rfind(b"\n") + 1
        if cut:
            yield _decode(rest[: cut - 1], encoding).split("\n")
        chunk = stream.read(PART_BYTES)
        if not chunk:
            if rest[cut:]:
                yield _decode(rest[cut:], encoding).split("\n")
            return
        rest = rest[cut:] + chunk


def _decode(data: bytes, encoding: str = model.ENCODING) -> str:
    text = data.decode(encoding, errors="replace").replace("\r\n", "\n")
    return text.removesuffix("\r")


def default_data_type(header: list[str], row: list[str]) -> tuple[str, str]:
    """The data types of a package, from its first row. Internal: its own column, or the
    delivery data type in lower case without blanks. Shown: the delivery data type, or the internal one."""
    cells = dict(zip(header, row))
    named = cells.get(model.DATA_TYPE) or cells.get("delivery_datatype") or ""
    internal = named.replace(" ", "").lower()
    return internal, cells.get("delivery_datatype") or internal


def layout_id(header: str) -> int:
    """A number for a header line, so that the line itself need not go with every row."""
    return int.from_bytes(hashlib.blake2b(header.encode(), digest_size=8).digest(), "big", signed=True)


class _Table:
    """Columns for one batch at a time: the header once, and the numbered lines that are not blank."""

    def __init__(self, package: str, rule: TypeRule):
        self.package, self.rule = package, rule
        self.common: dict = {}
        counted = ("Unreadable characters", "Line ends inside cells", "Blank cells beyond the header", "Blank lines left out")
        self.notes: dict[str, int | None] = dict.fromkeys(counted, 0)

    def rows(self, stream) -> Iterator[dict]:
        header, described, seq, place, blank = None, False, 0, 0, 0
        for lines in _text_blocks(stream, self.notes):
            block = [line for line in lines if line]
            if header is None and block:
                header = block[0]
                names = header.split(model.SEPARATOR)
                if repeated := repeated_known(names):
                    raise ValueError(f"the header names {', '.join(repeated)} more than once")
                skipped = lines.index(header) + 1
                blank, place = blank + skipped - 1, place + skipped
                lines, block = lines[skipped:], block[1:]
            blank += len(lines) - len(block)
            if header is not None and not described and block:
                yield self._header(header, *self.rule(names, block[0].split(model.SEPARATOR)), some=True)
                described = True
            if block:
                self._check(lines, place, len(names))
                n = len(block)
                yield {
                    "kind": "line",
                    **self.common,
                    "seq": list(range(seq + 1, seq + n + 1)),
                    "text": block,
                }
                seq += n
            place += len(lines)
        if header is not None and not described:
            yield self._header(header, "", "", some=False)
        self.notes["Blank lines left out"] = blank
        for text, n in self.notes.items():
            if n != 0:
                yield {"kind": ["note"], "package": [self.package], "seq": [n], "text": [text]}

    def _header(self, header: str, internal: str, display: str, some: bool) -> dict:
        """``seq`` tells whether lines follow."""
        self.common = {"package": self.package, "layout": layout_id(header), "data_type_internal": internal}
        return {"kind": ["header"], **{k: [v] for k, v in self.common.items()}, "data_type": [display], "seq": [int(some)], "text": [header]}

    def _check(self, lines: list[str], place: int, width: int) -> None:
        for i, line in enumerate(lines):
            if line.count(model.SEPARATOR) >= width:
                if any(line.split(model.SEPARATOR)[width:]):
                    raise ValueError(f"line {place + i + 1} has more cells than the header names")
                self.notes["Blank cells beyond the header"] += 1
            self.notes["Line ends inside cells"] += "\r" in line
            self.notes["Unreadable characters"] += "\ufffd" in line


DIRECTORY_SCHEMA = (
    "package string, path string, place int, member string, method int, flags int, header_at long, comp long, raw long, crc long, error string"
)
_DIRECTORY_ARROW = pa.schema(
    [
        ("package", pa.string()), ("path", pa.string()), ("place", pa.int32()), ("member", pa.string()), ("method", pa.int32()), ("flags", pa.int32()),
        ("header_at", pa.int64()), ("comp", pa.int64()), ("raw", pa.int64()), ("crc", pa.int64()), ("error", pa.string()),
    ]
)
LOCAL_MAGIC, LOCAL_BYTES = b"PK\3\4", 30
AGAIN = "Listed more than once, the last one is used: "


def _directory(package: str, path: str, body) -> Iterator[dict]:
    """A row per member with the place of its bytes; of a name that is listed again the last, and a row that tells of it."""
    with zipfile.ZipFile(body) as archive:
        infos = archive.infolist()
    last = {info.filename: place for place, info in enumerate(infos)}
    if model.DATA_FILE not in last:
        raise ValueError(f"no {model.DATA_FILE}")
    own = {"package": package, "path": path}
    for place, info in enumerate(infos):
        if last[info.filename] == place:
            yield {
                **own, "place": place, "member": info.filename, "method": info.compress_type, "flags": info.flag_bits, "header_at": info.header_offset,
                "comp": info.compress_size, "raw": info.file_size, "crc": info.CRC,
            }
    for name in sorted({info.filename for place, info in enumerate(infos) if last[info.filename] != place}):
        yield {**own, "error": AGAIN + name}


def _directories(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for package, path in zip(batch["package"].to_pylist(), batch["path"].to_pylist()):
            try:
                with _open(path) as body:
                    rows = list(_directory(package, path, body))
            except Exception as e:
                rows = [{"package": package, "path": path, "place": -1, "error": f"{type(e).__name__}: {e}"}]
            yield pa.RecordBatch.from_pylist(rows, schema=_DIRECTORY_ARROW)


def _member_stream(body, row: dict):
    """The inflated bytes of a member, checked against its checksum at their end."""
    if row["flags"] & ENCRYPTED:
        raise ValueError(f"{row['member']} is encrypted")
    body.seek(row["header_at"])
    fixed = body.read(LOCAL_BYTES)
    if fixed[:4] != LOCAL_MAGIC:
        raise zipfile.BadZipFile(f"{row['member']} is not where the directory tells")
    # names and extra fields of a member's own header may differ from the directory's
    body.seek(int.from_bytes(fixed[26:28], "little") + int.from_bytes(fixed[28:30], "little"), io.SEEK_CUR)
    info = zipfile.ZipInfo(row["member"])
    info.compress_type, info.compress_size, info.file_size, info.CRC = row["method"], row["comp"], row["raw"], row["crc"]
    return zipfile.ZipExtFile(body, "r", info)


def _member_rows(body, row: dict, rule: TypeRule) -> Iterator[dict]:
    common = {"package": [row["package"]], "member": [row["member"]]}
    if row["member"].endswith("/"):
        yield {"kind": ["folder"], **common, "seq": [0], "content": [b""]}
        return
    stream = _member_stream(body, row)
    if row["member"] == model.DATA_FILE:
        yield from _Table(row["package"], rule).rows(stream)
        return
    part, data = 0, stream.read(PART_BYTES)
    while data or part == 0:
        yield {"kind": ["file"], **common, "seq": [part], "content": [data]}
        part, data = part + 1, stream.read(PART_BYTES)


def _error(package: str, e: Exception) -> dict:
    return {"kind": ["error"], "package": [package], "text": [f"{type(e).__name__}: {e}"]}


def _in_batches(rows: Iterable[dict]) -> Iterator[pa.RecordBatch]:
    pending, size = [], 0
    for columns in rows:
        pending.append(_batch(columns))
        size += pending[-1].nbytes
        if size >= BATCH_BYTES:
            yield from _joined(pending)
            pending, size = [], 0
    yield from _joined(pending)


def _batch(columns: dict) -> pa.RecordBatch:
    """Columns to a batch; a single value is that of all rows."""
    n = next(len(v) for v in columns.values() if isinstance(v, list))

    def column(f: pa.Field) -> pa.Array:
        value = columns.get(f.name)
        if isinstance(value, list):
            return pa.array(value, f.type)
        return pa.nulls(n, f.type) if value is None else pa.repeat(pa.scalar(value, f.type), n)

    return pa.RecordBatch.from_arrays([column(f) for f in _ARROW], schema=_ARROW)


def _inflater(rule: TypeRule):
    """Members, sorted by where they lie, to staged rows; an archive stays open while its members follow each other."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        path, body = None, None
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    try:
                        if row["path"] != path:
                            if body is not None:
                                body.close()
                            path, body = None, None
                            body = _open(row["path"])
                            path = row["path"]
                        yield from _member_rows(body, row, rule)
                    except Exception as e:
                        yield _error(row["package"], e)
        finally:
            if body is not None:
                body.close()

    return lambda batches: _in_batches(rows(batches))


def _whole(rule: TypeRule):
    """Archives in rows to staged rows."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for package, content in zip(batch["package"].to_pylist(), batch["content"]):
                try:
                    body = pa.BufferReader(content.as_buffer())
                    for row in _directory(package, "", pa.PythonFile(body, mode="r")):
                        if row.get("member") is None:
                            yield {"kind": ["note"], "package": [package], "seq": [None], "text": [row["error"]]}
                        else:
                            yield from _member_rows(body, row, rule)
                except Exception as e:
                    yield _error(package, e)

    return lambda batches: _in_batches(rows(batches))


def _joined(pending: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from pa.Table.from_batches(pending, _ARROW).combine_chunks().to_batches()


def member_rows(directory: DataFrame, data_type: TypeRule = default_data_type) -> DataFrame:
    """Rows of a directory to staged rows. Members are dealt by number over as many tasks as the session shuffles to, so neither many
    archives nor one with many members is the work of one task."""
    tasks = int(directory.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = directory.where("member is not null").repartition(tasks, "package", "place").sortWithinPartitions("path", "header_at")
    return dealt.mapInArrow(_inflater(data_type), STAGED_SCHEMA)


def _told(rows: DataFrame, kind: str, text: Column) -> DataFrame:
    missing = {"layout": "long", "data_type_internal": "string", "data_type": "string", "member": "string", "seq": "long", "content": "binary"}
    return rows.select(F.lit(kind).alias("kind"), "package", text.alias("text"), *[F.lit(None).cast(t).alias(c) for c, t in missing.items()])


def stage_packages(
    packages: DataFrame,
    folder: str,
    data_type: TypeRule = default_data_type,
    by_arrow: Iterable[str] = (),
    row_bytes: int = ROW_BYTES,
) -> DataFrame:
    """Unzip packages into a table, one pass over each member.

    Rows by ``kind``: ``header`` and ``line`` of the data table, ``file`` (other members, in
    parts of bounded size), ``folder``, ``note`` (what the log should tell), ``error`` (the package could not be read to its end),
    ``replaced``. Of several archives of one name, as of several folders, the one with the greatest path counts, as if they
    had been published one after the other; the others are told. ``by_arrow`` names schemes of file systems that executors
    may open by themselves, with their own credentials, such as ``s3a``; archives elsewhere off the mounts are rows of at most ``row_bytes``.
    """
    spark = packages.sparkSession
    ship_package(spark)
    last = packages.groupBy("package").agg(F.max("path").alias("path"), F.count("*").alias("n"))
    repeated = last.where("n > 1").select("package", F.col("path").alias("_last"))
    other = packages.select("package", "path").join(repeated, "package").where("path <> _last")
    chosen = packages.join(other.select("path"), "path", "left_anti")
    opened = F.startswith("path", F.lit("/"))
    for scheme in ("file", *by_arrow):
        opened = opened | F.startswith("path", F.lit(f"{scheme}:"))
    catalogue = f"{scratch_folder(spark)}/directory"
    chosen.where(opened).select("package", "path").mapInArrow(_directories, DIRECTORY_SCHEMA).write.parquet(catalogue)
    directory = spark.read.schema(DIRECTORY_SCHEMA).parquet(catalogue)
    found = [
        member_rows(directory, data_type),
        _told(directory.where("place = -1"), "error", F.col("error")),
        _told(directory.where("place is null"), "note", F.col("error")),
        _told(other, "replaced", F.col("path")),
    ]
    if "content" in packages.columns and not packages.where(~opened).isEmpty():
        # the length reaches the scan, which does not read what is too long
        within = chosen.where((F.col("length") <= row_bytes) & ~opened)
        found.append(within.select("package", "content").mapInArrow(_whole(data_type), STAGED_SCHEMA))
        long = chosen.where((F.col("length") > row_bytes) & ~opened)
        found.append(_told(long, "error", F.concat(F.lit("OSError: more than "), F.lit(row_bytes), F.lit(" bytes on a file system that is not mounted"))))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    # a writer per kind, so that no task sorts its rows by kind
    with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", "8"), shuffles_removed(spark):
        rows.write.partitionBy("kind").parquet(folder, compression=STAGED_CODEC)
    return spark.read.schema(STAGED_SCHEMA).parquet(folder)


def _kind(staged: DataFrame, kind: str) -> DataFrame:
    return staged.where(F.col("kind") == kind)


def failed_packages(staged: DataFrame) -> DataFrame:
    """Packages that could not be read, with the reason; the others go on."""
    failed = _kind(staged, "error").groupBy("package").agg(F.min("text").alias("error"))
    return failed.select("package", "error", F.concat("package", F.lit(" -> "), "error").alias("msg"))


class Unreadable(NamedTuple):
    """Packages that failed, and what is known of their number; measured once, used by every read."""

    packages: DataFrame
    none: bool
    small: bool


def unreadable(staged: DataFrame) -> Unreadable:
    failed = _kind(staged, "error").select("package").distinct()
    none = failed.isEmpty()
    return Unreadable(failed, none, none or fits_broadcast(failed))


def _readable(staged: DataFrame, rows: DataFrame, failed: Unreadable | None = None) -> DataFrame:
    """Rows of packages without an error: what was read before one occurred does not count."""
    failed = unreadable(staged) if failed is None else failed
    return rows if failed.none else lookup_join(rows, failed.packages, ["package"], how="left_anti", small=failed.small)


def package_info(staged: DataFrame, failed: Unreadable | None = None) -> DataFrame:
    """One row per readable package: its names, data types, layout and header, and whether it has lines."""
    rows = _readable(staged, _kind(staged, "header"), failed)
    return rows.select(
        "package",
        base_name(F.col("package")).alias("base_name"),
        version(F.col("package")).alias("version"),
        "data_type_internal",
        "data_type",
        "layout",
        F.split("text", model.SEPARATOR, -1).alias("header"),
        (F.col("seq") > 0).alias("has_lines"),
    )


def read_members(staged: DataFrame) -> DataFrame:
    """The names of all members of readable packages."""
    other = _kind(staged, "file").where(F.col("seq") == 0).select("package", "member")
    data = _kind(staged, "header").select("package", F.lit(model.DATA_FILE).alias("member"))
    return _readable(staged, other.unionByName(data))


def read_files(staged: DataFrame, info: DataFrame | None = None, small: bool | None = None) -> DataFrame:
    """The bodies of all members but the data table, in parts; a folder is an empty member whose name ends in a slash.

    Of the packages of ``info``, whose data types go with them.
    """
    types = (package_info(staged) if info is None else info).select("package", "data_type_internal")
    files = staged.where(F.col("kind").isin("file", "folder")).select("package", "member", "seq", "content")
    return lookup_join(files, types, ["package"], how="inner", small=small).select("package", "data_type_internal", "member", "seq", "content")


def numbered_header(header: Column) -> Column:
    """Names of a header with their places from 0, and which of equal names each is."""
    return F.transform(
        header,
        lambda c, i: F.struct(
            c.alias("name"), i.alias("pos"), (F.size(F.filter(F.slice(header, 1, i + 1), lambda x: x == c))).alias("number")
        ),
    )


def union_headers(info: DataFrame) -> dict[str, list[HeaderColumn]]:
    """Per data type the columns of all its packages, by first place in a header."""
    layouts = info.select("data_type_internal", "layout", "header").dropDuplicates(["data_type_internal", "layout"])
    names = layouts.select("data_type_internal", F.explode(numbered_header(F.col("header"))).alias("h")).select("data_type_internal", "h.*")
    first = names.groupBy("data_type_internal", "name", "number").agg(F.min("pos").alias("pos"))
    found: dict[str, list[tuple[str, int]]] = {}
    # as many rows as there are column names, however many packages
    for row in first.orderBy("data_type_internal", "pos", "name", "number").collect():
        found.setdefault(row.data_type_internal, []).append((row.name, row.number))
    return {t: column_names(names) for t, names in found.items()}


def read_data_table(
    staged: DataFrame,
    data_types: Iterable[str] | None = None,
    columns: list[HeaderColumn] | None = None,
    info: DataFrame | None = None,
    failed: Unreadable | None = None,
) -> DataFrame:
    """The data tables of all readable packages, or of some data types, as one table of text cells.

    ``package``, ``layout`` (a number for the header as it was), ``_line`` and ``_type`` (of the package) come with the
    named columns; see ``functions.headers`` for names that Spark could not take. Cells a line lacks, and columns a
    package lacks, are blank. ``info`` may be given if it is at hand. Cells are cut in generated code; the place of
    each column is looked up per header.
    """
    failed = unreadable(staged) if failed is None else failed
    info = package_info(staged, failed) if info is None else info
    lines = _readable(staged, _kind(staged, "line"), failed)
    if data_types is not None:
        chosen = F.col("data_type_internal").isin(*data_types)
        info, lines = info.where(chosen), lines.where(chosen)
    if columns is None:
        headers = union_headers(info).values()
        every = {(c.name, c.number) for names in headers for c in names}
        order = {key: i for i, key in enumerate((c.name, c.number) for names in headers for c in names)}
        columns = column_names(sorted(every, key=order.__getitem__))
    places = F.array(*[_place(c) for c in columns]).cast("array<int>")
    headers = info.select("layout", "header").dropDuplicates(["layout"]).withColumn("_h", numbered_header(F.col("header")))
    layouts = headers.select("layout", places.alias("_places"))
    named = lines.select(
        "package", "layout", F.col("data_type_internal").alias("_type"), F.col("seq").alias("_line"), "text"
    )
    few = layouts.limit(FOLDED_LAYOUTS + 1).collect()
    if len(few) <= FOLDED_LAYOUTS:
        # few headers: places are part of the expressions, and lines meet no table
        joined = named.where(F.col("layout").isin([r["layout"] for r in few])) if few else named.where("false")

        def place(i: int) -> Column:
            places = {r["layout"]: r["_places"][i] for r in few}
            if len({*places.values()}) <= 1:
                return F.lit(next(iter(places.values()), None)).cast("int")
            out = F.lit(None).cast("int")
            for layout, at in places.items():
                out = F.when(F.col("layout") == layout, F.lit(at)).otherwise(out)
            return out

    else:
        joined = lookup_join(named, layouts, ["layout"], how="inner")
        place = lambda i: F.get("_places", F.lit(i))
    joined = joined.withColumn("_cells", F.split("text", model.SEPARATOR, -1))

    def cell(i: int) -> Column:
        return F.coalesce(F.get("_cells", place(i)), F.lit(""))

    return joined.select("package", "layout", "_type", "_line", *[cell(i).alias(c.column) for i, c in enumerate(columns)])


def _place(column: HeaderColumn) -> Column:
    own = F.filter("_h", lambda h: (h["name"] == column.name) & (h["number"] == column.number))
    return F.get(own, F.lit(0))["pos"]


def reading_notes(staged: DataFrame, failed: Unreadable | None = None) -> DataFrame:
    """Log rows for what reading changed or left out, counted when the archives were opened."""
    notes = _readable(staged, _kind(staged, "note"), failed).select(
        "package", F.lit("warning").alias("level"), F.lit("validation").alias("log_type"),
        F.when(F.col("seq").isNull(), F.col("text")).otherwise(F.concat("text", F.lit(" in "), F.col("seq"), F.lit(" lines"))).alias("msg"),
    )
    errors = failed_packages(staged).select("package", F.lit("error").alias("level"), F.lit("workflow").alias("log_type"), "msg")
    replaced = _kind(staged, "replaced").select(
        "package", F.lit("warning").alias("level"), F.lit("workflow").alias("log_type"),
        F.concat(F.lit("Another package of this name is used instead of "), "text").alias("msg"),
    )
    return notes.unionByName(errors).unionByName(replaced)
