"""Files assembled in place by many tasks.

Every task writes its parts of a file at their offsets, so a file of any size is never collected
anywhere. What a file is made of need not go through the plan: a task may put bytes aside in a body file of its own, and later
tasks copy ranges of such files, or of any others, to their places. The target must be a folder all executors have mounted.

The writer is a data source of Spark: files grow in a hidden folder of the run; when all tasks are done the driver checks
their sizes and gives them their names, and if the job fails it removes the hidden folder. Writing a part twice writes the
same bytes to the same place, so a repeated task does no harm.
"""

from __future__ import annotations

import contextlib
import os
import shutil
import uuid
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from kelpline.session import ship_package, shuffles_removed

BLOCK = 131_072
#: So many bytes of a file next to each other are written by one task.
RANGE_BYTES = 8 * 1024 * 1024
COPY_BYTES = 1024 * 1024
#: Of bytes that are put aside squeezed.
SQUEEZED = "zstd"
#: Names are given by so many threads of the driver.
NAMING_THREADS = 16


def local_folder(path: str) -> str:
    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    if "://" in path or not path.startswith("/"):
        raise ValueError(f"needs a folder all executors have mounted: {path}")
    return path.rstrip("/")


def is_mounted(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def sums_before(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """For each row the sum of ``values`` over the earlier rows of its key, and the key's total.

    ``order`` is a number unique per key. Sums are taken per block of numbers and then over the
    blocks, so that no task holds all rows of a large key.
    """
    blocked = df.withColumn("_block", F.floor(F.col(order) / BLOCK))
    blocks = blocked.groupBy(*keys, "_block").agg(*[F.sum(v).alias(f"_b_{v}") for v in values])
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*keys)
    bases = blocks.select(
        *keys,
        "_block",
        *[F.coalesce(F.sum(f"_b_{v}").over(earlier), F.lit(0)).alias(f"_base_{v}") for v in values],
        *[F.sum(f"_b_{v}").over(everything).alias(f"{v}_total") for v in values],
    )
    within = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inner = blocked.withColumns({f"_in_{v}": F.coalesce(F.sum(v).over(within), F.lit(0)) for v in values})
    joined = inner.join(bases, [*keys, "_block"])
    return joined.withColumns({f"{v}_before": F.col(f"_base_{v}") + F.col(f"_in_{v}") for v in values}).drop(
        "_block", *[f"_base_{v}" for v in values], *[f"_in_{v}" for v in values]
    )


def run_folder(folder: str, run: str) -> str:
    """Where a run keeps its bodies and the files that have no name yet."""
    return f"{folder}/.{run}"


def discard(folder: str, run: str) -> None:
    shutil.rmtree(run_folder(folder, run), ignore_errors=True)


class BodyFile:
    """Bytes a task puts aside. The name is that of an attempt, so attempts never meet; rows tell the one that counts."""

    def __init__(self, folder: str, run: str):
        self.path = f"{run_folder(folder, run)}/bodies/{uuid.uuid4().hex}"
        self.file, self.size = None, 0

    def put(self, data: bytes) -> int:
        """Add bytes; where they begin."""
        if self.file is None:
            os.makedirs(os.path.dirname(self.path), exist_ok=True)
            self.file = open(self.path, "wb")
        self.file.write(data)
        self.size += len(data)
        return self.size - len(data)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class _Open:
    """The file used last, by its path, since rows are in the order of files."""

    def __init__(self, flags: int):
        self.flags, self.path, self.handle = flags, None, None

    def at(self, path: str) -> int:
        if path != self.path:
            self.close()
            if self.flags & os.O_CREAT:
                os.makedirs(os.path.dirname(path), exist_ok=True)
            self.handle, self.path = os.open(path, self.flags, 0o644), path
        return self.handle

    def close(self) -> None:
        if self.handle is not None:
            os.close(self.handle)
        self.path = self.handle = None


def squeezed(data: bytes) -> bytes:
    """Bytes to be put aside that would else lie on the disk twice while they are placed."""
    return pa.Codec(SQUEEZED, compression_level=3).compress(data, asbytes=True)


def _put(target: int, offset: int, data: memoryview) -> None:
    done = 0
    while done < len(data):
        done += os.pwrite(target, data[done:], offset + done)


def _copy(source: int, at: int, target: int, offset: int, size: int, path: str) -> None:
    """A range of one file to a place in another; the kernel does it where it can."""
    in_kernel = hasattr(os, "copy_file_range")
    while size:
        n = 0
        if in_kernel:
            try:
                n = os.copy_file_range(source, target, size, at, offset)
            except OSError:
                in_kernel = False
                continue
        else:
            data = os.pread(source, min(size, COPY_BYTES), at)
            _put(target, offset, memoryview(data))
            n = len(data)
        if not n:
            raise OSError(f"{path} is shorter than it was")
        at, offset, size = at + n, offset + n, size - n


@dataclass
class Written(WriterCommitMessage):
    """Bytes that a task wrote, by file."""

    sizes: dict[str, int] = field(default_factory=dict)


class PlacedWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, run: str):
        self.folder, self.run = folder, run

    def _part(self, file: str) -> str:
        return f"{run_folder(self.folder, self.run)}/parts/{file}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        sizes: Counter[str] = Counter()
        target, source = _Open(os.O_WRONLY | os.O_CREAT), _Open(os.O_RDONLY)
        with contextlib.closing(target), contextlib.closing(source):
            for batch in iterator:
                columns = (batch[c].to_pylist() for c in ("file", "offset", "size", "body", "at", "stored"))
                for file, offset, size, body, at, stored, content in zip(*columns, batch["content"]):
                    handle = target.at(self._part(file))
                    if body is None:
                        _put(handle, offset, memoryview(content.as_buffer()))
                    elif stored is not None:
                        data = os.pread(source.at(body), stored, at)
                        _put(handle, offset, memoryview(pa.Codec(SQUEEZED).decompress(data, decompressed_size=size)))
                    else:
                        _copy(source.at(body), at, handle, offset, size, body)
                    sizes[file] += size
        return Written(dict(sizes))

    def _name(self, file: str, size: int) -> None:
        part, whole = self._part(file), f"{self.folder}/{file}"
        found = os.path.getsize(part) if os.path.exists(part) else None
        if found != size:
            raise OSError(f"{part} has {found} bytes of {size}: is {self.folder} mounted on all executors?")
        os.makedirs(os.path.dirname(whole), exist_ok=True)
        os.replace(part, whole)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Give the files their names; each is complete or has none."""
        sizes: Counter[str] = Counter()
        # as many names as there are files; their parts are the tasks'
        for message in messages:
            sizes.update(message.sizes if isinstance(message, Written) else {})
        with ThreadPoolExecutor(NAMING_THREADS) as pool:
            for _ in pool.map(lambda item: self._name(*item), sizes.items()):
                pass
        discard(self.folder, self.run)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        discard(self.folder, self.run)


class PlacedFiles(DataSource):
    """Only to be written: ``file, offset, size, content, body, at, stored``; options ``folder`` and ``run``."""

    @classmethod
    def name(cls) -> str:
        return "placed_files"

    def writer(self, schema: StructType, overwrite: bool) -> PlacedWriter:
        return PlacedWriter(self.options["folder"], self.options["run"])


def write_placed(parts: DataFrame, folder: str, run: str | None = None) -> DataFrame:
    """Write ``parts`` as files of ``folder`` and list them: ``(file, size)``.

    A part is ``(file, offset, content)``, or without content ``(file, offset, size, body, at)``: a range of the file
    ``body``; with ``stored`` it has so many bytes there, ``squeezed`` from ``size``. Parts must not overlap. Files get their names only when all are complete; a file that exists is replaced.
    """
    spark, folder = parts.sparkSession, local_folder(folder)
    ship_package(spark)
    os.makedirs(folder, exist_ok=True)
    if "body" not in parts.columns:
        parts = parts.withColumns({"size": F.octet_length("content").cast("long"), "body": F.lit(None).cast("string"), "at": F.lit(None).cast("long")})
    if "stored" not in parts.columns:
        parts = parts.withColumn("stored", F.lit(None).cast("long"))
    run = uuid.uuid4().hex if run is None else run
    # the rows are small and the bytes they stand for are not, so the rows are dealt out by number
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = parts.select("file", "offset", "size", "content", "body", "at", "stored").repartition(tasks, "file", F.floor(F.col("offset") / RANGE_BYTES))
    spark.dataSource.register(PlacedFiles)
    try:
        with shuffles_removed(spark):
            dealt.sortWithinPartitions("file", "offset").write.format(PlacedFiles.name()).mode("append").option("folder", folder).option("run", run).save()
    except Exception:
        # the job may have failed before the writer began
        discard(folder, run)
        raise
    return parts.groupBy("file").agg(F.sum("size").alias("size"))
