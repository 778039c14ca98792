"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import functools
import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # tables of many columns make generated methods the JVM would only interpret: leave those
    # stages to operators with smaller methods
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

#: Spark's own limit, beyond what the JVM compiles.
HUGE_METHODS = "65535"
#: Partitions in which shuffles of what is written begin, and the size up to which they are joined: in memory rows are several times as large.
SHUFFLE_CUTS, SHUFFLE_BYTES = 1024, "16m"


def builder(app: str = "kelpline") -> SparkSession.Builder:
    """A session builder with the settings the jobs expect; master and sizes are the caller's."""
    found = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        found = found.config(key, value)
    return found


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the length of one write."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_removed(spark: SparkSession) -> contextlib.AbstractContextManager:
    """Inside, the shuffles of a plan go when the plan has run. Else they stay until the driver happens to collect its garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@contextlib.contextmanager
def many_partitions(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffles begin with ``SHUFFLE_CUTS`` partitions and the adaptive planner joins them up to ``SHUFFLE_BYTES``, unless the session tells
    otherwise. It never cuts large ones, so what a task sorts would else grow with the table until it spills."""
    few = int(spark.conf.get("spark.sql.shuffle.partitions")) < SHUFFLE_CUTS
    cuts = {"coalescePartitions.initialPartitionNum": str(SHUFFLE_CUTS)} if few else {}
    with contextlib.ExitStack() as stack:
        for name, value in (cuts | {"advisoryPartitionSizeInBytes": SHUFFLE_BYTES}).items():
            if spark.conf.get(f"spark.sql.adaptive.{name}", None) is None:
                stack.enter_context(setting(spark, f"spark.sql.adaptive.{name}", value))
        yield


def small_methods(spark: SparkSession) -> None:
    """Give a session of another make the limit on fused methods of ``SETTINGS``, unless it has one of its own."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key) == HUGE_METHODS:
        spark.conf.set(key, SETTINGS[key])


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name under the shared folder the cluster sets in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one machine, may do without the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="kelpline-")
    return f"{root.rstrip('/')}/kelpline-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a staged table, or a part of it, that no plan needs any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, unless the session was given it."""
    _ship(spark.sparkContext.applicationId, spark)


@functools.cache
def _ship(app: str, spark: SparkSession) -> None:
    here = pathlib.Path(__file__).resolve().parent
    target = pathlib.Path(tempfile.mkdtemp(prefix="kelpline-")) / f"{here.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(here.rglob("*.py")):
            archive.write(file, file.relative_to(here.parent))
    # the driver serves the file to executors, so a folder of its own will do
    spark.sparkContext.addPyFile(str(target))
