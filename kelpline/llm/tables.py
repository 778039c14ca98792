"""Reading the corpus tables, and tables staged in the shared folder."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.session import remove_folder, scratch_folder, setting, shuffles_removed

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Word separators: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows in a batch that crosses to Python.
BATCH_ROWS = 2000

_watched: list[list[str]] = []


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again.

    Cuts the lineage, so a lost executor costs no more than the tasks after this point, and
    makes keys such as ``monotonically_increasing_id`` final.
    """
    spark, folder = df.sparkSession, scratch_folder(df.sparkSession)
    for folders in _watched:
        folders.append(folder)
    # nobody needs the shuffles of a plan that ends here; batches that cross to Python are held by both sides
    with shuffles_removed(spark), setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS)):
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


@contextlib.contextmanager
def watched() -> Iterator[list[str]]:
    """The folders of the tables that are staged inside."""
    folders: list[str] = []
    _watched.append(folders)
    try:
        yield folders
    finally:
        _watched.remove(folders)


def remove_tables(spark: SparkSession, folders: list[str]) -> None:
    """Delete staged tables that no plan needs any more."""
    for folder in folders:
        remove_folder(spark, folder)
    folders.clear()


#: A staged table of at most so many rows, and of so many items in its lists (32 MB of numbers), is read as one partition.
SMALL = 100_000
SMALL_ITEMS = 1 << 22


def fitted(df: DataFrame, small: int = SMALL) -> DataFrame:
    """A staged table; one of at most ``small`` rows and ``SMALL_ITEMS`` items in lists is one partition, so that what follows shuffles nothing."""
    df = staged(df)
    if df.limit(small + 1).count() > small:
        return df
    lists = [F.coalesce(F.sum(F.greatest(F.size(F.col(c)), F.lit(0))), F.lit(0)) for c, kind in df.dtypes if kind.startswith("array")]
    return df if lists and sum(df.agg(*lists).first()) > SMALL_ITEMS else df.coalesce(1)
