"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing to target weights, token encoding."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpline.llm import host_rules, line_dedup, mixing, near_dedup, word_bpe
from kelpline.llm.queries import vocabulary
from kelpline.llm.tables import DOCUMENT_COLUMNS, WORD, remove_tables, staged, table, watched


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

def _stage(function: Stage) -> Stage:
    """A stage that keeps no more staged tables than its result reads: the others go before it returns.

    What the result reads stays, so results of several calls stand side by side.
    """

    @functools.wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with watched() as folders:
            found = function(spark, docs, sf_dir)
        read = found.inputFiles()
        remove_tables(spark, [folder for folder in folders if not any(f"/{folder.rsplit('/', 1)[-1]}/" in file for file in read)])
        return found

    return stage


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail a rule themselves nor come from a host that does too often.

    A null, empty or blank text has no words and goes; documents without a source are one host; rows that repeat a document are judged each,
    and alike; other columns are left out; an empty table stays empty.
    """
    return host_rules.quality_rules(docs.select(*DOCUMENT_COLUMNS)).where("kept").select(*DOCUMENT_COLUMNS)


@_stage
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one; a document of which no word is left goes.

    That goes for a null, empty or blank text; of equal lines the first by document id stays, documents without an id
    coming last; rows that repeat id and text are one document, so each keeps the same lines; an empty table stays empty.
    """
    return _documents(line_dedup.dedup_lines(docs.select(*DOCUMENT_COLUMNS)).where(F.col("text").rlike(WORD)))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; rows that repeat a document stay once.

    The least id of a group stays; a text without words is in no group; a document without an id is in no group either and stays; an
    empty table stays empty.
    """
    docs = docs.select(*DOCUMENT_COLUMNS)
    gone = staged(near_dedup.near_duplicates(docs).where("not kept").select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"]).select(*DOCUMENT_COLUMNS)


@_stage
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources to their target weights: a document comes as often as it is taken.

    Documents without a source are a source of their own, the last; a text without words has no size and is not taken;
    rows that repeat a document are taken each by itself; an empty table stays empty.
    """
    return _documents(mixing.mix(docs.select(*DOCUMENT_COLUMNS)))


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, and the text that they decode to.

    A null text is empty and has no tokens; every row has a row, also those that repeat a document or have no id; an empty
    table stays empty.
    """
    path = vocabulary("byte_bpe_50k.json")
    encoded = word_bpe.decode(word_bpe.encode(docs.select("doc_id", "text"), path), path)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES = [("quality rules", quality), ("line dedup", lines), ("near dedup", near_duplicates), ("source mix", mixed), ("tokens", tokens)]

#: Near-dedup, the mix and the tokenizer cannot be expressed in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each is written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
