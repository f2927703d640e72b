"""The corpus pipeline: raw documents in, sharded training mix out.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; what it returns is written as Parquet and read again as the next one's
documents.  All stages but the last return the columns they are given, with
their values, whatever the names; repeated rows are rows like others but for
the deduplication, which keeps one of them.  Empty documents give empty stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetra.llm import decontam, mixing, neardup, pu_quality, sharding
from telemetra.llm.queries import table
from telemetra.operators.staging import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    A NULL text is judged as an empty one; equal texts are all kept or all
    rejected.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), "doc_id", "text")
    judged = pu_quality.classify(packed, table(spark, sf_dir, "labels"))
    return judged.filter("predicted = 1").select("_doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, that with the smallest
    doc_id (NULL last); texts without words, NULL among them, are alike only
    if equal."""
    return neardup.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; a NULL or empty text holds none."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources along their curriculum: each document as often as
    the mix holds it, range-sorted by training position, so that what is
    written holds the mix in training order, file after file.

    Documents tie in no order (md5 of id and text, repeated rows are
    interchangeable).  A NULL source is one of its own.  NULL and empty texts
    have no words and take none; they come along where they stand.
    """
    return mixing.emit(docs)


def in_written_order(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_training_file`` and ``_training_row``: the place of a
    row in the files that ``docs`` reads.

    A scan takes files in an order of its own; Spark's writers name them by
    partition (part-N) and by file of the partition (-cN).  A frame over
    files has to be the plain read of them, as the stages get it.  Rows that
    come from no file are written first, which keeps the order they stand in.
    """
    try:
        at = docs.metadataColumn("_metadata")
        docs.select(at)
    except AnalysisException:
        docs = stage(docs, "pipeline-unwritten")
        at = docs.metadataColumn("_metadata")
    path = at["file_path"]
    part, file = (F.lpad(F.regexp_extract(at["file_name"], name, 1), 10, "0") for name in (r"^part-(\d+)", r"-c(\d+)\."))
    return docs.withColumns({"_training_file": F.concat_ws("/", part, file, path), "_training_row": at["row_index"]})


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot; columns of the names that are
    added are replaced.

    A shard is a sample of the mix by text, of which the copies stay
    together; its slots follow the training order in which ``mix`` wrote it.
    """
    return sharding.shard(in_written_order(docs), order=("_training_file", "_training_row"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("shards", shards),
]

#: The first stages rest on a trained model, sampling and fingerprints: SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
