"""Documents made ready for training: five stages, each on all that the one before kept.

Language ID drops what it rejects; of every group of near duplicates the document with the
smallest identifier stays; documents that hold a benchmark item go; secrets are masked; the rest
is encoded and decoded again. Every stage but the last returns the columns of ``documents``.

Both dropping joins go by a stored number of each row, not by ``doc_id``, so a row never takes
another one of its identifier with it.

Defined results: rows without identifier go like all others if they are near copies, also of one
another, or hold a benchmark item; of rows with one identifier the near copies go and those that
differ stay; null texts are rejected by the first stage; an empty table gives an empty
result. ``lang`` and ``source`` are never looked at to drop a document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wirecount.llm import bpe, contamination, jaccard, langid, secret_scan
from wirecount.llm.common import free_name, stored
from wirecount.llm.queries import BYTE_BPE, language_model


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs, language_model(docs))


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written with a number for each row, and the name of that column."""
    row = free_name(docs, "row")
    return stored(docs.withColumn(row, F.monotonically_increasing_id())), row


def _without(docs: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """The rows whose number is not among ``gone (row)``, without the number."""
    return docs.join(gone.select(F.col(row)), row, "left_anti").drop(row)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    numbered, row = _numbered(docs)
    grouped = jaccard.near_duplicates(numbered.select(row, "text"), key=row).select(
        row, "group_id")
    # The smallest identifier of a group stays, one without only where none has any; among its
    # rows the content decides, whatever number a row got.
    content = F.xxhash64(*(F.col(c) for c in docs.columns))
    placed = stored(grouped.join(numbered.select(
        F.col(row), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id",
                             content.alias("content"), F.col(row).alias("at"))
        .alias("place")), row))
    first = placed.groupBy("group_id").agg(F.min("place").alias("first"))
    stay = first.select(F.col("first.at").alias(row))
    return _without(numbered, row, placed.join(stay, row, "left_anti"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    numbered, row = _numbered(docs)
    found = contamination.contaminated(numbered.select(row, "text"), benchmark, key=row)
    return _without(numbered, row, found.select(row).distinct())


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scanner = secret_scan.train(secret_scan.dictionary(docs))
    masked = secret_scan.redact(docs, scanner, path="source")
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(docs, BYTE_BPE)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", join_near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", mask_secrets),
    ("BPE encoding and decoding", encode),
]
#: The first and the fourth stage have trained models, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
