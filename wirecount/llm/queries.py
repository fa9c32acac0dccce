"""The registered queries: each operator over its whole table, with production settings."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wirecount.llm import (
    bpe, centroids, chat, contamination, jaccard, langid, licenses, prints, quality, secret_scan,
    warc, whitening, wordpiece,
)
from wirecount.llm.common import stored, table, text_of
from wirecount.session import scratch_dir

QUERIES = {}
BYTE_BPE = str(public_tokenizers.path("byte_bpe_50k.json"))


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.sql(f"""
        SELECT CAST(-1 AS BIGINT) conv_id, CAST(turn AS BIGINT) turn, role, '{said}' text
        FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)""")
    read = chat.read_back(chat.windows(turns.unionByName(more)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read.select(
        "conv_id", F.struct("start", told.alias("told"),
                            F.array_join("learned", "").alias("learned")).alias("part"),
        F.size("turns").alias("n"), F.length("text").alias("chars"))
    whole = parts.groupBy("conv_id").agg(
        F.sort_array(F.collect_list("part")).alias("parts"), F.sum("n").alias("n"),
        F.sum("chars").alias("chars"))
    learned = F.array_join(F.transform("parts", lambda p: p["learned"]), "")
    return whole.select(
        "conv_id", F.col("n").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("parts", lambda p: p["told"]), ""), 256)
        .alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.col("chars").cast("long").alias("formatted_chars"))


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), BYTE_BPE)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    records = warc.with_references(pages, least=0)
    manifest = stored(warc.write(records, f"{scratch_dir(spark)}/archives"))
    chunks = warc.read(spark, manifest)
    return chunks.where("last").select(
        "page_id", F.col("payload_bytes"), F.col("digest").alias("payload_digest"),
        "record_type", "refers_to")


def language_model(docs: DataFrame) -> langid.Model:
    """Learned from the labelled documents that are not held out."""
    learned = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    return langid.train(*langid.sample(docs, learned))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, language_model(docs))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = wordpiece.byte_pieces(BYTE_BPE)
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), pieces, pieces,
                                  bytewise=True)


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scanner = secret_scan.train(secret_scan.dictionary(docs))
    found = secret_scan.scan(docs, scanner, path="source")
    return found.select("doc_id", "start", "length", "kind", F.round("score", 6).alias("score"),
                        F.sha2("secret", 256).alias("secret_sha256"))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = licenses.scan(docs, licenses.train(licenses.sample(docs)))
    return found.where(F.col("family") != licenses.UNKNOWN).select(
        "doc_id", "line", "family", F.round("probability", 6).alias("probability"),
        F.round("similarity", 6).alias("similarity"), "confirmed")


@query
def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", text_of("text").alias("text"), F.length(text_of("text")).alias("n"))
    printed = prints.bins(docs, "text", "own", ["doc_id", "text", "n"])
    paired = prints.with_next(printed, "doc_id", "text", ["text", "own"],
                              keys=docs.select("doc_id", "text"))
    half = F.floor(F.col("n") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.col("n") - half),
                      F.substr("next.text", F.lit(1), half))
    whole = prints.held(paired.select(
        "doc_id", "text", "n", "own", "next"), edited=edited).select(
        "doc_id", "n", "own", F.col("next.own").alias("following"), "edited",
        F.sha2("edited", 256).alias("edited_sha256"))
    both = prints.bins(whole, "edited", "changed",
                       ["doc_id", "n", "own", "following", "edited_sha256"])
    return both.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), "edited_sha256",
        prints.packed("own").alias("fingerprint"),
        prints.packed("changed").alias("edited_fingerprint"),
        prints.likeness("own", "changed").alias("near_edited"),
        prints.likeness("own", "following").alias("near_next"))


@query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(table(spark, sf_dir, "embeddings"))


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))
