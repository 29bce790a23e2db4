"""A training corpus from raw documents: five stages, each written and read again.

language ID -> exact dedup -> n-gram Jaccard join -> mixing -> SentencePiece.
Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns rows with the columns of ``documents``; the last returns the token digests.
The rows travel through a stage as one struct, beside the columns that its operator
reads, so columns of the input may have any names.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationqc.llm import exact_dedup, langid, mixing, ngram_join, pieces
from stationqc.llm.common import shared_folder, word_count
from stationqc.llm.queries import PIECE_MODEL


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns, and every row whole in the struct ``row``."""
    return docs.select(*columns, F.struct("*").alias("row"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model, trained on the input's own labels, does not reject."""
    model = langid.fit(docs.select("doc_id", "lang", "text").filter(~langid.held_out()))
    return langid.identify(packed(docs, "text"), model).filter("accepted").select("row.*")


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one row stays: the smallest doc_id (one of rows that repeat it)."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    kept = (exact_dedup.exact_dedup(docs.select("doc_id", "text")).filter("kept")
            .select(name.alias("id"), F.col("text_sha256").alias("sha")))
    rows = packed(docs, "doc_id", "text").select(name.alias("id"), exact_dedup.text_sha256(F.col("text")).alias("sha"), "row")
    return rows.join(kept, ["id", "sha"], "left_semi").dropDuplicates(["id", "sha"]).select("row.*")


def distinct_contents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-copy links connect, the one with the smallest doc_id stays."""
    keep = (ngram_join.near_components(docs.select("doc_id", "text")).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("keep")).distinct())
    return packed(docs, "doc_id").join(keep, F.col("doc_id").eqNullSafe(F.col("keep")), "left_semi").select("row.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: taken / size, rounded up; those not drawn leave."""
    size = word_count(F.col("text")).alias("size")
    taken = mixing.mix_rows(docs.select("doc_id", "source", size)).filter("size > 0")
    times = (taken.groupBy("doc_id", "source", "size").agg(F.max(F.ceil(F.col("taken") / F.col("size"))).alias("times"))
             .select(F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("size").alias("n"), "times"))
    rows = packed(docs, "doc_id", "source", "text").select("doc_id", "source", size, "row")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("n"))
    return (rows.join(times, same).filter("times > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select("row.*"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining text, decoded and digested."""
    return pieces.encode_digests(docs.select("doc_id", "text"), public_tokenizers.path(PIECE_MODEL))


STAGES = [("language_id", known_language), ("exact_dedup", distinct_texts), ("ngram_join", distinct_contents),
          ("mixing", mixed), ("sentencepiece", tokenized)]

#: Language ID is a trained model, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; stage tables lie in the shared folder of the session."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
