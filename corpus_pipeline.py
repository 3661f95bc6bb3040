"""The corpus pipeline: toxic documents go, repeated lines go, one document of each near-duplicate group stays,
contaminated documents go, and the rest is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one reads what it returned as Parquet. All but
the last return the columns of documents, whatever else there was beside; an empty table goes through as one.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.llm import bpe, contamination, linededup, neardup, toxicity
from lexispark.llm._tables import forget, shared_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _measured(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity stays below the limit; the model is fitted on labels of these documents."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.toxicity(docs, model).where(~F.col("toxic")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; of each group of lines one occurrence is left."""
    return _measured(linededup.dedup_lines(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, the one with the smallest id; documents without words are in no group. Rows of one
    id are one document, and those of a null id are in no group."""
    out = neardup.near_duplicates(docs.select("doc_id", "text")).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(out, "doc_id", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark. Rows are told apart by id and text, null ids included."""
    keyed = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    found = contamination.contamination(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col="_row")
    out = found.where("n_hit > 0").select(F.col("doc_id").alias("_row")).distinct()
    return keyed.join(out, "_row", "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded_sha256): token ids, and the hash of the bytes that they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_duplicates), ("decontamination", drop_contaminated), ("encode", encode)]

#: Models, SimHashes and byte-pair merges can't be written as SQL; the tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    forget(spark, base)
    for name, stage in STAGES:
        path = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
