"""The corpus pipeline: raw documents to packed training sequences, one written table per stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawlane.llm import decontaminate, packing, quality, secrets, setjoin
from rawlane.session import work_path

WORD_BPE = "word_bpe_49k.json"


# All stages keep every column of their input as it is, whatever its name, but for what their docstrings say they change.
# Rows are told apart by id and text, ids may be NULL or repeated, and an empty table gives an empty table.


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects. Empty and NULL texts have too few words; every repeated row stays or goes."""
    return quality.kept_documents(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: five-word shingles, Jaccard similarity of 0.8 or more. The one
    with the smallest id stays (NULL counts as larger than any); of repeated rows one stays."""
    return setjoin.one_of_each(docs, width=5, percent=80)


def unseen_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than 80 per cent of the five-word shingles of every benchmark item. Rows are judged by id
    and text, so of several texts with one id only those that hold an item go; NULL ids are compared like any other."""
    found = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id", "text_hash").distinct()
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs["doc_id"].alias("own_id"), F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("own_hash"))
    same = (rows["own_hash"] == found["text_hash"]) & rows["own_id"].eqNullSafe(found["doc_id"])
    return rows.join(found, same, "left_anti").select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def documents_without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked, ``n_chars`` counted anew. NULL texts stay NULL."""
    out = secrets.masked(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document in pieces of training sequences of at most 2048 tokens: a piece per row, without the documents'
    columns but the id. NULL text counts as empty and is one end token; repeated rows are packed each."""
    pieces = packing.pack(docs, public_tokenizers.path(WORD_BPE), end_id=1, length=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("near-duplicates", distinct_documents),
    ("decontamination", unseen_documents),
    ("secrets", documents_without_secrets),
    ("packing", packed_sequences),
]

#: Similarity joins, randomness tests and token ids are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; what each returns is written and reread before the next one begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
