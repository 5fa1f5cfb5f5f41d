"""Token ids in Parquet list columns, in document order, with an index over them.

The files hold one row per document: ``doc_id, part, start_in_part, n_tokens, tokens``. The list column is dictionary
encoded (ids repeat, and a vocabulary fits one dictionary page; delta encoding follows where it does not), row groups and
pages have a set size, and the writer adds column and offset indexes. So a reader that wants a few documents, or the
lengths alone, opens only the pages it needs.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlane.llm.subwords import encoder

#: Tokens in an Arrow batch on their way to the writer.
BATCH_TOKENS = 1 << 18


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    row_group_bytes: int = 64 << 20,
    page_bytes: int = 256 << 10,
) -> None:
    """Encode every whole text, append ``end_id``, and write all rows to ``path`` in ascending id order.

    The range shuffle carries texts, which are smaller than their ids, and splits equal ids by a hash of the text. Rows
    with equal ids follow one another ordered by that hash, NULL ids come first, NULL text counts as empty, and other
    columns are ignored. Files appear only when their task has been committed, so a lost executor leaves none behind.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("part", T.IntegerType()),
            T.StructField("start_in_part", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("tokens", T.ArrayType(T.IntegerType(), False)),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, start = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            held: list[np.ndarray] = []
            first, size = 0, 0

            def rows() -> pa.RecordBatch:
                nonlocal start
                lengths = np.array([len(x) for x in held], np.int64)
                ends = np.cumsum(lengths)
                tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(np.concatenate(held)))  # noqa: B023
                columns = [batch.column(0).slice(first, len(held)), pa.array(np.full(len(held), part, np.int32)), pa.array(start + ends - lengths), pa.array(lengths), tokens]  # noqa: B023
                start += int(ends[-1])
                return pa.RecordBatch.from_arrays(columns, schema.names)

            for ids in words.documents(batch.column(1), end_id):
                held.append(ids)
                size += len(ids)
                if size >= BATCH_TOKENS:
                    yield rows()
                    first, size, held = first + len(held), 0, []
            if held:
                yield rows()

    ordered = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    (
        ordered.mapInArrow(encode, schema)
        .write.option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.dictionary.page.size", 1 << 20)
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("compression", "zstd")
        .parquet(path)
    )


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` of the files with ``start``: the tokens of all documents before.

    The table of parts has one row per file written, at most the session's shuffle partitions, so it may be broadcast.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("of_part"))
    parts = parts.select("part", F.coalesce(F.sum("of_part").over(before), F.lit(0)).alias("part_start"))
    return rows.join(F.broadcast(parts), "part").withColumn("start", F.col("part_start") + F.col("start_in_part"))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, part`` of every document: where its tokens lie among all. Reads no tokens."""
    rows = spark.read.parquet(path).select("doc_id", "part", "start_in_part", "n_tokens")
    return _placed(rows).select("doc_id", "start", "n_tokens", "part")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, tokens`` of every document, read back from the files."""
    return _placed(spark.read.parquet(path)).select("doc_id", "start", "n_tokens", "tokens")


def with_crc32(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: the checksum of the ids as little-endian unsigned 32-bit integers."""
    schema = T.StructType([*(tokens.schema[c] for c in ("doc_id", "start")), T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            at = lists.offsets.to_numpy()
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.diff(at).astype(np.int64)), pa.array(sums, pa.int64())], schema.names)

    return tokens.select("doc_id", "start", "tokens").mapInArrow(checksums, schema)
