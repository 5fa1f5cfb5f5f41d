"""Token counts without tokens: only lengths leave the Python worker."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rawlane.llm.arrow_text import buffers
from rawlane.llm.subwords import encoder


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, over whole texts.

    Texts reach the encoder in runs balanced by bytes; a text longer than a run is split at white space, where no token
    can straddle the cut. NULL text counts as empty: 0 bytes, 0 tokens. Every row, repeated or not, gives one row; a NULL
    id stays NULL; other columns are ignored; an empty table gives an empty table.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[doc_id].dataType),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer_path)
        for batch in batches:
            n = words.counts(batch.column(1))
            size = np.diff(buffers(batch.column(1))[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(count, schema)
