"""Packing documents into training sequences along a space-filling curve.

Every document's hashed bag of words is projected to a few dimensions by random signs and scaled to unit length, so its
direction counts and its length doesn't; the Hilbert key of that point orders documents so that neighbours on the curve
share words. Documents are range-sorted by key, in ranges of about equal bytes, and every partition cuts its stretch of the
curve into sequences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlane.llm.arrow_text import buffers, mix, word_hashes
from rawlane.llm.subwords import encoder
from rawlane.session import work_path

DIMENSIONS, BITS = 6, 10


def curve_points(column: pa.Array) -> np.ndarray:
    """The cell of every text in a grid of 2^10 steps in each of six dimensions. Texts without words lie in the middle.

    Six sums of signs estimate the length of the vector of word counts as well as its direction, so texts of any length
    spread over the whole sphere.
    """
    words, firsts = word_hashes(column)
    signs, sums = mix(words), np.zeros((len(words) + 1, DIMENSIONS), np.int32)
    for d in range(DIMENSIONS):
        np.cumsum(((signs >> np.uint64(7 * d)) & np.uint64(1)).astype(np.int8) * 2 - 1, dtype=np.int32, out=sums[1:, d])
    toward = (sums[firsts[1:]] - sums[firsts[:-1]]).astype(float)
    toward /= np.maximum(np.sqrt((toward**2).sum(1)), 1)[:, None]
    return np.minimum(((toward + 1) / 2 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """The place of grid cells along the Hilbert curve.

    From the highest bit down, each step undoes the reflection or exchange of axes that the curve applies to the half the
    cell lies in; what remains is a Gray code, read out with the dimensions' bits interleaved.
    """
    x = points.T.copy()
    dims = len(x)
    for bit in range(BITS - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(dims):
            high = (x[d] >> bit) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(high, low, swap)
            if d:
                x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for bit in range(BITS - 1, 0, -1):
        turn ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= turn
    keys = np.zeros_like(x[0])
    for bit in range(BITS - 1, -1, -1):
        for d in range(dims):
            keys = (keys << 1) | ((x[d] >> bit) & 1)
    return keys


def _cuts(keys: DataFrame, partitions: int, most_bytes: int, per_partition: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Where the curve is cut into ranges of about equal bytes: the last key (place and tie) of all ranges but one.

    ``keys`` has ``curve, tie, bytes`` per document. There are as many ranges as ``partitions``, fewer where they would
    hold less than a megabyte and more where they would hold over ``most_bytes``. Documents are drawn in proportion to
    their bytes, some ``per_partition`` for a range, so what the driver gets is bounded by the number of ranges.
    """
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    ranges = max(min(partitions, -(-total >> 20)), -(-total // most_bytes), 1)
    draw = F.pmod(F.xxhash64("tie", "curve"), F.lit(1 << 20)) / (1 << 20)
    drawn = keys.withColumn("times", F.floor(F.col("bytes") * (ranges * per_partition / max(total, 1)) + draw)).where("times > 0")
    drawn = drawn.select("curve", "tie", "times").toArrow()
    curve, tie, times = (drawn[c].to_numpy() for c in ("curve", "tie", "times"))
    order = np.lexsort((tie, curve))
    passed = np.cumsum(times[order])
    if not len(passed):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = order[np.searchsorted(passed, passed[-1] * np.arange(1, ranges) / ranges)]
    return curve[at], tie[at]


def _range_of(curve: np.ndarray, tie: np.ndarray, cuts: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The range that each key lies in. Equal places on the curve are told apart by their ties."""
    low, high = (np.searchsorted(cuts[0], curve, side) for side in ("left", "right"))
    for i in np.flatnonzero(low < high):
        low[i] += np.searchsorted(cuts[1][low[i] : high[i]], tie[i])
    return low


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    length: int = 2048,
    doc_id: str = "doc_id",
    text: str = "text",
    most_bytes: int = 128 << 20,
) -> DataFrame:
    """Pieces of all documents, laid into sequences of at most ``length`` (a power of two) tokens.

    One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``; ``ids`` are its token ids as
    little-endian unsigned 32-bit integers, ``start`` the document's tokens before it, ``offset`` its place in the
    sequence. A document is cut wherever a sequence is full. What is left at the end of a partition goes into sequences of
    falling powers of two, so nothing is ever padded.

    NULL text counts as empty: such a document is ``end_id`` alone. Ties on the curve are ordered by a hash of id and text,
    so copies don't have to meet in one partition. Repeated rows are packed each for itself. Other columns are ignored.
    A partition gets about ``most_bytes`` of text at most, more only by what one document is longer.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    id_field = T.StructField("doc_id", docs.schema[doc_id].dataType)
    keyed = T.StructType.fromDDL("curve long, tie long, bytes long")
    placed = T.StructType([id_field, *T.StructType.fromDDL("text string, curve long, tie long, range int").fields])
    longs = ("doc_tokens", "sequence_id", "offset")
    schema = T.StructType(
        [id_field, T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())]
        + [T.StructField(c, T.LongType()) for c in longs]
    )

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            curve, sizes = hilbert_keys(curve_points(batch.column(1))), np.diff(buffers(batch.column(1))[1])
            yield pa.RecordBatch.from_arrays([pa.array(curve), batch.column(2), pa.array(sizes)], keyed.names)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            curve = hilbert_keys(curve_points(batch.column(1)))
            ranges = _range_of(curve, batch.column(2).to_numpy(), cuts).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(curve), batch.column(2), pa.array(ranges)], placed.names)

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, first = encoder(tokenizer_path), TaskContext.get().partitionId() << 40
        sequence, filled = 0, 0
        full: list[tuple] = []
        open_pieces: list[tuple] = []  # of the sequence being filled
        for batch in batches:
            for key, ids in zip(batch.column(0), words.documents(batch.column(1), end_id), strict=True):
                at = 0
                while at < len(ids):
                    take = min(length - filled, len(ids) - at)
                    open_pieces.append((key, at, ids[at : at + take], len(ids), first + sequence, filled))
                    at, filled = at + take, filled + take
                    if filled == length:
                        full += open_pieces
                        open_pieces, sequence, filled = [], sequence + 1, 0
                if len(full) >= 2000:
                    yield rows(full)
                    full = []
        for key, start, ids, total, _, place_ in open_pieces:
            at = 0
            while at < len(ids):
                began, room = tail_block(filled, place_ + at)
                take = min(room - (place_ + at - began), len(ids) - at)
                k = sequence + (filled >> room.bit_length()).bit_count()
                full.append((key, start + at, ids[at : at + take], total, first + k, place_ + at - began))
                at += take
        if full:
            yield rows(full)

    def tail_block(total: int, at: int) -> tuple[int, int]:
        """Start and size of the block that holds place ``at`` when ``total`` is cut into its powers of two, large to small."""
        began = 0
        for bit in range(total.bit_length() - 1, -1, -1):
            if total >> bit & 1:
                if at < began + (1 << bit):
                    return began, 1 << bit
                began += 1 << bit
        raise IndexError(at)

    def rows(pieces: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*pieces, strict=True))
        lengths = [len(x) for x in columns[2]]
        ids = pa.array([x.astype("<u4").tobytes() for x in columns[2]], pa.binary())
        keys = pa.array([k.as_py() for k in columns[0]], columns[0][0].type)
        values = [keys, pa.array(columns[1], pa.int64()), pa.array(lengths, pa.int64()), ids, *(pa.array(c, pa.int64()) for c in columns[3:])]
        return pa.RecordBatch.from_arrays(values, schema.names)

    spark, path = docs.sparkSession, work_path(docs.sparkSession, "packing")
    tied = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), F.xxhash64(docs[doc_id], docs[text]).alias("tie"))
    tied.mapInArrow(keys, keyed).write.parquet(path)
    cuts = _cuts(spark.read.parquet(path), int(spark.conf.get("spark.sql.shuffle.partitions")), most_bytes)
    ordered = tied.mapInArrow(place, placed).repartitionById(len(cuts[0]) + 1, "range").sortWithinPartitions("curve", "tie")
    return ordered.select("doc_id", "text").mapInArrow(lay, schema)
