"""Benchmark decontamination: short test items inside long documents.

A size-partitioned MinHash containment search. Items are partitioned by the number of their shingles. An item's sketch is
its smallest shingle hashes, as many as its size asks for: of ``n`` shingles a document holding ``m = ceil(t n)`` of them
lacks ``n - m``, so among the ``n - m + 1`` smallest at least one is in every such document. Per partition the largest
hash of any sketch is the threshold below which a document's own hashes can matter; a document's sketch is everything
below the highest threshold, whatever the document's length. So nothing is missed, and the share of a document that is
looked up does not grow with it. What the sketches bring together is verified by exact containment of the shingles.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlane.llm.arrow_text import shingle_hashes

#: Up to so many shingles in all items, their table (16 bytes each) goes to every task; beyond that it is joined.
SENT_SHINGLES = 2_000_000

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, width: int) -> set[tuple[str, ...]]:
    """The shingles of a text as words; of a shorter text its whole sequence."""
    words = _WORD.findall((text or "").translate(_FOLD))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width)), strict=False))


def least_contained(n: int, percent: int) -> int:
    """Shingles of an item of ``n`` that a document has to hold."""
    return -(-n * percent // 100)


def _as_signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def item_sketches(items: DataFrame, width: int, percent: int) -> DataFrame:
    """``item, hash, in_sketch``: all shingle hashes of every row of ``item_id, text``, and which are its smallest."""
    fields = [T.StructField("item", items.schema["item_id"].dataType), T.StructField("hash", T.LongType()), T.StructField("in_sketch", T.BooleanType())]
    schema = T.StructType(fields)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_hashes(batch.column(1), width)
            sizes = np.array([len(s) for s in sets], np.int64)
            places = np.concatenate([np.arange(n) for n in sizes]) if len(sets) else np.zeros(0, np.int64)
            n = np.repeat(sizes, sizes)
            kept = places < n - (-(-n * percent // 100)) + 1
            items_ = batch.column(0).take(pa.array(np.repeat(np.arange(len(sets)), sizes)))
            hashes = _as_signed(np.concatenate(sets)) if len(sets) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([items_, pa.array(hashes), pa.array(kept)], schema.names)

    return items.mapInArrow(sketch, schema)


def _matched(docs: DataFrame, rows: list, width: int, percent: int) -> DataFrame:
    """Documents against items whose shingles were sent along."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("text_hash", T.LongType()), T.StructField("place", T.LongType()), T.StructField("n_shared", T.LongType())])
    hashes = np.array([r.hash for r in rows], np.int64).view(np.uint64)
    owners = np.array([r.place for r in rows], np.int64)
    kept = np.array([r.in_sketch for r in rows], bool)
    order = np.argsort(hashes, kind="stable")
    hashes, owners, kept = hashes[order], owners[order], kept[order]
    sizes = np.bincount(owners) if len(owners) else np.zeros(0, np.int64)
    least = -(-sizes * percent // 100)
    size_class = np.log2(np.maximum(sizes, 1)).astype(np.int64)[owners]
    partitions = [np.unique(hashes[kept & (size_class == c)]) for c in np.unique(size_class)]  # each sorted: the last is its threshold

    def in_sketch(own: np.ndarray) -> bool:
        for sketch in partitions:
            low = own[: np.searchsorted(own, sketch[-1], side="right")]
            if len(low) and (sketch[np.searchsorted(sketch, low)] == low).any():
                return True
        return False

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows_, places, shared = [], [], []
            for i, own in enumerate(shingle_hashes(batch.column(2), width)):
                if not in_sketch(own):
                    continue
                begins, ends = np.searchsorted(hashes, own), np.searchsorted(hashes, own, side="right")
                touched = np.flatnonzero(ends > begins)
                counts = np.bincount(np.concatenate([owners[begins[j] : ends[j]] for j in touched]), minlength=len(sizes))
                for place in np.flatnonzero((counts >= least) & (counts > 0)):
                    rows_.append(i)
                    places.append(int(place))
                    shared.append(int(counts[place]))
            if rows_:
                which = pa.array(rows_)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(which), batch.column(1).take(which), pa.array(places, pa.int64()), pa.array(shared, pa.int64())], schema.names)

    return docs.select("doc_id", "text_hash", "text").mapInArrow(search, schema)


def _candidates(docs: DataFrame, sketches: DataFrame, limit: int, width: int) -> DataFrame:
    """``doc_id, text_hash, item``: rows that share a sketch hash, by a join on the hash."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("text_hash", T.LongType()), T.StructField("hash", T.LongType())])
    highest = np.array([limit], np.int64).view(np.uint64)[0]

    def low(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                sets = shingle_hashes(batch.column(2).slice(begin, 500), width)
                sets = [s[: np.searchsorted(s, highest, side="right")] for s in sets]
                which = pa.array(np.repeat(np.arange(begin, begin + len(sets)), [len(s) for s in sets]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(which), batch.column(1).take(which), pa.array(_as_signed(np.concatenate(sets)))], schema.names)

    hits = docs.select("doc_id", "text_hash", "text").mapInArrow(low, schema)
    return hits.join(sketches.where("in_sketch").select("hash", "place"), "hash").select("doc_id", "text_hash", "place").distinct()


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    width: int = 5,
    percent: int = 80,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    sent_shingles: int = SENT_SHINGLES,
) -> DataFrame:
    """``doc_id, item_id, n_shared, n_item, text_hash``: documents that hold at least ``percent`` of an item's shingles.

    Shingles are ``width`` words after folding A-Z, over whole texts; a text with fewer words is one shingle, so an item
    that short is found only in documents that are exactly it. Items and documents without words, or NULL, match nothing.
    Every row that matches gives a row per item, repeated rows of either table too; NULL ids stay; other columns are
    ignored. ``text_hash`` tells rows with equal ids apart.

    The items' shingles are counted first. Up to ``sent_shingles`` they are sent to the tasks, and documents are read once
    without a shuffle; beyond that sketches are joined by hash, and only documents that share one are fetched for the
    verification.
    """
    docs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    items = items.select(items[item_id].alias("item_id"), items[item_text].alias("text"))
    texts = items.select("text").where("text IS NOT NULL").distinct()
    numbered = texts.select(F.xxhash64("text").alias("item_id"), "text")
    sketches = item_sketches(numbered, width, percent)
    total, limit = sketches.agg(F.count("*"), F.max(F.when(F.col("in_sketch"), F.shiftrightunsigned("hash", 1)))).first()
    items = items.withColumn("key", F.xxhash64("text")).drop("text")
    if total <= sent_shingles:
        rows = sketches.select("item", "hash", "in_sketch").collect()  # bounded by the check above
        keys = sorted({r.item for r in rows})
        places = {k: i for i, k in enumerate(keys)}
        found = _matched(docs, [Row(place=places[r.item], hash=r.hash, in_sketch=r.in_sketch) for r in rows], width, percent)
        sizes: dict[int, int] = {}
        for r in rows:
            sizes[r.item] = sizes.get(r.item, 0) + 1
        table = docs.sparkSession.createDataFrame([(places[k], k, sizes[k]) for k in keys], "place long, key long, n_item long")
        found = found.join(table, "place")
    else:
        top = (limit << 1) | 1
        top = top - (1 << 64) if top >= 1 << 63 else top
        pairs = _candidates(docs, sketches.withColumn("place", F.col("item")), top, width)
        with_texts = docs.join(pairs.distinct(), ["text_hash"]).where(docs["doc_id"].eqNullSafe(pairs["doc_id"]))
        with_texts = with_texts.select(docs["doc_id"], "text_hash", docs["text"], F.col("place").alias("key"))
        with_texts = with_texts.join(numbered.select(F.col("item_id").alias("key"), F.col("text").alias("item_text")), "key")
        found = _verified(with_texts.select("doc_id", "text_hash", "key", "text", "item_text"), width, percent)
    out = found.join(items, "key")
    return out.select("doc_id", "item_id", "n_shared", "n_item", "text_hash")


def _verified(pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs of texts whose shingles, compared as words, are contained as asked."""
    kept = ("doc_id", "text_hash", "key")
    schema = T.StructType([*(pairs.schema[c] for c in kept), T.StructField("n_shared", T.LongType()), T.StructField("n_item", T.LongType())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, shared, sizes = [], [], []
            for i, (text, item) in enumerate(zip(batch.column(3), batch.column(4), strict=True)):
                wanted = shingles(item.as_py(), width)
                both = len(wanted & shingles(text.as_py(), width))
                if wanted and both >= least_contained(len(wanted), percent):
                    rows.append(i)
                    shared.append(both)
                    sizes.append(len(wanted))
            if rows:
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(pa.array(rows)) for i in range(3)), pa.array(shared, pa.int64()), pa.array(sizes, pa.int64())], schema.names)

    return pairs.mapInArrow(verify, schema)


SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), item_words AS (
  SELECT item_id, row_number() OVER () AS i, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM benchmark
), grams AS (
  SELECT DISTINCT r, doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words
), item_grams AS (
  SELECT DISTINCT i, item_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM item_words
), sizes AS (
  SELECT i, count(*) AS n_item FROM item_grams GROUP BY i
), shared AS (
  SELECT r, doc_id, i, item_id, count(*) AS n_shared FROM grams JOIN item_grams USING (g) GROUP BY ALL
)
SELECT doc_id, item_id, n_shared, n_item FROM shared JOIN sizes USING (i) WHERE 100 * n_shared >= 80 * n_item
"""
