"""Audit of filter interactions: what every filter does at every place of every order in which filters can be applied.

A document is to this audit the set of filters that it fails, a mask. A mask is mapped to one wide integer with a 64-bit
field for every outcome of every step of every order. Adding up such integers, each times its number of documents, counts
all fields at once, and the sum is cut into fields again at the end. A field grows by no more than the number of orders per
document, which is checked against its width, so no field runs over into the next one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlane.llm.arrow_text import buffers
from rawlane.session import work_path

OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
FIELD_BITS = 64
#: Words are cut from pieces of a text of about this many bytes, so a very long one isn't held as a list of its words.
PIECE_BYTES = 1 << 20
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_INNER = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that do not begin a code point
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


class Counters:
    """Wide integers for the masks of the filters ``letters`` (the first one is bit 0)."""

    def __init__(self, letters: str):
        self.letters, self.orders = letters, ["".join(p) for p in permutations(letters)]
        self.steps = [(order, step) for order in self.orders for step in range(1, len(letters) + 1)]
        bits = np.array([[1 << letters.index(c) for c in order] for order in self.orders])
        self.own = bits.ravel()
        self.earlier = (np.cumsum(bits, axis=1) - bits).ravel()
        self.packed = lru_cache(maxsize=None)(self._packed)  # at most four integers for each mask

    def _packed(self, mask: int, good: bool, toxic: bool) -> int:
        fails, before = (mask & self.own) > 0, (mask & self.earlier) > 0
        removed = fails & ~before
        taken = np.bincount(np.log2(self.own).astype(int)[removed], minlength=len(self.letters))  # removals by filter, over all orders
        fields = np.zeros((len(self.own), len(OUTCOMES)), "<u8")
        fields[:, 0] = (mask & (self.earlier | self.own)) == 0
        fields[:, 1] = removed
        fields[:, 2] = fails & before
        fields[:, 3] = mask == self.own
        fields[:, 4] = removed & good
        fields[:, 5] = removed & toxic
        fields[:, 6] = taken[np.log2(self.own).astype(int)]
        return int.from_bytes(fields.tobytes(), "little")

    def unpacked(self, total: int, documents: int) -> np.ndarray:
        """One row per step, one column per outcome, of the sum of the integers of ``documents`` documents."""
        if documents * len(self.orders) >= 1 << FIELD_BITS - 1:
            raise OverflowError("more documents than a field can count")
        fields = total.to_bytes(len(self.own) * len(OUTCOMES) * FIELD_BITS // 8, "little")
        return np.frombuffer(fields, "<u8").reshape(len(self.own), len(OUTCOMES))


def audit(masks: DataFrame, letters: str) -> DataFrame:
    """``part, filter_order, step`` and one long per outcome, for every part, order of ``letters`` and step.

    ``masks``: ``part, mask, good, toxic, n`` (documents), any number of rows per part. kept: documents left after the
    step; removed: taken out by it; redundant: they fail its filter but were taken out before; unique_fails: they fail its
    filter only; good_lost, toxic_lost: good and toxic ones that it takes out; shapley: what its filter takes out, summed
    over all orders. Rows are summed by mask before they are dealt by part, so a task gets at most four rows per mask
    for a part, however many documents it has.
    """
    schema = T.StructType.fromDDL("part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in OUTCOMES))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = Counters(letters)
        orders, steps = zip(*counters.steps, strict=True)

        def rows(part: str, total: int, documents: int) -> pa.RecordBatch:
            fields = counters.unpacked(total, documents).astype(np.int64)
            names = [pa.array([part] * len(steps)), pa.array(orders), pa.array(steps, pa.int32())]
            return pa.RecordBatch.from_arrays([*names, *(pa.array(np.ascontiguousarray(c)) for c in fields.T)], schema.names)

        here, total, documents = None, 0, 0
        for batch in batches:
            for part, mask, good, toxic, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != here:
                    if here is not None:
                        yield rows(here, total, documents)
                    here, total, documents = part, 0, 0
                total, documents = total + n * counters.packed(mask, good, toxic), documents + n
        if here is not None:
            yield rows(here, total, documents)

    summed = masks.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
    return summed.repartition("part").sortWithinPartitions("part").mapInArrow(add, schema)


def _word_counts(raw: bytes) -> tuple[int, int]:
    """Words and different words."""
    if len(raw) <= PIECE_BYTES:
        words = raw.split()  # of bytes, at the same six characters
        return len(words), len(set(words))
    n, different, at = 0, set(), 0
    while at < len(raw):
        space = _SPACE.search(raw, at + PIECE_BYTES)
        end = space.start() if space else len(raw)
        words = raw[at:end].split()
        n, at = n + len(words), end
        different.update(words)
    return n, len(different)


def _failures(batches: Iterator[pa.RecordBatch], least_words: int, distinct_percent: int, capital_percent: int, symbols: bytes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, offsets = buffers(batch.column(2))
        masks, digests = [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            text = raw[a:b].tobytes()
            words, different = _word_counts(text)
            capitals = len(text) - len(text.translate(None, _CAPITALS))
            points = len(text.translate(None, _INNER))
            masks.append(
                (words < least_words)
                | (100 * different < distinct_percent * words) << 1
                | (100 * capitals > capital_percent * points) << 2
                | (len(text.translate(None, symbols)) < len(text)) << 3
            )
            digests.append(hashlib.sha256(text).digest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())], ["doc_id", "part", "mask", "digest"])


def failed_filters(
    docs: DataFrame,
    labels: DataFrame,
    least_words: int = 200,
    distinct_percent: int = 50,
    capital_percent: int = 2,
    symbols: str = "#$%&*|",
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """``part, mask, good, toxic, n``: documents by the filters ABCDE that they fail (A is bit 0) and by their labels.

    A: fewer than ``least_words`` words; B: different words are under ``distinct_percent`` per cent of all; C: A-Z make up
    over ``capital_percent`` per cent of the code points; D: one of ``symbols`` (ASCII) occurs; E: the text is that of a
    document with a smaller id, anywhere in the table. Every row is a document, repeated ones too; rows with one id and
    one text don't fail E for each other. A NULL text is empty, a NULL part the empty string. A document with a NULL id has
    no labels, doesn't fail E and lets no other fail it. Of several labels of an id, one with quality 1 makes it good, one
    with toxic 1 toxic. Other columns are ignored; an empty table gives an empty one.

    One pass over the texts leaves a digest and a mask per row. Rows that agree in all of this are combined at once, and
    texts are found again by the digest's least id, so a text that a third of all documents share is one row per task.
    """
    spark, folder = docs.sparkSession, work_path(docs.sparkSession, "interactions")
    fields = [T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("part", T.StringType()), T.StructField("mask", T.IntegerType()), T.StructField("digest", T.BinaryType())]
    named = docs.select(docs[doc_id].alias("doc_id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), docs[text].alias("text"))
    scanned = named.mapInArrow(lambda batches: _failures(batches, least_words, distinct_percent, capital_percent, symbols.encode("ascii")), T.StructType(fields))
    scanned.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n")).write.parquet(folder)
    rows = spark.read.parquet(folder)

    first = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("least"))
    met = rows.join(first.withColumnRenamed("digest", "of"), (F.col("digest") == F.col("of")) & (F.col("doc_id") == F.col("least")), "left")
    repeats = F.col("doc_id").isNotNull() & F.col("least").isNull()
    masked = met.select("doc_id", "part", F.col("mask").bitwiseOR(F.when(repeats, 16).otherwise(0)).alias("mask"), "n")

    def any_one(c: str) -> Column:
        return F.max(F.coalesce(F.col(c) == 1, F.lit(False)))

    flags = labels.select(labels["doc_id"].alias("id"), labels["quality"].alias("quality"), labels["toxic"].alias("toxic")).where("id IS NOT NULL")
    flags = flags.groupBy("id").agg(any_one("quality").alias("good"), any_one("toxic").alias("toxic"))
    unnamed = masked.where("doc_id IS NULL").select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"), "n")
    labelled = masked.where("doc_id IS NOT NULL").join(flags, F.col("doc_id") == F.col("id"), "left")
    labelled = labelled.select("part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "n")
    return labelled.unionByName(unnamed).groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))


def filter_audit(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``audit`` of the filters ABCDE of ``failed_filters``: 600 rows for every value of the part column."""
    return audit(failed_filters(docs, labels, **settings), "ABCDE")


SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), failed AS (
  SELECT doc_id, part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM words
), flags AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id
), masks AS (
  SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n FROM failed LEFT JOIN flags USING (doc_id) GROUP BY ALL
), orders AS (
  SELECT [a, b, c, d, e] AS o FROM range(5) r1(a), range(5) r2(b), range(5) r3(c), range(5) r4(d), range(5) r5(e)
  WHERE len(list_distinct([a, b, c, d, e])) = 5
), steps AS (
  SELECT array_to_string(list_transform(o, lambda x: chr((65 + x)::INT)), '') AS filter_order, step::INT AS step, 1 << o[step]::INT AS bit,
    list_sum(list_transform(o[1:step - 1], lambda x: 1 << x::INT))::INT AS earlier
  FROM orders, range(1, 6) s(step)
), outcomes AS (
  SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (mask & (bit | coalesce(earlier, 0)) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (mask & bit > 0 AND mask & coalesce(earlier, 0) = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (mask & bit > 0 AND mask & coalesce(earlier, 0) > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (good AND mask & bit > 0 AND mask & coalesce(earlier, 0) = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (toxic AND mask & bit > 0 AND mask & coalesce(earlier, 0) = 0), 0)::BIGINT AS toxic_lost
  FROM masks, steps GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM outcomes
"""
