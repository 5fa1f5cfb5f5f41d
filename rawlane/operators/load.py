"""Writing: replace the rows of re-delivered files, and clustered layouts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlane.sources.storage import exists
from rawlane.specs import DatasetSpec

#: Folders of loads are named by this column.
LOAD = "carga"


def table_schema(spec: DatasetSpec) -> T.StructType:
    return T.StructType(
        [*spec.target.fields, T.StructField("data_carga", T.TimestampType()), T.StructField("source_filename", T.StringType())]
    )


def stage_rows(valid: DataFrame, path: str, load: str, cluster: Sequence[str] = ()) -> None:
    """Write the rows of a load into a folder of its own. No reader sees them before the load's files are committed.

    Rows are not shuffled: a file's rows already sit together in the tasks that read it, and a huge file stays spread over
    many tasks. The sort is local to a task; it puts files, and within them the ``cluster`` keys, together. There is one
    folder per load, however many files it has.
    """
    valid.sortWithinPartitions("source_filename", *cluster).write.mode("overwrite").parquet(f"{path}/linhas/{LOAD}={load}")


def current_rows(spark: SparkSession, path: str, schema: T.StructType, committed: DataFrame) -> DataFrame:
    """The rows that are in force: of every file those of its latest committed load.

    ``committed``: ``source_filename, carga, feito_em``, a row for every file of every committed load, files without valid
    rows included. Loads that were never committed are pruned as folders; what later loads replaced is left out by an anti
    join with just those pairs of file and load.
    """
    if not exists(spark, f"{path}/linhas"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])).parquet(f"{path}/linhas")
    latest = committed.groupBy("source_filename").agg(F.max(F.struct("feito_em", LOAD))[LOAD].alias("_latest"))
    replaced = committed.join(latest, "source_filename").where(F.col(LOAD) != F.col("_latest")).select("source_filename", LOAD)
    valid = rows.join(committed.select(LOAD).distinct(), LOAD, "left_semi")
    return valid.join(replaced, ["source_filename", LOAD], "left_anti").select(*schema.fieldNames())


def replace_by_source_file(valid: DataFrame, files: DataFrame, path: str, cluster: Sequence[str] = ()) -> None:
    """Load rows so that each delivered file replaces what was loaded from a file of that name before.

    ``files`` has one row per delivered file (``source_filename``, one batch); one without valid rows left replaces earlier
    rows by none. The load is committed by a list of its files, written as a single file, so readers (``read_replaced``)
    see all of the old rows or all of the new ones, and a load that fails before leaves what was there.
    """
    load = uuid.uuid4().hex
    stage_rows(valid, path, load, cluster)
    named = files.select("source_filename").distinct().select("source_filename", F.lit(load).alias(LOAD), F.current_timestamp().alias("feito_em"))
    named.coalesce(1).write.mode("append").parquet(f"{path}/entregas")


def read_replaced(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The current rows of a table kept by ``replace_by_source_file``."""
    committed = spark.read.schema(f"source_filename string, {LOAD} string, feito_em timestamp").parquet(f"{path}/entregas")
    return current_rows(spark, path, schema, committed)


def clustered_write(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: str | None = None,
    partitions: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Lay a table out by ``keys``, so that file and row-group statistics let readers skip what they do not need.

    Range partitioning bounds each file's key range from a sample; a key value too frequent for one range is spread
    by a random last sort key, which costs readers nothing. Rows whose leading key is NULL are kept. With
    ``partition_by`` (few distinct values) the files are also split into folders.
    """
    ranged = [*([partition_by] if partition_by else []), *keys]
    spread = F.rand(seed=0).alias("_spread")
    columns = [*[F.col(k) for k in ranged], F.col("_spread")]
    salted = df.withColumn("_spread", spread)
    placed = salted.repartitionByRange(partitions, *columns) if partitions else salted.repartitionByRange(*columns)
    writer = placed.sortWithinPartitions(*ranged).drop("_spread").write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


#: Bins that a key's values are sampled by, one value each.
SAMPLE_BINS = 4096


def key_splits(df: DataFrame, key: str, ranges: int) -> list:
    """At most ``ranges - 1`` values that cut the different values of ``key`` into ranges of about equal number.

    From a sample of different values: of each of ``SAMPLE_BINS`` bins of hashes the value with the smallest hash, so the
    driver gets that many values at most and a frequent value counts once. Hash aggregations only, also for text.
    """
    values = df.select(F.col(key).alias("v")).where("v IS NOT NULL").select("v", F.xxhash64("v").alias("h"))
    least = values.groupBy(F.pmod("h", F.lit(SAMPLE_BINS)).alias("bin")).agg(F.min("h").alias("h")).select("h")
    chosen = values.join(F.broadcast(least), "h").select("v").distinct()  # as many hashes as there are bins at most
    sample = [r.v for r in chosen.orderBy("v").collect()]
    cuts = sorted({len(sample) * i // ranges for i in range(1, ranges)} - {0})
    return [sample[i] for i in cuts]


def interleaved(numbers: Sequence[Column], bits: int) -> Column:
    """One number whose bits are those of ``numbers`` in turn, highest first (Z-order)."""
    z = F.lit(0).cast("long")
    for bit in range(bits):
        for place, number in enumerate(reversed(numbers)):
            own = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("long")
            z = z.bitwiseOR(F.shiftleft(own, bit * len(numbers) + place))
    return z


def interleaved_write(df: DataFrame, path: str, keys: Sequence[str], partitions: int | None = None, bits: int = 5, mode: str = "overwrite") -> None:
    """Lay a table out so that a filter on any one of ``keys`` skips files, where ``clustered_write`` helps its first key.

    Each key is cut into ``2 ** bits`` ranges (``key_splits``); files hold neighbours in Z-order of the range numbers, so of n
    files a filter on one value of one of k keys reads about n ** ((k - 1) / k). NULLs are in the lowest range and
    kept; an empty table is written as such. Rows of one cell are spread over files by a random last sort key, so a value
    that a third of all rows share does not end up in one task. Columns named as the helpers are kept as they are.
    """
    if not keys or bits * len(keys) > 62:
        raise ValueError(f"1 to {62 // bits} keys at {bits} bits each, not {len(keys)}")

    def number(key: str) -> Column:
        splits = [F.lit(s).cast(df.schema[key].dataType) for s in key_splits(df, key, 1 << bits)]
        return F.size(F.filter(F.array(*splits), lambda s: s <= F.col(key))) if splits else F.lit(0)

    rows = df.select(F.struct(*df.columns).alias("row"), F.array(*[number(key) for key in keys]).alias("cell"))
    cell = [F.col("cell")[i] for i in range(len(keys))]
    rows = rows.select("row", interleaved(cell, bits).alias("z"), F.rand(seed=0).alias("spread"))
    placed = rows.repartitionByRange(partitions, "z", "spread") if partitions else rows.repartitionByRange("z", "spread")
    placed.sortWithinPartitions("z").select("row.*").write.mode(mode).parquet(path)
