"""Incremental intake of a drop folder."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawlane.plans.ingest import FILES_PER_BATCH, Store, take_in
from rawlane.session import work_path
from rawlane.sources.manifest import WHOLE_FILE_BYTES
from rawlane.sources.storage import complete_versions, drop_work, exists, literal_path, materialize
from rawlane.specs import DEFAULT_SPECS, DatasetSpec

#: What tells one delivery from another.
DELIVERY = "path string, modified timestamp, length long"


class Deliveries:
    """The deliveries that were taken in, kept below a folder: a base table per finished run, and what came since.

    The base of a run lists only files that are still in the drop folder, so this grows with the folder and not with its
    history. A base counts once it is complete; one that was not finished is written again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.version = max(complete_versions(spark, folder, "base"), default=0)

    def _path(self, kind: str, version: int) -> str:
        return f"{self.folder}/{kind}-{version}"

    def read(self) -> DataFrame:
        paths = [self._path(kind, self.version) for kind in ("base", "since")]
        paths = [p for p in paths if exists(self.spark, p)]
        return self.spark.read.schema(DELIVERY).parquet(*paths) if paths else self.spark.createDataFrame([], DELIVERY)

    def add(self, files: DataFrame) -> None:
        files.write.mode("append").parquet(self._path("since", self.version))

    def compact(self, listed: DataFrame) -> None:
        """Keep what is still there, as the next base."""
        if not exists(self.spark, self._path("since", self.version)):
            return
        kept = self.read().join(listed, ["path", "modified", "length"], "left_semi")
        kept.write.mode("overwrite").parquet(self._path("base", self.version + 1))
        for kind in ("base", "since"):
            drop_work(self.spark, self._path(kind, self.version))
        self.version += 1


def _plain(path: str) -> str:
    """One spelling of a path: ``file:/a`` and ``file:///a`` are the same."""
    return re.sub(r"^([A-Za-z0-9+.-]+):/+", r"\1:/", path)


def ingest_stream(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    specs: Sequence[DatasetSpec] = DEFAULT_SPECS,
    *,
    user: str | None = None,
    max_files_per_trigger: int = FILES_PER_BATCH,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> Store:
    """Take in the files that arrived since the last run, of any age, then return.

    The folder is listed, and what has the path, time and length of a file among the deliveries kept below ``checkpoint``
    is left out, so a file that was overwritten under its name comes again. New files go to the batch plan in batches of
    about ``max_files_per_trigger``, those of one name together. A batch is noted once it is through, without files that
    could not be read or written: these are tried again. A batch that is run again finds its finished files in the history.
    """
    deliveries, work = Deliveries(spark, f"{checkpoint}/deliveries"), work_path(spark, "arrivals")
    try:
        listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
        listed = materialize(listed.select("path", F.col("modificationTime").alias("modified"), "length"), f"{work}/listed")
        new = materialize(listed.join(deliveries.read(), ["path", "modified", "length"], "left_anti"), f"{work}/new")
        batches = -(-new.count() // max_files_per_trigger)
        batch = F.pmod(F.xxhash64(F.substring_index("path", "/", -1)), F.lit(max(batches, 1))).alias("batch")
        # One folder per batch, so that a batch does not read the names of all others.
        arrivals = materialize(new.select("*", batch).repartition("batch"), f"{work}/batches", "batch")
        for number in range(batches):
            files = arrivals.filter(F.col("batch") == number).select("path", "modified", "length")
            paths = [row.path for row in files.select("path").collect()]
            if paths:
                failed = set(map(_plain, take_in(spark, [literal_path(p) for p in paths], out, specs, user=user, whole_file_bytes=whole_file_bytes)))
                again = [(p,) for p in paths if _plain(p) in failed]
                deliveries.add(files.join(spark.createDataFrame(again, "path string"), "path", "left_anti").select(*files.columns))
        deliveries.compact(listed)
    finally:
        drop_work(spark, work)
    return Store(out)
