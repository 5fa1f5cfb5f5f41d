"""Session settings and the shared work folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def get_session(app_name: str = "rawlane", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on. Cluster sizing is left to the submitter."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a missing setting is an error, since a
    machine-local folder would lose its data with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="rawlane-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/rawlane/{purpose}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def _setting(spark: SparkSession, name: str, value: int) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def methods_that_compile(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """While this holds, stages whose generated method would be above HotSpot's limit of 8000 bytes of code run operator by
    operator instead. Beyond that limit the JVM interprets a method for good, which is several times slower."""
    return _setting(spark, "spark.sql.codegen.hugeMethodLimit", 8000)


def few_listing_tasks(spark: SparkSession) -> contextlib.AbstractContextManager[None]:
    """While this holds, a list of files is looked up by four tasks per core instead of a task for each file."""
    return _setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4 * spark.sparkContext.defaultParallelism)
