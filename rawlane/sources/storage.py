"""Small helpers around Spark tables kept as files."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def literal_path(path: str) -> str:
    """Escape glob characters, so that a file name is read as itself."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def materialize(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """Write a table and read it back, in folders per ``partition_by`` value if given.

    Cuts the lineage at storage every executor can reach, and gives the planner the table's true size, so that a join
    with it is broadcast only when it is really small.
    """
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def complete_versions(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers N of the tables ``name-N`` below ``folder`` whose writing came to its end."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}-*/_SUCCESS")
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target) or []
    return [int(status.getPath().getParent().getName().rsplit("-", 1)[1]) for status in found]


def isolate(items: list, job: Callable[[list], object]) -> tuple[list, list[tuple[object, Exception]]]:
    """Run ``job`` over ``items``; where it fails, over the halves, down to the single items that make it fail.

    Returns the results of the jobs that ended well and the failing items with their errors. One bad item of n costs some
    2 log n jobs more, which together see the items about twice.
    """
    done, bad, waiting = [], [], [items]
    while waiting:
        some = waiting.pop()
        try:
            done.append(job(some))
        except Exception as error:  # noqa: BLE001 - whatever it was, it is told of the item
            if len(some) == 1:
                bad.append((some[0], error))
            else:
                waiting += [some[len(some) // 2 :], some[: len(some) // 2]]
    return done, bad


def drop_work(spark: SparkSession, path: str) -> None:
    """Remove a work folder made by ``session.work_path``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
