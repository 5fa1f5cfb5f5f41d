"""The list of named queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tables:
    """The sample tables of one scale."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


@dataclass(frozen=True)
class Check:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(sql: str | None = None, name: str | None = None, money: Sequence[str] = (), dates: Sequence[str] = ()):
    """Register a query. ``money`` (exact decimals) and ``dates`` columns are shown as doubles and ISO text on both
    sides, since database clients differ in how they hand over decimals and empty dates."""
    shown = {c: "double" for c in money} | {c: "string" for c in dates}
    if sql is not None and shown:
        casts = [f"CAST({c} AS DOUBLE) AS {c}" for c in money] + [f"CAST({c} AS VARCHAR) AS {c}" for c in dates]
        sql = f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql})"

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        if key in CHECKS:
            raise ValueError(f"{key} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            result = build(Tables(spark, folder))
            return result.withColumns({c: F.col(c).cast(kind) for c, kind in shown.items()}) if shown else result

        CHECKS[key] = Check(run, sql)
        return build

    return register
