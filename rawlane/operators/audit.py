"""Run history as an append-only event list; the current state of a run is a fold over its events."""

from __future__ import annotations

import getpass
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawlane.sources.storage import exists
from rawlane.specs import RUN_EVENT_SCHEMA

RUNNING, SUCCESS, FAILURE = "em_execucao", "sucesso", "erro"
LAYER = "bronze"


def current_user() -> str:
    """Who runs the job: the ``DB_USER`` variable, else the OS user, else ``unknown``."""
    user = os.environ.get("DB_USER")
    if user:
        return user
    try:
        return getpass.getuser()
    except (OSError, KeyError):
        return "unknown"


def _events(df: DataFrame, given: dict[str, Column]) -> DataFrame:
    return df.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RUN_EVENT_SCHEMA.fields]
    )


def run_start_events(files: DataFrame, user: str | None = None) -> DataFrame:
    """A start event per file. Needs ``run_id, script, table, file_name, file_hash``."""
    return _events(
        files,
        {
            "id": F.col("run_id"),
            "event_ts": F.current_timestamp(),
            "script_nome": F.col("script"),
            "camada": F.lit(LAYER),
            "tabela_origem": F.col("file_name"),
            "tabela_destino": F.col("table"),
            "status": F.lit(RUNNING),
            "file_hash": F.col("file_hash"),
            "usuario_executante": F.lit(user or current_user()),
        },
    )


def run_end_events(metrics: DataFrame, status: str, message: Column | None = None) -> DataFrame:
    """An end event per run. Needs ``run_id``; absent counters count as zero.

    ``table``, ``file_name`` and ``carga``, if there, tell where the rows of a committed run are.
    """
    counters = ("linhas_processadas", "linhas_inseridas", "linhas_atualizadas", "linhas_erro")
    given = {c: F.coalesce(F.col(c), F.lit(0)) if c in metrics.columns else F.lit(0) for c in counters}
    given |= {"id": F.col("run_id"), "event_ts": F.current_timestamp(), "status": F.lit(status)}
    given |= {to: F.col(c) for c, to in (("table", "tabela_destino"), ("file_name", "tabela_origem"), ("carga", "carga")) if c in metrics.columns}
    if message is not None:
        given["mensagem_erro"] = message
    return _events(metrics, given)


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").parquet(path)


def commit_events(events: DataFrame, path: str) -> None:
    """Append the events of one batch (a row per file) as a single file: readers see all of them or none."""
    append_events(events.coalesce(1), path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], RUN_EVENT_SCHEMA)
    return spark.read.schema(RUN_EVENT_SCHEMA).parquet(path)


def committed_loads(events: DataFrame, table: str) -> DataFrame:
    """``source_filename, carga, feito_em`` of all files whose runs ended well and whose rows went into ``table``."""
    ended = events.where((F.col("status") == SUCCESS) & (F.col("tabela_destino") == table) & F.col("carga").isNotNull())
    return ended.select(F.col("tabela_origem").alias("source_filename"), "carga", F.col("event_ts").alias("feito_em"))


def uncommitted_runs(events: DataFrame) -> DataFrame:
    """``id`` of the runs that did not end well: failed, killed or still going on."""
    return events.where(F.col("status") == RUNNING).select("id").join(events.where(F.col("status") == SUCCESS).select("id"), "id", "left_anti")


def _latest(events: DataFrame) -> DataFrame:
    """One event per run, the latest. Time and a hash of the event make one number, so that a hash aggregation finds it."""
    others = [c for c in events.columns if c != "id"]
    micros = F.unix_micros(F.coalesce("event_ts", F.lit("1970-01-01").cast("timestamp"))).cast("decimal(38,0)")
    own = F.xxhash64(*others).bitwiseAND((1 << 62) - 1)
    ranked = events.withColumn("_rank", micros * F.lit(1 << 62).cast("decimal(19,0)") + own)
    ranked = ranked.withColumn("_rank", F.col("_rank").cast("decimal(38,0)"))
    last = ranked.groupBy("id").agg(F.max("_rank").alias("_rank"))
    return ranked.join(last, ["id", "_rank"]).drop("_rank").distinct()


def run_state(events: DataFrame) -> DataFrame:
    """One row per run: what its start event said, overlaid with its end event if there is one.

    Start and end are told apart by status, not by arrival, so equal timestamps do not matter; of several ends the latest
    counts. Counters of a run that has not ended are NULL. Hash aggregations and joins on the run id.
    """
    closing = ["linhas_processadas", "linhas_inseridas", "linhas_atualizadas", "linhas_erro", "mensagem_erro"]
    opening = ["script_nome", "camada", "tabela_origem", "tabela_destino", "file_hash", "usuario_executante"]
    start = _latest(events.where(F.col("status") == RUNNING).select("id", "event_ts", *opening)).withColumnRenamed("event_ts", "data_inicio")
    end = _latest(events.where(F.col("status") != RUNNING).select("id", "event_ts", "status", *closing)).withColumnRenamed("event_ts", "data_fim")
    return start.join(end, "id", "full").select(
        "id",
        "script_nome",
        "camada",
        "tabela_origem",
        "tabela_destino",
        "data_inicio",
        "data_fim",
        F.coalesce("status", F.lit(RUNNING)).alias("status"),
        *closing,
        "file_hash",
        "usuario_executante",
    )
