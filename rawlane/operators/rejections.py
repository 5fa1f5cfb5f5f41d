"""The rejection log: free-form records and appending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawlane.operators.routing import VALUE_LIMIT
from rawlane.specs import REJECTION_SCHEMA


def rejection_records(
    df: DataFrame,
    *,
    run_id: Column,
    script: str,
    table: str,
    field: Column,
    reason: Column,
    value: Column | None = None,
    line: Column | None = None,
    record: Column | None = None,
    severity: str = "ERROR",
) -> DataFrame:
    """Turn the rows of ``df`` into rejection records of any severity.

    ``record`` is a struct column holding the full row; it is stored as JSON. Values are cut at 500 characters.
    """
    nothing = F.lit(None)
    snapshot = nothing if record is None else F.when(record.isNotNull(), F.to_json(record, {"ignoreNullFields": "false"}))
    return df.select(
        run_id.cast("string").alias("execucao_fk"),
        F.lit(script).alias("script_nome"),
        F.lit(table).alias("tabela_destino"),
        (nothing if line is None else line).cast("long").alias("numero_linha"),
        field.cast("string").alias("campo_falha"),
        reason.cast("string").alias("motivo_rejeicao"),
        F.substring((nothing if value is None else value).cast("string"), 1, VALUE_LIMIT).alias("valor_recebido"),
        snapshot.cast("string").alias("registro_completo"),
        F.current_timestamp().alias("data_rejeicao"),
        F.lit(severity).alias("severidade"),
    )


def append_rejections(entries: DataFrame, path: str) -> None:
    """Append to the log. Severity has a handful of values and is what readers filter on, so it is the partition."""
    entries.select(*REJECTION_SCHEMA.fieldNames()).write.mode("append").partitionBy("severidade").parquet(path)


def read_rejections(spark, path: str) -> DataFrame:
    return spark.read.schema(REJECTION_SCHEMA).parquet(path)
