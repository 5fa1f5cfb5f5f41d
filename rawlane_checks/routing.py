"""Row routing, the rejection log and loading, over dirty billing rows made from orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlane.operators.load import clustered_write, interleaved_write, read_replaced, replace_by_source_file
from rawlane.operators.rejections import append_rejections, read_rejections, rejection_records
from rawlane.operators.routing import clean_table, error_entries, rejections, run_metrics, valid_rows, warn_entries
from rawlane.session import work_path
from rawlane.sources.storage import materialize
from rawlane.specs import FATURAMENTO, MONEY, DatasetSpec
from rawlane_checks.registry import Tables, check
from rawlane_checks.views import DIRTY_SQL, conformed_dirty, every

ENTRY = ["numero_linha", "campo_falha", "motivo_rejeicao", "valor_recebido", "severidade", "tabela_destino", "script_nome"]
ERROR_SQL = """SELECT o_orderkey AS numero_linha, campo AS campo_falha,
    CASE campo WHEN 'valor_da_conta' THEN 'Valor numérico inválido em ''valor_da_conta'': abc'
               WHEN 'vencimento' THEN 'Data inválida em ''vencimento'': 12/13/2020'
               ELSE 'Data inválida em ''data_fat'': 31/02/2024' END AS motivo_rejeicao,
    CASE campo WHEN 'valor_da_conta' THEN 'abc' WHEN 'vencimento' THEN '12/13/2020' ELSE '31/02/2024' END
      AS valor_recebido,
    'ERROR' AS severidade, 'faturamento' AS tabela_destino, 'ingest_faturamento' AS script_nome
  FROM routed WHERE campo IS NOT NULL"""
WARN_SQL = """SELECT o_orderkey AS numero_linha, missing AS campo_falha,
    'Campos obrigatórios vazios: ' || missing AS motivo_rejeicao, CAST(NULL AS VARCHAR) AS valor_recebido,
    'WARN' AS severidade, 'faturamento' AS tabela_destino, 'ingest_faturamento' AS script_nome
  FROM routed WHERE missing <> ''"""


def staged(t: Tables) -> DataFrame:
    """Staged rows, written once as an intake does: filters on them then read the result instead of parsing again."""
    rows = clean_table(conformed_dirty(t), FATURAMENTO, keep=["o_orderkey"])
    rows = materialize(rows, work_path(t.spark, "staged"))
    return rows.withColumns(
        {"run_id": F.lit("run"), "numero_linha": F.col("o_orderkey"), "source_filename": F.lit("pedidos.csv")}
    )


@check(f"WITH {DIRTY_SQL} SELECT o_orderkey, nullif(missing, '') AS missing FROM routed")
def missing_mandatory(t: Tables) -> DataFrame:
    return staged(t).select("o_orderkey", "missing")


@check(f"WITH {DIRTY_SQL} {WARN_SQL}", name="warn_entries")
def warnings(t: Tables) -> DataFrame:
    return warn_entries(staged(t), FATURAMENTO).select(*ENTRY)


@check(
    f"""WITH {DIRTY_SQL} SELECT o_orderkey, campo, campo IS NULL AS carregada FROM routed"""
)
def error_routing(t: Tables) -> DataFrame:
    error = F.col("first_error")
    return staged(t).select("o_orderkey", error["campo"].alias("campo"), error.isNull().alias("carregada"))


@check(f"WITH {DIRTY_SQL} {ERROR_SQL}", name="error_entries")
def errors(t: Tables) -> DataFrame:
    return error_entries(staged(t), FATURAMENTO).select(*ENTRY)


@check(
    f"""WITH {DIRTY_SQL} SELECT numero_documento, cnpj, valor AS valor_da_conta, data_fat, empresa,
          'pedidos.csv' AS source_filename FROM routed WHERE campo IS NULL""",
    name="valid_rows",
    money=["valor_da_conta"], dates=["data_fat"],
)
def loadable(t: Tables) -> DataFrame:
    rows = valid_rows(staged(t), FATURAMENTO)
    return rows.select("numero_documento", "cnpj", "valor_da_conta", "data_fat", "empresa", "source_filename")


SNAPSHOT = DatasetSpec(
    "snapshot",
    "-",
    "-",
    T.StructType([T.StructField("numero", T.StringType()), T.StructField("valor", MONEY), T.StructField("obs", T.StringType())]),
    ("obs",),
)


@check(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 OR o_orderkey % 3 = 0 THEN
         '{"numero":"' || o_orderkey || '","valor":"' || CASE WHEN o_orderkey % 2 = 0 THEN 'x' ELSE '1,5' END ||
         '","obs":' || CASE WHEN o_orderkey % 3 = 0 THEN 'null' ELSE '"' || o_orderpriority || '"' END || '}' END
         AS registro FROM orders"""
)
def row_snapshot(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("numero"),
        F.when(every("o_orderkey", 2), "x").otherwise("1,5").alias("valor"),
        F.when(~every("o_orderkey", 3), F.col("o_orderpriority")).alias("obs"),
    )
    return clean_table(rows, SNAPSHOT, keep=["o_orderkey"]).select("o_orderkey", "registro")


@check(
    """SELECT doc_id AS numero_linha, 'text' AS campo_falha, 'Texto longo' AS motivo_rejeicao,
         substr(text, 1, 500) AS valor_recebido, 'CRITICAL' AS severidade,
         '{"doc_id":' || doc_id || ',"lang":"' || lang || '"}' AS registro_completo
       FROM documents WHERE length(text) > 1000"""
)
def rejection_record(t: Tables) -> DataFrame:
    long = t.documents.filter(F.length("text") > 1000)
    records = rejection_records(
        long,
        run_id=F.lit("run"),
        script="revisao",
        table="documents",
        field=F.lit("text"),
        reason=F.lit("Texto longo"),
        value=F.col("text"),
        line=F.col("doc_id"),
        record=F.struct("doc_id", "lang"),
        severity="CRITICAL",
    )
    return records.select(
        "numero_linha", "campo_falha", "motivo_rejeicao", "valor_recebido", "severidade", "registro_completo"
    )


@check(f"WITH {DIRTY_SQL} {ERROR_SQL} UNION ALL {WARN_SQL}", name="append_rejections")
def appended(t: Tables) -> DataFrame:
    path = work_path(t.spark, "log")
    append_rejections(rejections(staged(t), FATURAMENTO), path)
    return read_rejections(t.spark, path).select(*ENTRY)


@check(
    f"""WITH {DIRTY_SQL} SELECT empresa, count(*) AS linhas_processadas,
          count(*) FILTER (campo IS NULL) AS linhas_inseridas, CAST(0 AS BIGINT) AS linhas_atualizadas,
          count(*) FILTER (campo IS NOT NULL) + count(*) FILTER (missing <> '') AS linhas_erro
        FROM routed GROUP BY empresa""",
    name="run_metrics",
)
def counters(t: Tables) -> DataFrame:
    return run_metrics(staged(t), ["empresa"])


@check(
    """SELECT o_orderkey, 'lote_' || (o_orderkey // 5000) % 4 || '.csv' AS source_filename,
         CASE WHEN (o_orderkey // 5000) % 4 = 0 THEN 2 ELSE 1 END AS entrega
       FROM orders WHERE (o_orderkey // 5000) % 4 <> 1""",
    name="replace_by_source_file",
)
def redelivery(t: Tables) -> DataFrame:
    """File 0 comes again with new rows, file 1 comes again with no valid row, files 2 and 3 stay."""
    path = work_path(t.spark, "redelivery")
    part = F.floor(F.col("o_orderkey") / 5000) % 4
    name = F.concat(F.lit("lote_"), part.cast("string"), F.lit(".csv"))
    first = t.orders.select("o_orderkey", part.alias("part"), name.alias("source_filename"))
    second = first.filter("part < 2")
    load = lambda rows, n: rows.select("o_orderkey", F.lit(n).alias("entrega"), "source_filename")
    replace_by_source_file(load(first, 1), first.select("source_filename"), path)
    replace_by_source_file(load(second.filter("part = 0"), 2), second.select("source_filename"), path, ["o_orderkey"])
    return read_replaced(t.spark, path, T.StructType.fromDDL("o_orderkey long, entrega int, source_filename string"))


@check("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS dia FROM orders", name="clustered_write", dates=["dia"])
def clustered(t: Tables) -> DataFrame:
    path = work_path(t.spark, "clustered")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("dia"))
    clustered_write(rows, path, ["o_custkey", "dia"], partition_by="o_orderstatus")
    return t.spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


@check("SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS dia FROM orders", name="interleaved_write", dates=["dia"])
def laid_out_by_two_keys(t: Tables) -> DataFrame:
    path = work_path(t.spark, "interleaved")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("dia"))
    interleaved_write(rows, path, ["o_custkey", "dia"])
    return t.spark.read.schema(rows.schema).parquet(path)
