"""The domain tables as views over the sample tables: once for Spark, once as SQL for the comparison.

The sample tables have no NULLs in the columns used, so some are made by key; dirty texts are made by key as well, so
that the SQL side can state the expected result from the clean columns instead of parsing text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawlane.specs import FATURAMENTO
from rawlane_checks.registry import Tables


def every(key: str, step: int) -> Column:
    return F.col(key) % step == 0


def null_every(key: str, step: int, value: Column) -> Column:
    return F.when(F.col(key) % step != 0, value)


def stamp(ts: Column) -> Column:
    """A timestamp as text, so that comparing it does not depend on time zone settings."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def faturamento(t: Tables) -> DataFrame:
    key = "o_orderkey"
    customer = F.lpad(F.col("o_custkey").cast("string"), 9, "0")
    seller = F.concat(F.lit(" nation_"), (F.col(key) % 25).cast("string"), F.lit(" - "), F.col("o_orderpriority"))
    return t.orders.select(
        F.col(key).cast("string").alias("numero_documento"),
        null_every(key, 101, F.concat(F.lit("Customer#"), customer)).alias("cliente_nome_fantasia"),
        null_every(key, 103, F.col("o_custkey").cast("string")).alias("cnpj"),
        null_every(key, 107, seller).alias("vendedor"),
        null_every(key, 109, F.col("o_totalprice").cast("decimal(18,2)")).alias("valor_da_conta"),
        null_every(key, 113, F.col("o_orderdate").cast("date")).alias("data_fat"),
        F.col("o_orderstatus").alias("empresa"),
    )


FATURAMENTO_SQL = """faturamento AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS numero_documento,
         CASE WHEN o_orderkey % 101 <> 0 THEN 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') END
           AS cliente_nome_fantasia,
         CASE WHEN o_orderkey % 103 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS cnpj,
         CASE WHEN o_orderkey % 107 <> 0
              THEN ' nation_' || CAST(o_orderkey % 25 AS VARCHAR) || ' - ' || o_orderpriority END AS vendedor,
         CASE WHEN o_orderkey % 109 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS valor_da_conta,
         CASE WHEN o_orderkey % 113 <> 0 THEN CAST(o_orderdate AS DATE) END AS data_fat,
         o_orderstatus AS empresa
  FROM orders)"""


def base_oficial(t: Tables) -> DataFrame:
    key = "c_custkey"
    return t.customer.select(
        F.col(key).cast("string").alias("cnpj"),
        F.col("c_name").alias("nome_fantasia"),
        null_every(key, 31, F.col("c_mktsegment")).alias("segmento"),
        F.concat(F.lit("G"), F.col("c_nationkey").cast("string")).alias("grupo"),
        null_every(key, 37, F.concat(F.lit("R"), (F.col(key) % 7).cast("string"))).alias("responsavel"),
        F.when(F.col("c_acctbal") >= 0, "Ativo").otherwise("Inativo").alias("status"),
        F.substring(F.lit("FOP"), (F.col(key) % 3 + 1).cast("int"), F.lit(1)).alias("empresa"),
    )


BASE_OFICIAL_SQL = """base_oficial AS (
  SELECT CAST(c_custkey AS VARCHAR) AS cnpj,
         c_name AS nome_fantasia,
         CASE WHEN c_custkey % 31 <> 0 THEN c_mktsegment END AS segmento,
         'G' || CAST(c_nationkey AS VARCHAR) AS grupo,
         CASE WHEN c_custkey % 37 <> 0 THEN 'R' || CAST(c_custkey % 7 AS VARCHAR) END AS responsavel,
         CASE WHEN c_acctbal >= 0 THEN 'Ativo' ELSE 'Inativo' END AS status,
         substr('FOP', CAST(c_custkey % 3 AS INTEGER) + 1, 1) AS empresa
  FROM customer)"""


def usuarios(t: Tables) -> DataFrame:
    key = "n_nationkey"
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.when(F.col(key) != 7, F.concat(F.lit("CARGO_"), (F.col(key) % 3).cast("string"))).alias("cargo"),
        F.when(F.col(key) % 5 == 4, "Inativo").otherwise("Ativo").alias("status_vendedor"),
        F.col("n_name").alias("consultor"),
        F.concat(F.lit("N"), (F.col(key) % 2).cast("string")).alias("nivel"),
        F.col("r_name").alias("time"),
        (F.col(key) * 10).alias("acesso_vendedor"),
        F.when(F.col(key) % 6 != 0, F.col(key) + 1).alias("acesso_gerente"),
    )


USUARIOS_SQL = """usuarios AS (
  SELECT CASE WHEN n_nationkey <> 7 THEN 'CARGO_' || CAST(n_nationkey % 3 AS VARCHAR) END AS cargo,
         CASE WHEN n_nationkey % 5 = 4 THEN 'Inativo' ELSE 'Ativo' END AS status_vendedor,
         n_name AS consultor,
         'N' || CAST(n_nationkey % 2 AS VARCHAR) AS nivel,
         r_name AS "time",
         n_nationkey * 10 AS acesso_vendedor,
         CASE WHEN n_nationkey % 6 <> 0 THEN n_nationkey + 1 END AS acesso_gerente
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


# --- dirty billing rows -------------------------------------------------------------------------------------------

MONTH_NAMES = ["jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez"]


def number_text() -> Column:
    """Order totals as Brazilian number text, some of it broken, dashed or blank by key."""
    grouped = F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2)
    return (
        F.when(every("o_orderkey", 97), F.lit("abc"))
        .when(every("o_orderkey", 89), F.lit(" -   "))
        .when(every("o_orderkey", 83), F.lit(""))
        .otherwise(F.concat(F.lit(" "), F.translate(grouped, ",.", ".,"), F.lit(" ")))
    )


NUMBER_SQL = """CASE WHEN o_orderkey % 97 = 0 THEN NULL
              WHEN o_orderkey % 89 = 0 THEN CAST(0 AS DECIMAL(18,2))
              WHEN o_orderkey % 83 = 0 THEN NULL
              ELSE CAST(o_totalprice AS DECIMAL(18,2)) END"""


def date_text() -> Column:
    """Order days as Brazilian date text in several formats, some of it impossible, by key."""
    day = F.col("o_orderdate").cast("date")
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    return (
        F.when(every("o_orderkey", 79), F.lit("31/02/2024"))
        .when(
            every("o_orderkey", 73),
            F.concat(F.upper(F.element_at(names, F.month(day))), F.lit("/"), F.year(day).cast("string")),
        )
        .when(every("o_orderkey", 71), F.date_format(day, "dd/MM/yy"))
        .otherwise(F.date_format(day, "dd/MM/yyyy"))
    )


DATE_SQL = """CASE WHEN o_orderkey % 79 = 0 THEN NULL
              WHEN o_orderkey % 73 = 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE)
              ELSE CAST(o_orderdate AS DATE) END"""


def dirty_faturamento(t: Tables) -> DataFrame:
    """Order rows as raw billing text rows with the target's column names; absent columns are left out."""
    key = "o_orderkey"
    return t.orders.select(
        key,
        null_every(key, 67, F.col(key).cast("string")).alias("numero_documento"),
        F.when(every(key, 61), F.lit("  ")).otherwise(F.col("o_custkey").cast("string")).alias("cnpj"),
        number_text().alias("valor_da_conta"),
        date_text().alias("data_fat"),
        F.col("o_orderstatus").alias("empresa"),
        F.when(every(key, 53), F.lit("12/13/2020")).alias("vencimento"),
    )


DIRTY_SQL = f"""dirty AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 67 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS numero_documento,
         CASE WHEN o_orderkey % 61 = 0 THEN '  ' ELSE CAST(o_custkey AS VARCHAR) END AS cnpj,
         {NUMBER_SQL} AS valor,
         {DATE_SQL} AS data_fat,
         o_orderstatus AS empresa,
         o_orderkey % 97 = 0 AS bad_number,
         o_orderkey % 79 = 0 AS bad_date,
         o_orderkey % 53 = 0 AS bad_due,
         concat_ws(', ',
           CASE WHEN o_orderkey % 67 = 0 THEN 'numero_documento' END,
           CASE WHEN o_orderkey % 61 = 0 THEN 'cnpj' END,
           CASE WHEN o_orderkey % 83 = 0 AND o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0
                THEN 'valor_da_conta' END) AS missing
  FROM orders),
routed AS (
  SELECT *,
         CASE WHEN bad_number THEN 'valor_da_conta' WHEN bad_due THEN 'vencimento' WHEN bad_date THEN 'data_fat' END
           AS campo
  FROM dirty)"""


def conformed_dirty(t: Tables) -> DataFrame:
    """The dirty rows with every target column, as ``clean_table`` takes them; the key is kept."""
    rows = dirty_faturamento(t)
    present = set(rows.columns)
    return rows.select(
        "o_orderkey",
        *[F.col(f.name) if f.name in present else F.lit(None).cast("string").alias(f.name) for f in FATURAMENTO.target],
    )


# --- audit tables ---------------------------------------------------------------------------------------------------

FIELDS_BY_EVENT = {
    "click": "cnpj, data_fat",
    "view": "cnpj",
    "signup": "empresa",
    "purchase": "valor_da_conta, empresa",
    "error": "data_fat",
}


def by_event(values: dict[str, str]) -> Column:
    column = F.lit(None).cast("string")
    for event, value in values.items():
        column = F.when(F.col("event_type") == event, value).otherwise(column)
    return column


def by_event_sql(values: dict[str, str]) -> str:
    return "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


def rejection_log(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("user_id").cast("string").alias("execucao_fk"),
        F.concat(F.lit("ingest_"), F.col("event_type")).alias("script_nome"),
        F.lit("faturamento").alias("tabela_destino"),
        F.col("event_id").alias("numero_linha"),
        by_event(FIELDS_BY_EVENT).alias("campo_falha"),
        F.col("ts").alias("data_rejeicao"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("WARN").alias("severidade"),
    )


REJECTION_LOG_SQL = f"""log_rejeicao AS (
  SELECT CAST(user_id AS VARCHAR) AS execucao_fk, 'ingest_' || event_type AS script_nome,
         'faturamento' AS tabela_destino, event_id AS numero_linha,
         {by_event_sql(FIELDS_BY_EVENT)} AS campo_falha, ts AS data_rejeicao,
         CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'WARN' END AS severidade
  FROM events)"""


HISTORY_SQL = """historico AS (
  SELECT CAST(event_id AS VARCHAR) AS id, 'ingest_' || event_type AS script_nome, 'faturamento' AS tabela_destino,
         ts AS data_inicio,
         CASE WHEN event_type = 'view' THEN 'em_execucao' WHEN event_type = 'error' THEN 'erro' ELSE 'sucesso' END
           AS status,
         CASE WHEN event_type <> 'view' THEN user_id END AS linhas_inseridas,
         CASE WHEN event_type <> 'view' THEN event_id % 7 END AS linhas_erro,
         CASE WHEN event_type = 'error' THEN 'falha ' || CAST(event_id AS VARCHAR) END AS mensagem_erro,
         'u' || CAST(user_id % 10 AS VARCHAR) AS usuario_executante
  FROM events)"""
