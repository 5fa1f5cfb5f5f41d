"""The documented queries over the domain views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawlane.operators.audit import run_state
from rawlane.plans import analytics
from rawlane.specs import RUN_EVENT_SCHEMA
from rawlane_checks.registry import Tables, check
from rawlane_checks.views import (
    BASE_OFICIAL_SQL,
    FATURAMENTO_SQL,
    HISTORY_SQL,
    REJECTION_LOG_SQL,
    USUARIOS_SQL,
    base_oficial,
    faturamento,
    rejection_log,
    stamp,
    usuarios,
)

SQL_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


@check(
    f"""WITH {BASE_OFICIAL_SQL}, placed AS (
          SELECT *, row_number() OVER (ORDER BY nome_fantasia, cnpj) AS place
          FROM (SELECT cnpj, nome_fantasia, segmento, grupo, responsavel FROM base_oficial
                WHERE (empresa, status) = ('O', 'Ativo')) candidates
          WHERE COLUMNS(*) IS NOT NULL)
        SELECT * EXCLUDE (place) FROM placed WHERE place <= 50"""
)
def active_customers(t: Tables) -> DataFrame:
    return analytics.active_customers(base_oficial(t), "O")


@check(
    f"""WITH {FATURAMENTO_SQL}, per_customer AS (
          SELECT year(data_fat) AS y, month(data_fat) AS m, cnpj, count(valor_da_conta) AS n, sum(valor_da_conta) AS total
          FROM faturamento WHERE empresa = 'P' GROUP BY ALL
        ), months AS (
          SELECT make_date(y, m, 1) AS mes, CAST(sum(n) AS BIGINT) AS qtd_notas,
                 CAST(sum(total) AS DECIMAL(38,2)) AS faturamento_total, count(*) AS qtd_clientes,
                 rank() OVER (ORDER BY y DESC, m DESC) AS place
          FROM per_customer WHERE y IS NOT NULL AND cnpj IS NOT NULL AND n > 0 GROUP BY y, m
        ) SELECT * EXCLUDE (place) FROM months WHERE place <= 12""",
    money=["faturamento_total"], dates=["mes"],
)
def monthly_billing(t: Tables) -> DataFrame:
    return analytics.monthly_billing(faturamento(t), "P")


@check(
    f"""WITH {USUARIOS_SQL} SELECT consultor, cargo, "time", nivel FROM usuarios
        WHERE status_vendedor = 'Ativo' AND consultor IS NOT NULL AND cargo IS NOT NULL AND "time" IS NOT NULL
          AND nivel IS NOT NULL
        ORDER BY "time", consultor"""
)
def active_sellers(t: Tables) -> DataFrame:
    return analytics.active_sellers(usuarios(t))


@check(
    f"""WITH {FATURAMENTO_SQL}, {BASE_OFICIAL_SQL}, {USUARIOS_SQL}, sold AS (
          SELECT cliente_nome_fantasia, cnpj, vendedor, upper(trim(split_part(vendedor, '-', 1))) AS seller,
                 sum(valor_da_conta) AS total, count(valor_da_conta) AS n
          FROM faturamento WHERE empresa = 'F' AND data_fat > DATE '1997-12-31' GROUP BY ALL
        ), customers AS (
          SELECT cnpj, segmento, count(nome_fantasia) AS times FROM base_oficial WHERE status = 'Ativo' GROUP BY ALL
        ), sellers AS (
          SELECT upper(consultor) AS seller, "time", count(cargo) AS times FROM usuarios
          WHERE status_vendedor = 'Ativo' GROUP BY ALL
        ), totals AS (
          SELECT cliente_nome_fantasia, cnpj, segmento, vendedor, "time", total * c.times * s.times AS total,
                 n * c.times * s.times AS qtd_notas
          FROM sold JOIN customers c USING (cnpj) JOIN sellers s USING (seller)
          WHERE cliente_nome_fantasia IS NOT NULL AND segmento IS NOT NULL AND "time" IS NOT NULL
        ), placed AS (
          SELECT * EXCLUDE (total), CAST(total AS DECIMAL(38,2)) AS faturamento,
                 row_number() OVER (ORDER BY total DESC, cliente_nome_fantasia, cnpj, segmento, vendedor, "time") AS place
          FROM totals WHERE total > 0
        ) SELECT * EXCLUDE (place) FROM placed WHERE place <= 100""",
    money=["faturamento"],
)
def billing_by_customer_seller(t: Tables) -> DataFrame:
    return analytics.billing_by_customer_seller(faturamento(t), base_oficial(t), usuarios(t), "F", dt.date(1998, 1, 1))


@check(
    f"""WITH {FATURAMENTO_SQL}, sales AS (
          SELECT * FROM faturamento WHERE empresa = 'O' AND year(data_fat) >= 1996 AND cnpj IS NOT NULL AND valor_da_conta IS NOT NULL
        ), sellers AS (
          SELECT cnpj, array_to_string(list_sort(list(vendedor)), ', ') AS responsaveis
          FROM (SELECT DISTINCT cnpj, vendedor FROM sales WHERE vendedor IS NOT NULL) pairs GROUP BY cnpj
        ), months AS (
          SELECT cnpj, count(*) AS meses_ativos
          FROM (SELECT DISTINCT cnpj, year(data_fat), month(data_fat) FROM sales) active GROUP BY cnpj
        ), sums AS (
          SELECT cnpj, max(cliente_nome_fantasia) AS cliente, sum(valor_da_conta) AS total, count(*) AS qtd_notas,
                 min(data_fat) AS primeira_venda, max(data_fat) AS ultima_venda
          FROM sales GROUP BY cnpj
        ), placed AS (
          SELECT *, row_number() OVER (ORDER BY total DESC, cnpj) AS place FROM sums WHERE total > 0
        )
        SELECT cliente, cnpj, responsaveis, CAST(total AS DECIMAL(38,2)) AS faturamento_total, qtd_notas, meses_ativos,
               primeira_venda, ultima_venda
        FROM placed JOIN months USING (cnpj) LEFT JOIN sellers USING (cnpj) WHERE place <= 10""",
    money=["faturamento_total"], dates=["primeira_venda", "ultima_venda"],
)
def top_customers(t: Tables) -> DataFrame:
    return analytics.top_customers(faturamento(t), "O", dt.date(1996, 1, 1))


@check(
    f"""WITH {REJECTION_LOG_SQL} SELECT execucao_fk, script_nome, numero_linha, campo_falha, severidade,
          {SQL_STAMP.format("data_rejeicao")} AS data_rejeicao
        FROM log_rejeicao
        ORDER BY log_rejeicao.data_rejeicao DESC NULLS FIRST, execucao_fk, numero_linha, severidade, campo_falha
        LIMIT 100"""
)
def latest_rejections(t: Tables) -> DataFrame:
    newest = analytics.latest_rejections(rejection_log(t))
    return newest.select(
        "execucao_fk",
        "script_nome",
        "numero_linha",
        "campo_falha",
        "severidade",
        stamp(F.col("data_rejeicao")).alias("data_rejeicao"),
    )


@check(
    f"""WITH {REJECTION_LOG_SQL} SELECT campo_falha, count(*) AS total FROM log_rejeicao WHERE severidade = 'WARN'
        GROUP BY campo_falha ORDER BY total DESC, campo_falha LIMIT 10"""
)
def top_failing_fields(t: Tables) -> DataFrame:
    return analytics.top_failing_fields(rejection_log(t))


@check(
    f"""WITH {REJECTION_LOG_SQL} SELECT campo AS campo_falha, count(*) AS total
        FROM (SELECT unnest(string_split(campo_falha, ', ')) AS campo FROM log_rejeicao WHERE severidade = 'WARN')
        GROUP BY campo ORDER BY total DESC, campo LIMIT 10"""
)
def top_failing_single_fields(t: Tables) -> DataFrame:
    return analytics.top_failing_fields(rejection_log(t), per_field=True)


def shown_counters(history: DataFrame) -> DataFrame:
    """Runs that have not ended have no counters; shown as -1."""
    return history.withColumns({c: F.coalesce(F.col(c), F.lit(-1)) for c in ("linhas_inseridas", "linhas_erro")})


def run_events(t: Tables) -> DataFrame:
    """Start and end events of runs, two rows per event row but for runs that never end."""
    e = t.events
    start = {
        "id": F.col("event_id"),
        "event_ts": F.col("ts"),
        "script_nome": F.concat(F.lit("ingest_"), F.col("event_type")),
        "camada": F.lit("bronze"),
        "tabela_destino": F.lit("faturamento"),
        "status": F.lit("em_execucao"),
        "usuario_executante": F.concat(F.lit("u"), (F.col("user_id") % 10).cast("string")),
    }
    failed = F.col("event_type") == "error"
    end = {
        "id": F.col("event_id"),
        "event_ts": F.col("ts"),
        "status": F.when(failed, "erro").otherwise("sucesso"),
        "linhas_inseridas": F.col("user_id"),
        "linhas_erro": F.col("event_id") % 7,
        "mensagem_erro": F.when(failed, F.concat(F.lit("falha "), F.col("event_id").cast("string"))),
    }

    def events(rows: DataFrame, given: dict) -> DataFrame:
        return rows.select(
            *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RUN_EVENT_SCHEMA.fields]
        )

    return events(e, start).unionByName(events(e.filter(F.col("event_type") != "view"), end))


@check(
    f"""WITH {HISTORY_SQL} SELECT id, script_nome, status, coalesce(linhas_inseridas, -1) AS linhas_inseridas,
          coalesce(linhas_erro, -1) AS linhas_erro, mensagem_erro, usuario_executante, {SQL_STAMP.format("data_inicio")} AS data_inicio,
          CASE WHEN status <> 'em_execucao' THEN {SQL_STAMP.format("data_inicio")} END AS data_fim FROM historico"""
)
def run_state_update(t: Tables) -> DataFrame:
    return shown_counters(run_state(run_events(t))).select(
        "id",
        "script_nome",
        "status",
        "linhas_inseridas",
        "linhas_erro",
        "mensagem_erro",
        "usuario_executante",
        stamp(F.col("data_inicio")).alias("data_inicio"),
        stamp(F.col("data_fim")).alias("data_fim"),
    )


@check(
    f"""WITH {HISTORY_SQL} SELECT script_nome, tabela_destino, mensagem_erro,
          {SQL_STAMP.format("data_inicio")} AS data_inicio
        FROM historico WHERE status = 'erro' ORDER BY historico.data_inicio DESC NULLS FIRST, id LIMIT 5"""
)
def failed_runs(t: Tables) -> DataFrame:
    return analytics.failed_runs(run_state(run_events(t))).withColumn("data_inicio", stamp(F.col("data_inicio")))


@check(
    f"""WITH {HISTORY_SQL} SELECT script_nome, usuario_executante, {SQL_STAMP.format("data_inicio")} AS data_inicio,
          status, coalesce(linhas_inseridas, -1) AS linhas_inseridas, coalesce(linhas_erro, -1) AS linhas_erro
        FROM historico ORDER BY historico.data_inicio DESC NULLS FIRST, id LIMIT 20"""
)
def run_history(t: Tables) -> DataFrame:
    latest = analytics.run_history(run_state(run_events(t)))
    return shown_counters(latest).withColumn("data_inicio", stamp(F.col("data_inicio")))
