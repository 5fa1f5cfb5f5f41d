"""The documented billing, customer, sales-team and audit queries, with their constants as parameters.

Sums are decimals, so they are exact. NULLs sort last ascending and first descending. Every top-k has a unique
tie-breaker, so its result does not depend on partitioning.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY_TOTAL = "decimal(38,2)"


def _complete(*columns: str) -> Column:
    present = F.lit(True)
    for column in columns:
        present = present & F.col(column).isNotNull()
    return present


def _month(day: str) -> Column:
    return F.trunc(day, "MM")


def active_customers(base_oficial: DataFrame, company: str, limit: int = 50) -> DataFrame:
    """Active customers of a company with complete data, by trade name."""
    shown = ["cnpj", "nome_fantasia", "segmento", "grupo", "responsavel"]
    rows = base_oficial.filter((F.col("empresa") == company) & (F.col("status") == "Ativo") & _complete(*shown))
    return rows.select(*shown).orderBy("nome_fantasia", "cnpj").limit(limit)


def monthly_billing(faturamento: DataFrame, company: str, limit: int = 12) -> DataFrame:
    """Invoices, total and distinct customers per month, newest first.

    Aggregated per month and customer first: the distinct count then needs no second pass over the invoices, and a
    customer with very many invoices is combined before the shuffle.
    """
    rows = faturamento.filter((F.col("empresa") == company) & _complete("data_fat", "valor_da_conta", "cnpj"))
    per_customer = rows.groupBy(_month("data_fat").alias("mes"), "cnpj").agg(
        F.count(F.lit(1)).alias("n"), F.sum("valor_da_conta").alias("total")
    )
    months = per_customer.groupBy("mes").agg(
        F.sum("n").alias("qtd_notas"),
        F.sum("total").cast(MONEY_TOTAL).alias("faturamento_total"),
        F.count(F.lit(1)).alias("qtd_clientes"),
    )
    return months.orderBy(F.desc("mes")).limit(limit)


def active_sellers(usuarios: DataFrame) -> DataFrame:
    """Active sales-team members with complete data, by team and name."""
    shown = ["consultor", "cargo", "time", "nivel"]
    return (
        usuarios.filter((F.col("status_vendedor") == "Ativo") & _complete(*shown)).select(*shown).orderBy("time", "consultor")
    )


def seller_key(vendedor: Column) -> Column:
    """The seller's name in ``NAME - PORTFOLIO``, as it is matched against the sales team."""
    return F.upper(F.trim(F.split_part(vendedor, F.lit("-"), F.lit(1))))


def billing_by_customer_seller(
    faturamento: DataFrame,
    base_oficial: DataFrame,
    usuarios: DataFrame,
    company: str,
    since: dt.date,
    limit: int = 100,
) -> DataFrame:
    """Billing per customer and seller over invoices that match an active customer and an active seller.

    Invoices are summed per customer and seller text before they are joined, which is exact since both joins only
    repeat or drop whole groups. What is shuffled for the joins is then one row per group, also for a customer with a
    third of all invoices. No join is hinted: the planner broadcasts a side only if it is measured to be small.
    """
    invoices = (
        faturamento.filter(
            (F.col("empresa") == company)
            & (F.col("data_fat") >= F.lit(since))
            & _complete("cliente_nome_fantasia", "cnpj", "vendedor", "valor_da_conta")
        )
        .groupBy("cliente_nome_fantasia", "cnpj", "vendedor")
        .agg(F.sum("valor_da_conta").alias("total"), F.count(F.lit(1)).alias("n"))
    )
    customers = base_oficial.filter(
        _complete("cnpj", "segmento", "nome_fantasia") & (F.col("status") == "Ativo")
    ).select("cnpj", "segmento")
    sellers = usuarios.filter(
        _complete("time", "cargo", "consultor") & (F.col("status_vendedor") == "Ativo")
    ).select("time", F.upper("consultor").alias("_seller"))
    keys = ["cliente_nome_fantasia", "cnpj", "segmento", "vendedor", "time"]
    return (
        invoices.withColumn("_seller", seller_key(F.col("vendedor")))
        .join(customers, "cnpj")
        .join(sellers, "_seller")
        .groupBy(*keys)
        .agg(F.sum("total").cast(MONEY_TOTAL).alias("faturamento"), F.sum("n").alias("qtd_notas"))
        .filter(F.col("faturamento") > 0)
        .orderBy(F.desc("faturamento"), *keys)
        .limit(limit)
    )


def top_customers(faturamento: DataFrame, company: str, since: dt.date, limit: int = 10) -> DataFrame:
    """Customers with the highest billing, their sellers in order, months with activity, first and last sale.

    Customers are ranked first, on nothing but their totals. Everything else is then worked out for the ``limit``
    customers that remain: their invoices are picked by a join with that short list and combined by name, seller and
    month before anything is gathered per customer, so a customer with a third of all invoices stays spread out.
    """
    rows = faturamento.filter(
        (F.col("empresa") == company) & (F.col("data_fat") >= F.lit(since)) & _complete("cnpj", "valor_da_conta")
    )
    leading = (
        rows.groupBy("cnpj")
        .agg(F.sum("valor_da_conta").alias("_total"))
        .filter(F.col("_total") > 0)
        .orderBy(F.desc("_total"), "cnpj")
        .limit(limit)
    )
    # Names are grouping keys here, not a text maximum: that would turn hash aggregation into sorting.
    combined = (
        rows.join(leading.select("cnpj"), "cnpj", "left_semi")
        .groupBy("cnpj", "cliente_nome_fantasia", "vendedor", _month("data_fat").alias("mes"))
        .agg(
            F.sum("valor_da_conta").alias("total"),
            F.count(F.lit(1)).alias("n"),
            F.min("data_fat").alias("primeira"),
            F.max("data_fat").alias("ultima"),
        )
    )
    return (
        combined.groupBy("cnpj")
        .agg(
            F.max("cliente_nome_fantasia").alias("cliente"),
            distinct_list(F.col("vendedor")).alias("responsaveis"),
            F.sum("total").cast(MONEY_TOTAL).alias("faturamento_total"),
            F.sum("n").alias("qtd_notas"),
            F.size(F.collect_set("mes")).cast("long").alias("meses_ativos"),
            F.min("primeira").alias("primeira_venda"),
            F.max("ultima").alias("ultima_venda"),
        )
        .select(
            "cliente",
            "cnpj",
            "responsaveis",
            "faturamento_total",
            "qtd_notas",
            "meses_ativos",
            "primeira_venda",
            "ultima_venda",
        )
        .orderBy(F.desc("faturamento_total"), "cnpj")
    )


def distinct_list(value: Column, separator: str = ", ") -> Column:
    """Aggregate: the distinct values in order, joined; NULL when there is none."""
    found = F.collect_set(value)
    return F.when(F.size(found) > 0, F.array_join(F.array_sort(found), separator))


def latest_rejections(log: DataFrame, limit: int = 100) -> DataFrame:
    """The newest log entries."""
    ties = ["execucao_fk", "numero_linha", "severidade", "campo_falha"]
    return log.orderBy(F.desc_nulls_first("data_rejeicao"), *[F.asc_nulls_last(c) for c in ties]).limit(limit)


def top_failing_fields(log: DataFrame, severity: str = "WARN", limit: int = 10, per_field: bool = False) -> DataFrame:
    """How often each field (as logged, possibly several joined) fails; ``per_field`` splits joined fields."""
    rows = log.filter(F.col("severidade") == severity)
    if per_field:
        rows = rows.select(F.explode(F.split("campo_falha", ", ")).alias("campo_falha"))
    counted = rows.groupBy("campo_falha").agg(F.count(F.lit(1)).alias("total"))
    return counted.orderBy(F.desc("total"), F.asc_nulls_last("campo_falha")).limit(limit)


def failed_runs(history: DataFrame, limit: int = 5) -> DataFrame:
    """The latest runs that ended in an error."""
    rows = history.filter(F.col("status") == "erro")
    newest = rows.orderBy(F.desc_nulls_first("data_inicio"), "id").limit(limit)
    return newest.select("script_nome", "tabela_destino", "mensagem_erro", "data_inicio")


def run_history(history: DataFrame, limit: int = 20) -> DataFrame:
    """The latest runs: who, when, status and counts."""
    newest = history.orderBy(F.desc_nulls_first("data_inicio"), "id").limit(limit)
    return newest.select("script_nome", "usuario_executante", "data_inicio", "status", "linhas_inseridas", "linhas_erro")
