"""The relational operators of the documented queries, one by one, over the domain views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawlane.plans.analytics import distinct_list, seller_key
from rawlane_checks.registry import Tables, check
from rawlane_checks.views import (
    BASE_OFICIAL_SQL,
    FATURAMENTO_SQL,
    USUARIOS_SQL,
    base_oficial,
    faturamento,
    usuarios,
)

MONEY = "decimal(18,2)"
TOTAL = "decimal(38,2)"


@check(f"WITH {FATURAMENTO_SQL} SELECT numero_documento AS documento, cnpj, data_fat FROM faturamento", dates=["data_fat"])
def projection_alias(t: Tables) -> DataFrame:
    return faturamento(t).select(F.col("numero_documento").alias("documento"), "cnpj", "data_fat")


@check(f"WITH {BASE_OFICIAL_SQL} SELECT cnpj, status FROM base_oficial WHERE empresa = 'F' AND status = 'Ativo'")
def equality_filter(t: Tables) -> DataFrame:
    return base_oficial(t).filter((F.col("empresa") == "F") & (F.col("status") == "Ativo")).select("cnpj", "status")


@check(
    f"""WITH {BASE_OFICIAL_SQL} SELECT cnpj, segmento, responsavel FROM base_oficial
        WHERE cnpj IS NOT NULL AND segmento IS NOT NULL AND responsavel IS NOT NULL"""
)
def not_null_filter(t: Tables) -> DataFrame:
    return base_oficial(t).select("cnpj", "segmento", "responsavel").dropna()


@check(
    f"""WITH {FATURAMENTO_SQL} SELECT numero_documento, data_fat FROM faturamento
        WHERE data_fat >= DATE '1998-01-01' AND data_fat < DATE '1999-07-01'""",
    dates=["data_fat"],
)
def date_range_filter(t: Tables) -> DataFrame:
    day = F.col("data_fat")
    inside = (day >= F.lit("1998-01-01").cast("date")) & (day < F.lit("1999-07-01").cast("date"))
    return faturamento(t).filter(inside).select("numero_documento", "data_fat")


@check(
    f"""WITH {FATURAMENTO_SQL}, {BASE_OFICIAL_SQL}
        SELECT f.numero_documento, f.cnpj, b.segmento FROM faturamento f JOIN base_oficial b ON f.cnpj = b.cnpj"""
)
def inner_equi_join(t: Tables) -> DataFrame:
    return faturamento(t).join(base_oficial(t), "cnpj").select("numero_documento", "cnpj", "segmento")


@check(
    f"""WITH {FATURAMENTO_SQL}, {USUARIOS_SQL}
        SELECT f.numero_documento, f.vendedor, u.consultor, u."time" FROM faturamento f
        JOIN usuarios u ON upper(trim(split_part(f.vendedor, '-', 1))) = upper(u.consultor)"""
)
def derived_key_join(t: Tables) -> DataFrame:
    matched = seller_key(F.col("vendedor")) == F.upper("consultor")
    return faturamento(t).join(usuarios(t), matched).select("numero_documento", "vendedor", "consultor", "time")


@check(
    f"""WITH {FATURAMENTO_SQL}, {BASE_OFICIAL_SQL}, {USUARIOS_SQL}
        SELECT f.numero_documento, b.nome_fantasia, u."time" FROM faturamento f
        JOIN base_oficial b ON f.cnpj = b.cnpj
        JOIN usuarios u ON upper(trim(split_part(f.vendedor, '-', 1))) = upper(u.consultor)"""
)
def three_way_join(t: Tables) -> DataFrame:
    matched = seller_key(F.col("vendedor")) == F.upper("consultor")
    joined = faturamento(t).join(base_oficial(t), "cnpj").join(usuarios(t), matched)
    return joined.select("numero_documento", "nome_fantasia", "time")


@check(
    f"""WITH {FATURAMENTO_SQL} SELECT empresa, cnpj, vendedor, count(*) AS qtd FROM faturamento
        GROUP BY empresa, cnpj, vendedor"""
)
def group_by_columns(t: Tables) -> DataFrame:
    return faturamento(t).groupBy("empresa", "cnpj", "vendedor").agg(F.count(F.lit(1)).alias("qtd"))


@check(
    f"""WITH {FATURAMENTO_SQL} SELECT CAST(date_trunc('month', data_fat) AS DATE) AS mes, count(*) AS qtd
        FROM faturamento GROUP BY 1""",
    dates=["mes"],
)
def group_by_expression(t: Tables) -> DataFrame:
    return faturamento(t).groupBy(F.trunc("data_fat", "MM").alias("mes")).agg(F.count(F.lit(1)).alias("qtd"))


@check(
    f"""WITH {FATURAMENTO_SQL} SELECT empresa, count(*) AS linhas, count(valor_da_conta) AS valores,
          CAST(sum(valor_da_conta) AS DECIMAL(38,2)) AS total, min(data_fat) AS primeira, max(data_fat) AS ultima,
          max(cliente_nome_fantasia) AS maior_nome
        FROM faturamento GROUP BY empresa""",
    money=["total"], dates=["primeira", "ultima"],
)
def aggregates(t: Tables) -> DataFrame:
    return (
        faturamento(t)
        .groupBy("empresa")
        .agg(
            F.count(F.lit(1)).alias("linhas"),
            F.count("valor_da_conta").alias("valores"),
            F.sum("valor_da_conta").cast(TOTAL).alias("total"),
            F.min("data_fat").alias("primeira"),
            F.max("data_fat").alias("ultima"),
            F.max("cliente_nome_fantasia").alias("maior_nome"),
        )
    )


@check(f"WITH {FATURAMENTO_SQL} SELECT empresa, count(DISTINCT cnpj) AS clientes FROM faturamento GROUP BY empresa")
def count_distinct(t: Tables) -> DataFrame:
    return faturamento(t).groupBy("empresa").agg(F.count_distinct("cnpj").alias("clientes"))


@check(
    f"""WITH {FATURAMENTO_SQL} SELECT cnpj, count(DISTINCT date_trunc('month', data_fat)) AS meses
        FROM faturamento GROUP BY cnpj"""
)
def count_distinct_expression(t: Tables) -> DataFrame:
    return faturamento(t).groupBy("cnpj").agg(F.count_distinct(F.trunc("data_fat", "MM")).alias("meses"))


@check(
    f"""WITH {FATURAMENTO_SQL} SELECT cnpj, string_agg(DISTINCT vendedor, ', ' ORDER BY vendedor) AS vendedores
        FROM faturamento GROUP BY cnpj"""
)
def string_agg_distinct(t: Tables) -> DataFrame:
    # Distinct pairs first: repeats are gone before lists are built.
    pairs = faturamento(t).select("cnpj", "vendedor").distinct()
    return pairs.groupBy("cnpj").agg(distinct_list(F.col("vendedor")).alias("vendedores"))


@check(
    f"""WITH {FATURAMENTO_SQL} SELECT cnpj, CAST(sum(valor_da_conta) AS DECIMAL(38,2)) AS total FROM faturamento
        GROUP BY cnpj HAVING sum(valor_da_conta) > 2500000""",
    money=["total"],
)
def having(t: Tables) -> DataFrame:
    totals = faturamento(t).groupBy("cnpj").agg(F.sum("valor_da_conta").cast(TOTAL).alias("total"))
    return totals.filter(F.col("total") > 2500000)


@check(
    f"""WITH {BASE_OFICIAL_SQL} SELECT cnpj, segmento, responsavel FROM base_oficial
        ORDER BY segmento ASC NULLS LAST, responsavel DESC NULLS FIRST, cnpj"""
)
def order_by_nulls(t: Tables) -> DataFrame:
    keys = [F.asc_nulls_last("segmento"), F.desc_nulls_first("responsavel"), "cnpj"]
    return base_oficial(t).select("cnpj", "segmento", "responsavel").orderBy(*keys)


@check(
    f"""WITH {FATURAMENTO_SQL} SELECT numero_documento, valor_da_conta FROM faturamento
        WHERE valor_da_conta IS NOT NULL ORDER BY valor_da_conta DESC, numero_documento LIMIT 100""",
    money=["valor_da_conta"],
)
def top_k(t: Tables) -> DataFrame:
    rows = faturamento(t).select("numero_documento", "valor_da_conta").dropna()
    return rows.orderBy(F.desc("valor_da_conta"), "numero_documento").limit(100)


@check(
    f"""WITH {FATURAMENTO_SQL} SELECT numero_documento, CAST(date_trunc('month', data_fat) AS DATE) AS mes
        FROM faturamento""",
    dates=["mes"],
)
def month_trunc(t: Tables) -> DataFrame:
    return faturamento(t).select("numero_documento", F.trunc("data_fat", "MM").alias("mes"))


@check(
    f"""WITH {FATURAMENTO_SQL} SELECT numero_documento, upper(trim(split_part(vendedor, '-', 1))) AS nome,
          split_part(vendedor, '-', 9) AS ausente FROM faturamento"""
)
def text_functions(t: Tables) -> DataFrame:
    return faturamento(t).select(
        "numero_documento",
        seller_key(F.col("vendedor")).alias("nome"),
        F.split_part("vendedor", F.lit("-"), F.lit(9)).alias("ausente"),
    )


@check(
    f"""WITH {FATURAMENTO_SQL}, {BASE_OFICIAL_SQL} SELECT b.cnpj FROM base_oficial b
        WHERE EXISTS (SELECT 1 FROM faturamento f WHERE f.cnpj = b.cnpj AND f.empresa = 'P')"""
)
def existence_probe(t: Tables) -> DataFrame:
    # A semi join cannot be split on its right side: repeated keys go before they are dealt out.
    found = faturamento(t).filter(F.col("empresa") == "P").select("cnpj").distinct()
    return base_oficial(t).join(found, "cnpj", "left_semi").select("cnpj")


@check(
    f"""WITH {FATURAMENTO_SQL} SELECT numero_documento, empresa FROM faturamento
        WHERE cnpj IS NULL OR cnpj NOT IN (SELECT cnpj FROM base_oficial WHERE status = 'Inativo')""".replace(
        FATURAMENTO_SQL, f"{FATURAMENTO_SQL}, {BASE_OFICIAL_SQL}"
    )
)
def delete_by_key(t: Tables) -> DataFrame:
    gone = base_oficial(t).filter(F.col("status") == "Inativo").select("cnpj")
    return faturamento(t).join(gone, "cnpj", "left_anti").select("numero_documento", "empresa")
