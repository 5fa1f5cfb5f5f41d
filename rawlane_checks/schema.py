"""Header contracts, conforming and type migration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlane.operators.schema import conform, header_contract, migrate_types
from rawlane.sources.manifest import describe_content
from rawlane.specs import DEFAULT_SPECS, USUARIOS, DatasetSpec
from rawlane_checks.registry import Tables, check
from rawlane_checks.views import USUARIOS_SQL, usuarios

HEADER = list(USUARIOS.header)
SWAPPED = [HEADER[1], HEADER[0], *HEADER[2:]]
FOUND = [HEADER, SWAPPED, HEADER[1:], [*HEADER, "extra"], [HEADER[0].upper(), *HEADER[1:]]]


@check(
    f"""SELECT c_custkey, c_custkey % 5 = 0 AS ok,
          CASE c_custkey % 5 {" ".join(f"WHEN {i} THEN '{'|'.join(h)}'" for i, h in enumerate(FOUND))} END AS found,
          CASE c_custkey % 5 WHEN 2 THEN 'cargo' WHEN 4 THEN 'cargo' ELSE '' END AS missing,
          CASE c_custkey % 5 WHEN 3 THEN 'extra' WHEN 4 THEN 'CARGO' ELSE '' END AS extra
        FROM customer""",
    name="header_contract",
)
def header_check(t: Tables) -> DataFrame:
    """Each customer row as one small file, with a right header or one broken in four ways."""
    line = F.lit(None).cast("string")
    for i, header in enumerate(FOUND):
        sep = ";,"[i % 2]
        quoted = sep.join([f'"{header[0]}"', *header[1:]])
        line = F.when(F.col("c_custkey") % len(FOUND) == i, quoted).otherwise(line)
    files = t.customer.select(
        "c_custkey",
        F.lit("usuarios").alias("dataset"),
        F.concat(line, F.lit("\r\n"), F.col("c_name")).cast("binary").alias("content"),
    )
    checked = header_contract(describe_content(files), DEFAULT_SPECS)
    return checked.select(
        "c_custkey",
        "ok",
        F.array_join("header", "|").alias("found"),
        F.array_join("missing", "|").alias("missing"),
        F.array_join("extra", "|").alias("extra"),
    )


TARGET = DatasetSpec(
    name="pedidos",
    pattern="pedidos",
    table="pedidos",
    target=T.StructType([T.StructField(n, T.StringType()) for n in ("cnpj", "categoria", "cliente_nome_fantasia", "grupo")]),
    mandatory=("cnpj", "grupo"),
    rename={"nome_fantasia": "cliente_nome_fantasia", "categorioa": "categoria"},
)


def conformed(t: Tables) -> DataFrame:
    """Renames, a name that is double after renaming, an extra column and an absent one."""
    key = F.col("o_custkey").cast("string")
    raw = t.orders.select(
        F.concat(F.lit("a"), key).alias("nome_fantasia"),
        F.col("o_orderstatus").alias("categorioa"),
        F.concat(F.lit("b"), key).alias("cliente_nome_fantasia"),
        F.col("o_orderkey").alias("sobra"),
        key.alias("cnpj"),
    )
    return conform(raw, TARGET)


@check("SELECT CAST(o_custkey AS VARCHAR) AS cnpj, o_orderstatus AS categoria FROM orders")
def rename_columns(t: Tables) -> DataFrame:
    return conformed(t).select("cnpj", "categoria")


@check("SELECT CAST(o_custkey AS VARCHAR) AS cnpj, 'a' || o_custkey AS cliente_nome_fantasia FROM orders")
def drop_duplicate_columns(t: Tables) -> DataFrame:
    return conformed(t).select("cnpj", "cliente_nome_fantasia")


@check("SELECT CAST(o_custkey AS VARCHAR) AS cnpj, CAST(NULL AS VARCHAR) AS grupo FROM orders")
def add_missing_mandatory(t: Tables) -> DataFrame:
    return conformed(t).select("cnpj", "grupo")


@check(
    """SELECT CAST(o_custkey AS VARCHAR) AS cnpj, o_orderstatus AS categoria, 'a' || o_custkey AS cliente_nome_fantasia,
         CAST(NULL AS VARCHAR) AS grupo FROM orders"""
)
def conform_to_target(t: Tables) -> DataFrame:
    return conformed(t)


@check(
    f"""WITH {USUARIOS_SQL} SELECT consultor, CAST(acesso_vendedor AS VARCHAR) AS acesso_vendedor,
          CAST(acesso_gerente AS VARCHAR) AS acesso_gerente FROM usuarios""",
    name="migrate_types",
)
def migrated(t: Tables) -> DataFrame:
    rows = usuarios(t).select("consultor", "acesso_vendedor", "acesso_gerente")
    return migrate_types(rows, {"acesso_vendedor": "string", "acesso_gerente": "string"})
