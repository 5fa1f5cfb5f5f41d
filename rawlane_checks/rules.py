"""Data-quality rules over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawlane.operators import rules
from rawlane_checks.registry import Tables, check
from rawlane_checks.views import BASE_OFICIAL_SQL, base_oficial


def outcome(df: DataFrame, rule: rules.Rule, key: str) -> DataFrame:
    return rules.validate(df, [rule], key).select("row_key", "ok", "message")


@check(
    f"""WITH {BASE_OFICIAL_SQL} SELECT cnpj AS row_key, segmento IS NOT NULL AS ok,
          CASE WHEN segmento IS NULL THEN 'O campo obrigatório ''segmento'' está vazio.' END AS message
        FROM base_oficial"""
)
def rule_required(t: Tables) -> DataFrame:
    return outcome(base_oficial(t), rules.required("segmento"), "cnpj")


def cases(key: str, texts: list[Column | str | None]) -> Column:
    chosen = F.lit(None).cast("string")
    for i, text in enumerate(texts):
        chosen = F.when(F.col(key) % len(texts) == i, F.lit(text) if not isinstance(text, Column) else text).otherwise(chosen)
    return chosen


@check(
    """SELECT o_orderkey AS row_key, o_orderkey % 6 < 2 AS ok,
         CASE o_orderkey % 6 WHEN 2 THEN 'O valor da data não pode ser vazio.'
              WHEN 3 THEN 'O valor da data não pode ser vazio.'
              WHEN 4 THEN 'A data ''2024-02-30'' não corresponde ao formato esperado ''%Y-%m-%d''.'
              WHEN 5 THEN 'A data ''' || strftime(o_orderdate, '%d/%m/%Y') ||
                          ''' não corresponde ao formato esperado ''%Y-%m-%d''.' END AS message
       FROM orders"""
)
def rule_date_format(t: Tables) -> DataFrame:
    day = F.col("o_orderdate")
    iso, short, dmy = (F.date_format(day, p) for p in ("yyyy-MM-dd", "yyyy-M-d", "dd/MM/yyyy"))
    rows = t.orders.select("o_orderkey", cases("o_orderkey", [iso, short, "", None, "2024-02-30", dmy]).alias("dia"))
    return outcome(rows, rules.date_format("dia"), "o_orderkey")


def tax_ids(kind: str, divide: str) -> dict[str, str]:
    """SQL text for made-up ids: a body from the key, right or wrong check digits by key. Works in both dialects."""
    if kind == "cpf":
        size, first, second = 9, list(range(10, 1, -1)), list(range(11, 1, -1))
        digit = lambda s: f"(CASE WHEN ({s} * 10) % 11 = 10 THEN 0 ELSE ({s} * 10) % 11 END)"
        body = "((c_custkey * 7654321) % 1000000000)"
    else:
        size, first = 12, [5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2]
        second = [6, *first]
        digit = lambda s: f"(CASE WHEN 11 - {s} % 11 >= 10 THEN 0 ELSE 11 - {s} % 11 END)"
        body = "((c_custkey * 987654321) % 1000000000000)"
    tens = lambda n: "1" + "0" * n

    def weighted(number: str, digits: int, weights: list[int]) -> str:
        return "(" + " + ".join(
            f"({divide.format(number, tens(digits - 1 - i))} % 10) * {w}" for i, w in enumerate(weights)
        ) + ")"

    d1 = digit(weighted("body", size, first))
    d2 = digit(weighted("(body * 10 + d1)", size + 1, second))
    shown1 = "CASE WHEN c_custkey % 4 = 1 THEN (d1 + 1) % 10 ELSE d1 END"
    shown2 = "CASE WHEN c_custkey % 4 = 2 THEN (d2 + 1) % 10 ELSE d2 END"
    return {"body": body, "d1": d1, "d2": d2, "shown1": shown1, "shown2": shown2, "size": str(size)}


def tax_sql(kind: str, divide: str, text: str) -> str:
    p = tax_ids(kind, divide)
    return f"""SELECT c_custkey, lpad(CAST(body AS {text}), {p["size"]}, '0') || CAST({p["shown1"]} AS {text}) ||
                 CAST({p["shown2"]} AS {text}) AS n
          FROM (SELECT *, {p["d2"]} AS d2 FROM (SELECT *, {p["d1"]} AS d1 FROM
               (SELECT c_custkey, {p["body"]} AS body FROM customer) a) b) c"""


def tax_rows(t: Tables, kind: str) -> DataFrame:
    return t.spark.sql(tax_sql(kind, "({} div {})", "string").replace("FROM customer", "FROM {customer}"), customer=t.customer)


def tax_oracle(kind: str, label: str, digits: int) -> str:
    return f"""SELECT c_custkey AS row_key,
        n <> repeat(substr(n, 1, 1), {digits}) AND c_custkey % 4 NOT IN (1, 2) AS ok,
        CASE WHEN n = repeat(substr(n, 1, 1), {digits}) THEN '{label} inválido (todos os dígitos são iguais): ' || n
             WHEN c_custkey % 4 = 1 THEN '{label} com primeiro dígito verificador inválido: ' || n
             WHEN c_custkey % 4 = 2 THEN '{label} com segundo dígito verificador inválido: ' || n END AS message
      FROM ({tax_sql(kind, "({} // {})", "VARCHAR")})"""


@check(tax_oracle("cpf", "CPF", 11))
def rule_cpf(t: Tables) -> DataFrame:
    n = F.col("n")
    shown = F.concat_ws(".", F.substring(n, 1, 3), F.substring(n, 4, 3), F.concat(F.substring(n, 7, 3), F.lit("-"), F.substring(n, 10, 2)))
    return outcome(tax_rows(t, "cpf").withColumn("n", shown), rules.tax_id("n"), "c_custkey")


@check(tax_oracle("cnpj", "CNPJ", 14))
def rule_cnpj(t: Tables) -> DataFrame:
    return outcome(tax_rows(t, "cnpj"), rules.tax_id("n"), "c_custkey")


@check(
    """SELECT c_custkey AS row_key, FALSE AS ok,
         CASE c_custkey % 3 WHEN 0 THEN 'CPF/CNPJ não pode ser vazio.'
              WHEN 1 THEN 'CPF/CNPJ com tamanho inválido (' || length(CAST(c_custkey AS VARCHAR)) || ' dígitos).'
              ELSE 'CPF/CNPJ com tamanho inválido (13 dígitos).' END AS message FROM customer"""
)
def rule_tax_id(t: Tables) -> DataFrame:
    texts = [None, F.concat(F.col("c_custkey").cast("string"), F.lit("-x")), "1.234.567/0001-11"]
    rows = t.customer.select("c_custkey", cases("c_custkey", texts).alias("n"))
    return outcome(rows, rules.tax_id("n"), "c_custkey")


NUMBERS = ["12", "1.5", "-3e2", "+.5", " 7 ", "1_000", "NaN", "dez", "", None]


def _number_sql(good: set[int], kind: str) -> str:
    texts = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(NUMBERS) if n is not None)
    ok = ", ".join(str(i) for i in sorted(good))
    return f"""SELECT o_orderkey AS row_key, o_orderkey % 10 IN ({ok}) AS ok,
        CASE WHEN o_orderkey % 10 >= 8 THEN 'O valor numérico não pode ser vazio.'
             WHEN o_orderkey % 10 NOT IN ({ok}) THEN 'O valor ''' || CASE o_orderkey % 10 {texts} END ||
               ''' não é um ''{kind}'' válido.' END AS message FROM orders"""


@check(_number_sql({0, 1, 2, 3, 4}, "decimal"))
def rule_numeric(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", cases("o_orderkey", NUMBERS).alias("n"))
    return outcome(rows, rules.numeric("n"), "o_orderkey")


@check(_number_sql({0, 4}, "int"))
def rule_integer(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", cases("o_orderkey", NUMBERS).alias("n"))
    return outcome(rows, rules.numeric("n", "int"), "o_orderkey")


@check("SELECT c_custkey AS row_key, c_acctbal >= 0 AS ok FROM customer")
def rule_non_negative(t: Tables) -> DataFrame:
    return outcome(t.customer, rules.non_negative("c_acctbal"), "c_custkey").drop("message")


@check("SELECT doc_id AS row_key, upper(lang) IN ('EN', 'FR') AS ok FROM documents")
def rule_domain(t: Tables) -> DataFrame:
    return outcome(t.documents, rules.domain("lang", ["en", "Fr"]), "doc_id").drop("message")


@check(
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"""
)
def rule_domain_table(t: Tables) -> DataFrame:
    allowed = t.customer.filter("c_acctbal >= 0").select("c_custkey")
    return rules.outside_domain(t.orders, "o_custkey", allowed).select("o_orderkey", "o_custkey")


@check(
    """SELECT doc_id AS row_key, length(text) BETWEEN 500 AND 5000 AS ok,
         CASE WHEN length(text) < 500 THEN 'A string é muito curta (mínimo de 500 caracteres).'
              WHEN length(text) > 5000 THEN 'A string é muito longa (máximo de 5000 caracteres).' END AS message
       FROM documents"""
)
def rule_length(t: Tables) -> DataFrame:
    return outcome(t.documents, rules.length("text", 500, 5000), "doc_id")


@check(
    """SELECT 'c_acctbal' AS "column", 'non_negative' AS rule, count(*) AS total,
         count(*) FILTER (c_acctbal >= 0) AS passed, count(*) FILTER (c_acctbal < 0) AS failed FROM customer
       UNION ALL SELECT 'c_mktsegment', 'domain', count(*), count(*) FILTER (c_mktsegment IN ('BUILDING', 'MACHINERY')),
         count(*) FILTER (c_mktsegment NOT IN ('BUILDING', 'MACHINERY')) FROM customer
       UNION ALL SELECT 'c_name', 'length', count(*), count(*) FILTER (length(c_name) <= 18),
         count(*) FILTER (length(c_name) > 18) FROM customer"""
)
def validation_summary(t: Tables) -> DataFrame:
    checks = [
        rules.non_negative("c_acctbal"),
        rules.domain("c_mktsegment", ["building", "machinery"]),
        rules.length("c_name", max_len=18),
    ]
    return rules.validation_summary(t.customer, checks)


@check(
    f"""WITH {BASE_OFICIAL_SQL}, totals AS (SELECT count(*) AS n, count(*) FILTER (segmento IS NULL) AS s,
          count(*) FILTER (responsavel IS NULL) AS r FROM base_oficial)
        SELECT n AS "rows", CAST(7 AS BIGINT) AS "columns", 'segmento' AS "column", s AS nulls,
               CAST(round(s * 100.0 / n, 1) AS DECIMAL(4,1)) AS pct FROM totals WHERE s > 0
        UNION ALL SELECT n, CAST(7 AS BIGINT), 'responsavel', r, CAST(round(r * 100.0 / n, 1) AS DECIMAL(4,1))
        FROM totals WHERE r > 0""",
    money=["pct"],
)
def profile_nulls(t: Tables) -> DataFrame:
    return rules.profile_nulls(base_oficial(t))
