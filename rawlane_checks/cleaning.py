"""Typed cleaning over order rows whose texts are made by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlane.operators.routing import clean_table
from rawlane.specs import DatasetSpec
from rawlane_checks.registry import Tables, check
from rawlane_checks.views import DATE_SQL, NUMBER_SQL, date_text, number_text

NUMBER = DatasetSpec("number", "-", "-", T.StructType([T.StructField("valor", T.DecimalType(18, 2))]), ())
DATE = DatasetSpec("date", "-", "-", T.StructType([T.StructField("dia", T.DateType())]), ())


def cleaned(t: Tables, spec: DatasetSpec, text: Column) -> DataFrame:
    column = spec.target.fieldNames()[0]
    rows = t.orders.select("o_orderkey", text.alias(column))
    staged = clean_table(rows, spec, keep=["o_orderkey"])
    return staged.select("o_orderkey", column, F.col("first_error").isNotNull().alias("erro"))


def by_key(step: int, texts: list[Column | str]) -> Column:
    chosen = F.lit(texts[-1]) if isinstance(texts[-1], str) else texts[-1]
    for i, text in enumerate(texts[:-1]):
        chosen = F.when(F.col("o_orderkey") % step == i, text).otherwise(chosen)
    return chosen


@check(f"SELECT o_orderkey, {NUMBER_SQL} AS valor, o_orderkey % 97 = 0 AS erro FROM orders", money=["valor"])
def parse_br_number(t: Tables) -> DataFrame:
    return cleaned(t, NUMBER, number_text())


# Number texts without a counterpart in the clean columns: text, value or NULL, and whether it is an error.
ODD_NUMBERS: list[tuple[str, str, bool]] = [
    ("1.000,50", "1000.50", False),
    ("1234.5", "12345", False),
    ("-5,1", "-5.1", False),
    ("+7", "7", False),
    (",5", "0.5", False),
    ("5,", "5", False),
    ("1e3", "1000", False),
    (chr(0xA0) + "5,0" + chr(0x2003), "5", False),
    ("\t12,00\n", "12", False),
    ("   ", "NULL", False),
    ("R$ 1", "NULL", True),
    ("5-", "NULL", True),
    ("--", "NULL", True),
    ("1,2,3", "NULL", True),
    ("1 000", "NULL", True),
    ("1_000", "NULL", True),
    ("0x1F", "NULL", True),
    (" nan ", "NULL", True),
    ("inf", "NULL", True),
    ("1e400", "NULL", True),
]
_ODD_CASES = " ".join(f"WHEN {i} THEN {v}" for i, (_, v, _) in enumerate(ODD_NUMBERS))
_ODD_BAD = ", ".join(str(i) for i, (_, _, bad) in enumerate(ODD_NUMBERS) if bad)


@check(
    f"""SELECT o_orderkey, CAST(CASE o_orderkey % {len(ODD_NUMBERS)} {_ODD_CASES} END AS DECIMAL(18,2)) AS valor,
          o_orderkey % {len(ODD_NUMBERS)} IN ({_ODD_BAD}) AS erro FROM orders""",
    money=["valor"],
)
def parse_odd_numbers(t: Tables) -> DataFrame:
    return cleaned(t, NUMBER, by_key(len(ODD_NUMBERS), [text for text, _, _ in ODD_NUMBERS]))


@check(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL WHEN o_orderkey % 4 = 2
            THEN -CAST(o_custkey AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS valor,
         o_orderkey % 4 = 3 AS erro FROM orders""",
    money=["valor"],
)
def dash_as_zero(t: Tables) -> DataFrame:
    negative = F.concat(F.lit("-"), F.col("o_custkey").cast("string"))
    return cleaned(t, NUMBER, by_key(4, ["-", "  -  ", negative, "- -"]))


@check(f"SELECT o_orderkey, {DATE_SQL} AS dia, o_orderkey % 79 = 0 AS erro FROM orders", dates=["dia"])
def parse_dates(t: Tables) -> DataFrame:
    return cleaned(t, DATE, date_text())


def day() -> Column:
    return F.col("o_orderdate").cast("date")


@check(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN CAST(o_orderdate AS DATE) END AS dia,
         o_orderkey % 4 >= 2 AS erro FROM orders""",
    dates=["dia"],
)
def parse_date_dmy(t: Tables) -> DataFrame:
    padded, short = F.date_format(day(), "dd/MM/yyyy"), F.date_format(day(), "d/M/yyyy")
    return cleaned(t, DATE, by_key(4, [padded, short, F.concat(padded, F.lit(" x")), F.date_format(day(), "MM/dd/yyyyy")]))


@check(
    """SELECT o_orderkey,
         CAST((CASE WHEN o_custkey % 100 <= 68 THEN 2000 ELSE 1900 END + o_custkey % 100) || '-03-' ||
              lpad(CAST(o_orderkey % 28 + 1 AS VARCHAR), 2, '0') AS DATE) AS dia, FALSE AS erro FROM orders""",
    dates=["dia"],
)
def parse_date_two_digit_year(t: Tables) -> DataFrame:
    year = F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0")
    return cleaned(t, DATE, F.concat_ws("/", (F.col("o_orderkey") % 28 + 1).cast("string"), F.lit("3"), year))


@check(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS dia,
         o_orderkey % 4 = 3 AS erro FROM orders""",
    dates=["dia"],
)
def parse_month_year(t: Tables) -> DataFrame:
    names = F.split(F.lit("jan fev mar abr mai jun jul ago set out nov dez"), " ")
    month, year = F.element_at(names, F.month(day())), F.date_format(day(), "yyyy")
    texts = [
        F.concat_ws("/", month, year),
        F.concat_ws("/", F.initcap(month), F.date_format(day(), "yy")),
        F.concat_ws("/", F.upper(month), year, F.lit("x")),
        F.concat_ws("/", F.concat(month, F.lit("o")), year),
    ]
    return cleaned(t, DATE, by_key(4, texts))


@check(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 < 5 THEN CAST(o_orderdate AS DATE) END AS dia,
         o_orderkey % 7 >= 5 AS erro FROM orders""",
    dates=["dia"],
)
def parse_date_fallback(t: Tables) -> DataFrame:
    texts = ["yyyy-MM-dd", "yyyy-MM-dd' 'HH:mm:ss", "yyyyMMdd", "d-M-yyyy", "d.M.yyyy", "yyyy/MM/dd", "MMM yyyy"]
    return cleaned(t, DATE, by_key(7, [F.date_format(day(), p) for p in texts]))


@check("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dia, false AS erro FROM orders", dates=["dia"])
def parse_date_with_time(t: Tables) -> DataFrame:
    texts = ["dd/MM/yyyy' 00:00:00'", "d/M/yyyy' 9:30'", "dd-MM-yyyy' 10:30:59.5'", "d.M.yyyy'T'HH:mm", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd' 23:59:59+02:00'"]
    return cleaned(t, DATE, by_key(6, [F.date_format(day(), p) for p in texts]))


@check(
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN DATE '1677-09-22' WHEN 1 THEN DATE '2262-04-11' END AS dia,
         o_orderkey % 5 BETWEEN 2 AND 4 AS erro FROM orders""",
    dates=["dia"],
)
def date_range_guard(t: Tables) -> DataFrame:
    return cleaned(t, DATE, by_key(5, ["22/09/1677", "11/04/2262", "21/09/1677", "12/04/2262", "10/10/5022"]))


@check(
    """SELECT o_orderkey, CAST(NULL AS DATE) AS dia, o_orderkey % 3 = 0 AS erro FROM orders""",
    dates=["dia"],
)
def conversion_failed(t: Tables) -> DataFrame:
    return cleaned(t, DATE, by_key(3, ["nunca", " \t ", F.lit(None).cast("string")]))


@check("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dia, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders", dates=["dia"])
def date_to_iso(t: Tables) -> DataFrame:
    rows = cleaned(t, DATE, F.date_format(F.col("o_orderdate"), "yyyy-MM-dd HH:mm:ss"))
    return rows.select("o_orderkey", "dia", F.col("dia").cast("string").alias("iso"))
