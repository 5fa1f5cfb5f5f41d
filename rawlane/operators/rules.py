"""Data-quality rules over whole tables, and NULL profiling.

A rule is a column expression: a message where the row breaks the rule, NULL where it does not. Any number of rules
runs in one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlane.functions.taxid import digits_of, tax_id_problem
from rawlane.functions.text import is_blank

EMPTY_NUMBER = "O valor numérico não pode ser vazio."


@dataclass(frozen=True)
class Rule:
    """``prepared`` holds columns to compute first, for rules that look at a derived value many times."""

    name: str
    column: str
    problem: Column
    prepared: Mapping[str, Column] = field(default_factory=dict)


def _prepared(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    columns = {name: column for rule in rules for name, column in rule.prepared.items()}
    return df.withColumns(columns) if columns else df


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _shown(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def required(column: str) -> Rule:
    """Fails on NULL and on blank text."""
    return Rule("required", column, F.when(is_blank(_text(column)), F.lit(f"O campo obrigatório '{column}' está vazio.")))


# English month names, in order, as %b (first three letters) and %B write them.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")

# Directives: how each is written, and what it tells. Alternatives stand longest first, as in the formats' own definition.
_DIRECTIVES = {
    "%Y": (r"(\d{4})", "year"),
    "%y": (r"(\d{2})", "year"),
    "%m": (r"(0[1-9]|1[0-2]|[1-9])", "month"),
    "%b": ("((?i:" + "|".join(m[:3] for m in MONTHS) + "))", "month"),
    "%B": ("((?i:" + "|".join(MONTHS) + "))", "month"),
    "%d": (r"(0[1-9]|[12]\d|3[01]|[1-9])", "day"),
    "%j": (r"(00[1-9]|0[1-9]\d|[12]\d\d|3[0-5]\d|36[0-6]|[1-9]\d|0[1-9]|[1-9])", "day_of_year"),
    "%H": (r"(2[0-3]|[0-1]\d|\d)", "hour"),
    "%I": (r"(1[0-2]|0[1-9]|[1-9])", "hour"),
    "%p": ("((?i:am|pm))", "half"),
    "%M": (r"([0-5]\d|\d)", "minute"),
    "%S": (r"(6[0-1]|[0-5]\d|\d)", "second"),
    "%f": (r"(\d{1,6})", "fraction"),
    "%z": (r"([+-]\d\d:?[0-5]\d(?::?[0-5]\d(?:\.\d{1,6})?)?|(?-i:Z))", "zone"),
}
_REGEX_SPECIAL = set(r"\.^$*+?{}[]|()")


def _date_pattern(fmt: str) -> tuple[str, dict[str, tuple[int, str]]]:
    """A format as a pattern, and for every part it tells the group and the directive."""
    pattern, places, i = "", {}, 0
    while i < len(fmt):
        directive = fmt[i : i + 2]
        if directive in _DIRECTIVES:
            regex, part = _DIRECTIVES[directive]
            if part in places:
                raise ValueError(f"{fmt!r} tells the {part} twice")
            pattern += regex
            places[part] = (len(places) + 1, directive)
            i += 2
        elif directive == "%%":
            pattern, i = pattern + "%", i + 2
        elif fmt[i] == "%":
            raise ValueError(f"unsupported date directive {directive!r}")
        elif fmt[i].isspace():
            pattern += r"\s+"
            while i < len(fmt) and fmt[i].isspace():
                i += 1
        else:
            pattern += f"\\{fmt[i]}" if fmt[i] in _REGEX_SPECIAL else fmt[i]
            i += 1
    return f"^{pattern}$", places


def date_format(column: str, fmt: str = "%Y-%m-%d") -> Rule:
    """Fails on empty text and on text that does not fit ``fmt`` or names a day that does not exist.

    Directives: %Y %y %m %b %B %d %j (days and the like), %H %I %p %M %S %f %z (time of day and zone), %%; others are refused
    when the rule is made. Month names are English, of any case; white space in the format stands for any. A format need not
    tell all parts: a day is judged in the year it names, else in 1900, which has no 29 February.
    """
    pattern, places = _date_pattern(fmt)
    value = _text(column)

    def part(name: str) -> Column:
        return F.regexp_extract(value, pattern, places[name][0])

    year = part("year") if "year" in places else F.lit("1900")
    if places.get("year", (0, ""))[1] == "%y":
        year = F.concat(F.when(year.try_cast("int") <= 68, F.lit("20")).otherwise(F.lit("19")), year)
    month = part("month") if "month" in places else F.lit("1")
    if places.get("month", (0, ""))[1] in ("%b", "%B"):
        month = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.substring(F.lower(month), 1, 3)).cast("string")
    day = F.concat_ws("-", year, month, part("day") if "day" in places else F.lit("1")).try_cast("date")
    good = value.rlike(pattern) & (year != "0000") & day.isNotNull()
    if "second" in places:  # the format knows 60 and 61, a time of day does not
        good = good & (part("second").try_cast("int") < 60)
    if "zone" in places:
        good = good & ~F.regexp_like(part("zone"), F.lit(r"^[+-](2[4-9]|[3-9]\d)"))
    problem = F.when(value.isNull() | (value == ""), F.lit("O valor da data não pode ser vazio.")).when(
        ~good, _shown("A data '", value, f"' não corresponde ao formato esperado '{fmt}'.")
    )
    return Rule("date_format", column, problem)


def date_typed(column: str) -> Rule:
    """For DATE and TIMESTAMP columns: fails on NULL only."""
    return Rule("date_format", column, F.when(F.col(column).isNull(), F.lit("O valor da data não pode ser vazio.")))


def tax_id(column: str) -> Rule:
    """Fails unless the digits form a valid CPF (11) or CNPJ (14)."""
    digits = f"_digits_{column}"
    problem = tax_id_problem(F.col(column), F.col(digits))
    return Rule("tax_id", column, problem, {digits: digits_of(F.col(column))})


def _is_number(value: Column, kind: str) -> Column:
    if kind == "int":
        return value.rlike(r"^\s*[+-]?\d+\s*$")
    return value.rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")


def _numeric_problem(column: str, kind: str) -> Column:
    value = _text(column)
    return F.when(is_blank(value), F.lit(EMPTY_NUMBER)).when(
        ~_is_number(value, kind), _shown("O valor '", value, f"' não é um '{kind}' válido.")
    )


def numeric(column: str, kind: str = "decimal") -> Rule:
    """Fails on empty values and on text that is not an ``int``, ``float`` or ``decimal``. NaN and digit groups fail."""
    if kind not in ("int", "float", "decimal"):
        return Rule("numeric", column, F.lit(f"Tipo numérico desconhecido: {kind}"))
    return Rule("numeric", column, _numeric_problem(column, kind))


def non_negative(column: str) -> Rule:
    """Fails where ``numeric`` fails, and below zero. The sign and the digits decide, so any magnitude is exact."""
    value = _text(column)
    below = value.rlike(r"^\s*-") & value.rlike(r"^[^eE]*[1-9]")
    problem = F.coalesce(
        _numeric_problem(column, "decimal"),
        F.when(below, _shown("O número deve ser não-negativo (>= 0), mas foi '", value, "'.")),
    )
    return Rule("non_negative", column, problem)


def domain(column: str, values: Sequence[str], case_sensitive: bool = False) -> Rule:
    """Fails on NULL and on values outside the list. For long lists use ``outside_domain``."""
    allowed = list(values) if case_sensitive else [v.upper() for v in values]
    value = _text(column)
    inside = (value if case_sensitive else F.upper(value)).isin(*allowed)
    problem = F.when(value.isNull(), F.lit("O valor não pode ser nulo para validação de domínio.")).when(
        ~inside, _shown("O valor '", value, f"' não pertence ao domínio permitido: {allowed}.")
    )
    return Rule("domain", column, problem)


def outside_domain(df: DataFrame, column: str, values: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Rows whose value is NULL or not in the one-column table ``values``.

    The planner broadcasts a small value list; a large one is a shuffled anti join, whose frequent values adaptive
    execution splits.
    """
    fold = (lambda c: c) if case_sensitive else F.upper
    key = fold(_text(column))
    allowed = values.select(fold(F.col(values.columns[0]).cast("string")).alias("_allowed")).distinct()
    return df.withColumn("_key", key).join(allowed, F.col("_key") == F.col("_allowed"), "left_anti").drop("_key")


def length(column: str, min_len: int | None = None, max_len: int | None = None) -> Rule:
    """Fails on NULL and outside the inclusive character bounds."""
    size = F.length(_text(column))
    problem = F.when(size.isNull(), F.lit("A string não pode ser nula para validação de tamanho."))
    if min_len is not None:
        problem = problem.when(size < min_len, F.lit(f"A string é muito curta (mínimo de {min_len} caracteres)."))
    if max_len is not None:
        problem = problem.when(size > max_len, F.lit(f"A string é muito longa (máximo de {max_len} caracteres)."))
    return Rule("length", column, problem)


def validate(df: DataFrame, rules: Sequence[Rule], key: str, failures_only: bool = False) -> DataFrame:
    """One row per (row, rule): ``row_key, column, rule, ok, message``. One scan, no shuffle."""
    outcomes = F.array(
        *[
            F.struct(
                F.lit(r.column).alias("column"),
                F.lit(r.name).alias("rule"),
                r.problem.isNull().alias("ok"),
                r.problem.alias("message"),
            )
            for r in rules
        ]
    )
    if failures_only:
        outcomes = F.filter(outcomes, lambda o: ~o["ok"])
    return _prepared(df, rules).select(F.col(key).alias("row_key"), F.inline(outcomes))


def validation_summary(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Per rule: rows checked, rows that pass, rows that fail. One aggregate over the table, all rules at once."""
    failed = [F.count_if(r.problem.isNotNull()).alias(f"failed_{i}") for i, r in enumerate(rules)]
    totals = _prepared(df, rules).agg(F.count(F.lit(1)).alias("total"), *failed)
    outcomes = F.array(
        *[
            F.struct(F.lit(r.column).alias("column"), F.lit(r.name).alias("rule"), F.col(f"failed_{i}").alias("failed"))
            for i, r in enumerate(rules)
        ]
    )
    return totals.select("total", F.inline(outcomes)).select(
        "column", "rule", "total", (F.col("total") - F.col("failed")).alias("passed"), "failed"
    )


def profile_nulls(df: DataFrame, only_with_nulls: bool = True) -> DataFrame:
    """NULL count and percentage (one decimal) per column, with the table's row and column counts.

    NaN counts as NULL in floating columns. One aggregate over the table; map tasks send one row each.
    """

    def absent(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
            return value.isNull() | F.isnan(value)
        return value.isNull()

    fields = df.schema.fields
    counts = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(absent(f)).alias(f"n{i}") for i, f in enumerate(fields)])
    listed = F.array(
        *[F.struct(F.lit(f.name).alias("column"), F.col(f"n{i}").alias("nulls")) for i, f in enumerate(fields)]
    )
    share = F.col("nulls") * F.lit(Decimal("100.0")) / F.col("rows")
    profile = counts.select("rows", F.lit(len(fields)).cast("long").alias("columns"), F.inline(listed)).select(
        "rows", "columns", "column", "nulls", F.round(F.when(F.col("rows") > 0, share), 1).cast("decimal(4,1)").alias("pct")
    )
    return profile.filter(F.col("nulls") > 0) if only_with_nulls else profile
