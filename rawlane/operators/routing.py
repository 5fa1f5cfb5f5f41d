"""Typed cleaning of a whole table, and what happens to rows that are incomplete or cannot be typed.

``clean_table`` turns raw text rows into *staged* rows in one pass. Everything else in this module is a projection of
staged rows: the rows to load, the errors, the warnings and the counters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawlane.functions.clean import day_month_year, in_date_range, parse_date, parse_number
from rawlane.functions.text import is_blank, strip
from rawlane.specs import REJECTION_SCHEMA, DatasetSpec

#: Characters of a value in a rejection record; the pipeline's own entries keep values whole.
VALUE_LIMIT = 500


def missing_mandatory(spec: DatasetSpec) -> Column:
    """Names of the mandatory columns that are NULL or blank, in contract order, joined by ', '; NULL when complete."""
    # concat_ws leaves NULLs out.
    absent = [F.when(is_blank(F.col(c)), F.lit(c)) for c in spec.mandatory]
    return F.nullif(F.concat_ws(", ", *absent), F.lit(""))


def row_snapshot(columns: Sequence[Column]) -> Column:
    """The raw row as JSON, NULLs included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def clean_table(df: DataFrame, spec: DatasetSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Type every numeric and date column of a conformed text table.

    Result: the ``keep`` columns, the target columns with their target types, and three columns that are NULL on clean
    rows: ``missing`` (names of empty mandatory columns), ``first_error`` (column and raw value of the first cell that
    cannot be typed, numeric columns before date columns) and ``registro`` (raw row as JSON).
    """
    names = [*spec.numeric_columns, *spec.date_columns]
    kinds = {f.name: f.dataType for f in spec.target}
    dates = set(spec.date_columns)
    text = {n: F.col(f"_text_{n}") for n in names}
    typed = {n: F.col(f"_typed_{n}") for n in names}
    # One narrow step per projection, so that nothing is computed twice and no step's generated code gets too large.
    # Blank text becomes NULL here, so that afterwards "has text but no value" means a failed conversion.
    steps = df.select("*", *[F.nullif(strip(F.col(n)), F.lit("")).alias(f"_text_{n}") for n in names])
    if dates:
        steps = steps.withColumns({f"_text_{n}": day_month_year(text[n]) for n in spec.date_columns})
    steps = steps.select(
        "*",
        *[(parse_date(text[n]) if n in dates else parse_number(text[n], kinds[n])).alias(f"_typed_{n}") for n in names],
    )
    if dates:
        steps = steps.withColumns({f"_typed_{n}": in_date_range(typed[n]).cast(kinds[n]) for n in spec.date_columns})
    place = F.lit(None).cast("int")
    for i, n in reversed(list(enumerate(names, start=1))):
        place = F.when(typed[n].isNull() & text[n].isNotNull(), i).otherwise(place)
    steps = steps.select("*", place.alias("_place"), missing_mandatory(spec).alias("missing"))
    error = F.lit(None).cast("struct<campo:string,valor:string>")
    if names:
        at = lambda values: F.element_at(F.array(*values), F.col("_place"))
        found = F.struct(at([F.lit(n) for n in names]).alias("campo"), at([F.col(n) for n in names]).alias("valor"))
        error = F.when(F.col("_place").isNotNull(), found)
    snapshot = F.col("_snapshot") if "_snapshot" in df.columns else row_snapshot([F.col(n) for n in kinds])
    return steps.select(
        *keep,
        *[typed.get(n, F.col(n)).alias(n) for n in kinds],
        "missing",
        error.alias("first_error"),
        F.when(F.col("missing").isNotNull() | F.col("_place").isNotNull(), snapshot).alias("registro"),
    )


def valid_rows(staged: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows to load: every row without a conversion error, incomplete ones included."""
    return staged.filter(F.col("first_error").isNull()).select(
        *spec.target.fieldNames(), "source_filename", F.current_timestamp().alias("data_carga")
    )


def _entries(staged: DataFrame, spec: DatasetSpec, field: Column, reason: Column, value: Column, severity: str) -> DataFrame:
    return staged.select(
        F.col("run_id").alias("execucao_fk"),
        F.lit(spec.script).alias("script_nome"),
        F.lit(spec.table).alias("tabela_destino"),
        F.col("numero_linha").cast("long").alias("numero_linha"),
        field.alias("campo_falha"),
        reason.alias("motivo_rejeicao"),
        value.alias("valor_recebido"),
        F.col("registro").alias("registro_completo"),
        F.current_timestamp().alias("data_rejeicao"),
        F.lit(severity).alias("severidade"),
    )


def error_entries(staged: DataFrame, spec: DatasetSpec) -> DataFrame:
    """One ERROR per row that cannot be typed, naming its first failing column. Needs ``run_id`` and ``numero_linha``."""
    rows = staged.filter(F.col("first_error").isNotNull())
    field, value = F.coalesce(F.col("first_error.campo"), F.lit("data_cleaning")), F.col("first_error.valor")
    kind = F.when(field.isin(spec.numeric_columns), F.lit("Valor numérico inválido")).otherwise(F.lit("Data inválida"))
    reason = F.concat(kind, F.lit(" em '"), field, F.lit("': "), value)
    return _entries(rows, spec, field, reason, value, "ERROR")


def warn_entries(staged: DataFrame, spec: DatasetSpec) -> DataFrame:
    """One WARN per row with empty mandatory columns; such a row is loaded all the same."""
    rows = staged.filter(F.col("missing").isNotNull())
    return _entries(
        rows,
        spec,
        F.col("missing"),
        F.concat(F.lit("Campos obrigatórios vazios: "), F.col("missing")),
        F.lit(None).cast("string"),
        "WARN",
    )


def rejections(staged: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Errors, then warnings. A row can give one of each."""
    return error_entries(staged, spec).unionByName(warn_entries(staged, spec)).select(*REJECTION_SCHEMA.fieldNames())


def run_metrics(staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counters per file: rows read, loaded, updated (always 0) and log entries (errors plus warnings)."""
    error, warn = F.col("first_error").isNotNull(), F.col("missing").isNotNull()
    return staged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("linhas_processadas"),
        F.count_if(~error).alias("linhas_inseridas"),
        F.lit(0).cast("long").alias("linhas_atualizadas"),
        (F.count_if(error) + F.count_if(warn)).alias("linhas_erro"),
    )
