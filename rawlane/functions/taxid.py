"""Check digits of Brazilian person (CPF, 11 digits) and company (CNPJ, 14 digits) numbers."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digit weights of the two check digits.
CPF_FIRST = (10, 9, 8, 7, 6, 5, 4, 3, 2)
CPF_SECOND = (11, 10, 9, 8, 7, 6, 5, 4, 3, 2)
CNPJ_FIRST = (5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
CNPJ_SECOND = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value.cast("string"), "[^0-9]", "")


def _digit(digits: Column, position: int) -> Column:
    # ascii() never fails, so the term is safe on numbers of any length.
    return F.ascii(F.substring(digits, position, 1)) - F.lit(48)


def _weighted(digits: Column, weights: tuple[int, ...]) -> Column:
    # Written out term by term: plain integer arithmetic stays in generated code, an array fold would not.
    return reduce(add, (_digit(digits, i) * F.lit(w) for i, w in enumerate(weights, start=1)))


def _all_equal(digits: Column, length: int) -> Column:
    return digits == F.repeat(F.substring(digits, 1, 1), F.lit(length))


def cpf_problem(digits: Column) -> Column:
    """NULL for a valid 11-digit number, else what is wrong with it."""

    def check(weights: tuple[int, ...]) -> Column:
        rest = (_weighted(digits, weights) * 10) % 11
        return F.when(rest == 10, F.lit(0)).otherwise(rest)

    return (
        F.when(_all_equal(digits, 11), F.concat(F.lit("CPF inválido (todos os dígitos são iguais): "), digits))
        .when(
            check(CPF_FIRST) != _digit(digits, 10),
            F.concat(F.lit("CPF com primeiro dígito verificador inválido: "), digits),
        )
        .when(
            check(CPF_SECOND) != _digit(digits, 11),
            F.concat(F.lit("CPF com segundo dígito verificador inválido: "), digits),
        )
    )


def cnpj_problem(digits: Column) -> Column:
    """NULL for a valid 14-digit number, else what is wrong with it."""

    def check(weights: tuple[int, ...]) -> Column:
        rest = F.lit(11) - _weighted(digits, weights) % 11
        return F.when(rest >= 10, F.lit(0)).otherwise(rest)

    return (
        F.when(_all_equal(digits, 14), F.concat(F.lit("CNPJ inválido (todos os dígitos são iguais): "), digits))
        .when(
            check(CNPJ_FIRST) != _digit(digits, 13),
            F.concat(F.lit("CNPJ com primeiro dígito verificador inválido: "), digits),
        )
        .when(
            check(CNPJ_SECOND) != _digit(digits, 14),
            F.concat(F.lit("CNPJ com segundo dígito verificador inválido: "), digits),
        )
    )


def tax_id_problem(value: Column, digits: Column) -> Column:
    """NULL for a valid CPF or CNPJ, else a message. ``digits`` is a column holding ``digits_of(value)``."""
    length = F.length(digits)
    return (
        F.when(value.isNull() | (value.cast("string") == ""), F.lit("CPF/CNPJ não pode ser vazio."))
        .when(length == 11, cpf_problem(digits))
        .when(length == 14, cnpj_problem(digits))
        .otherwise(F.concat(F.lit("CPF/CNPJ com tamanho inválido ("), length.cast("string"), F.lit(" dígitos).")))
    )
