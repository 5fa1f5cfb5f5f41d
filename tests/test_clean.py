"""Number and date texts, one table per test."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings as hsettings
from hypothesis import strategies as st
from pyspark.sql import types as T

from rawlane.operators.routing import clean_table
from rawlane.specs import DatasetSpec

NUMBER = DatasetSpec("n", "-", "-", T.StructType([T.StructField("v", T.DecimalType(18, 2))]), ())
DOUBLE = DatasetSpec("f", "-", "-", T.StructType([T.StructField("v", T.DoubleType())]), ())
DATE = DatasetSpec("d", "-", "-", T.StructType([T.StructField("v", T.DateType())]), ())
BAD = object()


def cleaned(spark, spec, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string").repartition(3)
    result = clean_table(rows, spec, keep=["i"]).orderBy("i").collect()
    return [BAD if r.first_error is not None else r.v for r in result]


NUMBERS = {
    " 398,23 ": Decimal("398.23"),
    " -   ": Decimal(0),
    "1.000,50": Decimal("1000.50"),
    "-5,1": Decimal("-5.1"),
    "+7": Decimal(7),
    "1234.5": Decimal(12345),
    ",5": Decimal("0.5"),
    "5,": Decimal(5),
    "1e3": Decimal(1000),
    "\xa05,0": Decimal(5),
    "  7 　": Decimal(7),
    "R$ 1": BAD,
    "5-": BAD,
    "--": BAD,
    "1,2,3": BAD,
    "1 000": BAD,
    "1_000": BAD,
    "0x1F": BAD,
    "true": BAD,
    "": None,
    "   ": None,
    None: None,
    " nan ": BAD,
    "inf": BAD,
    "Infinity": BAD,
    "1e400": BAD,
    "1d": BAD,
}


@pytest.mark.parametrize("spec", [NUMBER, DOUBLE], ids=["decimal", "double"])
def test_number_table(spark, spec):
    got = cleaned(spark, spec, list(NUMBERS))
    for text, value, expected in zip(NUMBERS, got, NUMBERS.values()):
        if expected is BAD or expected is None:
            assert value is expected, repr(text)
        else:
            assert float(value) == float(expected), repr(text)


DATES = {
    "05/03/2024": dt.date(2024, 3, 5),
    "5/3/2024": dt.date(2024, 3, 5),
    " 5/3/2024\t": dt.date(2024, 3, 5),
    "29/02/2024": dt.date(2024, 2, 29),
    "29/02/2023": BAD,
    "31/04/2024": BAD,
    "00/01/2024": BAD,
    "01/13/2024": BAD,
    "1/1/024": BAD,
    "1/1/12024": BAD,
    "05/03/2024 x": BAD,
    "05/03/68": dt.date(2068, 3, 5),
    "05/03/69": dt.date(1969, 3, 5),
    "5/3/00": dt.date(2000, 3, 5),
    "out/2025": dt.date(2025, 10, 1),
    "OUT/25": dt.date(2025, 10, 1),
    "Dez/1999": dt.date(1999, 12, 1),
    "fev/2024/lixo": dt.date(2024, 2, 1),
    "outubro/2025": BAD,
    "out/5": BAD,
    "out": BAD,
    "abc/2024": BAD,
    "2024-03-04": dt.date(2024, 3, 4),
    "2024-03-04 23:59:59": dt.date(2024, 3, 4),
    "2024-03-04T01:02:03.5": dt.date(2024, 3, 4),
    "2024-03-04 25:00": BAD,
    "20240304": dt.date(2024, 3, 4),
    "20241304": BAD,
    "4-3-2024": dt.date(2024, 3, 4),
    "4.3.2024": dt.date(2024, 3, 4),
    "4-3.2024": BAD,
    "2024": BAD,
    "2024-03": BAD,
    "mar 2024": BAD,
    "21/09/1677": BAD,
    "22/09/1677": dt.date(1677, 9, 22),
    "11/04/2262": dt.date(2262, 4, 11),
    "12/04/2262": BAD,
    "01/01/5022": BAD,
    "": None,
    " ": None,
    None: None,
}


def test_date_table(spark):
    got = cleaned(spark, DATE, list(DATES))
    for text, value, expected in zip(DATES, got, DATES.values()):
        assert value is expected or value == expected, repr(text)


def brazilian(value: Decimal) -> str:
    return f"{value:,.2f}".translate(str.maketrans(",.", ".,"))


@hsettings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    numbers=st.lists(st.decimals(-(10**15), 10**15, places=2, allow_nan=False), min_size=40, max_size=80),
    days=st.lists(st.dates(dt.date(1678, 1, 1), dt.date(2262, 4, 11)), min_size=40, max_size=80),
)
def test_format_then_parse_gives_the_value_back(spark, numbers, days):
    assert cleaned(spark, NUMBER, [brazilian(n) for n in numbers]) == numbers
    assert cleaned(spark, DATE, [f"{d.day:02d}/{d.month:02d}/{d.year}" for d in days]) == days


def test_integer_targets_are_refused():
    with pytest.raises(ValueError, match="not supported"):
        DatasetSpec("x", "x", "x", T.StructType([T.StructField("v", T.IntegerType())]), ())


def test_text_that_starts_with_a_visible_character_is_not_trimmed_to_see_if_it_is_blank(spark):
    from pyspark.sql import functions as F

    from rawlane.functions.text import WHITESPACE, is_blank

    odd = [*WHITESPACE, "!", "~", "\x7f", "\x80", "a", "é", "\x00", "\x1b", "\U0001f600"]
    texts = ["", *odd, *[a + b for a in odd for b in odd]]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", is_blank(F.col("t")).alias("blank")).collect()
    assert [r.t for r in rows if r.blank != (r.t.strip() == "")] == []
    assert spark.createDataFrame([(None,)], "t string").select(is_blank(F.col("t"))).first()[0] is True
    plan = spark.range(1).select(is_blank(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
    assert ">= !" in plan
