"""Data-quality rules on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rawlane.operators import rules

VALID = ["529.982.247-25", "11144477735", "11.222.333/0001-81", "11444777000161"]
BROKEN = {
    "52998224715": "CPF com primeiro dígito verificador inválido: 52998224715",
    "52998224726": "CPF com segundo dígito verificador inválido: 52998224726",
    "111.111.111-11": "CPF inválido (todos os dígitos são iguais): 11111111111",
    "11222333000191": "CNPJ com primeiro dígito verificador inválido: 11222333000191",
    "11222333000182": "CNPJ com segundo dígito verificador inválido: 11222333000182",
    "00000000000000": "CNPJ inválido (todos os dígitos são iguais): 00000000000000",
    "1122233300018": "CPF/CNPJ com tamanho inválido (13 dígitos).",
    "abc": "CPF/CNPJ com tamanho inválido (0 dígitos).",
    "": "CPF/CNPJ não pode ser vazio.",
    None: "CPF/CNPJ não pode ser vazio.",
}


def messages(spark, values, rule, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.message for r in rules.validate(rows, [rule], "i").orderBy("row_key").collect()]


def test_tax_ids(spark):
    assert messages(spark, VALID, rules.tax_id("v")) == [None] * len(VALID)
    assert messages(spark, list(BROKEN), rules.tax_id("v")) == list(BROKEN.values())


def test_required(spark):
    bad = "O campo obrigatório 'v' está vazio."
    assert messages(spark, ["x", " ", "", None, " "], rules.required("v")) == [None, bad, bad, bad, bad]


@pytest.mark.parametrize(
    ("fmt", "good", "bad"),
    [
        ("%Y-%m-%d", ["2024-02-29", "2024-2-9"], ["2023-02-29", "2024-02-29 ", "24-02-29", "29/02/2024", "0000-01-01"]),
        ("%d/%m/%Y", ["29/02/2024"], ["02/29/2024", "29-02-2024"]),
        ("%d.%m.%y", ["01.12.68", "01.12.69", "29.02.00"], ["29.02.01", "01x12x68"]),
    ],
)
def test_date_format(spark, fmt, good, bad):
    got = messages(spark, good + bad, rules.date_format("v", fmt))
    assert got == [None] * len(good) + [f"A data '{b}' não corresponde ao formato esperado '{fmt}'." for b in bad]
    assert messages(spark, ["", None], rules.date_format("v", fmt)) == ["O valor da data não pode ser vazio."] * 2
    assert messages(spark, [dt.date(2024, 1, 1), None], rules.date_typed("v"), "date") == [
        None,
        "O valor da data não pode ser vazio.",
    ]


def test_date_format_refuses_other_directives():
    for fmt in ("%U", "%Y-%m-%Q", "%"):
        with pytest.raises(ValueError, match="unsupported"):
            rules.date_format("v", fmt)
    with pytest.raises(ValueError, match="twice"):
        rules.date_format("v", "%Y %y")


@pytest.mark.parametrize(
    "fmt",
    ["%H:%M", "%Y-%m-%d %H:%M:%S", "%d/%m/%Y %H:%M:%S.%f", "%d %b %Y", "%d-%B-%y", "%Y-%j", "%j", "%I:%M %p", "%Y%m%d%H%M", "%Y-%m-%dT%H:%M:%S%z", "%d/%m", "100%% %Y", "%m.%Y"],
)
def test_date_formats_as_the_standard_library_reads_them(spark, fmt):
    """Every format against ``strptime``, on texts of all formats and slightly wrong ones."""
    texts = [
        "7:05", "07:5", "24:00", "2024-02-29 23:59:59", "2023-02-29 00:00:00", "2024-2-9  1:2:3", "2024-02-29 23:59:61", "2024-02-29 23:59:62",
        "29/02/2024 10:11:12.5", "29/02/2024 10:11:12.1234567", "9/2/2024 1:1:1.000001", "05 mar 2024", "31 Abr 2024", "31 JUN 2024", "30 Jun 2024", "5  MAY\t2024",
        "01-march-68", "1-Marcha-68", "31-september-24", "2024-366", "2023-366", "2024-1", "2024-0", "366", "12:00 pm", "0:30 AM", "13:00 PM", "1:7 Pm",
        "202402292359", "20230229123", "2024-02-29T01:02:03+0300", "2024-02-29T01:02:03-03:30", "2024-02-29T01:02:03Z", "2024-02-29T01:02:03z", "2024-02-29T01:02:03+25:00", "2024-02-29T01:02:03",
        "29/02", "28/02", "31/4", "100% 1999", "100%  0000", "12.2024", "00.2024", "1.1", "abc",
    ]

    def fits(text):
        try:
            dt.datetime.strptime(text, fmt)
        except ValueError:
            return False
        return True

    got = messages(spark, texts, rules.date_format("v", fmt))
    assert {t: m is None for t, m in zip(texts, got, strict=True)} == {t: fits(t) for t in texts}



def test_numbers(spark):
    texts = ["1", " -2 ", "1.5", "1e3", "1_000", "NaN", "x", "", None]
    empty = "O valor numérico não pode ser vazio."
    wrong = lambda kind, *bad: [f"O valor '{t}' não é um '{kind}' válido." if t in bad else None for t in texts[:7]]
    assert messages(spark, texts, rules.numeric("v")) == [*wrong("decimal", "1_000", "NaN", "x"), empty, empty]
    assert messages(spark, texts, rules.numeric("v", "float")) == [*wrong("float", "1_000", "NaN", "x"), empty, empty]
    expected = wrong("int", "1.5", "1e3", "1_000", "NaN", "x")
    assert messages(spark, texts, rules.numeric("v", "int")) == [*expected, empty, empty]
    assert messages(spark, ["1"], rules.numeric("v", "complexo")) == ["Tipo numérico desconhecido: complexo"]


def test_non_negative(spark):
    texts = ["0", "-0", "-0.0e9", "3", "-3", "-1e-400", "9" * 50, "x"]
    below = "O número deve ser não-negativo (>= 0), mas foi '{}'."
    expected = [None, None, None, None, below.format("-3"), below.format("-1e-400"), None, "O valor 'x' não é um 'decimal' válido."]
    assert messages(spark, texts, rules.non_negative("v")) == expected
    assert messages(spark, [1.5, -0.0, -2e-9, float("nan")], rules.non_negative("v"), "double")[:2] == [None, None]
    assert all(messages(spark, [-2e-9, float("nan")], rules.non_negative("v"), "double"))


def test_domain_and_length(spark):
    values = ["a", "B", "c", None]
    nothing = "O valor não pode ser nulo para validação de domínio."
    assert messages(spark, values, rules.domain("v", ["A", "b"])) == [
        None,
        None,
        "O valor 'c' não pertence ao domínio permitido: ['A', 'B'].",
        nothing,
    ]
    strict = messages(spark, values, rules.domain("v", ["a", "b"], case_sensitive=True))
    assert [m is None for m in strict] == [True, False, False, False]
    assert [m is None for m in messages(spark, ["", "é", "éé", "ééé", None], rules.length("v", 1, 2))] == [False, True, True, False, False]
    assert messages(spark, ["x" * 9], rules.length("v")) == [None]


def test_outside_domain_keeps_nulls(spark):
    rows = spark.createDataFrame([("a",), ("B",), ("c",), (None,)], "v string")
    allowed = spark.createDataFrame([("A",), ("b",), ("b",)], "d string")
    assert {r.v for r in rules.outside_domain(rows, "v", allowed).collect()} == {"c", None}


def test_many_rules_one_scan(spark):
    rows = spark.range(10).select("id", F.when(F.col("id") % 2 == 0, "x").alias("v"))
    checks = [rules.required("v"), rules.length("v", 2)]
    long = rules.validate(rows, checks, "id")
    assert long.columns == ["row_key", "column", "rule", "ok", "message"] and long.count() == 20
    assert rules.validate(rows, checks, "id", failures_only=True).count() == 15
    summary = {r.rule: (r.total, r.passed, r.failed) for r in rules.validation_summary(rows, checks).collect()}
    assert summary == {"required": (10, 5, 5), "length": (10, 0, 10)}


def test_profile(spark):
    rows = spark.createDataFrame([(1, None, 1.0), (2, "x", float("nan")), (3, None, None)], "a int, b string, `c.d` double")
    got = {r.column: (r.rows, r.columns, r.nulls, float(r.pct)) for r in rules.profile_nulls(rows).collect()}
    assert got == {"b": (3, 3, 2, 66.7), "c.d": (3, 3, 2, 66.7)}
    assert rules.profile_nulls(rows.limit(0)).collect() == []
    assert rules.profile_nulls(rows, only_with_nulls=False).count() == 3
