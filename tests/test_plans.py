"""What the physical plans may and may not contain."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rawlane import FATURAMENTO
from rawlane.operators.load import clustered_write, interleaved_write, key_splits
from rawlane.plans import analytics
from rawlane_checks import CHECKS
from rawlane_checks.registry import Tables
from rawlane_checks.views import base_oficial, faturamento, usuarios

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_no_python_and_no_cross_joins(spark, name):
    if name.startswith(("ingest", "incremental", "isolated", "retried", "read_delimited", "record_number", "source_lineage")):
        pytest.skip("runs a whole intake; its parts are covered elsewhere")
    text = plan(CHECKS[name].run(spark, FOLDER))
    for word in ("Python", "Cartesian", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    faturamento(Tables(spark, FOLDER)).write.parquet(str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    text = plan(analytics.monthly_billing(stored, "P"))
    assert "EqualTo(empresa,P)" in text and "IsNotNull(data_fat)" in text
    schema = text.split("ReadSchema: ")[1].split(">")[0]
    assert "vendedor" not in schema and "numero_documento" not in schema
    text = plan(analytics.top_customers(stored, "P", dt.date(1998, 1, 1)))
    assert "(data_fat" in text and ">= 1998-01-01)" in text.split("DataFilters: ")[1]
    assert "TakeOrderedAndProject" in text


def test_totals_are_ranked_without_sorting_invoices(spark):
    text = plan(analytics.top_customers(faturamento(Tables(spark, FOLDER)), "P", dt.date(1998, 1, 1)))
    ranking = text[text.index("TakeOrderedAndProject") :]
    assert "HashAggregate" in ranking and "SortAggregate" not in ranking


def test_invoices_are_summed_before_they_are_joined(spark, settings):
    t = Tables(spark, FOLDER)
    with settings(spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(
            analytics.billing_by_customer_seller(faturamento(t), base_oficial(t), usuarios(t), "F", dt.date(1998, 1, 1))
        )
    assert text.count("SortMergeJoin") >= 2 and "BroadcastHashJoin" not in text


def test_hot_customer_does_not_change_results(spark):
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "1").otherwise(F.col("id").cast("string")).alias("cnpj"),
        F.lit("Loja").alias("cliente_nome_fantasia"),
        F.concat(F.lit("V"), (F.col("id") % 5).cast("string")).alias("vendedor"),
        F.lit(1).cast("decimal(18,2)").alias("valor_da_conta"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 300).cast("int")).alias("data_fat"),
        F.lit("A").alias("empresa"),
    )
    top = analytics.top_customers(hot, "A", dt.date(2024, 1, 1), 1).first()
    assert (top.cnpj, top.qtd_notas, top.meses_ativos) == ("1", 6668, 10)
    assert top.responsaveis == "V0, V1, V2, V3, V4"


def test_clustered_write_spreads_a_hot_key(spark, tmp_path, settings):
    rows = spark.range(8000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    clustered_write(rows, str(tmp_path / "c"), ["k"], partitions=8)
    written = spark.read.parquet(str(tmp_path / "c"))
    assert written.count() == 8000
    per_file = written.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.min("k"), F.max("k")).collect()
    assert max(r.n for r in per_file) < 3 * 8000 / 8
    assert FATURAMENTO.cluster == ("empresa", "data_fat")


def test_run_state_hashes(spark):
    for name in ("run_state_update", "failed_runs", "run_history"):
        assert "SortAggregate" not in plan(CHECKS[name].run(spark, FOLDER))


def files_read(table, key, value):
    """Files whose statistics do not rule the value out, of all files."""
    per_file = table.groupBy(F.input_file_name().alias("f")).agg(F.min(key).alias("lo"), F.max(key).alias("hi")).collect()
    return sum(r.lo is not None and r.lo <= value <= r.hi for r in per_file), len(per_file)


def test_interleaved_write_lets_every_key_skip_files(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.format_string("Customer#%09d", F.pmod(F.xxhash64("id"), F.lit(3000))).alias("cnpj"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1500)).cast("int")).alias("data_fat"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("z"),
        F.when(F.col("id") % 11 > 0, "x").alias("spread"),
    )
    path = str(tmp_path / "i")
    interleaved_write(rows, path, ["cnpj", "data_fat"], partitions=32)
    table = spark.read.parquet(path)
    assert table.columns == rows.columns and sorted(table.collect(), key=str) == sorted(rows.collect(), key=str)
    for key, value in (("cnpj", "Customer#000001234"), ("data_fat", dt.date(2022, 3, 4))):
        read, files = files_read(table, key, value)
        assert files >= 30 and 1 <= read < files / 3
    assert files_read(table, "z", 7)[0] > files_read(table, "cnpj", "Customer#000000001")[0]


def test_interleaved_write_of_hot_null_and_no_rows(spark, tmp_path):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), F.col("id").alias("v"))
    interleaved_write(rows, str(tmp_path / "h"), ["k", "v"], partitions=8)
    table = spark.read.parquet(str(tmp_path / "h"))
    per_file = [r["count"] for r in table.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == 9000 and max(per_file) < 3 * 9000 / 8 and table.where("k IS NULL").count() == 3000
    interleaved_write(rows.limit(0), str(tmp_path / "n"), ["k"])
    assert spark.read.schema(rows.schema).parquet(str(tmp_path / "n")).count() == 0
    interleaved_write(rows.select(F.lit(None).cast("string").alias("k")), str(tmp_path / "o"), ["k"])
    assert spark.read.parquet(str(tmp_path / "o")).count() == 9000
    with pytest.raises(ValueError):
        interleaved_write(rows, str(tmp_path / "x"), [])


def test_splits_cut_different_values_evenly(spark):
    rows = spark.range(50_000).select(F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"))
    splits = key_splits(rows, "k", 8)
    counts = [rows.where((F.col("k") >= lo) & (F.col("k") < hi)).select("k").distinct().count() for lo, hi in zip([-2, *splits], [*splits, 1 << 40], strict=True)]
    assert len(splits) == 7 and max(counts) < 1.3 * 25_000 / 8
