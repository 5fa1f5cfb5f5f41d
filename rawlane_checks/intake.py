"""Whole intakes: billing files written from orders, taken in as a batch and as a stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rawlane.operators.audit import append_events, run_start_events
from rawlane.operators.load import stage_rows
from rawlane.operators.rejections import append_rejections
from rawlane.plans.ingest import Store, ingest
from rawlane.session import work_path
from rawlane.sources.storage import materialize
from rawlane.specs import FATURAMENTO, USUARIOS
from rawlane.streaming.intake import ingest_stream
from rawlane_checks.registry import Tables, check
from rawlane_checks.routing import ERROR_SQL, WARN_SQL
from rawlane_checks.sources import RAGGED_SQL, ROWS_PER_FILE, lote_of, one_file_each, ragged_folder
from rawlane_checks.views import DIRTY_SQL, dirty_faturamento

LOADED = ["numero_documento", "cnpj", "valor_da_conta", "data_fat", "empresa", "observacao"]
LOADED_SQL = f"""WITH {DIRTY_SQL} SELECT numero_documento, cnpj, valor AS valor_da_conta, data_fat, empresa,
    'observação' AS observacao FROM routed WHERE campo IS NULL"""


#: Files that one task writes, as far as that leaves every core two tasks. A task for each spent more on starting than on rows.
FILES_PER_TASK = 16


def planned_files(t: Tables) -> DataFrame:
    """One row per file: ``lote``, whether it is ``full``, and its ``place`` among such files of its format."""
    files = t.orders.groupBy(lote_of(F.col("o_orderkey")).alias("lote")).agg((F.count(F.lit(1)) == ROWS_PER_FILE).alias("full"))
    place = F.row_number().over(Window.partitionBy(F.col("lote") % 2, "full").orderBy("lote")) - 1
    return materialize(files.withColumn("place", place), work_path(t.spark, "files"))


def drop_folder(t: Tables) -> str:
    """Dirty billing files: semicolon and UTF-8 for even file numbers, comma and Latin-1 for odd ones."""
    path = work_path(t.spark, "drop")
    rows = dirty_faturamento(t).withColumns(
        {"lote": lote_of(F.col("o_orderkey")), "observacao": F.lit("observação")}
    )
    known = set(rows.columns)
    target = {FATURAMENTO.rename.get(c, c): c for c in FATURAMENTO.header}
    cells = [(F.col(n) if n in known else F.lit(None).cast("string")).alias(c) for n, c in target.items()]
    planned = planned_files(t)
    counts = planned.groupBy((F.col("lote") % 2).alias("odd"), "full").agg(F.count(F.lit(1)).alias("n")).collect()
    for odd, full, files in sorted(tuple(row) for row in counts):
        sep, encoding = (",", "ISO-8859-1") if odd else (";", "UTF-8")
        # Full files follow each other in a task and are cut by their number of rows; any other file has a task of its own.
        each = max(1, min(FILES_PER_TASK, files // (2 * t.spark.sparkContext.defaultParallelism))) if full else 1
        mine = planned.filter((F.col("lote") % 2 == odd) & (F.col("full") == full))
        (
            one_file_each(rows.join(mine.select(F.col("lote"), F.floor(F.col("place") / each).alias("task")), "lote"), -(-files // each), "task")
            .sortWithinPartitions("o_orderkey")
            .select(*cells)
            .write.mode("append")
            .option("header", True)
            .option("mapreduce.output.basename", "faturamento")
            # Tasks put their files in place, not the driver one after the other.
            .option("mapreduce.fileoutputcommitter.algorithm.version", 2)
            .option("maxRecordsPerFile", ROWS_PER_FILE if full else 0)
            .option("sep", sep)
            .option("encoding", encoding)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("emptyValue", "")
            .csv(path)
        )
    return path


def batch(t: Tables) -> Store:
    return ingest(t.spark, drop_folder(t), work_path(t.spark, "store"), user="teste")


@check(LOADED_SQL, money=["valor_da_conta"], dates=["data_fat"])
def ingest_loaded(t: Tables) -> DataFrame:
    return batch(t).read_table(t.spark, FATURAMENTO).select(*LOADED)


LOGGED = ["numero_linha", "campo_falha", "motivo_rejeicao", "valor_recebido", "severidade"]
# Within a file rows are numbered from 2 on in key order.
LOGGED_SQL = f"""WITH {DIRTY_SQL}, entries AS ({ERROR_SQL} UNION ALL {WARN_SQL})
  SELECT numero_linha % {ROWS_PER_FILE} + 2 AS numero_linha, campo_falha, motivo_rejeicao, valor_recebido, severidade
  FROM entries"""


@check(LOGGED_SQL)
def ingest_rejections(t: Tables) -> DataFrame:
    return batch(t).read_rejections(t.spark).select(*LOGGED)


@check(
    f"""WITH {DIRTY_SQL} SELECT 'ingest_faturamento' AS script_nome, 'faturamento' AS tabela_destino,
          'sucesso' AS status, count(*) AS linhas_processadas, count(*) FILTER (campo IS NULL) AS linhas_inseridas,
          CAST(0 AS BIGINT) AS linhas_atualizadas,
          count(*) FILTER (campo IS NOT NULL) + count(*) FILTER (missing <> '') AS linhas_erro,
          'teste' AS usuario_executante
        FROM routed GROUP BY o_orderkey // {ROWS_PER_FILE}"""
)
def ingest_history(t: Tables) -> DataFrame:
    return batch(t).read_history(t.spark).select(
        "script_nome",
        "tabela_destino",
        "status",
        "linhas_processadas",
        "linhas_inseridas",
        "linhas_atualizadas",
        "linhas_erro",
        "usuario_executante",
    )


@check(
    f"""SELECT CAST(2 AS BIGINT) AS entregas, count(DISTINCT o_orderkey // {ROWS_PER_FILE}) AS execucoes,
          (SELECT count(*) FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 79 <> 0 AND o_orderkey % 53 <> 0)
            AS linhas
        FROM orders"""
)
def ingest_twice(t: Tables) -> DataFrame:
    """A second run over the same folder adds no run and no row."""
    folder, out = drop_folder(t), work_path(t.spark, "store")
    ingest(t.spark, folder, out)
    store = ingest(t.spark, folder, out)
    runs = store.read_history(t.spark).agg(F.count(F.lit(1)).alias("execucoes"))
    rows = store.read_table(t.spark, FATURAMENTO).agg(F.count(F.lit(1)).alias("linhas"))
    return runs.crossJoin(rows).select(F.lit(2).cast("long").alias("entregas"), "execucoes", "linhas")


@check(LOADED_SQL, money=["valor_da_conta"], dates=["data_fat"])
def incremental_intake(t: Tables) -> DataFrame:
    out = work_path(t.spark, "store")
    store = ingest_stream(t.spark, drop_folder(t), out, work_path(t.spark, "progress"), max_files_per_trigger=1000)
    return store.read_table(t.spark, FATURAMENTO).select(*LOADED)


def spoil(spark: SparkSession, pattern: str) -> None:
    """Spoil the checksums that a local file system keeps beside the file: reading it then fails."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    (status,) = files.globStatus(target)
    out = files.getRawFileSystem().create(files.getChecksumFile(status.getPath()), True)
    out.write(bytes(b"crc\0\0\0\2\0" + b"\1\2\3\4" * (1 + status.getLen() // 512)))
    out.close()


@check(
    f"""WITH {RAGGED_SQL} SELECT 'sucesso' AS status, count(DISTINCT lote) AS arquivos, count(*) AS linhas FROM ragged WHERE lote <> 1
        UNION ALL SELECT 'erro', 1, 0"""
)
def isolated_failure(t: Tables) -> DataFrame:
    """One file cannot be read: its run fails, all others are loaded. (Needs a local file system, which has checksums.)"""
    folder = ragged_folder(t, least_files=2)  # file 1 is there, however few orders
    spoil(t.spark, f"{folder}/usuarios-00001-*.csv")
    store = ingest(t.spark, folder, work_path(t.spark, "store"))
    runs = store.read_history(t.spark).groupBy("status").agg(F.count(F.lit(1)).alias("arquivos"))
    rows = store.read_table(t.spark, USUARIOS).agg(F.count(F.lit(1)).alias("linhas"))
    loaded = rows.select(F.lit("sucesso").alias("status"), "linhas")
    return runs.join(loaded, "status", "left").select("status", "arquivos", F.coalesce("linhas", F.lit(0)).alias("linhas"))


@check(
    f"""WITH {DIRTY_SQL}, entries AS ({ERROR_SQL} UNION ALL {WARN_SQL})
        SELECT (SELECT count(*) FROM routed WHERE campo IS NULL) AS linhas, (SELECT count(*) FROM entries) AS entradas,
          (SELECT count(DISTINCT o_orderkey // {ROWS_PER_FILE}) FROM routed) AS sucesso, CAST(1 AS BIGINT) AS em_execucao"""
)
def retried_load(t: Tables) -> DataFrame:
    """A load is killed after its rows and log entries were written, then all is delivered once more: nothing counts twice."""
    folder, out = drop_folder(t), work_path(t.spark, "store")
    store = ingest(t.spark, folder, out)
    rows, log = store.read_table(t.spark, FATURAMENTO), store.read_rejections(t.spark)
    killed = rows.select("source_filename").limit(1).select(
        F.lit("morta").alias("run_id"), F.lit("ingest_faturamento").alias("script"), F.lit("faturamento").alias("table"), F.col("source_filename").alias("file_name"), F.lit("x").alias("file_hash")
    )
    append_events(run_start_events(killed), store.history)
    stage_rows(rows, store.table(FATURAMENTO), "morta")
    append_rejections(log.withColumn("execucao_fk", F.lit("morta")), store.rejections)
    store = ingest(t.spark, folder, out)
    linhas = store.read_table(t.spark, FATURAMENTO).agg(F.count(F.lit(1)).alias("n"))
    entradas = store.read_rejections(t.spark).agg(F.count(F.lit(1)).alias("n"))
    history = store.read_history(t.spark)
    counted = [linhas.select(F.lit("linhas").alias("o"), "n"), entradas.select(F.lit("entradas").alias("o"), "n"), history.groupBy(F.col("status").alias("o")).agg(F.count(F.lit(1)).alias("n"))]
    every = reduce(DataFrame.unionByName, counted)
    return every.agg(*[F.max(F.when(F.col("o") == name, F.col("n"))).alias(name) for name in ("linhas", "entradas", "sucesso", "em_execucao")])
