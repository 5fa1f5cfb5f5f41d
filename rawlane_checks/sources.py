"""The manifest over table rows taken as files, and delimited reading over files written from tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawlane.functions.text import NULL_TOKENS, null_tokens_sql
from rawlane.session import work_path
from rawlane.sources.delimited import read_delimited, with_record_numbers
from rawlane.sources.manifest import build_manifest, describe_content, route_files
from rawlane.sources.manifest import skip_seen_files as skip_seen
from rawlane.specs import USUARIOS
from rawlane_checks.registry import Tables, check


ROWS_PER_FILE = 2500


@check(
    """SELECT * FROM (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'faturamento' WHEN 1 THEN 'base_oficial'
         WHEN 2 THEN 'usuarios' WHEN 5 THEN 'usuarios' END AS dataset FROM documents) WHERE dataset IS NOT NULL""",
    name="route_files",
)
def routed(t: Tables) -> DataFrame:
    names = ["X_Faturamento_{}.csv", "usuarios_BASE_OFICIAL_{}.csv", "usuarios{}.csv", "outro_{}.csv", "faturamento_{}.txt", "a.usuarios.{}.csv"]
    name = F.lit(None).cast("string")
    for i, pattern in enumerate(names):
        head, tail = pattern.split("{}")
        shown = F.concat(F.lit(head), F.col("doc_id").cast("string"), F.lit(tail))
        name = F.when(F.col("doc_id") % len(names) == i, shown).otherwise(name)
    return route_files(t.documents.select("doc_id", name.alias("file_name"))).select("doc_id", "dataset")


def document_files(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.col("text").cast("binary").alias("content"))


@check("SELECT doc_id, md5(text) AS file_hash FROM documents")
def file_fingerprint(t: Tables) -> DataFrame:
    return describe_content(document_files(t)).select("doc_id", F.col("md5").alias("file_hash"))


@check(
    """SELECT doc_id, CASE WHEN contains(line, ';') THEN ';' WHEN contains(line, ',') THEN ','
         WHEN contains(line, chr(9)) THEN chr(9) ELSE ',' END AS sep
       FROM (SELECT doc_id, split_part(split_part(text, chr(10), 1), chr(13), 1) AS line FROM documents)"""
)
def detect_separator(t: Tables) -> DataFrame:
    return describe_content(document_files(t)).select("doc_id", "sep")


@check("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'ISO-8859-1' ELSE 'UTF-8' END AS encoding FROM documents")
def detect_encoding(t: Tables) -> DataFrame:
    """Every third text ends in a byte that is not UTF-8; a text is judged by all of its bytes."""
    stray = F.when(F.col("doc_id") % 3 == 0, F.unhex(F.lit("E7"))).otherwise(F.unhex(F.lit("")))
    files = document_files(t).withColumn("content", F.concat("content", stray))
    return describe_content(files).select("doc_id", "encoding")


@check(
    """SELECT min(doc_id) AS doc_id, md5(text) AS file_hash FROM documents
       WHERE md5(text) NOT IN (SELECT md5(text) FROM documents WHERE doc_id % 10 = 0) GROUP BY md5(text)"""
)
def skip_seen_files(t: Tables) -> DataFrame:
    """Every tenth document was loaded before; of equal documents the first counts."""
    manifest = describe_content(document_files(t)).withColumn("file_hash", F.col("md5")).withColumn("path", F.lpad(F.col("doc_id").cast("string"), 12, "0"))
    earlier = manifest.filter(F.col("doc_id") % 10 == 0)
    failed = manifest.filter(F.col("doc_id") % 10 == 1).select("file_hash", F.lit("erro").alias("status"))
    history = earlier.select("file_hash", F.lit("sucesso").alias("status")).union(failed)
    return skip_seen(manifest, history).select("doc_id", "file_hash")


@check(
    f"""SELECT CAST(2 AS BIGINT) AS arquivos, CAST(4 AS BIGINT) AS leituras, CAST(sum(length(o_orderkey || ';' || o_orderpriority) + 1) AS BIGINT) AS tamanho,
          lote FROM (SELECT *, o_orderkey // {ROWS_PER_FILE} AS lote FROM orders) GROUP BY lote"""
)
def file_fingerprint_in_splits(t: Tables) -> DataFrame:
    """Every file comes twice and is described twice, whole and from its lines: all four have one fingerprint."""
    key, lotes = F.col("o_orderkey"), lotes_in(t)
    value = F.concat_ws(";", key.cast("string"), "o_orderpriority")
    rows = t.orders.select(F.explode(F.array(lote_of(key), lote_of(key) + lotes)).alias("lote"), key.alias("place"), value.alias("value"))
    path = work_path(t.spark, "twice")
    write_lines(rows, 2 * lotes, path, "usuarios")
    described = [build_manifest(t.spark, path, limit) for limit in (64 * 1024 * 1024, 1024)]
    lote = F.regexp_extract("file_name", "-0*([0-9]+)-", 1).cast("long") % lotes
    both = described[0].unionByName(described[1]).withColumn("lote", lote)
    found = both.groupBy("file_hash", "lote").agg(F.count_distinct("uri").alias("arquivos"), F.count(F.lit(1)).alias("leituras"), F.max("length").alias("tamanho"))
    return found.select("arquivos", "leituras", "tamanho", "lote")


_TOKEN_CASES = " ".join(f"WHEN {i} THEN NULL" for i in range(len(NULL_TOKENS)))


@check(
    f"""SELECT o_orderkey, CASE o_orderkey % {len(NULL_TOKENS) + 3} {_TOKEN_CASES}
          WHEN {len(NULL_TOKENS)} THEN ' NA' WHEN {len(NULL_TOKENS) + 1} THEN 'na' ELSE o_orderpriority END AS cell
        FROM orders""",
    name="null_tokens",
)
def tokens(t: Tables) -> DataFrame:
    texts = [*NULL_TOKENS, " NA", "na"]
    cell = F.col("o_orderpriority")
    for i, text in enumerate(texts):
        cell = F.when(F.col("o_orderkey") % (len(texts) + 1) == i, text).otherwise(cell)
    return t.orders.select("o_orderkey", cell.alias("cell")).selectExpr("o_orderkey", f"{null_tokens_sql('cell')} AS cell")


# --- ragged files ---------------------------------------------------------------------------------------------------

def one_file_each(rows: DataFrame, lotes: int, number: str = "lote") -> DataFrame:
    """One task, and so one file, per ``lote`` (0, 1, ...), or another ``number``."""
    return rows.repartitionById(lotes, F.col(number).cast("int"))


def lote_of(key: Column) -> Column:
    return F.floor(key / ROWS_PER_FILE)


def lotes_in(t: Tables) -> int:
    return t.orders.agg(F.max(lote_of(F.col("o_orderkey")))).first()[0] + 1


def write_lines(rows: DataFrame, lotes: int, path: str, name: str) -> None:
    """Write ``value`` lines to one file per ``lote``, in ``place`` order, exactly as they are."""
    lines = rows.select("lote", "place", F.posexplode(F.split("value", "\n")).alias("part", "value"))
    placed = one_file_each(lines, lotes).sortWithinPartitions("place", "part").select("value")
    (
        placed.write.option("mapreduce.output.basename", name)
        .option("sep", "\u0001")
        .option("quote", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .csv(path)
    )


def ragged_folder(t: Tables, least_files: int = 0) -> str:
    """Orders as team files with odd records by key: too long, too short, blank lines, hidden separators, line ends.

    The first ``least_files`` files are there even if no order falls into them, with a header only."""
    key = F.col("o_orderkey")
    text = key.cast("string")
    tail = F.lit(";x" * (len(USUARIOS.header) - 3))
    usual = F.concat(text, F.lit(";"), F.col("o_orderpriority"), F.lit(";c"), tail)
    value = (
        F.when(key % 53 == 0, F.concat(usual, F.lit(";")))
        .when(key % 47 == 0, F.concat(usual, F.lit(";mais;ainda")))
        .when(key % 43 == 0, F.concat(text, F.lit(";curta")))
        .when(key % 41 == 0, F.lit("   "))
        .when(key % 37 == 0, F.concat(text, F.lit(';"a;""b"""'), F.lit(";c"), tail))
        .when(key % 31 == 0, F.concat(text, F.lit(';"a\nb"'), F.lit(";c"), tail))
        .otherwise(usual)
    )
    rows = t.orders.select(lote_of(key).alias("lote"), key.alias("place"), value.alias("value"))
    lotes = rows.select("lote").union(t.spark.range(least_files).select(F.col("id").alias("lote"))).distinct()
    heads = lotes.select("lote", F.lit(-1).alias("place"), F.lit(";".join(USUARIOS.header)).alias("value"))
    path = work_path(t.spark, "ragged")
    write_lines(rows.union(heads), max(lotes_in(t), least_files), path, "usuarios")
    return path


RAGGED_SQL = f"""ragged AS (
  SELECT *, row_number() OVER (PARTITION BY lote ORDER BY o_orderkey) + 1 AS numero_linha FROM (
    SELECT o_orderkey, o_orderkey // {ROWS_PER_FILE} AS lote, CAST(o_orderkey AS VARCHAR) AS cargo,
           CASE WHEN o_orderkey % 43 = 0 THEN 'curta' WHEN o_orderkey % 37 = 0 THEN 'a;"b"'
                WHEN o_orderkey % 31 = 0 THEN 'a' || chr(10) || 'b' ELSE o_orderpriority END AS status_vendedor,
           CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE 'c' END AS consultor,
           CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE 'x' END AS acesso_temporario
    FROM orders
    WHERE o_orderkey % 53 <> 0 AND o_orderkey % 47 <> 0 AND (o_orderkey % 43 = 0 OR o_orderkey % 41 <> 0)))"""


def ragged(t: Tables, whole_file_bytes: int) -> DataFrame:
    manifest = route_files(build_manifest(t.spark, ragged_folder(t), whole_file_bytes))
    return with_record_numbers(read_delimited(t.spark, manifest, USUARIOS))


READ = ["cargo", "status_vendedor", "consultor", "acesso_temporario", "numero_linha"]


@check(f"WITH {RAGGED_SQL} SELECT {', '.join(READ)} FROM ragged", name="read_delimited")
def read_whole(t: Tables) -> DataFrame:
    """Files small enough for one task each."""
    return ragged(t, 64 * 1024 * 1024).select(*READ)


@check(f"WITH {RAGGED_SQL} SELECT {', '.join(READ)} FROM ragged")
def read_delimited_in_splits(t: Tables) -> DataFrame:
    """The same files taken as too large for one task: records are put together from split lines."""
    return ragged(t, 1024).select(*READ)


@check(f"WITH {RAGGED_SQL} SELECT cargo, numero_linha FROM ragged")
def record_number(t: Tables) -> DataFrame:
    return ragged(t, 64 * 1024 * 1024).select("cargo", "numero_linha")


@check(
    f"""WITH {RAGGED_SQL} SELECT lote, count(*) AS linhas, CAST(1 AS BIGINT) AS arquivos, TRUE AS nome_ok
        FROM ragged GROUP BY lote"""
)
def source_lineage(t: Tables) -> DataFrame:
    rows = ragged(t, 64 * 1024 * 1024)
    lote = F.floor(F.col("cargo").cast("long") / ROWS_PER_FILE).alias("lote")
    named = F.col("source_filename").rlike(r"^usuarios-.*\.csv$")
    return rows.groupBy(lote).agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_distinct("source_filename").alias("arquivos"),
        F.bool_and(named).alias("nome_ok"),
    )
