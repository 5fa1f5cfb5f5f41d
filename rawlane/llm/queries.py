"""The operators of this package as named queries over the sample tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawlane.llm import bytepair, counts, decontaminate, infill, interactions, packing, pii, quality, secrets, setjoin, tokenfiles, urlfilter, warc
from rawlane.session import work_path

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_shared", "n_item")


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "warc")
    warc.write_warc(_table(spark, folder, "pages"), path)
    parsed = work_path(spark, "warc-records")
    warc.read_warc(spark, path, with_payload=False).write.parquet(parsed)
    captures = warc.assemble_transactions(spark.read.schema(warc.RECORD).parquet(parsed))
    page = F.try_element_at("metadata.fields", F.lit("key")).cast("long")
    captures = warc.revisited(captures, page)
    return captures.select(
        page.alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("revisits").alias("refers_to"),
        F.col("target_uri").alias("url"),
        F.col("request.start_line").alias("request"),
    )


def op3_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return setjoin.similar_sets(_table(spark, folder, "documents"), width=4, percent=85).select("doc_id", "n_shingles", "component_id")


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.spelled_spans(pii.personal_spans(_table(spark, folder, "documents")))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(_table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE), end_id=1, length=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.quality_rules(_table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "token-files")
    tokenfiles.write_token_files(_table(spark, folder, "documents"), path, public_tokenizers.path(WORD_BPE), end_id=2)
    return tokenfiles.with_crc32(tokenfiles.read_tokens(spark, path))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.token_counts(_table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE), limit=2048)


def _dated(pages: DataFrame) -> DataFrame:
    """The pages with a fetch day. The table has none, so a day of two years is dealt out by page number."""
    return pages.select("page_id", "url", F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(F.col("page_id") * 37, F.lit(730)).cast("int")).alias("fetch_date"))


def _listed(pages: DataFrame) -> DataFrame:
    """Dated list entries about the pages' own hosts, parent domains and addresses; days come from digests of the names."""

    def digits(name: str, at: int) -> Column:
        return F.conv(F.substring(F.md5(name), at, 4), 16, 10).cast("int")

    def entry(kind: str, name: str, listed: str, action: str, day: Column) -> Column:
        return F.struct(F.lit(listed).alias("list_name"), F.lit(kind).alias("kind"), F.col(name).alias("pattern"), F.lit(action).alias("action"), day.alias("effective"))

    start = F.lit("2023-01-01").cast("date")
    hosts = pages.select(urlfilter.url_host(F.col("url")).alias("host")).where("host IS NOT NULL").distinct()
    added = F.date_add(start, digits("host", 1) % 500)
    removed = F.date_add(added, 30 + digits("host", 5) % 90)
    by_host = hosts.select(
        F.explode(F.array(entry("host", "host", "malware", "add", added), entry("host", "host", "malware", "remove", removed), entry("host", "host", "malware", "add", F.date_add(removed, 60)))).alias("e")
    )
    domains = hosts.select(F.substring_index("host", ".", -3).alias("domain")).distinct()
    by_domain = domains.select(entry("domain", "domain", "adult", "add", F.date_add(start, digits("domain", 9) % 1400)).alias("e"))
    urls = _dated(pages).select(urlfilter.url_key(F.col("url")).alias("url_key"), "fetch_date").where("url_key IS NOT NULL")
    taken = F.date_add(F.col("fetch_date"), digits("url_key", 1) % 21 - 10)
    by_url = urls.select(F.explode(F.array(entry("url", "url_key", "takedown", "add", taken), entry("url", "url_key", "takedown", "remove", F.date_add(taken, 5)))).alias("e"))
    return by_host.union(by_domain).union(by_url).select("e.*")


def op9_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return urlfilter.judge_captures(_dated(pages), _listed(pages))


OP9_SQL = r"""
WITH captures AS (
  SELECT page_id, url, DATE '2023-01-01' + ((page_id * 37) % 730)::INT AS fetch_date,
    nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '\.$', ''), '') AS host,
    regexp_replace(regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?[^/?#]*', ''), '#.*$', ''), '/+$', '') AS rest
  FROM pages
), hosts AS (
  SELECT host, md5(host) AS m, DATE '2023-01-01' + ('0x' || substr(md5(host), 1, 4))::INT % 500 AS added FROM (SELECT DISTINCT host FROM captures WHERE host IS NOT NULL)
), domains AS (
  SELECT DISTINCT array_to_string(string_split(host, '.')[greatest(len(string_split(host, '.')) - 2, 1):], '.') AS domain FROM hosts
), entries AS (
  SELECT 'malware' AS list_name, 'host' AS kind, host AS pattern, true AS active, added AS day FROM hosts
  UNION ALL SELECT 'malware', 'host', host, false, added + 30 + ('0x' || substr(m, 5, 4))::INT % 90 FROM hosts
  UNION ALL SELECT 'malware', 'host', host, true, added + 90 + ('0x' || substr(m, 5, 4))::INT % 90 FROM hosts
  UNION ALL SELECT 'adult', 'domain', domain, true, DATE '2023-01-01' + ('0x' || substr(md5(domain), 9, 4))::INT % 1400 FROM domains
  UNION ALL SELECT 'takedown', 'url', host || rest, true, fetch_date + ('0x' || substr(md5(host || rest), 1, 4))::INT % 21 - 10 FROM captures WHERE host IS NOT NULL
  UNION ALL SELECT 'takedown', 'url', host || rest, false, fetch_date + ('0x' || substr(md5(host || rest), 1, 4))::INT % 21 - 5 FROM captures WHERE host IS NOT NULL
), days AS (
  SELECT list_name, kind, pattern, day, bool_or(active) AS active FROM entries GROUP BY ALL
), asked AS (
  SELECT DISTINCT host, fetch_date, 'host' AS kind, host AS pattern FROM captures
  UNION SELECT DISTINCT host, fetch_date, 'domain', array_to_string(string_split(host, '.')[i:], '.')
    FROM (SELECT DISTINCT host, fetch_date, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM captures)
  UNION SELECT DISTINCT host || rest, fetch_date, 'url', host || rest FROM captures
), lists AS (
  SELECT DISTINCT list_name, kind, pattern FROM days
), state AS (
  SELECT a.host AS key, a.fetch_date, a.kind, a.pattern, a.list_name, d.active
  FROM (SELECT * FROM asked JOIN lists USING (kind, pattern)) a
  ASOF JOIN days d ON a.list_name = d.list_name AND a.kind = d.kind AND a.pattern = d.pattern AND a.fetch_date >= d.day
), found AS (
  SELECT key, fetch_date, kind = 'url' AS whole, list_name || ':' || kind || ':' || pattern AS name FROM state WHERE active
), named AS (
  SELECT key, fetch_date, whole, list(DISTINCT name) AS names FROM found GROUP BY ALL
)
SELECT page_id, url, c.fetch_date, coalesce(array_to_string(list_sort(list_concat(coalesce(h.names, []), coalesce(u.names, []))), ','), '') AS matches,
  h.names IS NOT NULL OR u.names IS NOT NULL AS blocked
FROM captures c
LEFT JOIN named h ON h.key = c.host AND h.fetch_date = c.fetch_date AND NOT h.whole
LEFT JOIN named u ON u.key = c.host || c.rest AND u.fetch_date = c.fetch_date AND u.whole
"""

def op10_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.spelled_spans(secrets.secret_spans(_table(spark, folder, "documents")), secrets.KINDS)



def op11_infill(spark: SparkSession, folder: str) -> DataFrame:
    cut = infill.fill_in_middle(_table(spark, folder, "documents"))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return interactions.filter_audit(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_BPE)
    there_and_back = bytepair.decode(bytepair.encode(_table(spark, folder, "documents"), path), path)
    return there_and_back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontamination, op2_warc, op3_ngram_jaccard_join, op4_personal_data, op5_packing, op6_quality_rules, op7_token_files, op8_token_counts, op9_url_filters, op10_secret_scans, op11_infill, op12_filter_audit, op13_byte_bpe)
}
ORACLE_SQL: dict[str, str] = {"op1_decontamination": decontaminate.SQL, "op6_quality_rules": quality.SQL, "op9_url_filters": OP9_SQL, "op11_infill": infill.SQL, "op12_filter_audit": interactions.SQL}
