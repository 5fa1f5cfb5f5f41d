"""Intake of a drop folder: manifest, checks, staging, load, rejection log, run history.

Driver loops run over batches of files and over datasets, never over rows or single files. Per batch the driver holds
one small record per file; the batch size bounds that, and bounds everything that is broadcast.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rawlane.functions.text import uuid_from
from rawlane.operators.audit import (
    FAILURE,
    SUCCESS,
    append_events,
    commit_events,
    committed_loads,
    read_events,
    run_end_events,
    run_start_events,
    run_state,
    uncommitted_runs,
)
from rawlane.operators.load import current_rows, stage_rows, table_schema
from rawlane.operators.rejections import append_rejections
from rawlane.operators.routing import clean_table, rejections, run_metrics, valid_rows
from rawlane.operators.schema import header_contract
from rawlane.session import methods_that_compile, work_path
from rawlane.sources.delimited import LINEAGE, read_delimited, record_offsets, with_record_numbers
from rawlane.sources.manifest import WHOLE_FILE_BYTES, build_manifest, route_files, skip_seen_files
from rawlane.sources.storage import drop_work, exists, isolate, literal_path, materialize
from rawlane.specs import DEFAULT_SPECS, REJECTION_SCHEMA, RUN_EVENT_SCHEMA, DatasetSpec

log = logging.getLogger(__name__)

FILES_PER_BATCH = 10_000

#: Message of a run whose file ends inside a quoted field.
UNCLOSED = "Arquivo ilegível: termina dentro de um campo entre aspas"

# What the driver holds of each file of a batch.
FILE_FACTS = ("dataset", "path", "uri", "sep", "encoding", "layout", "header", "superseded")


@dataclass(frozen=True)
class Store:
    """Where the tables live."""

    root: str

    def table(self, spec: DatasetSpec) -> str:
        return f"{self.root}/bronze/{spec.table}"

    @property
    def rejections(self) -> str:
        return f"{self.root}/auditoria/log_rejeicao"

    @property
    def history(self) -> str:
        return f"{self.root}/auditoria/historico_execucao"

    def read_table(self, spark: SparkSession, spec: DatasetSpec) -> DataFrame:
        """The current rows: of every file those of its latest run that ended well."""
        committed = committed_loads(read_events(spark, self.history), spec.table)
        return current_rows(spark, self.table(spec), table_schema(spec), committed)

    def read_rejections(self, spark: SparkSession) -> DataFrame:
        """Log entries of the runs that ended well; a run that was killed or failed has left none."""
        if not exists(spark, self.rejections):
            return spark.createDataFrame([], REJECTION_SCHEMA)
        logged = spark.read.schema(REJECTION_SCHEMA).parquet(self.rejections)
        out = uncommitted_runs(read_events(spark, self.history)).withColumnRenamed("id", "execucao_fk")
        return logged.join(out, "execucao_fk", "left_anti").select(*REJECTION_SCHEMA.fieldNames())

    def read_history(self, spark: SparkSession) -> DataFrame:
        """Run state: one row per run."""
        return run_state(read_events(spark, self.history))


def _with_script(files: DataFrame, specs: Sequence[DatasetSpec]) -> DataFrame:
    """Add ``script`` and ``table`` by ``dataset``."""
    script, table = F.lit(None).cast("string"), F.lit(None).cast("string")
    for spec in specs:
        script = F.when(F.col("dataset") == spec.name, F.lit(spec.script)).otherwise(script)
        table = F.when(F.col("dataset") == spec.name, F.lit(spec.table)).otherwise(table)
    return files.withColumns({"script": script, "table": table})


def plan_files(manifest: DataFrame, specs: Sequence[DatasetSpec], history: DataFrame, run: str) -> DataFrame:
    """Decide per routed file: header verdict and run id; leave out unreadable and already loaded files.

    ``superseded`` marks a file that another file of the same name, later in path order, replaces in this delivery.
    """
    checked = header_contract(manifest.filter(F.col("header").isNotNull()), specs)
    # A file that ends inside quotes can't be told apart into records: nothing of it is read or replaced.
    cut_short = F.when(F.col("unclosed"), F.lit(UNCLOSED))
    checked = checked.withColumns({"ok": F.col("ok") & ~F.col("unclosed"), "message": F.coalesce("message", cut_short)})
    checked = skip_seen_files(checked, history)
    last = checked.filter("ok").groupBy("dataset", "file_name").agg(F.max("path").alias("_last"))
    named = _with_script(checked.join(last, ["dataset", "file_name"], "left"), specs)
    return named.select(
        *[c for c in checked.columns if c not in ("expected", "missing", "extra", "unclosed")],
        "script",
        "table",
        uuid_from(F.lit(run), F.col("uri")).alias("run_id"),
        F.coalesce(F.col("path") < F.col("_last"), F.lit(False)).alias("superseded"),
    )


def stage(spark: SparkSession, files: Sequence[Row], spec: DatasetSpec, run: str) -> DataFrame:
    """Read and clean one batch of one dataset. Lazy; one pass over the input.

    Only flagged rows carry their ``run_id``: hashing it for every row took a fifth of staging. Rows are counted by ``uri``.
    """
    rows = read_delimited(spark, files, spec)
    run_id = F.when(F.col("registro").isNotNull(), uuid_from(F.lit(run), F.col("uri")))
    return clean_table(rows, spec, keep=LINEAGE).withColumn("run_id", run_id)


def _load_batch(spark: SparkSession, files: DataFrame, listed: Sequence[Row], spec: DatasetSpec, store: Store, run: str, work: str) -> list[str]:
    """Stage one batch of one dataset, then load, log and commit its runs. ``listed`` are the collected ``files``.

    Staged rows are written once: the source text is parsed a single time, the load starts only when it is through, and
    lost executors do not repeat the parsing. A file that cannot be read is found by halving the batch; the others are
    loaded. Rows and log entries are nobody's until the end events of their runs are there, which come as one file at the
    end, so whatever fails or is killed before leaves the earlier rows in force and no log entries.
    Returns the ``uri`` of the files that failed.
    """
    parts, folders = [], iter(range(2 * len(listed)))

    def read(some: list[Row]) -> DataFrame:
        # Typing some thirty columns makes one method far above what the JVM compiles.
        with methods_that_compile(spark):
            return materialize(stage(spark, some, spec, run), f"{work}/staged-{next(folders)}")

    parts, unreadable = isolate(list(listed), read)
    if unreadable:
        for row, error in unreadable:
            log.error("%s could not be read: %s", row.path, error)
        told = spark.createDataFrame([(row.uri, str(error)) for row, error in unreadable], "uri string, _message string")
        append_events(run_end_events(files.join(told, "uri"), FAILURE, F.col("_message")), store.history)
        files = files.join(told.select("uri"), "uri", "left_anti")
    failed = [row.uri for row, _ in unreadable]
    if not parts:
        return failed
    load, metrics = uuid.uuid4().hex, None
    try:
        staged = reduce(DataFrame.unionByName, parts)
        metrics = files.join(run_metrics(staged, ["uri"]), "uri", "left")
        offsets = materialize(record_offsets(staged), f"{work}/offsets")
        # Superseded files are read for their counters and log entries only.
        current = staged
        if any(row.superseded for row in listed):
            current = staged.join(files.filter("superseded").select("uri"), "uri", "left_anti")
        stage_rows(valid_rows(current, spec), store.table(spec), load, spec.cluster)
        # Only flagged rows have a snapshot; asking for that lets the scan skip row groups without any.
        flagged = staged.filter(F.col("registro").isNotNull())
        append_rejections(rejections(with_record_numbers(flagged, offsets), spec), store.rejections)
        commit_events(run_end_events(metrics.withColumn("carga", F.when(~F.col("superseded"), F.lit(load))), SUCCESS), store.history)
    except Exception as error:  # noqa: BLE001 - whatever went wrong is recorded; other batches go on
        log.exception("load of dataset %s failed", spec.name)
        # Rows were read, none came into force and no log entry did.
        known = (files if metrics is None else metrics).withColumns({c: F.lit(0) for c in ("linhas_inseridas", "linhas_erro")})
        append_events(run_end_events(known, FAILURE, F.lit(str(error))), store.history)
        drop_work(spark, f"{store.table(spec)}/linhas/carga={load}")
        failed = [row.uri for row in listed]
    return failed


def _described(spark: SparkSession, paths: str | Sequence[str], whole_file_bytes: int, specs: Sequence[DatasetSpec], work: str) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    """The routed manifest (None if nothing could be read), written once, and what could not be read: path and message.

    The plan looks at the manifest several times, the input must be hashed a single time. Only if that fails all is described
    once more, without the files that cannot be read whole; those that are missing then are read again by themselves, halved
    in lists of bounded length. So one bad file of many costs one more pass, and a passing fault of a disk costs no file.
    """
    folders = iter(range(1 << 62))

    def describe(some: str | Sequence[str], skip_unreadable: bool = False) -> DataFrame:
        folder = f"{work}/manifest-{next(folders)}"
        return materialize(build_manifest(spark, some, whole_file_bytes, f"{folder}-work", skip_unreadable), folder)

    try:
        return route_files(describe(paths), specs), []
    except AnalysisException:
        raise  # no such path: nothing that a single file does
    except Exception as error:  # noqa: BLE001 - a file that cannot be read shows as any error
        log.warning("a file cannot be read, looking for it: %s", error)
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(paths if isinstance(paths, str) else list(paths))
    found, parts, unreadable = found.select("path", F.col("_metadata.file_path").alias("uri")), [], []
    try:
        parts.append(describe(paths, True))
        found = found.join(parts[0].select("uri"), "uri", "left_anti")
    except Exception as error:  # noqa: BLE001 - one that is too large to be read whole
        log.warning("a large file cannot be read, looking for it: %s", error)
    found = materialize(found.select("path"), f"{work}/missing")
    lists = -(-found.count() // FILES_PER_BATCH)
    found = materialize(found.withColumn("list", F.pmod(F.xxhash64("path"), F.lit(max(lists, 1))).cast("int")), f"{work}/paths", "list")
    for number in range(lists):
        some = [literal_path(row.path) for row in found.where(F.col("list") == number).collect()]
        done, bad = isolate(some, describe) if some else ([], [])
        parts += done
        unreadable += [(path, str(error)) for path, error in bad]
    return route_files(reduce(DataFrame.unionByName, parts), specs) if parts else None, unreadable


def _note_unreadable(spark: SparkSession, unreadable: list[tuple[str, str]], specs: Sequence[DatasetSpec], store: Store, run: str, user: str | None) -> None:
    """A failed run, without a fingerprint, for every routed file of which not even the manifest could be read."""
    files = spark.createDataFrame(unreadable, "path string, message string").withColumn("file_name", F.substring_index("path", "/", -1))
    files = _with_script(route_files(files, specs), specs).withColumns({"run_id": uuid_from(F.lit(run), F.col("path")), "file_hash": F.lit(None).cast("string")})
    append_events(run_start_events(files, user).unionByName(run_end_events(files, FAILURE, F.col("message"))), store.history)


def ingest(
    spark: SparkSession,
    paths: str | Sequence[str],
    out: str,
    specs: Sequence[DatasetSpec] = DEFAULT_SPECS,
    *,
    user: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> Store:
    """Take in every ``*.csv`` file below ``paths`` that a dataset claims and that was not loaded before.

    A file with a wrong header, or that cannot be read, ends with status ``erro`` and may be delivered again; other files
    go on. If writing the rows of a batch fails, its files end so. Running twice over the same folder changes nothing the
    second time.
    """
    take_in(spark, paths, out, specs, user=user, files_per_batch=files_per_batch, whole_file_bytes=whole_file_bytes)
    return Store(out)


def take_in(
    spark: SparkSession,
    paths: str | Sequence[str],
    out: str,
    specs: Sequence[DatasetSpec] = DEFAULT_SPECS,
    *,
    user: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    whole_file_bytes: int = WHOLE_FILE_BYTES,
) -> list[str]:
    """``ingest``, returning the paths of the files that may load when they are tried again: those that could not be read or
    written, but not those that were refused for what they hold."""
    store, run, failed = Store(out), uuid.uuid4().hex, []
    work = work_path(spark, "ingest")
    try:
        manifest, unreadable = _described(spark, paths, whole_file_bytes, specs, work)
        if unreadable:
            _note_unreadable(spark, unreadable, specs, store, run, user)
            failed += [path for path, _ in unreadable]
        if manifest is None:
            return failed
        plan = materialize(plan_files(manifest, specs, store.read_history(spark), run), f"{work}/plan")
        batches = max(-(-plan.count() // files_per_batch), 1)
        # Files of one name come into one batch: a superseded file never counts as loaded when the last one fails.
        plan = plan.withColumn("batch", F.pmod(F.xxhash64("dataset", "file_name"), F.lit(batches)))
        if batches > 1:
            # One folder per batch, so that a batch does not read the plan of all others.
            plan = materialize(plan.repartition("batch"), f"{work}/batches", "batch")
        for batch in range(batches):
            files = plan.filter(F.col("batch") == batch)
            refused = run_end_events(files.filter(~F.col("ok")).drop("table", "file_name"), FAILURE, F.col("message"))
            append_events(run_start_events(files, user).unionByName(refused), store.history)
            listed = files.filter("ok").select(*FILE_FACTS).collect()
            for spec in specs:
                mine = [row for row in listed if row.dataset == spec.name]
                if not mine:
                    continue
                accepted = files.filter(F.col("ok") & (F.col("dataset") == spec.name))
                folder = f"{work}/{spec.name}-{batch}"
                try:
                    failed += [unquote(uri) for uri in _load_batch(spark, accepted, mine, spec, store, run, folder)]
                finally:
                    drop_work(spark, folder)
    finally:
        drop_work(spark, work)
    return failed
