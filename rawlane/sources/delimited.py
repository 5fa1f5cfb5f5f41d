"""Reading delimited text as conformed rows of strings, with file lineage and record numbers."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from rawlane.functions.text import null_tokens_sql, percent_decoded
from rawlane.operators.schema import conform_cells, first_positions
from rawlane.session import few_listing_tasks
from rawlane.sources.manifest import ASSEMBLED, BLANKS, LATIN1, prefix_before, read_lines
from rawlane.sources.quoting import bare_text, number_records, pieces, record_cells
from rawlane.sources.storage import literal_path
from rawlane.specs import DatasetSpec

LINEAGE = ("uri", "source_filename", "block", "pos")


def _cell_names(count: int) -> list[str]:
    return [f"_c{i}" for i in range(count)]


def separators_outside_quotes(line: Column, sep: str) -> Column:
    """How many separators of a record are not inside a quoted field."""
    bare = bare_text(line, sep)
    return F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))


def keep_record(line: Column, sep: str, columns: int) -> Column:
    """False for records with more fields than the header and for blank lines; short records stay."""
    blank = F.btrim(line, F.lit(BLANKS)) == ""
    if sep == "\t":
        blank = blank & ~line.contains("\t")
    return ~blank & (separators_outside_quotes(line, sep) < columns)


def _read_split_records(spark: SparkSession, paths: list[str], sep: str, encoding: str, columns: int) -> DataFrame:
    """Records of files in which quotes hide line ends: put together from the pieces of split lines, then parsed."""
    lines = read_lines(spark, [literal_path(p) for p in paths]).withColumnRenamed("file_name", "source_filename")
    if encoding == LATIN1:
        lines = lines.withColumn("value", F.decode(F.col("value").cast("binary"), LATIN1))
    lines = lines.select(
        "uri",
        "source_filename",
        "block",
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )
    numbered = number_records(pieces(lines), sep)
    parts = F.sort_array(F.collect_list(F.struct("block", "pos", "value", "end")))
    text = F.concat_ws("", F.flatten(F.transform("parts", lambda p: F.array(p["value"], p["end"]))))
    records = (
        numbered.groupBy("uri", "source_filename", "record")
        .agg(parts.alias("parts"))
        .select(
            "uri",
            "source_filename",
            "record",
            F.col("parts")[0]["block"].alias("block"),
            # without the line end after the record
            F.substring(text, F.lit(1), F.length(text) - F.length(F.element_at("parts", -1)["end"])).alias("_line"),
        )
        .filter((F.col("record") > 0) & keep_record(F.col("_line"), sep, columns))
    )
    # A split starts a bounded number of records, so this window is bounded too.
    pos = F.row_number().over(Window.partitionBy("uri", "block").orderBy("record"))
    cells = _cell_names(columns)
    parsed = records.select("uri", "source_filename", "block", pos.cast("long").alias("pos"), record_cells(F.col("_line"), sep).alias("_cells"))
    return parsed.select("uri", "source_filename", "block", "pos", *[F.get("_cells", F.lit(i)).alias(c) for i, c in enumerate(cells)])


def _read_group(spark: SparkSession, paths: list[str], sep: str, encoding: str, layout: str, columns: int) -> DataFrame:
    """One multi-file read: cells by position plus lineage. The header line is dropped by position, not checked."""
    if layout == ASSEMBLED:
        return _read_split_records(spark, paths, sep, encoding, columns)
    cells = _cell_names(columns)
    rows = (
        spark.read.schema(", ".join(f"{c} string" for c in [*cells, "_line"]))
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_line")
        # With pruning on, records would be measured against the selected columns only.
        .option("columnPruning", False)
        .csv([literal_path(p) for p in paths])
    )
    # ``_line`` is set only on records whose field count differs from the header. Naming a cell next to it is needed
    # as well: the reader refuses to produce that column alone, as a mere count would ask for.
    line = F.when(F.col(cells[0]).isNotNull() | F.col("_line").isNotNull(), F.col("_line"))
    kept = rows.select(
        *cells,
        "_line",
        F.col("_metadata.file_path").alias("uri"),
        percent_decoded(F.col("_metadata.file_name")).alias("source_filename"),
        F.col("_metadata.file_block_start").alias("block"),
    ).filter(line.isNull() | keep_record(line, sep, columns))
    return kept.select("uri", "source_filename", "block", *cells)


def _json_object(names: Column, values: Column) -> Column:
    def quoted(value: Column) -> Column:
        listed = F.to_json(F.array(value))
        return F.substring(listed, F.lit(2), F.length(listed) - 2)

    pairs = F.zip_with(names, values, lambda n, v: F.concat(quoted(n), F.lit(":"), quoted(v)))
    return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))


def _conform_group(spark: SparkSession, rows: DataFrame, files: list[Row], spec: DatasetSpec) -> DataFrame:
    cells = _cell_names(len(files[0].header))
    lineage = [c for c in LINEAGE if c in rows.columns]
    if spec.header is not None:
        at = first_positions(files[0].header, spec.rename)
        cell = lambda name: null_tokens_sql(cells[at[name]]) if name in at else "CAST(NULL AS STRING)"
        return rows.selectExpr(*lineage, *[f"{cell(f.name)} AS `{f.name}`" for f in spec.target])
    # No template: each file has its own column order. The lookup has one row per file of the batch.
    headers = spark.createDataFrame([(f.uri, list(f.header)) for f in files], "uri string, _header array<string>")
    listed = F.expr(f"array({', '.join(null_tokens_sql(c) for c in cells)})")
    joined = rows.join(F.broadcast(headers), "uri").withColumn("_cells", listed)
    return joined.select(
        *lineage,
        *conform_cells(F.col("_cells"), F.col("_header"), spec),
        _json_object(F.col("_header"), F.col("_cells")).alias("_snapshot"),
    )


def read_delimited(spark: SparkSession, manifest: DataFrame | Sequence[Row], spec: DatasetSpec) -> DataFrame:
    """Read one dataset's files of one batch as conformed rows of strings.

    The manifest rows of the batch are collected to group the files by separator, encoding, layout and header; each
    group is one read. Callers pass batches of bounded size (see ``plans.ingest``), never a whole large folder.

    Result: ``uri, source_filename, block, pos`` and the target columns. ``pos`` counts kept records within a split
    (see ``with_record_numbers``).
    """
    if isinstance(manifest, DataFrame):
        wanted = manifest.filter((F.col("dataset") == spec.name) & F.col("header").isNotNull())
        manifest = wanted.select("path", "uri", "sep", "encoding", "layout", "header").collect()
    groups: dict[tuple, list[Row]] = defaultdict(list)
    for file in manifest:
        shape = tuple(file.header) if spec.header is not None else len(file.header)
        groups[file.sep, file.encoding, file.layout, shape].append(file)
    lines, assembled = [], []
    for (sep, encoding, layout, _), files in sorted(groups.items(), key=lambda item: str(item[0])):
        columns = len(files[0].header)
        with few_listing_tasks(spark):
            rows = _read_group(spark, [f.path for f in files], sep, encoding, layout, columns)
        (assembled if layout == ASSEMBLED else lines).append(_conform_group(spark, rows, files, spec))
    parts = []
    if lines:
        # The counter runs over kept rows only, without gaps inside a split. Being above the union it also keeps later
        # projections there, so that their code is generated once and not per group.
        together = reduce(DataFrame.unionByName, lines)
        names = [c for c in together.columns if c not in LINEAGE]
        counter = F.monotonically_increasing_id().alias("pos")
        parts.append(together.select("uri", "source_filename", "block", counter, *names))
    if assembled:
        parts.append(reduce(DataFrame.unionByName, assembled))
    if not parts:
        strings = ", ".join(f"{f.name} string" for f in spec.target)
        return spark.createDataFrame([], f"uri string, source_filename string, block long, pos long, {strings}")
    return reduce(DataFrame.unionByName, parts)


def record_offsets(rows: DataFrame) -> DataFrame:
    """Per file and split: what to add to ``pos`` to get the record number. One small row per split."""
    blocks = rows.groupBy("uri", "block").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("lo"))
    # The header is record 1, so the first data record is number 2.
    return blocks.select("uri", "block", (prefix_before(F.col("n")) - F.col("lo") + 2).alias("offset"))


def with_record_numbers(rows: DataFrame, offsets: DataFrame | None = None) -> DataFrame:
    """Add ``numero_linha``: ordinal of the record among the kept records of its file, the first one being 2.

    Numbers come from per-split counts and a prefix sum over splits, so no file is ever sorted or gathered.
    """
    offsets = record_offsets(rows) if offsets is None else offsets
    return rows.join(offsets, ["uri", "block"]).withColumn("numero_linha", F.col("pos") + F.col("offset")).drop("offset")
