"""The manifest: one row per input file with everything needed to route, check and read it.

Files up to ``whole_file_bytes`` are described from their bytes, one file per row. Larger files are never held in one
row or one task: they are described from their lines, which Spark reads in splits. Both give the same facts, so the limit
may change at any time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rawlane.functions.text import percent_decoded, strip
from rawlane.session import work_path
from rawlane.sources.digest import digest_of_lines, digest_of_splits, line_shares, split_sums
from rawlane.sources.quoting import ends_in_quotes, files_ending_in_quotes, hides_records, odd_quotes, pieces
from rawlane.sources.storage import materialize
from rawlane.specs import DEFAULT_SPECS, DatasetSpec

WHOLE_FILE_BYTES = 64 * 1024 * 1024

# How a file's records are read.
LINES = "lines"  # every line is a record: split freely
ASSEMBLED = "assembled"  # quotes hide line ends: records are put together from pieces of lines

# Separators in order of preference.
SEPARATORS = (";", ",", "\t")
DEFAULT_SEPARATOR = ","

UTF8, LATIN1 = "UTF-8", "ISO-8859-1"

MANIFEST_COLUMNS = (
    "path",
    "uri",
    "file_name",
    "length",
    "modified",
    "file_hash",
    "encoding",
    "sep",
    "header",
    "layout",
    "unclosed",
)

BLANKS = " \t\r\n"
BOM = chr(0xFEFF)


def detect_separator(first_line: Column) -> Column:
    """The first of ``SEPARATORS`` that is present at all; comma when none is."""
    found = F.lit(DEFAULT_SEPARATOR)
    for sep in reversed(SEPARATORS):
        found = F.when(first_line.contains(sep), F.lit(sep)).otherwise(found)
    return found


def header_cells(line: Column, sep: Column) -> Column:
    """Split a header line, honouring quotes. A leading separator makes every match non-empty."""
    pattern = F.concat(sep, F.lit('("(?:[^"]|"")*"|[^'), sep, F.lit("]*)"))
    cells = F.regexp_extract_all(F.concat(sep, line), pattern, F.lit(1))
    return F.transform(
        cells,
        lambda c: F.when(
            c.startswith('"') & c.endswith('"') & (F.length(c) > 1),
            F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(c),
    )


def _without_bom(text: Column) -> Column:
    return F.when(text.startswith(BOM), F.substring(text, F.lit(2), F.length(text))).otherwise(text)


def _first_line(text: Column) -> Column:
    return F.substring_index(F.substring_index(text, "\n", 1), "\r", 1)


def describe_content(files: DataFrame) -> DataFrame:
    """Fingerprint, MD5, encoding, separator, header and layout of files given with their whole ``content``."""
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    decoded = files.withColumn("_utf8", valid).withColumn(
        "_text", F.when(F.col("_utf8"), F.col("content").cast("string")).otherwise(F.decode("content", LATIN1))
    )
    text = F.col("_text")
    first = _first_line(text)
    # Blank lines before the header are skipped, but the separator is looked for on the physical first line.
    header_line = F.when(strip(first) != "", first).otherwise(_first_line(F.ltrim(text, F.lit(BLANKS))))
    lined = decoded.withColumns({"sep": detect_separator(first), "_header": _without_bom(header_line)})
    blank_record = (F.col("sep") == "\t") & text.rlike(r"(?m)^[ \t]*\t[ \t]*\r?$")
    # UTF-8 as it is, else one character per byte: so lines have their bytes whatever the encoding.
    lines = F.split(text, "\n")

    def any_of(test: Callable[[str], Column]) -> Column:
        return reduce(Column.__or__, [(F.col("sep") == sep) & test(sep) for sep in SEPARATORS])

    # Most files need no look at single lines: three patterns for each took a third of a description's time.
    lined = lined.withColumn("_odd", any_of(lambda sep: odd_quotes(text, sep)))
    hidden = any_of(lambda sep: F.exists(lines, lambda line: hides_records(line, sep)))
    return lined.select(
        *[c for c in files.columns if c != "content"],
        digest_of_lines(F.length("content"), lines, F.col("_utf8")).alias("file_hash"),
        F.md5("content").alias("md5"),
        F.when(F.col("_utf8"), F.lit(UTF8)).otherwise(F.lit(LATIN1)).alias("encoding"),
        "sep",
        F.when(strip(F.col("_header")) != "", header_cells(F.col("_header"), F.col("sep"))).alias("header"),
        F.when((F.col("_odd") & hidden) | blank_record, F.lit(ASSEMBLED)).otherwise(F.lit(LINES)).alias("layout"),
        (F.col("_odd") & ends_in_quotes(_without_bom(text), F.col("sep"))).alias("unclosed"),
    )


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Physical lines with their file, split and a counter that grows by one within a split."""
    return (
        spark.read.option("lineSep", "\n")
        .option("pathGlobFilter", "*.csv")
        .text(paths if isinstance(paths, str) else list(paths))
        .select(
            "value",
            F.col("_metadata.file_path").alias("uri"),
            percent_decoded(F.col("_metadata.file_name")).alias("file_name"),
            F.col("_metadata.file_size").alias("length"),
            F.col("_metadata.file_modification_time").alias("modified"),
            F.col("_metadata.file_block_start").alias("block"),
        )
    )


def prefix_before(value: Column, file: str = "uri", block: str = "block") -> Column:
    """Sum over the earlier blocks of the same file. Rows are blocks, so even a huge file has few."""
    window = Window.partitionBy(file).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0))


def describe_lines(spark: SparkSession, paths: str | Sequence[str], larger_than: int, work: str) -> DataFrame:
    """The same facts for files larger than ``larger_than`` bytes, gathered from their split lines.

    Two scans: one sums up every split, the digest of its lines included, the other picks the first lines of each file's
    first split. Files with quotes that hide line ends are scanned once more, to see whether they end inside quotes.
    """
    # The filter on file size is applied to the file listing: smaller files are not opened.
    lines = read_lines(spark, paths).filter(F.col("length") > larger_than)
    lines = lines.withColumn("pos", F.monotonically_increasing_id())
    value = F.col("value")
    text_blank = F.btrim(value, F.lit(BLANKS)) == ""
    blocks = lines.withColumn("_shares", line_shares(value, F.col("pos"))).groupBy("uri", "file_name", "length", "modified", "block").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("pos").alias("lo"),
        F.min(F.when(~text_blank, F.col("pos"))).alias("lo_text"),
        F.bool_and(F.is_valid_utf8(value)).alias("utf8"),
        *[F.bool_or(hides_records(value, sep)).alias(f"hides_{i}") for i, sep in enumerate(SEPARATORS)],
        F.bool_or(text_blank & value.contains("\t")).alias("tabs"),
        *split_sums(F.col("_shares")),
    )
    blocks = materialize(blocks.withColumn("base", prefix_before(F.col("n"))), f"{work}/blocks")
    per_file = blocks.groupBy("uri", "file_name", "length", "modified").agg(
        digest_of_splits(F.col("length"), F.col("n"), F.col("base"), F.col("lo")).alias("file_hash"),
        F.bool_and("utf8").alias("utf8"),
        *[F.bool_or(f"hides_{i}").alias(f"hides_{i}") for i in range(len(SEPARATORS))],
        F.bool_or("tabs").alias("tabs"),
    )
    # Only the first line and the first non-blank line of the first split can be the separator or header line.
    first = blocks.filter("block = 0")
    heads = first.select("uri", F.col("lo").alias("pos"), F.lit("first").alias("which")).unionByName(
        first.filter("lo_text IS NOT NULL").select("uri", F.col("lo_text").alias("pos"), F.lit("text").alias("which"))
    )
    heads = lines.filter("block = 0").select("uri", "pos", "value").join(heads, ["uri", "pos"])
    heads = heads.groupBy("uri").agg(*[F.collect_list(F.when(F.col("which") == w, value))[0].alias(f"_{w}") for w in ("first", "text")])

    def decoded(line: str) -> Column:
        return F.when(F.col("utf8"), F.col(line)).otherwise(F.decode(F.col(line).cast("binary"), LATIN1))

    facts = per_file.join(heads, "uri", "left")
    start = _first_line(F.coalesce(decoded("_first"), F.lit("")))
    header_line = F.when(strip(start) != "", start).otherwise(_first_line(F.ltrim(decoded("_text"), F.lit(BLANKS))))
    facts = facts.withColumns({"sep": detect_separator(start), "_header": _without_bom(header_line)})
    hidden = F.col("tabs") & (F.col("sep") == "\t")
    for i, sep in enumerate(SEPARATORS):
        hidden = hidden | (F.col(f"hides_{i}") & (F.col("sep") == sep))
    described = facts.select(
        "uri",
        "file_name",
        "length",
        "modified",
        "file_hash",
        F.when(F.col("utf8"), F.lit(UTF8)).otherwise(F.lit(LATIN1)).alias("encoding"),
        "sep",
        F.when(strip(F.col("_header")) != "", header_cells(F.col("_header"), F.col("sep"))).alias("header"),
        F.when(hidden, F.lit(ASSEMBLED)).otherwise(F.lit(LINES)).alias("layout"),
    )
    described = materialize(described, f"{work}/described")
    # The state at the end of the last split, found from the lines as assembled reading sees them.
    unclosed = []
    for sep in SEPARATORS:
        mine = described.filter((F.col("layout") == ASSEMBLED) & (F.col("sep") == sep)).select("uri")
        quoted = lines.filter(F.col("value").contains('"')).join(mine, "uri", "left_semi")
        unclosed.append(files_ending_in_quotes(pieces(quoted.select("uri", "block", "pos", "value")), sep))
    unclosed = reduce(DataFrame.unionByName, unclosed).withColumn("unclosed", F.lit(True))
    return described.join(unclosed, "uri", "left").withColumn("unclosed", F.coalesce("unclosed", F.lit(False)))


def build_manifest(
    spark: SparkSession,
    paths: str | Sequence[str],
    whole_file_bytes: int = WHOLE_FILE_BYTES,
    work: str | None = None,
    skip_unreadable: bool = False,
) -> DataFrame:
    """Describe every ``*.csv`` file below ``paths`` (a folder, a glob, or a list of them).

    Lazy but for the split table of large files, which is only built when there are any. With ``skip_unreadable`` files up
    to ``whole_file_bytes`` that cannot be read have no row; a larger one is an error all the same, since part of its lines
    would pass for the whole.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("ignoreCorruptFiles", skip_unreadable)
        .load(paths if isinstance(paths, str) else list(paths))
        .select(
            "content",
            "length",
            F.col("modificationTime").alias("modified"),
            F.col("_metadata.file_path").alias("uri"),
            percent_decoded(F.col("_metadata.file_name")).alias("file_name"),
        )
    )
    # The length filter is pushed to the source: larger files are listed, but not read here.
    small = describe_content(files.filter(F.col("length") <= whole_file_bytes)).drop("md5")
    manifest = small
    if not files.filter(F.col("length") > whole_file_bytes).select("uri").isEmpty():
        large = describe_lines(spark, paths, whole_file_bytes, work or work_path(spark, "manifest"))
        manifest = small.unionByName(large)
    return manifest.withColumn("path", percent_decoded(F.col("uri"))).select(*MANIFEST_COLUMNS)


def route_files(manifest: DataFrame, specs: Sequence[DatasetSpec] = DEFAULT_SPECS) -> DataFrame:
    """Add ``dataset`` by the first pattern found in the lower-cased file stem; other files and types are left out."""
    stem = F.lower(F.regexp_replace("file_name", r"\.[^.]*$", ""))
    dataset = F.lit(None).cast("string")
    for spec in reversed(specs):
        dataset = F.when(stem.contains(spec.pattern), F.lit(spec.name)).otherwise(dataset)
    return manifest.filter(F.col("file_name").endswith(".csv")).withColumn("dataset", dataset).filter("dataset is not null")


def skip_seen_files(manifest: DataFrame, history: DataFrame) -> DataFrame:
    """Drop files whose content was loaded before, under any name or dataset, or comes twice in this delivery.

    ``history`` is the run state. Failed runs do not count, so their files may be tried again. Within a delivery files
    count in path order, and only a file that passes its header check (column ``ok``, if present) makes later copies
    duplicates. The first path per content is found by an aggregate, so many copies of one file are combined early.
    """
    good = manifest.filter("ok") if "ok" in manifest.columns else manifest
    first = good.groupBy("file_hash").agg(F.min("path").alias("_first_path"))
    loaded = history.filter(F.col("status") == "sucesso").select("file_hash")
    return (
        manifest.join(loaded, "file_hash", "left_anti")
        .join(first, "file_hash", "left")
        .filter(F.col("_first_path").isNull() | (F.col("path") <= F.col("_first_path")))
        .drop("_first_path")
    )
