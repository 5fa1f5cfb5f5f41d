"""Quotes and line ends: which physical lines form one record, found without reading a file front to back.

What a line does to the state "inside a quoted field" is one of four things: leave it, flip it, set it, clear it. Such
steps can be combined in any grouping, so the state at the start of every split follows from one small row per split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _mark(sep: str) -> str:
    return "\\t" if sep == "\t" else f"\\{sep}"


def bare_text(line: Column, sep: str) -> Column:
    """A record without its quoted fields. A quote only opens a field at the field's start.

    Doubled quotes are removed first; what is left in quotes then has no quote inside, and the pattern needs no
    nesting however long a field is.
    """
    single = F.replace(line, F.lit('""'), F.lit(""))
    return F.when(line.contains('"'), F.regexp_replace(single, f'(^|{_mark(sep)})"[^"]*+"', "$1")).otherwise(line)


def has_tail(line: Column, sep: str) -> Column:
    """True when text follows the closing quote of a field, before the next separator."""
    single = F.replace(line, F.lit('""'), F.lit(""))
    empty = line.rlike(f'(^|{_mark(sep)})(?:"")++[^"{_mark(sep)}\\r\\n]')
    return line.contains('"') & (empty | single.rlike(f'(^|{_mark(sep)})"[^"]*+"[^{_mark(sep)}\\r\\n]'))


def opens_quote(line: Column, sep: str) -> Column:
    """True when a line that starts outside quotes ends inside them."""
    return line.contains('"') & bare_text(line, sep).rlike(f'(^|{_mark(sep)})"')


def hides_records(line: Column, sep: str) -> Column:
    """True when a physical line (up to ``\\n``) cannot be read by itself by a reader of plain lines: it ends inside
    quotes, has a lone ``\\r`` next to quotes, or has text after a closing quote."""
    broken = F.rtrim(line, F.lit("\r")).contains("\r")
    return line.contains('"') & (broken | opens_quote(F.rtrim(line, F.lit("\r")), sep) | has_tail(line, sep))


def pieces(lines: DataFrame) -> DataFrame:
    """Physical lines (up to ``\\n``) as pieces between any two line ends: ``\\n``, ``\\r\\n`` or a lone ``\\r``.

    Each has ``value``, ``end`` (the characters of the line end after it, which count where they are quoted) and ``pos``,
    now line and piece. A ``\\r`` before ``\\n`` belongs to it, so most lines are one piece.
    """
    others = [c for c in lines.columns if c not in ("pos", "value")]
    whole = F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    cut = lines.select(*others, "pos", F.col("value").endswith("\r").alias("_cr"), F.split(whole, "\r").alias("_parts"))
    spread = cut.select(*others, "pos", "_cr", F.size("_parts").alias("_n"), F.posexplode("_parts").alias("_part", "value"))
    end = F.when(F.col("_part") < F.col("_n") - 1, "\r").when(F.col("_cr"), "\r\n").otherwise("\n")
    return spread.select(*others, F.struct("pos", F.col("_part").alias("part")).alias("pos"), "value", end.alias("end"))


def record_cells(record: Column, sep: str) -> Column:
    """The cells of a record. A quoted cell may hold separators and line ends; text after its closing quote belongs to it."""
    mark = _mark(sep)
    found = F.regexp_extract_all(F.concat(F.lit(sep), record), F.lit(f'{mark}("[^"]*+(?:""[^"]*+)*+"?+[^{mark}]*+|[^{mark}]*+)'), F.lit(1))
    return F.transform(
        found,
        lambda c: F.when(
            c.startswith('"'),
            F.concat(F.replace(F.regexp_extract(c, '(?s)^"([^"]*+(?:""[^"]*+)*+)', 1), F.lit('""'), F.lit('"')), F.regexp_extract(c, '(?s)^"[^"]*+(?:""[^"]*+)*+"?+(.*)$', 1)),
        ).otherwise(c),
    )


def odd_quotes(text: Column, sep: str) -> Column:
    """False when every quote of a file's text belongs to a field quoted as a whole within its line, and no lone ``\\r`` is
    there: then no line hides records and the text does not end inside quotes, which one scan of the text tells.

    A quoted field that ends in a separator counts as odd: its closing quote would look like an opening one.
    """
    mark = _mark(sep)
    plain = F.regexp_replace(text, f'(^|[\\n{mark}])"(?:[^"\\r\\n]*[^"\\r\\n{mark}])?"(?=[\\r\\n{mark}]|\\z)', "$1")
    lone = text.contains("\r") & text.rlike("\\r(?!\\r*+(?:\\n|\\z))")
    return text.contains('"') & (plain.contains('"') | lone)


def ends_in_quotes(text: Column, sep: Column) -> Column:
    """True when a whole file's text ends inside a quoted field, by the rules of ``bare_text`` over all its lines."""
    start = F.concat(F.lit("(^|[\\r\\n"), sep, F.lit("])\""))
    single = F.replace(text, F.lit('""'), F.lit(""))
    bare = F.regexp_replace(single, F.concat(start, F.lit('[^"]*+"')), F.lit("$1"))
    return text.contains('"') & F.regexp_like(bare, start)


def _stays_open(line: Column, sep: str) -> Column:
    """True when a line that starts inside quotes ends inside them."""
    single = F.replace(line, F.lit('""'), F.lit(""))
    # Text after the closing quote belongs to the same field, so a quote right there opens nothing.
    rest = F.concat(F.lit("x"), F.substring(single, F.instr(single, '"') + 1, F.length(single)))
    return ~single.contains('"') | opens_quote(rest, sep)


def _stepped(lines: DataFrame, sep: str) -> DataFrame:
    """Add what a split's lines up to each one do to the state: ``_flips``, and ``_fixed``, the last state set and when."""
    inside, outside = _stays_open(F.col("value"), sep).cast("int"), opens_quote(F.col("value"), sep).cast("int")
    so_far = Window.partitionBy("uri", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stepped = lines.withColumns({"_if_out": outside, "_if_in": inside})
    stepped = stepped.withColumn("_flips", F.sum(((F.col("_if_out") == 1) & (F.col("_if_in") == 0)).cast("int")).over(so_far))
    fixed = F.when(F.col("_if_out") == F.col("_if_in"), F.struct(F.col("_if_out").alias("state"), F.col("_flips").alias("at")))
    return stepped.withColumn("_fixed", F.last(fixed, ignorenulls=True).over(so_far))


def _split_steps(stepped: DataFrame) -> DataFrame:
    """Per split what the whole of it does to the state: ``set`` to a state, or NULL, and the flips up to its end of
    all splits of the file that only flip it."""
    file = Window.partitionBy("uri").orderBy("block")
    splits = stepped.groupBy("uri", "block").agg(F.max_by(F.struct("_flips", "_fixed"), "pos").alias("end"))
    ends_fixed = F.when(
        F.col("end._fixed").isNotNull(), (F.col("end._fixed.state") + F.col("end._flips") - F.col("end._fixed.at")) % 2
    )
    return splits.select(
        "uri",
        "block",
        ends_fixed.alias("set"),
        F.sum(F.when(ends_fixed.isNull(), F.col("end._flips")).otherwise(0)).over(
            file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ).alias("flips"),
    )


def files_ending_in_quotes(lines: DataFrame, sep: str) -> DataFrame:
    """``uri`` of the files whose last line ends inside a quoted field. ``lines`` has ``uri, block, pos, value``.

    Lines without a quote leave the state as it is, so only those with one are looked at.
    """
    splits = _split_steps(_stepped(lines.filter(F.col("value").contains('"')), sep))
    last = splits.groupBy("uri").agg(
        F.max_by(F.struct("set", "flips"), F.when(F.col("set").isNotNull(), F.col("block"))).alias("last"),
        F.max_by("flips", "block").alias("flips"),
    )
    state = F.coalesce(F.col("last.set"), F.lit(0)) + F.col("flips") - F.coalesce(F.col("last.flips"), F.lit(0))
    return last.filter(state % 2 == 1).select("uri")


def number_records(lines: DataFrame, sep: str) -> DataFrame:
    """Add ``record``: 0 for the header line, then 1, 2, ... along each file, counting blank lines too.

    ``lines`` has ``uri, block, pos, value``, as ``pieces`` gives them. Windows run over one split each, whose size is bounded; across splits
    only per-split summaries are combined.
    """
    split = Window.partitionBy("uri", "block").orderBy("pos")
    so_far = split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stepped = _stepped(lines, sep)
    # Then the state before each split.
    file = Window.partitionBy("uri").orderBy("block")
    before = file.rowsBetween(Window.unboundedPreceding, -1)
    splits = _split_steps(stepped)
    last_set = F.last(F.when(F.col("set").isNotNull(), F.struct("set", "flips")), ignorenulls=True).over(before)
    flips_before = F.coalesce(F.lag("flips").over(file), F.lit(0))
    splits = splits.select("uri", "block", last_set.alias("last"), flips_before.alias("flips"))
    opening = F.when(F.col("last").isNotNull(), (F.col("last.set") + F.col("flips") - F.col("last.flips")) % 2).otherwise(
        F.col("flips") % 2
    )
    opened = stepped.join(splits.select("uri", "block", opening.alias("_open")), ["uri", "block"])

    after = F.when(
        F.col("_fixed").isNotNull(), (F.col("_fixed.state") + F.col("_flips") - F.col("_fixed.at")) % 2
    ).otherwise((F.col("_open") + F.col("_flips")) % 2)
    started = opened.withColumn("_after", after).withColumn(
        "_start", (F.coalesce(F.lag("_after").over(split), F.col("_open")) == 0).cast("int")
    )
    text = F.when(F.btrim("value", F.lit(" \t\r\n")) != "", F.col("pos"))
    started = started.withColumns({"_nth": F.sum("_start").over(so_far), "_first_text": F.min(text).over(so_far)})

    counts = started.groupBy("uri", "block").agg(F.sum("_start").alias("n"))
    base = F.coalesce(F.sum("n").over(before), F.lit(0))
    numbered = started.join(counts.select("uri", "block", base.alias("_base")), ["uri", "block"])
    # The header is the first non-blank line of the file's first split; blank lines before it go with it.
    heading = (F.col("block") == 0) & (F.col("_first_text").isNull() | (F.col("pos") == F.col("_first_text")))
    record = F.when(heading, F.lit(0)).otherwise(F.col("_base") + F.col("_nth"))
    return numbered.select(*lines.columns, record.cast("long").alias("record"))
