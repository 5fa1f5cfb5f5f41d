"""Quality rules: a table of thresholds over ratios of a text, compiled into one projection of built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words, as a character class of a regular expression.
SPACES = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
# Very common words of English, Spanish, German, French, Italian and Portuguese.
STOP_WORDS = tuple(
    """the of and to a in that is was for it with as on be at by this have from or had not are but which you were
    de la que el en y los se del las un por con no una su para es al lo como más
    der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch
    le les des et du une dans est que qui pour au sur par pas plus avec ce il ne
    di il che è per non della sono gli alla ma più anche
    o e do da em um os dos uma não ao das mais""".split()
)


@dataclass(frozen=True)
class Threshold:
    """A rule: the measure must lie in [low, high]. A measure that is undefined (nothing to divide by) passes."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None

    def failed(self) -> Column:
        value = F.col(self.measure)
        bounds = [value < self.low] if self.low is not None else []
        bounds += [value > self.high] if self.high is not None else []
        broken = bounds[0] if len(bounds) == 1 else bounds[0] | bounds[1]
        return F.coalesce(broken, F.lit(False))


#: Wide bounds: each cuts off what hardly occurs in running text of any of the languages.
THRESHOLDS: tuple[Threshold, ...] = (
    Threshold("word_length", "mean_word_chars", low=2.0, high=15.0),
    Threshold("symbols", "symbol_ratio", high=0.2),
    Threshold("stop_words", "stop_ratio", low=0.01),
    Threshold("repeated_lines", "dup_line_ratio", high=0.5),
    Threshold("ellipses", "ellipsis_line_ratio", high=0.5),
    Threshold("bullets", "bullet_line_ratio", high=0.95),
)


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of every whole text: ``doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stop,
    n_ellipsis, n_bullet``.

    ``n_lines`` counts lines with a word, ``n_dup_lines`` those among them that equal an earlier line, ``n_repeat_words``
    the words inside three-word windows found at least twice. Windows are compared by 64-bit hash. NULL text counts as
    empty. Arrays that several expressions use get a projection of their own, so that each is built once.
    """
    value, words, lines = F.coalesce(F.col("text"), F.lit("")), F.col("words"), F.col("lines")
    spot = F.col("spot")

    def neighbours_equal(entry: Column, i: Column) -> Column:
        before, after = F.get(F.col("ordered"), i - 1)["h"], F.get(F.col("ordered"), i + 1)["h"]
        return entry["h"].eqNullSafe(before) | entry["h"].eqNullSafe(after)

    out = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).select(
        "doc_id",
        F.filter(F.split(value, f"{SPACES}+"), lambda w: w != "").alias("words"),
        F.filter(F.split(value, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.regexp_count(value, F.lit(SYMBOLS)).alias("n_symbols"),
    )
    out = out.withColumn(
        "windows",
        F.when(
            F.size(words) >= 3,
            F.transform(
                F.slice(words, F.lit(1), F.size(words) - 2),
                lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    out = out.withColumn(
        "ordered",
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    )
    out = out.withColumn("spot", F.transform(F.filter("ordered", neighbours_equal), lambda entry: entry["i"]))
    covered = F.flatten(F.array(spot, F.transform(spot, lambda i: i + 1), F.transform(spot, lambda i: i + 2)))
    return out.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(covered)).cast("long").alias("n_repeat_words"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop"),
        F.size(F.filter(lines, lambda x: x.rlike(rf"(\.\.\.|…){SPACES}*$"))).cast("long").alias("n_ellipsis"),
        F.size(F.filter(lines, lambda x: x.rlike(rf"^{SPACES}*[-*•‣●]"))).cast("long").alias("n_bullet"),
    )


def quality_rules(
    docs: DataFrame,
    thresholds: Sequence[Threshold] = THRESHOLDS,
    min_words: int = 50,
    repeat_percent: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The measures of every document, its ratios, ``base_failed``, ``failed`` (names of broken rules) and ``kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``repeat_percent`` per cent of them in repeated windows.
    ``kept``: neither that nor any rule of the table. Every row gives one row, repeated ones too; NULL or empty text has no
    words and so fails; a NULL id stays; other columns are ignored.
    """
    per_word = {"mean_word_chars": "word_chars", "symbol_ratio": "n_symbols", "stop_ratio": "n_stop"}
    per_line = {"dup_line_ratio": "n_dup_lines", "ellipsis_line_ratio": "n_ellipsis", "bullet_line_ratio": "n_bullet"}
    out = measures(docs, doc_id, text)
    ratios = {name: F.try_divide(F.col(c).cast("double"), F.col("n_words")) for name, c in per_word.items()}
    ratios |= {name: F.try_divide(F.col(c).cast("double"), F.col("n_lines")) for name, c in per_line.items()}
    out = out.withColumns(ratios)
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    broken = F.array(*(F.when(t.failed(), F.lit(t.name)) for t in thresholds)) if thresholds else F.array().cast("array<string>")
    out = out.withColumns({"base_failed": base, "failed": F.array_compact(broken)})
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


def kept_documents(docs: DataFrame, thresholds: Sequence[Threshold] = THRESHOLDS, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep.

    A filter on ``kept`` alone would be pushed through the projections and their expressions repeated inside one another;
    a column that cannot be computed twice holds it back.
    """
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[text].alias("text"))
    judged = quality_rules(rows, thresholds, doc_id="row").withColumn("_place", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("_place") >= 0)).select("doc_id.*")


SQL = rf"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT r, doc_id, text,
    list_filter(regexp_split_to_array(text, '{SPACES}+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM base
), windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM cut WHERE len(words) >= 3)
), repeated AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), counted AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(words, lambda w: lower(w) IN ({", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))}))) AS n_stop,
    len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…){SPACES}*$'))) AS n_ellipsis,
    len(list_filter(lines, lambda l: regexp_matches(l, '^{SPACES}*[-*•‣●]'))) AS n_bullet, len(lines) AS n_lines
  FROM cut LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars::DOUBLE / n_words BETWEEN 2 AND 15 AND n_symbols::DOUBLE / n_words <= 0.2
    AND n_stop::DOUBLE / n_words >= 0.01 AND n_dup_lines::DOUBLE / n_lines <= 0.5
    AND n_ellipsis::DOUBLE / n_lines <= 0.5 AND n_bullet::DOUBLE / n_lines <= 0.95 AS kept
FROM judged
"""
