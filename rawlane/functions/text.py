"""Text helpers shared by the cleaning, routing and rule jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = "".join(
    map(
        chr,
        (
            *range(0x09, 0x0E),
            *range(0x1C, 0x21),
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ),
    )
)

# Cell texts that count as NULL when a delimited file is read.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def strip(value: Column) -> Column:
    """Remove Unicode whitespace from both ends (``trim`` alone only removes the space character)."""
    return F.btrim(value, F.lit(WHITESPACE))


def is_blank(value: Column) -> Column:
    # Text that starts with a visible ASCII character needs no trimming, which takes longer than all else here.
    visible = (value >= "!") & (value < "\u007f")
    return value.isNull() | (~visible & (strip(value) == ""))


def null_tokens_sql(column: str) -> str:
    """SQL text that turns the cell texts in ``NULL_TOKENS`` into NULL.

    Text, since it is applied to every cell of wide tables: building the same as column objects takes seconds.
    """
    tokens = ", ".join(f"'{token}'" for token in NULL_TOKENS)
    return f"CASE WHEN `{column}` NOT IN ({tokens}) THEN `{column}` END"


def uuid_from(*parts: Column) -> Column:
    """A UUID-shaped id derived from its inputs, so a recomputed task yields the same id."""
    digest = F.md5(F.concat_ws("\u0001", *parts))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.substring(digest, 13, 4),
        F.substring(digest, 17, 4),
        F.substring(digest, 21, 12),
    )


def percent_decoded(uri: Column) -> Column:
    """Undo percent-encoding of a path; a plus sign is not an encoded space there."""
    return F.when(uri.contains("%"), F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))).otherwise(uri)
