"""A fingerprint of a file's content that can be put together from the parts in which the file is read.

Every line gives four 31-bit words. The fingerprint's sums are those words, weighted with the line number's power of a base,
in the field of a prime: a part's sums over its own line numbers become its share of the file's sums when they are shifted by
the power of the number of lines before it. So one scan and one small row per split do, and neither split sizes nor whether a
file is read whole matter. A line is what stands between two ``\\n``; the file's length tells whether the last one has one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A Mersenne prime: products of two remainders fit into a long. The base is a primitive root.
PRIME, BASE = (1 << 31) - 1, 48271
WORDS = 4
#: Bits of a number that one lookup in a table of powers takes, and bits of record numbers within a Spark partition.
DIGIT_BITS, NUMBER_BITS = 4, 33


def power(exponent: Column, bits: int = NUMBER_BITS) -> Column:
    """BASE to a number of up to ``bits`` bits, in the field: one lookup per digit of the number."""
    out = F.lit(1).cast("long")
    for low in range(0, bits, DIGIT_BITS):
        table = ", ".join(f"{pow(BASE, digit << low, PRIME)}L" for digit in range(1 << DIGIT_BITS))
        digit = F.shiftright(exponent, low).bitwiseAND((1 << DIGIT_BITS) - 1).cast("int")
        out = out * F.get(F.expr(f"array({table})"), digit) % PRIME
    return out


def line_hashes(line: Column) -> list[Column]:
    return [F.xxhash64(line), F.xxhash64(F.lit("b"), line)]


def hash_words(hashes: list[Column]) -> list[Column]:
    return [half.bitwiseAND(PRIME) for h in hashes for half in (h, F.shiftright(h, 32))]


def line_words(line: Column) -> list[Column]:
    """The words of a line (text or binary)."""
    return hash_words(line_hashes(line))


def _spelled(length: Column, lines: Column, sums: list[Column]) -> Column:
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in (length, lines, *sums)]))


def line_shares(line: Column, position: Column) -> Column:
    """What a line adds to the sums of its split. ``position`` counts lines within a Spark partition in its lower bits."""
    weight = power(position.bitwiseAND((1 << NUMBER_BITS) - 1))
    # No function over an array: that would not be compiled, and would look the weight up once more for every word.
    return F.array(*[word * weight % PRIME for word in line_words(line)])


def split_sums(shares: Column) -> list[Column]:
    """Aggregates over the lines of a split: ``sum_0`` ... A split has far fewer than 2^32 lines, so they fit."""
    return [(F.sum(shares[i]) % PRIME).alias(f"sum_{i}") for i in range(WORDS)]


def digest_of_splits(length: Column, lines: Column, before: Column, lowest: Column) -> Column:
    """An aggregate over the splits of a file: ``lines`` in each, ``before`` it, its ``lowest`` position, and its sums."""
    # Powers repeat after PRIME - 1, which makes differences below zero positive.
    shift = power(F.pmod(before - lowest.bitwiseAND((1 << NUMBER_BITS) - 1), F.lit(PRIME - 1)), 31)
    sums = [F.sum(F.col(f"sum_{i}") * shift % PRIME) % PRIME for i in range(WORDS)]
    return _spelled(F.max(length), F.sum(lines), sums)


def digest_of_lines(length: Column, lines: Column, utf8: Column) -> Column:
    """The same of a file that is there as a whole, its ``lines`` split at ``\\n``: text where ``utf8`` is true, else bytes as
    characters U+0000 to U+00FF. What comes after a final line end is no line; a byte-order mark counts by the length only,
    since readers of lines drop it.

    The sums are folded from the last line to the first, each step times the base, so no power is looked up: functions over
    arrays are not compiled, and looking up the powers took most of a description's time.
    """
    none = (F.size(lines) > 0) & (F.element_at(lines, -1) == "")
    own = F.when(none, F.slice(lines, 1, F.size(lines) - 1)).otherwise(lines)

    def hashes(line: Column, number: Column) -> Column:
        head = (number == 0) & line.startswith(F.when(utf8, F.lit("\ufeff")).otherwise(F.lit("ï»¿")))
        line = F.when(head, F.substring(line, F.when(utf8, F.lit(2)).otherwise(F.lit(4)), F.lit(2**31 - 1))).otherwise(line)
        content = F.when(utf8, line.cast("binary")).otherwise(F.encode(line, "ISO-8859-1"))
        return F.array(*line_hashes(content))

    def step(sums: Column, found: Column) -> Column:
        words = hash_words([F.get(found, F.lit(i)) for i in range(WORDS // 2)])
        return F.array(*[(F.get(sums, F.lit(i)) * BASE + word) % PRIME for i, word in enumerate(words)])

    sums = F.aggregate(F.reverse(F.transform(own, hashes)), F.array(*[F.lit(0).cast("long")] * WORDS), step)
    counted = F.struct(F.size(own).alias("n"), sums.alias("sums"))
    return _spelled(length, counted["n"], [counted["sums"][i] for i in range(WORDS)])
