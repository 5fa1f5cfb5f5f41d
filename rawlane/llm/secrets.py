"""Secret scans: fixed patterns, and a battery of randomness tests with false-discovery control for what has no pattern.

A token that could be an encoded key is tested for uniform use of its alphabet (chi-squared), for the number of runs above
and below the middle of the alphabet, and for correlation of neighbouring characters. The three p-values of "this is
random" are combined into one score, small for random strings. How often running text scores as low is not assumed but
measured: every different paragraph is cut into stretches of several lengths and alphabets, all of which are scored. A
token's p-value is the share of such stretches of its length and alphabet that score as low, and one Benjamini-Hochberg step
over all different tokens decides. A token counts once however often it occurs, and so does a paragraph, so what many
documents repeat doesn't decide about the rest.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlane.llm.arrow_text import buffers, runs
from rawlane.llm.spans import Span, free_of, matches
from rawlane.session import work_path

KINDS = ("assign", "access", "hex")
# What the scan is defined to find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: Lengths at which a class of lengths begins; within a class a longer token only has more evidence.
LENGTHS = (20, 24, 32, 44, 64, 96)
#: Scores are counted in steps of this size. One random string in a thousand scores above the last step (chi-squared with six
#: degrees of freedom): what does is not random, and how far above it is doesn't matter.
STEP, STEPS = 0.25, 90
_CODES = {}
for _name, _letters in ALPHABETS.items():
    _CODES[_name] = np.full(128, -1, np.int16)
    _CODES[_name][[ord(c) for c in _letters]] = np.arange(len(_letters))
_CODES["base64"][[ord("-"), ord("_")]] = [62, 63]
# Of running text letters count in any case where the alphabet has one case only.
_RUNNING = {
    "hex": _CODES["hex"][[ord(chr(c).lower()) for c in range(128)]],
    "base32": _CODES["base32"][[ord(chr(c).upper()) for c in range(128)]],
    "base64": _CODES["base64"],
}


def inferred_encoding(token: str) -> str | None:
    """The smallest alphabet that holds a token with letters as well as digits or both cases; None if there is none.

    Words are letters of one case (perhaps with a capital first), numbers are digits: neither says anything was encoded.
    """
    body = token.rstrip("=")
    letters = [c for c in body if c.isalpha()]
    if not letters or (body[1:].islower() or body.isupper()) and len(letters) == len(body):
        return None
    if all(c in "0123456789abcdefABCDEF" for c in body) and (body.lower() == body or body.upper() == body):
        return "hex"
    if all(c in ALPHABETS["base32"] for c in body):
        return "base32"
    return "base64"


def length_class(n: int) -> int:
    return max(i for i, least in enumerate(LENGTHS) if i == 0 or n >= least)


def _upper_normal(z: np.ndarray) -> np.ndarray:
    """P(N(0, 1) > z), with a relative error below 2e-7: a Chebyshev fit of the complementary error function."""
    x = np.atleast_1d(z) / math.sqrt(2)
    t = 1 / (1 + np.abs(x) / 2)
    fit = np.full_like(t, 0.17087277)
    for c in (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        fit = fit * t + c
    tail = t * np.exp(np.maximum(fit - x * x, -700)) / 2
    return np.where(x >= 0, tail, 1 - tail)


def running_sums(codes: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Of a string of symbol numbers below ``size``: sums over its beginnings of what ``stretch_scores`` needs."""
    codes = codes.astype(np.int32)
    high = codes >= size // 2
    out = []
    for values in (high, high[1:] != high[:-1], codes, codes**2, codes[1:] * codes[:-1]):
        out.append(np.zeros(len(values) + 1, np.int64))
        np.cumsum(values, out=out[-1][1:])
    return tuple(out)


def stretch_scores(codes: np.ndarray, sums: tuple[np.ndarray, ...], starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Scores of the stretches of ``n`` symbols that begin at ``starts``: Fisher's -2 sum ln p, or anything above the last
    step for those whose use of the alphabet alone puts them there, which is most of running text.

    Chi-squared by the Wilson-Hilferty cube root; runs above and below the middle and lag-one serial correlation by their
    normal limits, both two-sided. All but the counts of symbols comes from running sums, which are whole numbers.
    """
    squares = np.empty(len(starts))
    within, apart = np.arange(n), (np.arange(1024) * size)[:, None]
    for begin in range(0, len(starts), 1024):
        some = starts[begin : begin + 1024]
        keyed = codes[some[:, None] + within] + apart[: len(some)]
        counts = np.bincount(keyed.ravel(), minlength=len(some) * size).reshape(-1, size)
        squares[begin : begin + len(some)] = np.einsum("ij,ij->i", counts, counts)
    x2, df = squares * size / n - n, size - 1
    p_uniform = _upper_normal((np.cbrt(x2 / df) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))
    scores = -2 * np.log(np.clip(p_uniform, 1e-12, 1))
    left = np.flatnonzero(scores <= STEP * (STEPS + 1))
    starts = starts[left]
    ends = starts + n
    highs, changes, total, total2, pairs = sums
    ones = highs[ends] - highs[starts]
    mean = 2.0 * ones * (n - ones) / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    runs = changes[ends - 1] - changes[starts] + 1
    z = np.abs(runs - mean) / np.sqrt(np.maximum(variance, 1e-9))
    p_runs = np.where(variance > 0, 2 * _upper_normal(z), 1e-12)
    whole = total[ends] - total[starts]
    middle = whole / n
    power = (n * (total2[ends] - total2[starts]) - whole**2) / n
    inner = 2 * whole - codes[starts] - codes[ends - 1]
    serial = (pairs[ends - 1] - pairs[starts] - middle * inner + (n - 1) * middle**2) / np.maximum(power, 1e-9)
    p_serial = np.where(power > 0, 2 * _upper_normal(np.abs(serial + 1 / n) * math.sqrt(n)), 1e-12)
    scores[left] -= 2 * sum(np.log(np.clip(p, 1e-12, 1)) for p in (p_runs, p_serial))
    return scores


def battery(codes: np.ndarray, size: int) -> np.ndarray:
    """Scores of equally long strings, a row of symbol numbers each, over an alphabet of ``size``."""
    rows, n = codes.shape
    return stretch_scores(codes.ravel(), running_sums(codes.ravel(), size), np.arange(rows) * n, n, size)


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed patterns, by start, then kind."""
    found: list[Span] = []
    if "=" in text or ":" in text:
        found += (("assign", m.start(), m.end()) for m in matches(ASSIGN, text, lambda m: len(m[2]) >= 6))
    found += (("access", m.start(), m.end()) for m in matches(ACCESS, text, lambda m: len(m[0]) >= 20))
    found += (("hex", m.start(), m.end()) for m in HEX.finditer(text))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def tokens(text: str, spans: list[Span]) -> list[tuple[int, int, str, int, int, int]]:
    """Untouched tokens of an inferred encoding: start, end, encoding, length class, score in steps, hash."""
    free, out = free_of(spans), []
    for m in TOKEN.finditer(text):
        encoding = inferred_encoding(m[0])
        if encoding and free(m.start(), m.end()):
            body = m[0].rstrip("=")
            body = body.lower() if encoding == "hex" else body
            codes = _CODES[encoding][np.frombuffer(body.encode(), np.uint8)][None, :]
            score = float(battery(codes.astype(np.int64), len(ALPHABETS[encoding]))[0])
            name = int.from_bytes(hashlib.blake2b(body.encode(), digest_size=8).digest(), "big", signed=True)
            out.append((m.start(), m.end(), encoding, length_class(len(body)), min(int(score / STEP), STEPS + 1), name))
    return out


def running_symbols(letters: np.ndarray, encoding: str, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of lines without tokens (``letters``, a code below 128 each, lines ending at ``stops``), where among them
    words begin, and for each of these where its line ends.

    Folded to one case where the alphabet has one. What is not in the alphabet goes; where the alphabet has a separator, a
    run of it between words becomes one, as in words that are joined to a token.
    """
    codes = _RUNNING[encoding][letters]
    gap = codes < 0
    begins = ~gap & np.append(True, gap[:-1])
    if encoding == "base64":
        keep = ~gap | np.append(False, ~gap[:-1])
        codes = np.where(gap, np.int16(62), codes)
    else:
        keep = ~gap
    kept = np.cumsum(keep)
    words = np.flatnonzero(begins)
    return codes[keep], kept[words] - 1, kept[stops[np.searchsorted(stops, words)]]


def null_scores(texts: list[str]) -> dict[tuple[str, int, int], int]:
    """Scores of running text: how often each (encoding, length class, step) occurs, all above the last step as one.

    Per alphabet and class of lengths every line of the texts is cut into stretches of the class's shortest length that don't overlap
    and begin with a word: each begins with the first word after the one before it, and all are scored.
    """
    out: dict[tuple[str, int, int], int] = {}
    raw = np.frombuffer((TOKEN.sub(" ", "\n".join(texts)) + "\n").encode("ascii", "replace"), np.uint8)
    stops = np.flatnonzero(raw == ord("\n"))
    for encoding, letters in ALPHABETS.items():
        codes, words, ends = running_symbols(raw, encoding, stops)
        if not len(words):
            continue
        codes, sums = codes.astype(np.int64), running_sums(codes, len(letters))
        words_before = np.zeros(len(codes) + LENGTHS[-1] + 1, np.int64)
        words_before[words + 1] = 1
        words_before = np.cumsum(words_before)
        for k, n in enumerate(LENGTHS):
            # Where the next stretch begins, for every word from which one fits into its text.
            room = words + n <= ends
            fits = np.flatnonzero(room)
            if not len(fits):
                continue
            ranks = np.append(0, np.cumsum(room))
            follows = ranks[words_before[words[fits] + n]].tolist()
            chosen, at, last = [], 0, len(fits)
            while at < last:
                chosen.append(at)
                at = follows[at]
            scores = stretch_scores(codes, sums, words[fits[chosen]], n, len(letters))
            steps = np.minimum(scores / STEP, STEPS + 1).astype(np.int64)
            for step, times in enumerate(np.bincount(steps).tolist()):
                if times:
                    out[encoding, k, step] = times
    return out


def paragraph_scores(docs: DataFrame, text: str = "text") -> DataFrame:
    """``encoding, length_class, step, n``: scores of the stretches of all different paragraphs (lines) of ``docs``.

    Equal paragraphs are combined in each task before they are dealt out, so one that a third of all documents hold is a row
    per task. A paragraph shorter than the shortest stretch has none.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int, int], int] = {}
        for batch in batches:
            for begin, end in runs(buffers(batch.column(0))[1]):
                for key, times in null_scores(batch.column(0).slice(begin, end - begin).to_pylist()).items():
                    total[key] = total.get(key, 0) + times
        if total:
            columns = [*zip(*total, strict=True), tuple(total.values())]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0]), *(pa.array(c, pa.int64()) for c in columns[1:])], ["encoding", "length_class", "step", "n"])

    paragraphs = docs.select(F.explode(F.split(docs[text], "\n")).alias("paragraph")).where(F.length("paragraph") >= LENGTHS[0])
    scored = paragraphs.distinct().mapInArrow(score, "encoding string, length_class long, step long, n long")
    return scored.groupBy("encoding", "length_class", "step").agg(F.sum("n").alias("n"))


Counts = dict[tuple[str, int], dict[int, int]]


def accepted_steps(null: Counts, found: Counts, q: float) -> dict[tuple[str, int], int]:
    """The largest score step that is accepted per (encoding, length class), by one Benjamini-Hochberg step at level ``q``
    over the tokens ``found`` in all of them. Classes in which nothing is accepted are left out.

    The p-value of a step is (1 + null scores of its class up to it) / (1 + null scores of its class).
    """
    tested = sum(n for steps in found.values() for n in steps.values())
    values: dict[tuple[str, int], list[float]] = {}
    for group in found:
        own, below = null.get(group, {}), 0
        values[group] = []
        for step in range(STEPS + 1):
            below += own.get(step, 0)
            values[group].append((1 + below) / (1 + sum(own.values())))
    ordered = sorted((values[group][step], n) for group, steps in found.items() for step, n in steps.items() if step <= STEPS)
    seen, level = 0, 0.0
    for p, n in ordered:  # of equal values the last one has seen them all
        seen += n
        if p <= q * seen / tested:
            level = p
    return {group: max(step for step, p in enumerate(ps) if p <= level) for group, ps in values.items() if ps[0] <= level}


def secret_spans(docs: DataFrame, q: float = 0.01, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, added`` for every row: spans (``kind, start, end`` in code points) of the fixed patterns, and of
    kind ``random`` those of the randomness battery, which touch no base span.

    One pass over whole texts finds spans and tokens and writes them to the shared folder; another scores the different
    paragraphs. Counts of scores (at most encodings x length classes x steps rows) go to the driver, which decides one
    threshold per encoding and length class; tokens are told apart by 64-bit hashes and counted once.
    NULL and empty text have no spans; every row gives one row, repeated ones too; other columns are ignored.
    """
    span = "struct<kind:string,start:bigint,end:bigint>"
    token = "struct<start:bigint,end:bigint,encoding:string,length_class:bigint,step:bigint,hash:bigint>"
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *T.StructType.fromDDL(f"base array<{span}>, tokens array<{token}>").fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = [
            pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])),
            pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.string()), ("length_class", pa.int64()), ("step", pa.int64()), ("hash", pa.int64())])),
        ]
        for batch in batches:
            for begin, end in runs(buffers(batch.column(1))[1]):
                bases, found = [], []
                for x in batch.column(1).slice(begin, end - begin).to_pylist():
                    spans = base_spans(x or "")
                    bases.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans])
                    found.append([dict(zip(("start", "end", "encoding", "length_class", "step", "hash"), t, strict=True)) for t in tokens(x or "", spans)])
                columns = [batch.column(0).slice(begin, end - begin), *(pa.array(v, t) for v, t in zip((bases, found), arrow, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    path = work_path(docs.sparkSession, "secrets")
    docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(scan, schema).write.parquet(path)
    scanned = docs.sparkSession.read.parquet(path)

    by = ["encoding", "length_class", "step"]
    seen = scanned.select(F.explode("tokens").alias("e")).select("e.*").select(*by, "hash").distinct().groupBy(*by).agg(F.count("*").alias("n"))
    counts: tuple[Counts, Counts] = ({}, {})
    for which, table in enumerate((paragraph_scores(docs, text), seen)):
        for encoding, k, step, n in table.collect():  # encodings x classes x steps rows at most
            counts[which].setdefault((encoding, k), {})[step] = n
    limits = accepted_steps(*counts, q)

    def accepted(t: Column) -> Column:
        verdict = F.lit(False)
        for (encoding, k), step in limits.items():
            verdict = verdict | ((t["encoding"] == encoding) & (t["length_class"] == k) & (t["step"] <= step))
        return verdict

    added = F.transform(F.filter("tokens", accepted), lambda t: F.struct(F.lit("random").alias("kind"), t["start"].alias("start"), t["end"].alias("end")))
    return scanned.select("doc_id", "base", added.alias("added"))


def masked(docs: DataFrame, q: float = 0.01, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mask``; spans that overlap or touch become one. Other columns
    and rows without secrets stay as they are."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[text].alias("text"))
    found = secret_spans(rows, q, "row", "text")
    spans = F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"], s["end"]))
    flat = found.select(*(F.col("doc_id")[c].alias(f"c{i}") for i, c in enumerate(docs.columns)), F.array_sort(spans).alias("spans"))
    names, at = docs.columns, docs.columns.index(text)

    def hide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, touched = list(batch.columns[:-1]), {}
            for i, spans_ in enumerate(batch.columns[-1].to_pylist()):
                if spans_:
                    whole, out, done = columns[at][i].as_py(), [], 0
                    for s in spans_:
                        start, end = s.values()
                        if start > done or not out:
                            out += [whole[done:start], mask]
                        done = max(done, end)
                    touched[i] = "".join(out) + whole[done:]
            if touched:
                values = columns[at].to_pylist()
                columns[at] = pa.array([touched.get(i, v) for i, v in enumerate(values)], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return flat.mapInArrow(hide, docs.schema)


def spelled_spans(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """``doc_id``, a count of base spans per kind, ``base_sha256`` and ``spans`` (base and added ones by start, then kind)."""

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    rank = F.create_map(*(F.lit(x) for pair in zip((*kinds, "random"), range(len(kinds) + 1), strict=True) for x in pair))
    every = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    counts = [F.size(F.filter(F.col("base")["kind"], F.lit(kind).eqNullSafe)).cast("long").alias(f"n_{kind}") for kind in kinds]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(every).alias("spans"))
