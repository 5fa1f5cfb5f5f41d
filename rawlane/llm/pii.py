"""Personal data by weak supervision: labelers vote on candidate spans, their reliabilities are estimated, a classifier decides.

Candidates are spans of a wide pattern per kind. Three families of labelers vote yes, no or nothing on each: regular
expressions and checksums (form), word lists (gazetteers), and what stands around a span (context). Spans are counted by
kind, votes and a few features. What is counted are settings: the words beside a span, with numbers and names masked. Of
each value one setting counts, and each setting once per votes and features, so neither copies of a passage, whatever
stands around them, nor lines made from one template, each with a number of its own, weigh more than one line. From that table, which has a bounded number of rows whatever the corpus,
expectation maximisation estimates how reliable every labeler is and how likely every pattern of votes is personal. A
labeler is taken to be better than chance, so its yes never counts against a span and its no never for it. A logistic
classifier of votes and features, fitted to these probabilities, then decides on every candidate span on which more
labelers say yes than no.

Lengths in the patterns of candidates are those that the formats allow (64 and 63 characters of an address, 34 of an
account number) or, for names, three words of 21 letters; longer look-alikes are no candidates. Labelers of context read
``CONTEXT_CHARS`` code points before a span, settings up to ``SETTING_WORDS`` words of its line on either side.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlane.llm.spans import Span, free_of
from rawlane.session import work_path

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("email_spelled", "phone_local", "national_id", "iban", "person")

# What the base scan is defined to find. Lookarounds only keep the search linear: they hold at every match.
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

#: Wide patterns of what else may be personal, the most particular first.
CANDIDATES = {
    "email_spelled": re.compile(r"\b[A-Za-z0-9][A-Za-z0-9._-]{1,63}\s?(?:\(at\)|\[at\]|\{at\})\s?[A-Za-z0-9-]{2,63}(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\})\s?[A-Za-z0-9-]{2,63}){1,3}\b", re.ASCII),
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b", re.ASCII),
    "national_id": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "phone_local": re.compile(r"(?<![0-9+.\-])(?:\([0-9]{2,4}\)\x20?|0[0-9]{1,4}[\x20/-]|[0-9]{3}[.\x20-])[0-9]{3,4}[.\x20-][0-9]{3,5}(?![0-9.\-])"),
    "person": re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Sr|Sra|Mme|Monsieur|Madame)\.?\x20[A-Z][a-z]{1,20}(?:\x20[A-Z][a-z]{1,20}){0,2}\b", re.ASCII),
}
# Gazetteers.
TOP_LEVEL = frozenset("com org net edu gov info io co uk de fr es it pt nl be ch at br mx us ca au jp cn in ru pl se no dk fi ie eu".split())
COUNTRIES_OF_IBAN = frozenset("AD AE AL AT AZ BA BE BG BH BR CH CR CY CZ DE DK EE ES FI FO FR GB GE GI GL GR HR HU IE IL IS IT LB LI LT LU LV MC MD ME MK MT NL NO PL PT RO RS SA SE SI SK SM TN TR UA".split())
GIVEN_NAMES = frozenset(
    "james mary john linda robert susan michael sarah william karen david laura thomas anna peter maria hans petra klaus ursula jean marie pierre sophie jose carmen juan lucia carlos ana paulo joao giulia marco".split()
)
NEAR = {
    "email_spelled": ("mail", "contact", "write", "reach", "kontakt", "correo", "courriel"),
    "phone_local": ("phone", "tel", "call", "mobile", "fax", "cell", "whatsapp", "telefon", "teléfono", "llam", "appel"),
    "national_id": ("ssn", "social security", "security number", "national id"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte", "transfer"),
    "person": ("name", "patient", "client", "contact", "born", "lives", "address", "nombre", "wohnt"),
}
AGAINST = ("version", "isbn", "order", "invoice", "part no", "model", "serial", "page", "example", "chapter", "figure")

LABELERS = ("form", "gazetteer", "context", "surroundings")
#: Code points before a span that the labeler of context reads; code points and words on either side that make a setting.
CONTEXT_CHARS, SETTING_CHARS, SETTING_WORDS = 40, 120, 3
#: Bounds of the weight (log odds) of a yes and of a no, and imagined spans per class that support a labeler beforehand.
YES_WEIGHT, NO_WEIGHT, ANCHOR = (math.log(1.5), math.log(50)), (math.log(1.5), math.log(50)), 20
#: How often a labeler that speaks is right, as assumed beforehand: a checksum says more than a shape. Others ``RIGHT``.
RIGHT, RIGHT_OF_FORM = 0.75, {"iban": 0.97, "national_id": 0.85, "phone_local": 0.9, "email_spelled": 0.85}


def luhn(digits: str) -> bool:
    doubled = (int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits)))
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches of local part, @, domain. Every match holds exactly one @, so these are where to look."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
            free = domain.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """The spans of the base kinds: by kind as listed, then by start."""
    out = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        out += (("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(_small(p) for p in m[0].split(".")))
        out += (("card", m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d))
        if "+" in text:
            out += (("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15)
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _iban_checks(value: str) -> bool:
    value = value.replace(" ", "")
    turned = value[4:] + value[:4]
    return 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _form(kind: str, value: str) -> int:
    if kind == "iban":
        return 1 if _iban_checks(value) else -1
    if kind == "national_id":
        area, group, serial = value.split("-")
        return 1 if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000" else -1
    if kind == "phone_local":
        if not 9 <= len(_digits(value)) <= 12:
            return -1
        return 1 if value[0] in "(0" or value.count("-") == 2 else 0  # groups of digits alone may be any numbers
    if kind == "email_spelled":
        return 1 if re.search(r"[(\[{]at[)\]}]", value) else 0
    return 1 if len(value.split()) >= 3 else 0


def _gazetteer(kind: str, value: str) -> int:
    if kind == "email_spelled":
        return 1 if re.split(r"[^A-Za-z]+", value)[-1].lower() in TOP_LEVEL else -1
    if kind == "iban":
        return 1 if value[:2] in COUNTRIES_OF_IBAN else -1
    if kind == "person":
        return 1 if any(w.lower() in GIVEN_NAMES for w in value.split()[1:]) else 0
    return 0


def votes(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    """What every labeler says of a span: 1 personal, -1 not, 0 nothing."""
    value, before = text[start:end], text[max(0, start - CONTEXT_CHARS) : start].lower()
    near, against = any(w in before for w in NEAR[kind]), any(w in before for w in AGAINST)
    glued = start > 0 and text[start - 1].isalnum() or end < len(text) and text[end].isalnum()
    return _form(kind, value), _gazetteer(kind, value), (1 if near else 0) - (1 if against else 0), -1 if glued else 0


def features(kind: str, text: str, start: int, end: int) -> tuple[int, ...]:
    """Features with few values: length (in steps), share of digits (in quarters), a line start or end beside the span, a
    colon or equals sign before it, a sign such as # or $ before it. None of them is what a labeler votes by."""
    value, before = text[start:end], text[max(0, start - 2) : start].rstrip()[-1:]
    edge = start == 0 or text[start - 1] == "\n" or end == len(text) or text[end] == "\n"
    return min(len(value) // 5, 7), round(4 * len(_digits(value)) / len(value)), int(edge), int(before in (":", "=")), int(before in tuple("#$%&*/"))


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _masked(word: str) -> str:
    """A word as settings have it: with a digit it is 0, with a capital A, else its letters alone."""
    return "0" if _DIGIT.search(word) else "A" if word[:1].isupper() else "".join(c for c in word if c.isalpha())


def setting(text: str, start: int, end: int) -> int:
    """Hash of the words beside a span on its line, numbers and names masked: equal for lines made from one template."""
    before = text[max(0, start - SETTING_CHARS) : start].rpartition("\n")[2].split()[-SETTING_WORDS:]
    after = text[end : end + SETTING_CHARS].partition("\n")[0].split()[:SETTING_WORDS]
    return _hash(" ".join([*map(_masked, before), "|", *map(_masked, after)]))


def candidate_spans(text: str, base: Sequence[Span]) -> list[tuple]:
    """Candidates that touch no base span and none of an earlier kind: kind, start, end, votes, features, setting, hash of the value."""
    taken, out = list(base), []
    for kind, pattern in CANDIDATES.items():
        free = free_of(taken)
        for m in pattern.finditer(text):
            if free(m.start(), m.end()):
                where = (kind, m.start(), m.end())
                taken.append(where)
                span = kind, text, m.start(), m.end()
                out.append((*where, list(votes(*span)), list(features(*span)), setting(*span[1:]), _hash(m[0])))
    return out


def _share(p: np.ndarray, n: np.ndarray) -> float:
    return float(np.clip((n @ p + ANCHOR) / (n.sum() + 2 * ANCHOR), 0.25, 0.75))


def vote_weights(chances: np.ndarray) -> np.ndarray:
    """Per labeler what a no, silence and a yes add to the log odds: on the vote's own side of zero, within bounds."""
    ratio = np.log(chances[:, 1] / chances[:, 0])
    return np.stack([-np.clip(-ratio[:, 0], *NO_WEIGHT), np.zeros(len(ratio)), np.clip(ratio[:, 2], *YES_WEIGHT)], 1)


def estimate(patterns: Sequence[Sequence[int]], counts: Sequence[int], right: Sequence[float] | None = None, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Expectation maximisation over vote patterns: P(personal) of each, and per labeler its chances of voting (-1, 0, 1)
    on spans that are not and that are personal.

    Starts from the majority of the votes. Per class and labeler ``ANCHOR`` imagined spans, on which a labeler that speaks
    is right as often as ``right`` says, keep chances apart from 0. What a vote adds to the log odds stays within
    ``YES_WEIGHT`` or ``NO_WEIGHT``, on its own side of zero, and silence adds nothing, so the classes cannot trade places
    and a frequent pattern cannot turn a labeler's no into a yes.
    """
    v, n = np.asarray(patterns, np.int64).reshape(len(counts), -1), np.asarray(counts, float)
    p = 1 / (1 + np.exp(-1.5 * v.sum(1)))
    labelers = np.arange(v.shape[1])
    r = np.full(len(labelers), RIGHT) if right is None else np.asarray(right, float)
    silent = np.ones(len(labelers))
    prior = ANCHOR / 2 * np.stack([np.stack([r, silent, 1 - r], 1), np.stack([1 - r, silent, r], 1)], 1)
    chances = np.zeros((len(labelers), 2, 3))
    for _ in range(rounds):
        share = _share(p, n)
        for j in labelers:
            for c, weight in enumerate((n * (1 - p), n * p)):
                mass = np.bincount(v[:, j] + 1, weight, 3) + prior[j, c]
                chances[j, c] = mass / mass.sum()
        odds = math.log(share / (1 - share)) + vote_weights(chances)[labelers, v + 1].sum(1)
        p = 1 / (1 + np.exp(-odds))
    return p, chances


def design(votes_: Sequence[int], features_: Sequence[int]) -> list[float]:
    yes, no = [float(x > 0) for x in votes_], [float(x < 0) for x in votes_]
    length, digits, *marks = features_
    return [1.0, *yes, *no, length / 7, digits / 4, *map(float, marks)]


def more_yes(votes_: Sequence[int]) -> bool:
    """Whether more labelers say yes than no; one at least has to."""
    return sum(votes_) > 0


def starting_weights(p: np.ndarray, n: np.ndarray, chances: np.ndarray, columns: int) -> np.ndarray:
    """The classifier that says what expectation maximisation says: weights of votes, none of features."""
    share, weights = _share(p, n), vote_weights(chances)
    votes_ = np.concatenate([[math.log(share / (1 - share))], weights[:, 2], weights[:, 0]])
    return np.concatenate([votes_, np.zeros(columns - len(votes_))])


def fit_classifier(x: np.ndarray, p: np.ndarray, n: np.ndarray, start: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic classifier fitted to probabilities, by Newton steps with a ridge that draws them to ``start``."""
    w = start.copy()
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (q - p)) + ridge * (w - start)
        curve = (x * (n * q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return w


def personal_spans(docs: DataFrame, least: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, added`` for every row: base spans (``kind, start, end`` in code points, end exclusive), and those
    that more labelers favour than oppose and the classifier gives a probability of ``least`` or more.

    Whole texts are scanned once; spans go to a table in the shared folder. The counts by kind, votes and features that go
    to the driver have at most kinds x 3^labelers x features rows. NULL and empty text have no spans; every row gives one
    row, repeated ones too; a NULL id stays; other columns are ignored; without any candidate nothing is added.
    """
    spark = docs.sparkSession
    schema = T.StructType.fromDDL("base array<struct<kind:string,start:bigint,end:bigint>>, candidates array<struct<kind:string,start:bigint,end:bigint,votes:array<int>,features:array<int>,setting:bigint,value:bigint>>")
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *schema.fields])
    span = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
    more = [("votes", pa.list_(pa.int32())), ("features", pa.list_(pa.int32())), ("setting", pa.int64()), ("value", pa.int64())]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [n for n, _ in span + more]
        for batch in batches:
            bases, candidates = [], []
            for value in batch.column(1):
                whole = value.as_py() or ""
                base = base_spans(whole)
                bases.append([dict(zip(names, s, strict=False)) for s in base])
                candidates.append([dict(zip(names, c, strict=True)) for c in candidate_spans(whole, base)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bases, pa.list_(pa.struct(span))), pa.array(candidates, pa.list_(pa.struct(span + more)))], schema.names)

    path = work_path(spark, "pii")
    docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(scan, schema).write.parquet(path)
    scanned = spark.read.parquet(path)
    each = scanned.select(F.explode("candidates").alias("c")).select("c.kind", "c.votes", "c.features", "c.value", "c.setting")
    each = each.groupBy("kind", "votes", "features", "value").agg(F.min("setting").alias("setting")).drop("value").distinct()
    counted = each.groupBy("kind", "votes", "features").count().orderBy("kind", "votes", "features").collect()
    accepted: dict[str, list[str]] = {}
    for kind in ADDED_KINDS:
        rows = [r for r in counted if r.kind == kind]
        if not rows:
            continue
        n = np.array([r["count"] for r in rows], float)
        p, chances = estimate([r.votes for r in rows], n, [RIGHT_OF_FORM.get(kind, RIGHT), *[RIGHT] * (len(LABELERS) - 1)])
        x = np.array([design(r.votes, r.features) for r in rows])
        score = 1 / (1 + np.exp(-np.clip(x @ fit_classifier(x, p, n, starting_weights(p, n, chances, x.shape[1])), -30, 30)))
        accepted[kind] = [_pattern(r.votes, r.features) for r, s in zip(rows, score, strict=True) if s >= least and more_yes(r.votes)]

    def chosen(c: Column) -> Column:
        named = F.concat_ws("/", F.array_join(c["votes"], ","), F.array_join(c["features"], ","))
        verdict = F.lit(False)
        for kind, patterns in accepted.items():
            if patterns:
                verdict = verdict | ((c["kind"] == kind) & named.isin(*patterns))
        return verdict

    added = F.transform(F.filter("candidates", chosen), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return scanned.select("doc_id", "base", added.alias("added"))


def _pattern(votes_: Sequence[int], features_: Sequence[int]) -> str:
    return ",".join(map(str, votes_)) + "/" + ",".join(map(str, features_))


def spelled_spans(found: DataFrame) -> DataFrame:
    """``doc_id``, a count of base spans per kind, ``base_sha256`` and ``spans`` (base ones by kind and start, then the
    added ones likewise)."""

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [F.size(F.filter(F.col("base")["kind"], F.lit(kind).eqNullSafe)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"))
