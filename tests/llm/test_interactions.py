"""The filter audit against one document after another through every order."""

import collections
import itertools
import random
import re

import duckdb

from rawlane.llm import interactions
from tests.llm.conftest import prose

WORD = re.compile("[^\x20\x09-\x0d]+")


def failures(doc_id, text, rows):
    text = text or ""
    words = WORD.findall(text)
    out = {c for c, bad in zip("ABCD", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text), any(c in "#$%&*|" for c in text)), strict=True) if bad}
    if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows):
        out.add("E")
    return out


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    own = [(s or "", failures(i, t, rows), i in good, i in toxic) for i, t, s in rows]
    out = {}
    for part in {p for p, *_ in own}:
        docs, taken = [d[1:] for d in own if d[0] == part], collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = list(docs)
            for step, c in enumerate(order, 1):
                removed = [d for d in left if c in d[0]]
                left = [d for d in left if c not in d[0]]
                taken[c] += len(removed)
                fails = sum(c in d[0] for d in docs)
                out[part, "".join(order), step] = [len(left), len(removed), fails - len(removed), sum(d[0] == {c} for d in docs), sum(d[1] for d in removed), sum(d[2] for d in removed)]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(taken[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def sample():
    rng = random.Random(3)
    long = [prose(i, 220) for i in range(6)]
    kinds = [
        "few words", "", None, "A B C", " \n", *long,
        " ".join(["again and again"] * 100), " ".join(f"w{i}" for i in range(100)) + " $" + " x" * 100,
        " ".join(f"Up{i}" for i in range(250)), " ".join(f"UP{i}#" for i in range(250)), "x y " * 150 + "#",
    ]
    rows = [(i, rng.choice(kinds), rng.choice(["a", "b", None, ""])) for i in range(300)]
    rows += [rows[5], rows[5], (7, long[0], "c"), (None, long[0], "c"), (None, "few words", "a"), (8, long[1], None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 300, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    return rows, labels


def test_every_step_of_every_order(spark, monkeypatch):
    rows, labels = sample()
    docs = spark.createDataFrame([(*r, 1, 2, "k") for r in rows], "doc_id long, text string, source string, mask int, n int, part string")
    flags = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, id string")
    want = plain_audit(rows, labels)
    for piece in (1 << 20, 50):
        monkeypatch.setattr(interactions, "PIECE_BYTES", piece)
        got = interactions.filter_audit(docs, flags).collect()
        assert len(got) == len(want) == 600 * 4
        assert {tuple(r[:3]): tuple(r[3:]) for r in got} == want
    with duckdb.connect() as db:
        named = [(i, t, s) for i, t, s in rows if i is not None]
        db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
        db.executemany("INSERT INTO documents VALUES (?, ?, ?)", named)
        db.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
        db.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
        cursor = db.execute(interactions.SQL)
        names = [d[0] for d in cursor.description]
        found = [dict(zip(names, r, strict=True)) for r in cursor.fetchall()]
    want = plain_audit(named, labels)
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in interactions.OUTCOMES) for r in found} == want


def test_no_rows(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interactions.filter_audit(no_docs, labels, part="lang").collect() == []
    docs = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    rows = interactions.filter_audit(docs, labels).collect()
    assert len(rows) == 600 and {r.part for r in rows} == {""} and sum(r.removed for r in rows) == 120


def test_fields_hold_large_counts():
    counters = interactions.Counters("ABCDE")
    n = 10**15
    total = n * counters.packed(0b10101, True, False) + 3 * counters.packed(0, False, True)
    fields = counters.unpacked(total, n + 3)
    assert set(fields[:, 0].tolist()) == {3, n + 3} and fields[:, 6].sum() == 120 * 120 * n
    try:
        counters.unpacked(total, 1 << 62)
    except OverflowError:
        return
    raise AssertionError("no overflow was seen")
