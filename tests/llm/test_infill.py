"""Fill-in-the-middle against a plain version, and the skip list against running sums."""

import collections
import hashlib
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rawlane.llm import infill

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def plain_version(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return (doc_id, len(units), "plain", None, None, text)
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return (doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}")
    return (doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


TEXTS = st.text(alphabet=st.sampled_from(list("ab \t\n\x0b\x1c\x85 é日👩<P>SM")), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXTS), min_size=1, max_size=8))
def test_places_of_all_ranks(texts):
    units, chars = infill.unit_widths(pa.array(texts, pa.string()))
    lists, own = infill.SkipList(units, chars), [UNIT.findall(t or "") for t in texts]
    assert list(units) == [len(u) for u in own]
    asked = [(i, k) for i, u in enumerate(own) for k in range(len(u) + 1)]
    want = [len("".join(own[i][:k])) for i, k in asked]
    i, k = (np.array(x, np.int64) for x in zip(*asked, strict=True))
    assert lists.places(i, k).tolist() == want


def test_express_lanes_pass_many_units():
    text = " ".join(f"w{i}é" for i in range(20000))
    units, chars = infill.unit_widths(pa.array(["a b", text, None]))
    lists = infill.SkipList(units, chars)
    assert len(lists.lanes) > 5 and max(lists.lanes[-1].units) > 500
    ranks = np.array([0, 1, 9999, 19999, 20000])
    want = [0, *np.cumsum([len(u) for u in UNIT.findall(text)])[ranks[1:] - 1]]
    assert lists.places(np.full(5, 1), ranks).tolist() == want


def test_all_rows(spark, odd_docs, no_docs):
    more = [(i, f"some  words <{'M>' if i % 7 == 0 else 'M'} and\tsomething é{i} else \n" * (i % 5)) for i in range(100, 300)]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    rows = infill.fill_in_middle(docs).withColumn("restored", infill.restored(F.col("output"), F.col("form"))).collect()
    got = collections.Counter(tuple(r)[:6] for r in rows)
    given_rows = docs.collect()
    assert got == collections.Counter(plain_version(*r) for r in given_rows)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert collections.Counter((r.doc_id, r.restored) for r in rows) == collections.Counter((i, t or "") for i, t in given_rows)
    with duckdb.connect() as db:
        db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
        db.executemany("INSERT INTO documents VALUES (?, ?)", given_rows)
        names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
        found = db.execute(f"SELECT {', '.join(names)} FROM ({infill.SQL})").fetchall()
    digest = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    assert collections.Counter(found) == collections.Counter((*p[:5], digest(p[5]), digest(r[1])) for r, p in ((r, plain_version(*r)) for r in given_rows))
    clashing = infill.fill_in_middle(odd_docs.withColumn("form", F.lit(1)).withColumn("output", F.lit("x")))
    assert clashing.count() == odd_docs.count()
    assert infill.fill_in_middle(no_docs).collect() == []


def test_marks_that_could_be_read_in_two_ways(spark, no_docs):
    for marks in (("<P>", "<P>", ""), ("aba", "<S>", "<M>"), ("<P>", "P><", "<M>"), ("<P>", "x<P>", "<M>")):
        with pytest.raises(ValueError):
            infill.fill_in_middle(no_docs, marks=marks)
