"""The Jaccard join, decontamination and components against brute force."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rawlane.llm import decontaminate, setjoin
from rawlane.llm.components import connected_components

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(FOLD))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())


def components(rows, width, percent):
    """Row number -> smallest id reachable, by comparing all pairs."""
    sets, parent = [shingles(t, width) for _, t in rows], list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(doc_id)
    return [rows[i][0] if not sets[i] else min((x for x in ids[find(i)] if x is not None), default=None) for i in range(len(rows))], sets


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("most", [2048, 3])
def test_join_of_odd_rows(spark, odd_docs, no_docs, monkeypatch, most):
    monkeypatch.setattr(setjoin, "GROUP_NODES", most)
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    least, sets = components(rows, 4, 85)
    want = [(i, len(s), c) for (i, _), s, c in zip(rows, sets, least, strict=True)]
    got = setjoin.similar_sets(odd_docs, width=4, percent=85).select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, got)) == order(want)
    assert setjoin.similar_sets(no_docs).collect() == []


@pytest.mark.parametrize("most", [2048, 8])
def test_join_of_random_rows(spark, monkeypatch, most):
    """Families of copies with few and with many changes, all with one long passage in common."""
    monkeypatch.setattr(setjoin, "GROUP_NODES", most)
    monkeypatch.setattr(setjoin, "FREQUENT_MEMBERS", 2)
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for family in range(12):
        base = [rng.choice("abcdefghij") + str(rng.randrange(30)) for _ in range(rng.randrange(8, 90))]
        for _ in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(own + passage if family % 2 else own)))
    least, sets = components(rows, 5, 80)
    got = setjoin.similar_sets(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_shingles", "component_id").collect()
    assert order(map(tuple, got)) == order((i, len(s), c) for (i, _), s, c in zip(rows, sets, least, strict=True))


def test_one_of_each_component_stays(spark, odd_docs):
    stay = setjoin.one_of_each(odd_docs)
    assert stay.columns == odd_docs.columns
    got = [(r.doc_id, r.text) for r in stay.collect()]
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    least, sets = components(rows, 5, 80)
    linked = [(i, t) for i, t in got if shingles(t, 5)]
    assert sorted(str(i) for i, _ in linked) == sorted(["0", "3", "3", "7", "9", "10", "11", "12"])  # of id 3 two texts
    assert sum(not shingles(t, 5) for _, t in got) == sum(not s for s in sets)  # those without words all stay


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(1, 1), (5, 3), (3, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 7 for i in [7, *range(200, 260)]} | {3: 3, 5: 3}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_items_inside_documents(spark, odd_docs, no_docs):
    texts = {r.doc_id: r.text for r in odd_docs.collect() if r.text}
    words = texts[9].split()
    items = [(1, " ".join(words[20000:20040])), (2, " ".join([*words[5:25], "gone", *words[26:70]])), (3, "two words"), (4, None), (5, ""), (6, "nowhere to be found in any of them"), (None, " ".join(words[9:29]).upper())]
    items += [(7, " ".join([*words[100:110], "a", "b", "c", "d", *words[110:115]]))]  # less than 80 per cent
    table = spark.createDataFrame([(*x, 5) for x in items], "item_id long, text string, n_item int")
    want = []
    for r in odd_docs.collect():
        for i, t in items:
            item = shingles(t, 5)
            both = len(item & shingles(r.text, 5))
            if item and 100 * both >= 80 * len(item):
                want.append((r.doc_id, i, both, len(item)))
    assert {x[1] for x in want} == {1, 2, 3, None}
    for sent in (1 << 20, 0):
        got = decontaminate.contaminated(odd_docs, table, sent_shingles=sent)
        assert order(map(tuple, got.select("doc_id", "item_id", "n_shared", "n_item").collect())) == order(want)
    assert decontaminate.contaminated(no_docs, table).collect() == []
    assert decontaminate.contaminated(odd_docs, table.where(F.lit(False))).collect() == []


def test_documents_that_share_no_shingle(spark):
    """Two words that a polynomial hash takes for one are two."""
    from tests.llm.test_tokens import opposites

    rows = [(i, f"x y z {w}") for i, w in enumerate(opposites())]
    got = setjoin.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"), width=4, percent=85).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(0, 0), (1, 1)]
    bench = spark.createDataFrame([(7, " ".join(["a b c d", opposites()[0]]))], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"a b c d {w}") for i, w in enumerate(opposites())], "doc_id long, text string")
    assert [r.doc_id for r in decontaminate.contaminated(docs, bench).collect()] == [0]


def test_columns_named_like_those_of_the_stage(spark):
    rows = [(1, "one two three four five six", "h", 5, "e", "k", 0.5), (2, "one two three four five six", "h2", 6, "e2", "k2", 1.5)]
    names = "doc_id long, text string, _hash string, _hash_of_text int, _each string, row string, own_hash double"
    docs = spark.createDataFrame(rows, names)
    kept = setjoin.one_of_each(docs)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [rows[0]]


def test_asking_again_joins_no_pairs(spark, settings, monkeypatch):
    """Families of two that share a passage and are not linked: no join has a row per pair of families and token."""
    rng, rows = random.Random(3), []
    passage = [f"p{i}" for i in range(40)]
    for family in range(48):
        own = [f"w{rng.randrange(10**6)}" for _ in range(20)]
        rows += [(2 * family, " ".join(own + passage)), (2 * family + 1, " ".join([*own[:-1], f"x{family}", *passage, "end"]))]
    monkeypatch.setattr(setjoin, "GROUP_NODES", 16)
    monkeypatch.setattr(setjoin, "FREQUENT_MEMBERS", 1000)
    written, most, sizes = setjoin._written, {}, {}

    def joins(plan):
        below = plan.children()
        own = [plan.metrics().apply("numOutputRows").value()] if "Join" in plan.nodeName() else []
        return own + [n for i in range(below.size()) for n in joins(below.apply(i))]

    def counted(df, path):
        name = path.rsplit("/", 1)[1]
        df._jdf.queryExecution().toRdd().count()
        most[name] = max(joins(df._jdf.queryExecution().executedPlan()), default=0)
        out = written(df, path)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(setjoin, "_written", counted)
    with settings(spark__sql__adaptive__enabled="false"):
        got = setjoin.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"), width=4, percent=70).select("doc_id", "n_shingles", "component_id").collect()
    least, sets = components(rows, 4, 70)
    assert order(map(tuple, got)) == order((i, len(s), c) for (i, _), s, c in zip(rows, sets, least, strict=True))
    assert len(set(least)) == 48 and sizes["worth"] > 48
    assert max(most[name] for name in ("apart", "rest") if name in most) <= 2 * most["worth"], (most, sizes)


def test_sets_of_a_batch_come_in_runs_of_bounded_memory():
    """All texts of a batch at once took several times the batch's bytes, per task."""
    texts = pa.array([" ".join(f"w{i}x{j}" for j in range(300)) for i in range(4000)], pa.large_string())
    whole = setjoin.shingle_hashes(texts, 5)
    tracemalloc.start()
    place = 0
    for begin, sets in setjoin._set_runs(texts, 5):
        assert begin == place
        for own in sets:
            assert np.array_equal(own, whole[place])
            place += 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert place == len(texts)
    assert peak < 16 * setjoin.RUN_BYTES < 2 * texts.nbytes
