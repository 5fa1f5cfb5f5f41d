"""The queries against their SQL, and the pipeline's stages against what each has to do."""

import collections
import re

import pytest

import corpus_pipeline
from compare import as_frame, connect, normal
from rawlane.llm import queries, secrets
from tests.llm.test_sets import components, shingles
from tests.llm.test_texts import brute_measures

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    ours = as_frame(queries.QUERIES[name](spark, FOLDER))
    theirs = connect(FOLDER).execute(queries.ORACLE_SQL[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns) and normal(ours) == normal(theirs)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, tables[-1], FOLDER).write.parquet(str(tmp_path / name))
        tables.append(spark.read.parquet(str(tmp_path / name)))
    assert all(t.columns == docs.columns for t in tables[:-1])
    raw, good, single, unseen, clean, packed = ([tuple(r) for r in t.collect()] for t in tables)
    kept = {r.doc_id for r in queries.op6_quality_rules(spark, FOLDER).collect() if r.kept}
    assert sorted(good) == sorted(r for r in raw if r[0] in kept)
    assert all(brute_measures(r[1])[0] >= 50 for r in good)
    least, _ = components([(r[0], r[1]) for r in good], 5, 80)
    assert sorted(single) == sorted(r for r, c in zip(good, least, strict=True) if r[0] == c)
    wanted = [shingles(t, 5) for t in items]
    assert sorted(unseen) == sorted(r for r in single if not any(w and 100 * len(w & shingles(r[1], 5)) >= 80 * len(w) for w in wanted))
    before = {r[0]: r for r in unseen}
    assert {r[0] for r in clean} == set(before)
    for r in clean:
        spans = secrets.base_spans(before[r[0]][1])
        assert (r[1] == before[r[0]][1]) == (not spans) or "[SECRET]" in r[1]
        assert not secrets.base_spans(r[1]) and r[2:4] == before[r[0]][2:4] and r[4] == len(r[1])
        assert re.sub(r"\[SECRET\]", "", r[1]) != "" or spans
    assert {r[0] for r in packed} == set(before)
    lengths = collections.Counter()
    for doc_id, _, length, *_ in packed:
        lengths[doc_id] += length
    assert all(lengths[r[0]] == r[4] for r in packed)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, odd_docs, no_docs, name, stage):
    odd = odd_docs.select("doc_id", "text", "kept")
    got = stage(spark, odd, FOLDER)
    assert name == "packing" or got.columns == odd.columns
    assert (got.count() > 0) == (name != "quality")  # none of these has a common word
    assert stage(spark, no_docs, FOLDER).collect() == []
