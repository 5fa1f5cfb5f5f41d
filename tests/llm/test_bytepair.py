"""Byte-level BPE against the tokenizer library, and a round trip."""

import base64
import collections
import hashlib
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rawlane.llm import bytepair

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
with open(PATH, "rb") as _file:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, _file)}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PARTS = st.sampled_from(
    ["'s", "'re", "'r", "'", "''", "'ll", "'lL", "'t", " ", "  ", "\n", "\n ", "\t", " ", "　", "\x85", "\x1c", "a", "word", "é", "日本", "12", "½", "Ⅷ", "!", "!?", "_", "👩‍👧", "́", "x" * 40, " ", "\U000105c0", "\U00010d40", "-'s"]
)
TEXTS = st.lists(st.one_of(PARTS, st.text(max_size=4)), max_size=12).map(lambda x: "".join(x).encode("utf-8", "ignore").decode())


def ids_of(texts):
    out = [[] for _ in texts]
    for row, ids, bounds in bytepair.ranks(PATH).encode(pa.array(texts, pa.string())):
        for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True), row):
            out[i] += ids[a:b].tolist()
    return out


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXTS), max_size=6))
def test_ids_are_the_librarys(texts):
    assert ids_of(texts) == [LIBRARY.encode_ordinary(t or "") for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=30).map("".join), st.integers(1, 40))
def test_long_texts_in_chunks(text, chunk):
    before = bytepair.CHUNK
    bytepair.CHUNK = chunk
    try:
        assert ids_of(["a b", text, "c"])[1] == LIBRARY.encode_ordinary(text)
    finally:
        bytepair.CHUNK = before


@settings(max_examples=200, deadline=None)
@given(TEXTS.filter(bool))
def test_pieces_are_the_patterns_matches(text):
    known = "".join(c for c in text if unicodedata.category(c) != "Cn") or "a"  # of an age that both libraries know
    ((_, data, starts, _),) = bytepair.pieces(pa.array([known]))
    ends = [*starts.tolist(), len(data)]
    assert [data[a:b].decode() for a, b in zip(ends, ends[1:], strict=False)] == regex.findall(public_tokenizers.PATTERN, known)


def test_scan_composes_functions():
    rng = np.random.default_rng(1)
    for n in (1, 2, 63, 64, 65, 4097, 9000):
        functions, state = rng.integers(0, 16, n).astype(np.uint8), bytepair.DONE
        got = bytepair._VALUES[bytepair.scanned(functions), bytepair.DONE]
        for f, after in zip(functions, got, strict=True):
            state = bytepair._VALUES[f, state]
            assert state == after


def test_long_pieces_and_forgetting(monkeypatch):
    texts = ["ab" * 3000, "z" * 5000 + " " * 5000, "日" * 2000, "'" * 999, "\n" * 3000 + "x", "e1" * 2000]
    want = [LIBRARY.encode_ordinary(t) for t in texts]
    assert ids_of(texts) == want
    monkeypatch.setattr(bytepair, "REMEMBERED_BYTES", 100)
    monkeypatch.setattr(bytepair, "TOGETHER_BYTES", 4000)
    monkeypatch.setattr(bytepair, "DECODED_TOGETHER", 7)
    assert ids_of(texts) == want and ids_of(texts[::-1]) == want[::-1]
    vocabulary = bytepair.ranks(PATH)
    for text, ids in zip(texts, want, strict=True):
        lengths = vocabulary.lengths[ids]
        assert vocabulary.text(np.array(ids), np.cumsum(lengths) - lengths).decode() == text


def test_all_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("x")).withColumn("offsets", F.lit("y"))
    encoded = bytepair.encode(docs, PATH)
    rows = bytepair.decode(encoded, PATH).collect()
    want = [(r.doc_id, LIBRARY.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect()]
    digest = lambda i, ids, text: (i, len(ids), np.array(ids, "<u4").tobytes(), hashlib.sha256(text).hexdigest())
    assert collections.Counter((r.doc_id, r.n_tokens, bytes(r.ids), hashlib.sha256(r.decoded).hexdigest()) for r in rows) == collections.Counter(digest(*w) for w in want)
    for r in encoded.where("n_tokens > 0").limit(5).collect():
        ids, offsets = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.offsets, "<u4")
        whole = bytepair.ranks(PATH).text(ids, offsets.astype(np.int64))
        part = bytepair.ranks(PATH).text(ids[3:6], offsets[3:6].astype(np.int64))
        assert whole[offsets[3] :].startswith(part) if len(ids) > 3 else part == b""
    assert bytepair.decode(bytepair.encode(no_docs, PATH), PATH).collect() == []
    with pytest.raises(ValueError):
        bytepair.ranks(PATH).text(np.array([5, 6, 7]), np.array([0, 2, 3]))
