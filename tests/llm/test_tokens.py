"""Token counts, token files and packing against the tokenizer itself."""

import collections
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rawlane.llm import arrow_text, counts, packing, tokenfiles
from rawlane.llm.subwords import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


ENCODER = WordEncoder(PATH)
LIBRARY = Tokenizer.from_file(PATH)
PIECES = st.sampled_from(
    ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "'s", "don't", "I'LL.", " ", "\n", "\x1c", "\x85", " ", "é", "é", "ß×÷", "Ünde.", "a,", ".", ",,", "½", "日本", "x" * 90, "A|b.", "\x0b", "ſ", "İ", "12.5"]
)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.one_of(PIECES, st.text(max_size=6)), max_size=8).map("".join), max_size=5))
def test_words_give_the_ids_of_the_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = [list(x[:-1]) for x in ENCODER.documents(pa.array(texts, pa.string()), 7)]
    assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert list(ENCODER.counts(pa.array(texts, pa.string()))) == [len(x) for x in got]


def opposites(n: int = 1024) -> list[str]:
    """Two words that agree under every polynomial hash modulo a power of two."""
    sides = [bin(i).count("1") % 2 for i in range(n)]
    return ["".join("ab"[x] for x in sides), "".join("ba"[x] for x in sides)]


def test_different_words_are_told_apart():
    words = [w for n in (8, 64, 256, 512, 1024) for w in opposites(n)]
    texts = pa.array(["x y z " + w for w in words] + words)
    got = [list(x[:-1]) for x in WordEncoder(PATH).documents(texts, 7)]
    assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts.to_pylist()]
    assert len({s.tobytes() for s in arrow_text.shingle_hashes(texts, 4)}) == len(texts)
    for lane in (0, 1):
        raw = np.frombuffer("".join(words).encode(), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        assert len(set(arrow_text.span_hashes(arrow_text.eights(raw), ends - [len(w) for w in words], ends, lane=lane).tolist())) == len(words)


def test_words_with_one_hash(monkeypatch):
    """Should two words ever have one hash, their texts are encoded as a whole."""
    from rawlane.llm import subwords

    real = arrow_text.span_hashes
    monkeypatch.setattr(subwords, "span_hashes", lambda *a, lane=0, **k: real(*a, lane=lane, **k) if lane else real(*a, **k) % np.uint64(3))
    words = WordEncoder(PATH)
    texts = pa.array(["one two three four five six seven. eight, nine", None, "", "ten one <|endoftext|>", "one"] * 3)
    want = [LIBRARY.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
    assert [list(x[:-1]) for x in words.documents(texts, 7)] == want
    assert words.counts(texts).tolist() == [len(w) for w in want]


def test_spans_with_equal_hashes_and_heads_are_equal():
    raw = np.frombuffer(b"a\0bcdefghi\0\0abcdefgh", np.uint8)
    words, seen = arrow_text.eights(raw), {}
    for start in range(len(raw)):
        for end in range(start, min(start + 8, len(raw)) + 1):
            at = np.array([start]), np.array([end])
            name = int(arrow_text.span_hashes(words, *at)[0]), int(arrow_text.span_heads(words, *at)[0])
            assert seen.setdefault(name, raw[start:end].tobytes()) == raw[start:end].tobytes()
    assert len(set(seen.values())) == len(seen)


def test_words_that_share_a_slot(monkeypatch):
    from rawlane.llm import subwords

    monkeypatch.setattr(subwords, "SLOT_BITS", 1)
    words = WordEncoder(PATH)
    texts = pa.array(["one two three four five six seven", None, "six one eight internationalisation Internationalisation, x"] * 2)
    for _ in range(2):
        assert [list(x[:-1]) for x in words.documents(texts, 7)] == [LIBRARY.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]


def test_long_texts_are_cut_before_white_space():
    text = "".join(f"word{i} " for i in range(5000)) + "x" * 3000
    parts = list(arrow_text.parts(pa.array(["a", text, "b"]), 1000))
    assert [row for row, _ in parts][:2] == [0, 1] and parts[-1][0] == 2
    assert "".join(p[0].as_py() for row, p in parts if row == 1) == text
    assert all(len(p[0].as_py()) <= 1000 or " " not in p[0].as_py()[1000:].strip() for _, p in parts)


def test_counts(spark, odd_docs, no_docs, library):
    rows = counts.token_counts(odd_docs, PATH, limit=100).collect()
    want = [(r.doc_id, len((r.text or "").encode()), len(ids_of(library, r.text))) for r in odd_docs.collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in rows], key=key) == sorted(want, key=key)
    assert all(r.over_limit == (r.n_tokens > 100) for r in rows)
    assert counts.token_counts(no_docs, PATH).collect() == []


def test_files_hold_all_ids_in_order(spark, odd_docs, no_docs, library, tmp_path):
    path = str(tmp_path / "tokens")
    tokenfiles.write_token_files(odd_docs, path, PATH, end_id=2)
    rows = sorted(tokenfiles.with_crc32(tokenfiles.read_tokens(spark, path)).collect(), key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    want = collections.Counter((r.doc_id, zlib.crc32(np.array([*ids_of(library, r.text), 2], "<u4").tobytes())) for r in odd_docs.collect())
    assert collections.Counter((r.doc_id, r.ids_crc32) for r in rows) == want
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    index = tokenfiles.token_index(spark, path)
    assert sorted(r.start for r in index.collect()) == [r.start for r in rows]
    assert "tokens:array" not in index._jdf.queryExecution().executedPlan().toString()
    empty = str(tmp_path / "none")
    tokenfiles.write_token_files(no_docs, empty, PATH, end_id=2)
    assert tokenfiles.read_tokens(spark, empty).collect() == []


def test_every_id_is_packed_once_without_padding(spark, odd_docs, no_docs, library):
    pieces = packing.pack(odd_docs, PATH, end_id=1, length=256).collect()
    filled = collections.defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length
        filled[p.sequence_id].append(p)
    for own in filled.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 256 and at & (at - 1) == 0
    want = collections.Counter()
    for r in odd_docs.collect():
        n = len(ids_of(library, r.text)) + 1
        want.update((r.doc_id, n, i) for i in range(n))
    got = collections.Counter()
    for p in pieces:
        got.update((p.doc_id, p.doc_tokens, p.start + i) for i in range(p.length))
    assert got == want
    texts = {tuple(ids_of(library, r.text)) + (1,) for r in odd_docs.collect()}
    for p in pieces:
        own = tuple(np.frombuffer(p.ids, "<u4"))
        assert any(t[p.start : p.start + p.length] == own for t in texts if len(t) == p.doc_tokens)
    assert packing.pack(no_docs, PATH, end_id=1).collect() == []


def test_hilbert_keys_make_a_curve(monkeypatch):
    monkeypatch.setattr(packing, "BITS", 3)
    axes = np.array(np.meshgrid(*[np.arange(8)] * 3, indexing="ij")).reshape(3, -1).T
    keys = packing.hilbert_keys(axes)
    assert sorted(keys) == list(range(512))
    path = axes[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_near_copies_lie_together_on_the_curve():
    from tests.llm.conftest import prose

    texts = [prose(i, 300) for i in range(50)]
    near = [t.replace("alpha", "omega", 1) for t in texts]
    keys = packing.hilbert_keys(packing.curve_points(pa.array(texts + near)))
    order = np.argsort(np.argsort(keys))
    assert np.median(np.abs(order[:50] - order[50:])) <= 3


def test_ranges_of_equal_bytes(spark):
    """Long documents, copies of one document and a third of all rows at one place are spread by their bytes."""
    rng = np.random.default_rng(1)
    n = 6000
    curve = np.where(rng.random(n) < 1 / 3, 77, rng.integers(0, 1 << 40, n))
    sizes = np.where(curve % 50 == 0, 300_000, rng.integers(0, 6000, n))
    tie = rng.integers(-(1 << 62), 1 << 62, n)
    keys = spark.createDataFrame(pa.table({"curve": curve, "tie": tie, "bytes": sizes}))
    cuts = packing._cuts(keys, partitions=12, most_bytes=1 << 30)
    where = packing._range_of(curve, tie, cuts)
    order = np.lexsort((tie, curve))
    assert (np.diff(where[order]) >= 0).all() and set(where) == set(range(12))
    held = np.bincount(where, sizes)
    assert held.max() < 2 * np.median(held)
    assert len(packing._cuts(keys, partitions=1, most_bytes=1 << 20)[0]) == -(-int(sizes.sum()) >> 20) - 1
    assert len(packing._cuts(keys.limit(0), partitions=8, most_bytes=1 << 30)[0]) == 0
