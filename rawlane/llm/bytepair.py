"""Byte-level BPE by a file of ranks: texts to ids and ids to texts.

Where pieces begin is found without regular expressions. Every code point becomes a symbol (its class, and what matters of
its next ones); every symbol is a function between the states of a small automaton; functions are put together by an
associative scan over whole arrays, so the state before each code point, and with it whether a piece begins there, comes
from a few array operations. The automaton is that of the pattern which the public byte-level vocabularies share:
contractions, letters, numbers and other signs with a space before them, white space, of which the last goes to what follows.

Pieces are merged once and remembered by their bytes. Where each id's bytes begin is kept beside the ids, so any of them can
be decoded by itself.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rawlane.llm.arrow_text import buffers, runs

#: Code points of a long text that are looked at together.
CHUNK = 1 << 18
#: Different pieces, and bytes of them, remembered by a process; beyond that it starts afresh.
REMEMBERED, REMEMBERED_BYTES = 1 << 18, 1 << 24
#: Pieces up to this length are merged many at a time, longer ones (few) one by one.
TOGETHER_BYTES = 64
#: Ids that are decoded at a time.
DECODED_TOGETHER = 1 << 16

LETTER, NUMBER, OTHER, CONTRACTION_2, CONTRACTION_3, INNER_SPACE, LAST_BLANK, LAST_SPACE = SYMBOLS = range(8)
# States: what the code points since the last beginning are. A blank is a U+0020 that the next piece begins with.
LETTERS, NUMBERS, OTHERS, SPACES, BLANK, DONE, ONE_LEFT, TWO_LEFT = STATES = range(8)


def _next(symbol: int, state: int) -> tuple[int, bool]:
    """The state after a symbol, and whether a piece begins with it."""
    if symbol == LETTER and state in (ONE_LEFT, TWO_LEFT):
        return (DONE if state == ONE_LEFT else ONE_LEFT), False
    if symbol in (CONTRACTION_2, CONTRACTION_3) and state in (OTHERS, BLANK):
        return OTHERS, False  # an apostrophe within a run of signs
    after = {LETTER: LETTERS, NUMBER: NUMBERS, OTHER: OTHERS, CONTRACTION_2: ONE_LEFT, CONTRACTION_3: TWO_LEFT, INNER_SPACE: SPACES, LAST_BLANK: BLANK, LAST_SPACE: DONE}[symbol]
    goes_on = state == after and symbol in (LETTER, NUMBER, OTHER, INNER_SPACE) or state == BLANK and symbol in (LETTER, NUMBER, OTHER)
    return after, not goes_on


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions that sequences of symbols amount to: their table of composition, their values, the identity's number last.

    Numbers below 8 are the symbols' own functions, the next 8 those of symbols that begin a text.
    """
    own = [tuple(_next(symbol, state)[0] for state in STATES) for symbol in SYMBOLS]
    functions = own + [(f[DONE],) * len(STATES) for f in own]
    known = {f: i for i, f in reversed(list(enumerate(functions)))}
    for f in functions:  # grows while it is read
        for g in own:
            if (h := tuple(g[x] for x in f)) not in known:
                known[h] = len(functions)
                functions.append(h)
    functions.append(tuple(STATES))
    known.setdefault(functions[-1], len(functions) - 1)
    table = np.array([[known[tuple(g[x] for x in f)] for g in functions] for f in functions], np.uint8)
    return table, np.array(functions, np.uint8), np.array([[_next(symbol, state)[1] for state in STATES] for symbol in SYMBOLS])


_TABLE, _VALUES, _BEGINS = _monoid()
_IDENTITY = len(_TABLE) - 1
_FLAT = _TABLE.ravel()


def scanned(functions: np.ndarray) -> np.ndarray:
    """For every place the composition of the functions up to it."""
    width = 64 if len(functions) > 64 else max(len(functions), 1)
    rows = -(-len(functions) // width)
    grid = np.full(rows * width, _IDENTITY, np.uint8)
    grid[: len(functions)] = functions
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    for j in range(1, width):
        grid[j] = _FLAT[grid[j - 1].astype(np.intp) * len(_TABLE) + grid[j]]
    if rows > 1:
        before = scanned(grid[-1])[:-1].astype(np.intp) * len(_TABLE)
        grid[:, 1:] = _FLAT[before + grid[:, 1:]]
    return grid.T.ravel()[: len(functions)]


_CLASSES: list[np.ndarray] = []


def code_point_classes() -> np.ndarray:
    """LETTER, NUMBER, INNER_SPACE or OTHER for every code point, as the tokenizer library's own tables have them.

    Python's tables may be of another version of Unicode. The library is asked once per process, with a vocabulary of bare
    bytes: it leaves out what its pattern doesn't match.
    """
    if not _CLASSES:
        every = np.arange(0x110000, dtype="<u4")
        every = every[(every < 0xD800) | (every > 0xDFFF)]
        classes = np.full(0x110000, OTHER, np.uint8)
        for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", INNER_SPACE)):
            asked = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
            for some in np.array_split(every, 32):
                matched = bytes(asked.encode_ordinary(some.tobytes().decode("utf-32-le")))
                classes[np.frombuffer(matched.decode().encode("utf-32-le"), "<u4")] = kind
        _CLASSES.append(classes)
    return _CLASSES[0]


def symbols(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The symbol of every code point of texts that begin at ``firsts``."""
    out = code_point_classes()[points]
    followed = np.ones(len(points) + 1, bool)  # by a code point of the same text
    followed[firsts] = False
    followed[-1] = False
    followed = followed[1:]
    spaces = np.flatnonzero(out == INNER_SPACE)
    following = np.minimum(spaces + 1, len(points) - 1)
    last = spaces[followed[spaces] & (out[following] != INNER_SPACE)]
    out[last] = np.where(points[last] == 0x20, LAST_BLANK, LAST_SPACE)
    marks = np.flatnonzero((points == ord("'")) & followed)
    if len(marks):
        one = points[marks + 1]
        two = np.where(followed[marks + 1], points[np.minimum(marks + 2, len(points) - 1)], 0)
        out[marks[np.isin(one, [ord(c) for c in "stmd"])]] = CONTRACTION_2
        out[marks[np.isin(one * 0x200000 + two, [ord(a) * 0x200000 + ord(b) for a, b in ("re", "ve", "ll")])]] = CONTRACTION_3
    return out


def beginnings(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where pieces begin among the code points of texts that begin at ``firsts`` (ascending, without empty texts)."""
    own = symbols(points, firsts)
    functions = own.copy()
    functions[firsts] += len(SYMBOLS)
    before = np.append(np.uint8(DONE), _VALUES[scanned(functions)[:-1], DONE])
    begins = _BEGINS[own, before]
    begins[firsts] = True
    return np.flatnonzero(begins)


def _points(data: bytes) -> np.ndarray:
    return np.frombuffer(data.decode().encode("utf-32-le"), "<u4").astype(np.int64)


def _cut_long(data: bytes) -> Iterator[tuple[bytes, np.ndarray]]:
    """Parts of one text with the beginnings of their pieces (in bytes). A part ends where a piece does: there the automaton
    starts afresh. The last two code points of a chunk may need those after them, so nothing is decided there."""
    at, size = 0, CHUNK
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        part = data[at:end]
        starts = beginnings(_points(part), np.zeros(1, np.int64))
        leads = np.flatnonzero((np.frombuffer(part, np.uint8) & 0xC0) != 0x80)
        if end < len(data):
            starts = starts[starts < len(leads) - 2]
            if len(starts) < 2:
                size *= 2
                continue
            part, starts = part[: leads[starts[-1]]], starts[:-1]
        yield part, leads[starts]
        at, size = at + len(part), CHUNK


def pieces(column: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray]]:
    """Runs of texts: number of the first row, bytes, where pieces begin, pieces before each text.

    A long text comes in several runs of one text each; concatenated they are the whole text.
    """
    raw, offsets = buffers(column)
    for begin, end in runs(offsets):
        data = raw[offsets[begin] : offsets[end]].tobytes()
        if end == begin + 1 and len(data) > CHUNK:
            for part, starts in _cut_long(data):
                yield begin, part, starts, np.array([0, len(starts)])
            continue
        leads = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
        bounds = offsets[begin : end + 1] - offsets[begin]
        filled = bounds[:-1][np.diff(bounds) > 0]
        starts = leads[beginnings(_points(data), np.searchsorted(leads, filled))] if len(data) else np.zeros(0, np.int64)
        yield begin, data, starts, np.searchsorted(starts, bounds)


class Ranks:
    """A vocabulary of ranks, and the pieces merged so far."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        tokens = sorted(self.ranks, key=self.ranks.__getitem__)
        self.lengths = np.zeros(self.ranks[tokens[-1]] + 1, np.int64)
        self.lengths[[self.ranks[t] for t in tokens]] = [len(t) for t in tokens]
        self.firsts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.pairs: tuple[np.ndarray, np.ndarray] | None = None
        self._forget()

    def _forget(self) -> None:
        self.codes: dict[bytes, int] = {}  # number of every piece met so far
        self.ids, self.bounds = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)
        self.held = 0

    def _keep(self, found: list[bytes], ids: np.ndarray, counts: np.ndarray) -> None:
        known, used = len(self.codes), int(self.bounds[len(self.codes)])
        while known + len(found) + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        while used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[used : used + len(ids)] = ids
        self.bounds[known + 1 : known + len(found) + 1] = used + np.cumsum(counts)
        self.codes.update(zip(found, range(known, known + len(found)), strict=True))
        self.held += sum(map(len, found))

    def _learn(self, found: set[bytes]) -> None:
        whole = [x for x in found if x in self.ranks]
        self._keep(whole, np.array([self.ranks[x] for x in whole], np.int32), np.ones(len(whole), np.int64))
        short = [x for x in found if len(x) <= TOGETHER_BYTES and x not in self.ranks]
        if short:
            if self.pairs is None:
                self.pairs = pair_ranks(self.ranks)
            self._keep(short, *merged_together(short, self.ranks, *self.pairs))
        for x in found:
            if len(x) > TOGETHER_BYTES and x not in self.ranks:
                ids = merge(x, self.ranks)
                self._keep([x], np.array(ids, np.int32), np.array([len(ids)]))

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Runs of texts: number of the first row, ids of its texts one after another, ids before each text."""
        for row, data, starts, firsts in pieces(column):
            if len(self.codes) > REMEMBERED or self.held > REMEMBERED_BYTES:
                self._forget()
            ends = [*starts.tolist(), len(data)]
            slices = [data[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            if found := set(slices).difference(self.codes):
                self._learn(found)
            codes = np.fromiter(map(self.codes.__getitem__, slices), np.int64, len(slices))
            lengths = self.bounds[codes + 1] - self.bounds[codes]
            before = np.append(0, np.cumsum(lengths))
            yield row, self.ids[np.repeat(self.bounds[codes] - before[:-1], lengths) + np.arange(before[-1])], before[firsts]

    def text(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of ids, each put where ``offsets`` says that it begins (from the first one on)."""
        if (np.diff(offsets) != self.lengths[ids[:-1]]).any():
            raise ValueError("ids and offsets don't belong together")
        out = []
        for at in range(0, len(ids), DECODED_TOGETHER):
            some, begins = ids[at : at + DECODED_TOGETHER], offsets[at : at + DECODED_TOGETHER]
            begins, lengths = begins - begins[0], self.lengths[some]
            places = np.arange(int(begins[-1] + lengths[-1]))
            out.append(self.bytes[np.repeat(self.firsts[some] - begins, lengths) + places].tobytes())
        return b"".join(out)


def pair_ranks(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all pairs of ids whose bytes together have a rank (left id, then 32 bits of right id), ascending, and that rank."""
    found = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            if (left := ranks.get(token[:cut])) is not None and (right := ranks.get(token[cut:])) is not None:
                found[left << 32 | right] = rank
    keys = np.array(sorted(found), np.int64)
    return keys, np.array([found[k] for k in keys.tolist()], np.int64)


_NEVER = np.int64(1 << 62)


def merged_together(found: list[bytes], ranks: dict[bytes, int], keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of many pieces one after another, and how many each has, by joining the best pair of every piece at a time."""
    of_byte = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
    parts = of_byte[np.frombuffer(b"".join(found), np.uint8)]
    piece = np.repeat(np.arange(len(found)), [len(x) for x in found])

    def rank_after(at: np.ndarray) -> np.ndarray:
        """Of parts and the ones after them; never for the last one of a piece."""
        right = np.minimum(at + 1, len(parts) - 1)
        asked = parts[at] << 32 | parts[right]
        place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return np.where((keys[place] == asked) & (piece[at] == piece[right]) & (right > at), values[place], _NEVER)

    best, done = rank_after(np.arange(len(parts))), []
    while len(parts):
        firsts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
        lengths = np.diff(np.append(firsts, len(parts)))
        least = np.repeat(np.minimum.reduceat(best, firsts), lengths)
        ended = least == _NEVER
        if ended.any():
            done.append((piece[ended], parts[ended]))
            parts, piece, best, least = (x[~ended] for x in (parts, piece, best, least))
            if not len(parts):
                break
        at = np.flatnonzero(best == least)
        at = at[np.append(True, piece[at[1:]] != piece[at[:-1]])]  # the leftmost of each piece
        parts[at] = best[at]  # the rank of a pair is the id of the two together
        stay = np.ones(len(parts), bool)
        stay[at + 1] = False
        at = at - np.arange(len(at))  # where they are without the parts after them: one goes before each next one
        parts, piece, best = parts[stay], piece[stay], best[stay]
        touched = np.union1d(at, np.maximum(at - 1, 0))
        best[touched] = rank_after(touched)
    pieces_, ids = (np.concatenate(x) for x in zip(*done, strict=True))
    return ids[np.argsort(pieces_, kind="stable")].astype(np.int32), np.bincount(pieces_, minlength=len(found))


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a piece: of all neighbours whose union has a rank the lowest is joined, the leftmost first, to the end."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n))  # bounds of the parts, -1 where two were joined
    waiting = [(rank, i, i + 1, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i : i + 2])) is not None]
    heapq.heapify(waiting)
    while waiting:
        _, i, j, k = heapq.heappop(waiting)
        if after[i] != j or j >= n or after[j] != k:
            continue
        after[i], after[j], before[k] = k, -1, i
        if i > 0 and (rank := ranks.get(piece[before[i] : k])) is not None:
            heapq.heappush(waiting, (rank, before[i], i, k))
        if k < n and (rank := ranks.get(piece[i : after[k]])) is not None:
            heapq.heappush(waiting, (rank, i, k, after[k]))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


_RANKS: dict[str, Ranks] = {}


def ranks(path: str) -> Ranks:
    """The vocabulary of this process for a file of ranks."""
    if path not in _RANKS:
        _RANKS[path] = Ranks(path)
    return _RANKS[path]


def encode(docs: DataFrame, ranks_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids, offsets`` of every row: its ids and where the bytes of each begin in the text, both as
    little-endian unsigned 32-bit integers.

    NULL text counts as empty and has no ids; every row gives one row, repeated or not, with a NULL id too; other columns
    are ignored; an empty table gives an empty table. A long text is worked on in chunks.
    """
    types = {"doc_id": docs.schema[doc_id].dataType, "n_tokens": T.LongType(), "ids": T.BinaryType(), "offsets": T.BinaryType()}
    schema = T.StructType([T.StructField(c, t) for c, t in types.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = ranks(ranks_path)

        def rows(names: pa.Array, ids: list[bytes], offsets: list[bytes]) -> pa.RecordBatch:
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            return pa.RecordBatch.from_arrays([names, counts, pa.array(ids, pa.binary()), pa.array(offsets, pa.binary())], schema.names)

        for batch in batches:
            names, last, held = batch.column(0), None, ([], [], 0)  # of a text in several runs
            for row, found, bounds in vocabulary.encode(batch.column(1)):
                if last is not None and row != last:
                    yield rows(names.slice(last, 1), [b"".join(held[0])], [b"".join(held[1])])
                    last, held = None, ([], [], 0)
                lengths = vocabulary.lengths[found]
                begins = np.cumsum(lengths) - lengths
                if len(bounds) == 2:
                    held[0].append(found.astype("<u4").tobytes())
                    held[1].append((begins + held[2]).astype("<u4").tobytes())
                    last, held = row, (held[0], held[1], held[2] + int(lengths.sum()))
                    continue
                own = np.repeat(np.append(begins, 0)[np.minimum(bounds[:-1], len(begins))], np.diff(bounds))
                flat, placed, at = found.astype("<u4").tobytes(), (begins - own).astype("<u4").tobytes(), (4 * bounds).tolist()
                cuts = list(zip(at, at[1:], strict=False))
                yield rows(names.slice(row, len(cuts)), [flat[a:b] for a, b in cuts], [placed[a:b] for a, b in cuts])
            if last is not None:
                yield rows(names.slice(last, 1), [b"".join(held[0])], [b"".join(held[1])])

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` (``doc_id, n_tokens, ids, offsets``, as ``encode`` gives them) with ``decoded``, the bytes of the text,
    instead of the offsets. Ids without bytes in the vocabulary, or with other offsets than theirs, are an error."""
    kept = [f for f in encoded.schema.fields if f.name != "offsets"]
    schema = T.StructType([*kept, T.StructField("decoded", T.BinaryType())])
    at = [encoded.columns.index(f.name) for f in kept]
    of_ids, of_offsets = encoded.columns.index("ids"), encoded.columns.index("offsets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = ranks(ranks_path)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                some = batch.slice(begin, 256)
                pairs = zip(some.column(of_ids).to_pylist(), some.column(of_offsets).to_pylist(), strict=True)
                texts = [vocabulary.text(np.frombuffer(i, "<u4"), np.frombuffer(o, "<u4")) for i, o in pairs]
                yield pa.RecordBatch.from_arrays([*(some.column(i) for i in at), pa.array(texts, pa.binary())], schema.names)

    return encoded.mapInArrow(run, schema)
