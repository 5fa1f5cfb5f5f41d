"""Words and word shingles of Arrow text columns, computed over whole batches with numpy.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return. All of these are
ASCII, so words can be cut from UTF-8 without decoding it. Words and shingles are represented by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_SEEDS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_FACTORS = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
#: Of a run of eight bytes, which count where 0 to 8 are left.
_LEFT = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Longer spans are hashed one by one.
LONG_SPAN = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * _C1
    x = (x ^ (x >> np.uint64(27))) * _C2
    return x ^ (x >> np.uint64(31))


#: Per lane, what the length of a span adds to its first eight bytes.
_OF_LENGTH = [mix(np.arange(LONG_SPAN + 2, dtype=np.uint64) * f + seed) for f, seed in zip(_FACTORS, _SEEDS, strict=True)]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column. NULL counts as empty text."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def parts(column: pa.Array, most_bytes: int = 1 << 18) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive texts of about ``most_bytes`` bytes, each run with the number of its first row.

    A longer text comes by itself, as several arrays of one text each, cut before white space; concatenated they are the
    whole text. So what is computed at a time stays small, whatever the texts' lengths.
    """
    raw, offsets = buffers(column)
    begin = 0
    while begin < len(column):
        end = int(np.searchsorted(offsets, offsets[begin] + most_bytes, side="right")) - 1
        if end > begin:
            yield begin, column.slice(begin, end - begin)
            begin = end
            continue
        at, stop = int(offsets[begin]), int(offsets[begin + 1])
        while at < stop:
            cut = at + most_bytes
            while cut < stop:  # the next white space, sought in steps
                spaces = np.flatnonzero(_SPACE[raw[cut : min(cut + 4096, stop)]])
                if len(spaces):
                    cut += int(spaces[0])
                    break
                cut += 4096
            cut = min(cut, stop)
            yield begin, pa.array([raw[at:cut].tobytes().decode()], pa.large_string())
            at = cut
        begin += 1


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each text (one more entry than texts)."""
    inside = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(raw), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty(len(raw), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def eights(raw: np.ndarray, lower: bool = True) -> np.ndarray:
    """The eight bytes from every place on (zeros beyond the end) as one number, A-Z folded to lower case if asked."""
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[:-8] = _LOWER[raw] if lower else raw
    return np.ndarray(len(raw) + 1, "<u8", padded.data, 0, (1,))


def span_heads(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first eight bytes of each span, zeros where it is shorter. ``words`` are the ``eights`` of its text."""
    return words[starts] & _LEFT[np.minimum(ends - starts, 8)]


def span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, lane: int = 0, heads: np.ndarray | None = None) -> np.ndarray:
    """A hash of the bytes of each span of a text, given by its ``eights``. The two lanes are independent.

    Eight bytes at a time go through a mixing that is not linear in them, so no pattern of words makes them agree. Of
    spans up to eight bytes, two that have equal hashes and equal heads are equal.
    """
    lengths = ends - starts
    heads = span_heads(words, starts, ends) if heads is None else heads
    out = mix(heads + _OF_LENGTH[lane][np.minimum(lengths, LONG_SPAN + 1)])
    going, at = np.flatnonzero((lengths > 8) & (lengths <= LONG_SPAN)), 8
    while len(going):
        left = lengths[going] - at
        some = words[starts[going] + at] & _LEFT[np.minimum(left, 8)]
        out[going] = mix((out[going] ^ mix(some + _SEEDS[lane])) * _FACTORS[lane] + np.uint64(at + 1))
        at += 8
        going = going[left > 8]
    for i in np.flatnonzero(lengths > LONG_SPAN):
        out[i] = int.from_bytes(hashlib.blake2b(_bytes(words, starts[i], ends[i]), digest_size=8, salt=bytes([lane])).digest(), "little")
    return out


def _bytes(words: np.ndarray, start: int, end: int) -> bytes:
    return (words[start:end] & np.uint64(255)).astype(np.uint8).tobytes()


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, A-Z folded to lower case, and the number of words before each text."""
    hashes, counts = [np.zeros(0, np.uint64)], np.zeros(len(column) + 1, np.int64)
    for row, part in parts(column):
        raw, offsets = buffers(part)
        starts, ends, firsts = word_bounds(raw, offsets)
        hashes.append(span_hashes(eights(raw), starts, ends))
        counts[row + 1 : row + 1 + len(part)] += np.diff(firsts)
    return np.concatenate(hashes), np.cumsum(counts)


def shingle_hashes(column: pa.Array, width: int) -> list[np.ndarray]:
    """The set of ``width``-word shingles of every text, as a sorted array of distinct hashes.

    A text with fewer words has its whole sequence as its only shingle; a text without words, or NULL, has none.
    """
    words, firsts = word_hashes(column)
    weights = mix(np.arange(1, width + 1, dtype=np.uint64) * _C2) | np.uint64(1)
    n = len(words) - width + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    for i in range(width if n > 0 else 0):
        rolled += words[i : i + n] * weights[i]
    rolled = mix(rolled)
    out = []
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            out.append(mix((words[a:b] * weights[: b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def runs(offsets: np.ndarray, most_bytes: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``most_bytes`` bytes, at least one text each; no text is split."""
    begin = 0
    while begin < len(offsets) - 1:
        end = max(int(np.searchsorted(offsets, offsets[begin] + most_bytes, side="right")) - 1, begin + 1)
        yield begin, end
        begin = end
