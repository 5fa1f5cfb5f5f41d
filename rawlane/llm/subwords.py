"""Subword ids of texts by a ``tokenizers`` file, encoding every different word once.

The tokenizer must drop white space before it looks at the text and fold case, as ``word_bpe_49k.json`` does: then the ids
of a text are the ids of its words, one after another, and any run of ASCII white space is a safe boundary. A full stop or
comma that ends a word after an ASCII letter is a piece of its own for such a tokenizer and is cut off too. Words are
found in a batch with numpy and remembered between batches by a hash of 64 bits; only words not yet seen go to the
tokenizer, in batches balanced by bytes. A check value of every word, its bytes where it has eight at most and a second,
independent hash where it is longer, is compared with that of the word remembered; texts in which they ever differ go to
the tokenizer themselves.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from rawlane.llm.arrow_text import buffers, eights, parts, span_hashes, span_heads, word_bounds

#: Different words remembered by a process (some 30 bytes each); beyond that it starts afresh.
REMEMBERED = 2_000_000
#: Bits of the hash by which a word is looked up first; of words that share them, the latest is found so.
SLOT_BITS = 20
#: Bytes of new words that the tokenizer gets at once.
BATCH_BYTES = 1 << 14

_LETTER = np.zeros(256, bool)
_LETTER[ord("a") : ord("z") + 1] = _LETTER[ord("A") : ord("Z") + 1] = True
#: Bytes of a word of letters only: ASCII letters, and the two-byte letters from U+00C0 to U+00FF.
_PLAIN = _LETTER.copy()
_PLAIN[0xC3] = True
_PLAIN[0x80:0xC0] = True
_STOP = np.zeros(256, bool)
_STOP[[ord("."), ord(",")]] = True


def _running(flags: np.ndarray) -> np.ndarray:
    """The number of flags before each place."""
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


class HashClash(Exception):
    """Two different words have one hash."""


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.stops = np.zeros(256, np.int32)
        for sign in (".", ","):
            (self.stops[ord(sign)],) = self.tokenizer.encode(sign, add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted, and where each is in the memory
        self.rows = np.zeros(0, np.int64)
        self.slots = np.zeros(1 << SLOT_BITS, np.int32)
        self.names = np.zeros((2, 1 << 16), np.uint64)  # hash and check value of what is in the memory
        self.ids = np.zeros(1 << 16, np.int32)
        self.bounds = np.zeros(1 << 16, np.int64)
        self.known = 0

    def _keep(self, ids: np.ndarray, counts: np.ndarray) -> None:
        used = int(self.bounds[self.known])
        while self.known + len(counts) + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
            self.names = np.concatenate([self.names, np.zeros_like(self.names)], axis=1)
        while used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[used : used + len(ids)] = ids
        self.bounds[self.known + 1 : self.known + len(counts) + 1] = used + np.cumsum(counts)
        self.known += len(counts)

    def _learn(self, words: list[str], plain: bool) -> None:
        """Encode new words. ``plain`` ones hold letters only, so each ends with its only end-of-word piece."""
        begin = 0
        while begin < len(words):
            end, size = begin, 0
            while end < len(words) and (end == begin or size + len(words[end]) <= BATCH_BYTES):
                size += len(words[end])
                end += 1
            part = words[begin:end]
            if plain:
                got = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0]
                ids = np.asarray(got.ids, np.int32)
                counts = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
                if len(counts) != len(part):
                    raise ValueError("a word of letters has not exactly one end: this tokenizer doesn't fit")
            else:
                got = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
                ids = np.asarray(got.ids, np.int32)
                counts = np.bincount(np.asarray(got.word_ids, np.int64), minlength=len(part))
            self._keep(ids, counts)
            begin = end

    def _codes(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each word is in the memory, the id of the stop that follows it (or 0), words before each text."""
        raw, offsets = buffers(column)
        starts, ends, firsts = word_bounds(raw, offsets)
        if not len(starts):
            return starts, starts.astype(np.int32), firsts
        stopped = _STOP[raw[ends - 1]] & (ends - starts > 1) & _LETTER[raw[np.maximum(ends - 2, 0)]]
        stops = np.where(stopped, self.stops[raw[ends - 1]], 0)
        ends = ends - stopped
        barred = _running(raw == ord("|"))
        exact = barred[ends] > barred[starts]
        hashes, checks = self._names(raw, starts, ends)
        if exact.any():  # special strings are told apart by case
            hashes[exact], checks[exact] = (~x for x in self._names(raw, starts[exact], ends[exact], lower=False))
        slots = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        rows = self.slots[slots].astype(np.int64)
        unknown = np.flatnonzero(self.names[0, rows] != hashes) if self.known else np.arange(len(hashes))
        if len(unknown):
            found, first, inverse = np.unique(hashes[unknown], return_index=True, return_inverse=True)
            if self.known + len(found) > REMEMBERED:
                self._forget()
                return self._codes(column)
            at = np.searchsorted(self.hashes, found)
            new = np.ones(len(found), bool)
            inside = at < len(self.hashes)
            new[inside] = self.hashes[at[inside]] != found[inside]
            if new.any():
                which = unknown[first[new]]
                got = self._learned(raw, starts[which], ends[which])
                self.names[:, got] = hashes[which], checks[which]
                self.hashes = np.insert(self.hashes, at[new], found[new])
                self.rows = np.insert(self.rows, at[new], got)
                at = np.searchsorted(self.hashes, found)
            rows[unknown] = self.rows[at][inverse]
            self.slots[slots[unknown]] = rows[unknown]
        if (self.names[1, rows] != checks).any():
            raise HashClash
        return rows, stops, firsts

    def _names(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """The hash and the check value of each span."""
        words = eights(raw, lower)
        checks = span_heads(words, starts, ends)
        hashes, long = span_hashes(words, starts, ends, heads=checks), np.flatnonzero(ends - starts > 8)
        checks[long] = span_hashes(words, starts[long], ends[long], lane=1)
        return hashes, checks

    def _learned(self, raw: np.ndarray, begins: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Where in the memory the words that lie there are now that they have been encoded."""
        odd = _running(~_PLAIN[raw])
        signs = _running((raw[:-1] == 0xC3) & ((raw[1:] == 0x97) | (raw[1:] == 0xB7)))  # the two signs among those letters
        thirds = _running((raw >= 0x80) & (raw < 0xC0))
        leads = _running(raw == 0xC3)
        plain = (odd[stop] == odd[begins]) & (signs[stop - 1] == signs[begins])
        plain &= (thirds[stop] - thirds[begins]) == (leads[stop] - leads[begins])
        data, here = raw.tobytes(), self.known
        for kind in (True, False):
            self._learn([data[a:b].decode() for a, b in zip(begins[plain == kind], stop[plain == kind], strict=True)], kind)
        rows = np.empty(len(begins), np.int64)
        rows[plain] = here + np.arange(plain.sum())
        rows[~plain] = here + plain.sum() + np.arange((~plain).sum())
        return rows

    def counts(self, column: pa.Array) -> np.ndarray:
        """The number of ids of every text. NULL counts as empty."""
        out = np.zeros(len(column), np.int64)
        for row, part in parts(column):
            try:
                codes, stops, firsts = self._codes(part)
                sums = _running(self.bounds[codes + 1] - self.bounds[codes] + (stops > 0))
                out[row : row + len(part)] += sums[firsts[1:]] - sums[firsts[:-1]]
            except HashClash:
                out[row : row + len(part)] += [len(self.tokenizer.encode(x or "", add_special_tokens=False).ids) for x in part.to_pylist()]
        return out

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Runs of texts: number of the first row, ids of its texts one after another, ids before each text.

        A very long text comes in several runs of one text each. NULL counts as empty.
        """
        for row, part in parts(column):
            try:
                codes, stops, firsts = self._codes(part)
            except HashClash:
                own = [np.asarray(self.tokenizer.encode(x or "", add_special_tokens=False).ids, np.int32) for x in part.to_pylist()]
                yield row, np.concatenate(own), np.cumsum([0, *map(len, own)])
                continue
            lengths = self.bounds[codes + 1] - self.bounds[codes]
            inner, sums = _running(lengths)[:-1], _running(lengths + (stops > 0))
            out = np.empty(int(sums[-1]), np.int32)
            flat = np.arange(int(lengths.sum()))
            out[np.repeat(sums[:-1] - inner, lengths) + flat] = self.ids[np.repeat(self.bounds[codes] - inner, lengths) + flat]
            out[(sums[:-1] + lengths)[stops > 0]] = stops[stops > 0]
            yield row, out, sums[firsts]

    def documents(self, column: pa.Array, end_id: int) -> Iterator[np.ndarray]:
        """The ids of each text in turn, ``end_id`` last."""
        end, held = np.array([end_id], np.int32), []
        for row, ids, bounds in self.encode(column):
            if held and row > held[0][0]:
                yield np.concatenate([*(x for _, x in held), end])
                held = []
            last = len(bounds) - 2
            for i in range(last):
                yield np.concatenate([ids[bounds[i] : bounds[i + 1]], end])
            held.append((row + last, ids[bounds[last] : bounds[last + 1]]))
        if held:
            yield np.concatenate([*(x for _, x in held), end])


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this process for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
