"""Fill-in-the-middle: texts cut at two ranks and put together again with the middle last.

A text is a sequence of units (a word with the white space before it, or white space at the end). Cuts are drawn as ranks
among units and needed as places among code points. An indexable skip list gives one from the other: its lowest lane links
every unit, express lanes link ever fewer, and each link carries how many units and how many code points it passes. A
search goes along the highest lane while it doesn't pass the rank, then descends; the widths it has added up are the place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawlane.llm.arrow_text import buffers, mix, runs, word_bounds

#: Marks of the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")


class Lane:
    """Links of one lane. Where a text's last link would be, both widths are zero and nothing is passed."""

    def __init__(self, units: np.ndarray, chars: np.ndarray, heads: np.ndarray, down: np.ndarray | None):
        self.units, self.chars, self.heads, self.down = units, chars, heads, down


class SkipList:
    """An indexable skip list for each of several texts, in common arrays.

    ``units`` is the number of units of each text, ``chars`` the code points of all units. A text's head stands before its
    first unit, its k-th node after its k-th unit. A node's tower has a lane more with probability 1/4, by a hash of its
    number, so equal input gives equal lists.
    """

    def __init__(self, units: np.ndarray, chars: np.ndarray):
        heads = np.cumsum(units + 1) - units - 1
        last = heads + units
        nodes = len(chars) + len(units)
        linked = np.ones(nodes, bool)
        linked[last] = False
        widths = np.zeros(nodes, np.int32)
        widths[linked] = chars
        self.lanes = [Lane(linked.astype(np.int32), widths, heads, None)]
        towers, here = mix(np.arange(1, nodes + 1, dtype=np.uint64)), np.arange(nodes)
        level = 0
        while True:
            below, is_head = self.lanes[-1], np.zeros(len(here), bool)
            is_head[below.heads] = True
            level += 1
            rises = is_head | (towers[here] & np.uint64((1 << 2 * level) - 1) == 0)
            down = np.flatnonzero(rises)
            if len(down) == len(heads):
                return
            here, ends = here[down], np.append(is_head[down][1:], True)
            passed = (np.add.reduceat(w, down).astype(np.int32) for w in (below.units, below.chars))
            self.lanes.append(Lane(*(np.where(ends, 0, w) for w in passed), np.flatnonzero(is_head[down]), down))

    def places(self, texts: np.ndarray, ranks: np.ndarray) -> np.ndarray:
        """Code points before the cut after the first ``ranks[i]`` units of text ``texts[i]``."""
        units, chars = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        at = self.lanes[-1].heads[texts]
        for lane in reversed(self.lanes):
            going = np.arange(len(texts))
            while len(going):
                width = lane.units[at[going]]
                going = going[(width > 0) & (units[going] + width <= ranks[going])]
                units[going] += lane.units[at[going]]
                chars[going] += lane.chars[at[going]]
                at[going] += 1
            if lane.down is not None:
                at = lane.down[at]
        return chars


def unit_widths(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of units of every text, and code points of all units."""
    raw, offsets = buffers(column)
    _, ends, _ = word_bounds(raw, offsets)
    filled = np.flatnonzero(np.diff(offsets))
    ends = np.union1d(ends, offsets[filled + 1])  # white space at the end is a unit of its own
    before = np.searchsorted(ends, offsets, side="right")
    if not len(ends):
        return np.diff(before), np.zeros(0, np.int64)
    leads = (raw & 0xC0) != 0x80
    return np.diff(before), np.add.reduceat(leads, np.append(0, ends[:-1]), dtype=np.int64)


def _draws(seed: int, doc_id: object) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def _check(marks: tuple[str, str, str]) -> None:
    """No mark may begin as another (or itself) ends, or hold another: else outputs could be read in two ways."""
    for a, b in product(marks, repeat=2):
        if not a or any(a.endswith(b[:i]) for i in range(1, len(b))) or (a is not b and a in b):
            raise ValueError(f"marks {a!r} and {b!r} overlap")


def fill_in_middle(
    docs: DataFrame, seed: int = 42, percent: int = 50, suffix_first: int = 80, marks: tuple[str, str, str] = MARKS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row.

    Of ``percent`` per cent of the texts a prefix, a middle and a suffix are cut at two units drawn from the id; ``output``
    holds them with the middle last: form ``spm`` (suffix, prefix, middle) for ``suffix_first`` per cent of these, ``psm``
    (prefix, suffix, middle) for the others. All else is ``plain``, the text itself, with NULL widths: empty texts too, and
    texts that hold one of ``marks``. ``n`` is the number of units, the other widths are code points.

    NULL text counts as empty; a NULL id draws like the empty string, equal ids draw alike. Every row gives one row,
    repeated ones too, whatever its length; other columns are ignored; an empty table gives an empty table.
    """
    _check(marks)
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [docs.schema[doc_id].dataType, T.LongType(), T.StringType(), T.LongType(), T.LongType(), T.StringType()]
    schema = T.StructType([T.StructField(c, t) for c, t in zip(names, types, strict=True)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in runs(buffers(batch.column(1))[1]):
                ids, column = batch.column(0).slice(begin, end - begin), batch.column(1).slice(begin, end - begin)
                texts = [x or "" for x in column.to_pylist()]
                units, chars = unit_widths(column)
                draws = [_draws(seed, i) for i in ids.to_pylist()]
                moved = [i for i, (x, d) in enumerate(zip(texts, draws, strict=True)) if x and d[2] % 100 < percent and not any(m in x for m in marks)]
                ranks = np.array([sorted(h % (int(units[i]) + 1) for h in draws[i][:2]) for i in moved], np.int64).reshape(-1, 2)
                places = SkipList(units, chars).places(np.repeat(moved, 2).astype(np.int64), ranks.ravel()).reshape(-1, 2)
                forms, widths, out = ["plain"] * len(texts), [(None, None)] * len(texts), texts
                for i, (first, second) in zip(moved, places.tolist(), strict=True):
                    prefix, middle, suffix = texts[i][:first], texts[i][first:second], texts[i][second:]
                    spm = draws[i][3] % 100 < suffix_first
                    p, s, m = marks
                    forms[i], widths[i] = "spm" if spm else "psm", (first, second - first)
                    out[i] = f"{s}{suffix}{p}{prefix}{m}{middle}" if spm else f"{p}{prefix}{s}{suffix}{m}{middle}"
                prefix, middle = zip(*widths, strict=True)
                columns = [ids, pa.array(units, pa.int64()), pa.array(forms), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(out, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(cut, schema)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text from which ``fill_in_middle`` made an output. A moved text holds none of the marks, so each occurs once."""
    p, s, m = (F.lit(x) for x in marks)

    def between(begin: Column, end: Column | None) -> Column:
        after = F.split_part(output, begin, F.lit(2))
        return after if end is None else F.split_part(after, end, F.lit(1))

    return (
        F.when(form == "psm", F.concat(between(p, s), between(m, None), between(s, m)))
        .when(form == "spm", F.concat(between(p, m), between(m, None), between(s, p)))
        .otherwise(output)
    )


SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
    sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), ranked AS (
  SELECT doc_id, t, units, len(units) AS n, ('0x' || h[1:8])::UBIGINT % (len(units) + 1)::UBIGINT AS a, ('0x' || h[9:16])::UBIGINT % (len(units) + 1)::UBIGINT AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::UBIGINT % 100 >= 50 THEN 'plain'
      WHEN ('0x' || h[25:32])::UBIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, t, n, form, array_to_string(units[1:least(a, b)::BIGINT], '') AS prefix,
    array_to_string(units[least(a, b)::BIGINT + 1:greatest(a, b)::BIGINT], '') AS middle, array_to_string(units[greatest(a, b)::BIGINT + 1:], '') AS suffix
  FROM ranked
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""
