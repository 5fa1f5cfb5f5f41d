"""Spans of characters: what pattern scans share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

Span = tuple[str, int, int]  # kind, start, end in code points, end exclusive


def matches(pattern: re.Pattern, text: str, fits: Callable[[re.Match], bool]) -> Iterator[re.Match]:
    """Leftmost non-overlapping matches that fit; others are passed over whole."""
    return (m for m in pattern.finditer(text) if fits(m))


def free_of(spans: Sequence[Span]) -> Callable[[int, int], bool]:
    """A test whether a range touches none of the spans."""
    taken = sorted((start, end) for _, start, end in spans)

    def free(start: int, end: int) -> bool:
        return all(e <= start or s >= end for s, e in taken)

    return free
