"""Spans shared by the scans: (start, end) in code points, end exclusive, by kind."""

from __future__ import annotations

import hashlib
from bisect import bisect_right


def in_order(found: dict[str, list[tuple[int, int]]]) -> list[str]:
    """``kind:start:end`` of all spans by start, then kind as listed in ``found``, then end."""
    rows = sorted((s, k, e, kind) for k, (kind, spans) in enumerate(found.items()) for s, e in spans)
    return [f"{kind}:{s}:{e}" for s, _, e, kind in rows]


def digest(found: dict[str, list[tuple[int, int]]]) -> str:
    return hashlib.sha256(",".join(in_order(found)).encode()).hexdigest()


class Cover:
    """Spans sorted and merged once; ``meets`` is then a binary search, so a text with many spans stays linear."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for s, e in sorted(spans):
            if self.ends and s <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def meets(self, start: int, end: int) -> bool:
        """Whether [start, end) meets one of the spans."""
        i = bisect_right(self.ends, start)
        return i < len(self.starts) and self.starts[i] < end
