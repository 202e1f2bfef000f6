"""Chunks of bounded length that end at the last good boundary and overlap their neighbours."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import few_at_a_time

#: Fixed value: the boundaries a chunk may end at; of two that start together the one named first counts.
BOUNDARIES = ("\n\n", "\n", ". ", "! ", "? ", "؟ ", "; ", ": ", ", ")
#: What the next chunk may start after, the best first.
GAPS = ("\n\n", "\n", " ")
SOLID = re.compile(r"\S(?:.*\S)?", re.DOTALL)


@dataclass(frozen=True)
class ChunkRules:
    """``most`` characters a chunk (and one for a boundary that ends there), ``overlap`` with the next,
    ``least`` characters before a boundary counts, which must lie in the last ``window`` characters."""

    most: int = 900
    overlap: int = 120
    least: int = 180
    window: int = 220

    def __post_init__(self):
        if self.most <= self.overlap or self.least <= 0:
            raise ValueError("chunks must be longer than their overlap")


class _Marks:
    """All boundaries and gaps of a text, sorted by place in one scan each; lookups are binary searches."""

    def __init__(self, text: str):
        def places(mark: str) -> list[int]:
            out, at = [], text.find(mark)
            while at >= 0:
                out.append(at)
                at = text.find(mark, at + 1)
            return out

        # of boundaries that start together the one named first comes last, so that a search from the right meets it
        found = sorted((at, -rank, at + len(mark)) for rank, mark in enumerate(BOUNDARIES) for at in places(mark))
        self.starts, self.ends = [f[0] for f in found], [f[2] for f in found]
        self.gaps = [(len(mark), places(mark)) for mark in GAPS]

    def cut(self, low: int, reach: int) -> int:
        """End of the boundary that starts last in [low, reach] and ends by reach + 1; ``reach`` without one."""
        for i in range(bisect_right(self.starts, reach) - 1, bisect_left(self.starts, low) - 1, -1):
            if self.ends[i] <= reach + 1:
                return self.ends[i]
        return reach

    def resume(self, low: int, high: int) -> int:
        """End of the first gap in [low, high), the best kind there is; ``low`` without one."""
        for width, places in self.gaps:
            i = bisect_left(places, low)
            if i < len(places) and places[i] + width <= high:
                return places[i] + width
        return low


def _windows(size: int, marks: _Marks, rules: ChunkRules) -> Iterator[tuple[int, int]]:
    """[start, stop) of the windows over a text, each at least one character on from the last."""
    start, stop = 0, 0
    while stop < size:
        reach = start + rules.most
        stop = size if reach >= size else marks.cut(max(start + rules.least, reach - rules.window), reach)
        yield start, stop
        start = marks.resume(max(stop - rules.overlap, start + 1), min(stop + 1, size))


def chunk_spans(text: str, rules: ChunkRules) -> list[tuple[int, int]]:
    """[start, end) of each chunk, in code points of ``text``: windows without the white space at their ends.

    A last chunk shorter than ``least`` joins the one before where both fit into ``most``. Blank
    texts have no chunk.
    """
    solid = (SOLID.search(text, *window) for window in _windows(len(text), _Marks(text), rules))
    spans = [m.span() for m in solid if m]
    if len(spans) > 1:
        (first, _), (tail, end) = spans[-2:]
        if end - tail < rules.least and end - first <= rules.most:
            spans[-2:] = [(first, end)]
    return spans


def chunk_lists(texts: pa.Array, rules: ChunkRules) -> pa.Array:
    """``chunks`` of a batch."""
    fields = [pa.field("start", pa.int32()), pa.field("end", pa.int32()), pa.field("text", pa.string())]

    def made(some: pa.Array) -> pa.Array:
        held = some.to_pylist()
        spans = [chunk_spans(t or "", rules) for t in held]
        flat = np.array([s for each in spans for s in each], np.int32).reshape(-1, 2)
        pieces = pa.array([t[a:b] for t, each in zip(held, spans, strict=True) for a, b in each], pa.string())
        each = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1]), pieces], fields=fields)
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, spans)]), pa.int32()), each)

    return few_at_a_time(texts, pa.list_(pa.struct(fields)), made)


def chunks(text: Column, rules: ChunkRules = ChunkRules()) -> Column:
    """array<struct<start, end, text>>; empty for null and blank texts."""

    @F.arrow_udf("array<struct<start:int,end:int,text:string>>")
    def cut(texts: pa.Array) -> pa.Array:
        return chunk_lists(texts, rules)

    return cut(text)
