"""Splitting oversized items at natural boundaries.

Method: structure-tree packing. A text is read as a tree: sections by heading level, within them paragraphs, within them
list items or lines, then sentences, clauses, and as a last resort single words or characters. Sibling subtrees are merged
bottom-up as long as they fit; only a node that is too large is descended into. Every piece after the first begins with
the last ``overlap`` units of the one before.

The size of a text is the number of runs of ASCII letters and digits plus the number of characters U+4E00 to U+9FFF. As a
run counts one however long it is and is never cut, every piece keeps the limit. Pieces without their overlaps give the
text back exactly.

Null and empty texts and texts within the limit are not oversized and give no pieces. A text that is one long run has the
size 1. Full copies of a row come out once. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 500
OVERLAP = 40

_UNIT = re.compile("[A-Za-z0-9]+|[一-鿿]")
#: At the start of a line, or right after a sentence where the line break was lost.
_HEADING = re.compile(r"(?:^[ ]{0,3}|(?<=[。！？!?；;.]))(#{1,6})[ \t]+\S", re.MULTILINE)
_ITEM = re.compile(r"^([ \t]*)(?:[-*+•]|\d{1,3}[.)、])[ \t]*", re.MULTILINE)
_BLANK = re.compile(r"\n[ \t]*(?:\n[ \t]*)+")
_SENTENCE = re.compile(r"[。！？!?；;]+[”’\"')）]*\s*|\.[”’\"')]*\s+")
_CLAUSE = re.compile(r"[，,、：:]\s*|\s+")


class _Text:
    """Sizes of spans of a text by bisection over the starts of its units."""

    def __init__(self, text: str):
        self.text = text
        units = [m.span() for m in _UNIT.finditer(text)]
        self.starts, self.ends = [s for s, _ in units], [e for _, e in units]

    def size(self, start: int, end: int) -> int:
        return bisect_left(self.starts, end) - bisect_left(self.starts, start)

    def back(self, start: int, end: int, units: int) -> int:
        """Where the last units before end begin, not before start."""
        first = bisect_left(self.starts, end) - units
        return self.starts[first] if first >= 0 and self.starts[first] >= start else start


def _cut(start: int, end: int, at: list[int]) -> list[tuple[int, int]]:
    points = [start, *sorted({p for p in at if start < p < end}), end]
    return list(zip(points, points[1:]))


def _children(t: _Text, start: int, end: int, level: int) -> tuple[list[tuple[int, int]], int]:
    """The parts of a node of a level, and the level of the parts. Levels: 0 to 5 sections by heading, 6 paragraphs, 7 list
    items by indentation and lines, 8 sentences, 9 clauses, 10 units."""
    text = t.text
    while level <= 10:
        at: list[int] = []
        if level < 6:
            at = [m.start() for m in _HEADING.finditer(text, start, end) if len(m.group(1)) == level + 1 and m.start() > start]
        elif level == 6:
            at = [m.end() for m in _BLANK.finditer(text, start, end)]
        elif level == 7:
            items = [(len(m.group(1)), m.start()) for m in _ITEM.finditer(text, start, end)]
            least = min((i for i, p in items if p > start), default=None)
            at = [p for i, p in items if i == least and p > start] if least is not None else [m.end() for m in re.compile("\n").finditer(text, start, end)]
        elif level == 8:
            at = [m.end() for m in _SENTENCE.finditer(text, start, end)]
        elif level == 9:
            at = [m.end() for m in _CLAUSE.finditer(text, start, end)]
        else:
            lo, hi = bisect_left(t.starts, start), bisect_left(t.starts, end)
            at = t.starts[lo + 1 : hi]
        parts = _cut(start, end, at)
        if len(parts) > 1:
            # An item that holds deeper items is cut again by them; any other part is cut by the next level.
            return parts, level if level == 7 else level + 1
        level += 1
    return [(start, end)], 11


def _pack(t: _Text, start: int, end: int, level: int, room: int) -> list[tuple[int, int]]:
    """The node as spans of at most room units: whole if it fits, else its parts, merged with their neighbours."""
    todo: list[tuple[int, int, int]] = [(start, end, level)]
    done: list[tuple[int, int]] = []
    # Depth first and from left to right, without recursion: a part that is too large is replaced by its parts.
    while todo:
        s, e, lv = todo.pop()
        if t.size(s, e) <= room or lv > 10:
            if done and done[-1][1] == s and t.size(done[-1][0], e) <= room:
                done[-1] = (done[-1][0], e)
            else:
                done.append((s, e))
            continue
        parts, nxt = _children(t, s, e, lv)
        todo += [(a, b, nxt) for a, b in reversed(_merged(t, parts, room))]
    return done


def _merged(t: _Text, parts: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """Neighbouring siblings joined as long as they fit."""
    out: list[tuple[int, int]] = []
    for s, e in parts:
        if out and t.size(out[-1][0], e) <= room:
            out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


def size(text: str | None) -> int:
    return len(_UNIT.findall(text)) if text else 0


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int, int]]:
    """(start, content start, end, size) of the pieces of a text: the piece is text[start:end], of which the part before
    content start repeats the piece before. One piece if the text fits."""
    t = _Text(text)
    total = len(t.starts)
    if total <= limit:
        return [(0, 0, len(text), total)]
    out, before = [], 0
    for s, e in _pack(t, 0, len(text), 0, limit - overlap):
        start = t.back(before, s, overlap) if out else s
        out.append((start, s, e, t.size(start, e)))
        before = s
    return out


def split_oversized(rows: DataFrame, row_id: str = "record_id", text: str = "text", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """row_id, chunk_index (from 0), total_chunks, tokens, overlap_tokens, text: the pieces of the texts above the limit.
    Only texts of more characters than the limit leave the JVM, as a unit has at least one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = pieces(x, limit, overlap)
                if len(got) == 1 and got[0][3] <= limit:
                    continue
                for k, (start, content, end, n) in enumerate(got):
                    for col, v in zip(cols, (i, k, len(got), n, size(x[start:content]), x[start:end])):
                        col.append(v)
            types = [b.schema.field(0).type, pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["row_id", "chunk_index", "total_chunks", "tokens", "overlap_tokens", "text"])

    kind = rows.schema[row_id].dataType.simpleString()
    long = rows.where(F.length(text) > limit).select(F.col(row_id).alias("row_id"), F.col(text).alias("text"))
    out = long.mapInArrow(run, f"row_id {kind}, chunk_index int, total_chunks int, tokens int, overlap_tokens int, text string")
    return out.withColumnRenamed("row_id", row_id)
