"""Chunks of a text along headings and sentences, and plain windows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text as T

# What counts as a heading, as a list, and as the end of a sentence.
_HEADING = re.compile(r"\s{0,3}#{1,6}\s+\S")
_LISTED = re.compile(r"^\s*(?:[-*]|\d+\.)\s+", re.MULTILINE)
_SENTENCES = re.compile(r"(?<=[。！？!?；;])\s+")

Measure = Callable[[str], int]


def char_windows(rows: DataFrame, row_id: str, text: str, size: int = 400, overlap: int = 80) -> DataFrame:
    """row_id, window_no, start (from 0), piece: windows of size characters, each starting size - overlap after the one
    before, up to the end of the text; pieces are stripped and blank ones left out. Stays in the JVM."""
    step = max(1, size - overlap)
    n = F.length(text)
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    flat = rows.select(row_id, text, F.posexplode(starts).alias("window_no", "start"))
    piece = T.strip(F.substring(F.col(text), F.col("start") + 1, F.lit(size)))
    return flat.select(row_id, "window_no", "start", piece.alias("piece")).where("piece != ''")


def sections(rows: DataFrame, row_id: str, text: str) -> DataFrame:
    """row_id, section_no (from 0), heading, body: a section for each line that is a heading, and one for what comes before
    the first, if that isn't blank; its heading is empty. A text without headings is one section. Stays in the JVM."""
    lines = F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n|[\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}]", "\n")
    is_heading = r"[ \t]{0,3}#{1,6}[ \t]+\S"
    parts = F.filter(F.split(lines, f"(?m)^(?={is_heading})"), lambda p: T.strip(p) != "")
    flat = rows.select(row_id, F.posexplode(parts).alias("section_no", "part"))
    first = F.substring_index("part", "\n", 1)
    headed = first.rlike(f"^{is_heading}")
    body = F.when(headed, F.expr("substring(part, locate('\\n', concat(part, '\\n')) + 1)")).otherwise(F.col("part"))
    return flat.select(row_id, "section_no", F.when(headed, T.strip(first)).otherwise("").alias("heading"), T.strip(body).alias("body"))


def units_of(body: str) -> list[str]:
    """Paragraphs between blank lines; those that aren't lists are cut behind ends of sentences followed by white space."""
    out: list[str] = []
    for paragraph in filter(None, map(str.strip, re.split(r"\n\s*\n+", body))):
        if _LISTED.search(paragraph):
            out.append(paragraph)
        else:
            out += [s for s in map(str.strip, _SENTENCES.split(paragraph)) if s]
    return out


def _windows(text: str, size: int, overlap: int) -> list[str]:
    step = max(1, size - overlap)
    return [p for p in (text[i : i + size].strip() for i in range(0, len(text), step)) if p]


def pack(text: str | None, limit: int = 500, overlap: int | None = None, measure: Measure = len, windows: Callable[[str, int, int], list[str]] = _windows) -> list[str]:
    """Chunks of a text: each section's units joined by blank lines as long as they fit, each chunk headed by its
    section's heading. A unit that doesn't fit is cut into windows; a section without a body is its heading. overlap: of
    windows, a fifth of the limit and at least 20 unless told. The joints count two characters as measure sees them."""
    limit = limit if limit > 0 else 500
    overlap = max(20, limit // 5) if overlap is None else overlap
    overlap = min(max(0, overlap), limit - 1)
    chunks: list[str] = []
    for heading, body in _sections(text or ""):
        head = f"{heading}\n" if heading else ""
        if not body:
            chunks.append(heading)
            continue
        room = max(20, limit - measure(head)) if head else limit
        joint = measure("\n\n")
        group: list[str] = []
        used = 0

        def close() -> None:
            if group:
                chunks.append((head + "\n\n".join(group)).strip())  # noqa: B023
                group.clear()  # noqa: B023

        for unit in units_of(body):
            n = measure(unit)
            if n > room:
                close()
                chunks += [(head + w).strip() for w in windows(unit, room, min(overlap, room // 4))]
                continue
            if group and used + joint + n > room:
                close()
            used = used + joint + n if group else n
            group.append(unit)
        close()
    return [c for c in chunks if c]


def _sections(text: str) -> list[tuple[str, str]]:
    heads: list[tuple[str, list[str]]] = [("", [])]
    for line in map(str.rstrip, text.splitlines()):
        if _HEADING.match(line):
            heads.append((line.strip(), []))
        else:
            heads[-1][1].append(line)
    joined = [(h, "\n".join(body).strip()) for h, body in heads]
    return [(h, body) for h, body in joined if h or body]


def chunk_texts(rows: DataFrame, row_id: str, text: str, limit: int = 500, overlap: int | None = None, measure: Measure = len, windows: Callable[[str, int, int], list[str]] = _windows) -> DataFrame:
    """row_id, chunk_index (from 0), total_chunks, size, chunk. Null and blank texts have no chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(5)]
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                got = pack(t, limit, overlap, measure, windows)
                for k, c in enumerate(got):
                    for col, v in zip(cols, (i, k, len(got), measure(c), c)):
                        col.append(v)
            types = [b.schema.field(0).type, pa.int32(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["row_id", "chunk_index", "total_chunks", "size", "chunk"])

    kind = rows.schema[row_id].dataType.simpleString()
    out = rows.where(F.col(text).isNotNull()).select(F.col(row_id).alias("row_id"), text).mapInArrow(run, f"row_id {kind}, chunk_index int, total_chunks int, size int, chunk string")
    return out.withColumnRenamed("row_id", row_id)
