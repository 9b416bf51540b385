"""Sizes of texts in tokens of a public tokenizer, whose files are read where they lie."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.plans.shared import ship

#: Vocabulary of a byte-level BPE for many languages.
TOKENIZER = os.environ.get("SPARKLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: How such vocabularies cut a text before merging. A fixed value of the public tokenizers.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache
def encoding(path: str = TOKENIZER):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


#: Texts are encoded in parts of about so many characters, cut before white space, where the pattern cuts anyway.
PART = 100_000


def _parts(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PART:
        end = text.find(" ", at + PART)
        line = text.find("\n", at + PART)
        end = min((p for p in (end, line) if p >= 0), default=len(text))
        # In a run of white space the pattern may cut elsewhere: go on to a single blank between visible characters.
        while 0 < end < len(text) - 1 and (text[end - 1].isspace() or text[end + 1].isspace()):
            nxt = [p for p in (text.find(" ", end + 1), text.find("\n", end + 1)) if p >= 0]
            end = min(nxt, default=len(text))
        if end >= len(text):
            break
        yield text[at:end]
        at = end
    yield text[at:]


def count(text: str | None, path: str = TOKENIZER) -> int:
    """Tokens of a text; 0 for null and empty ones."""
    return sum(len(encoding(path).encode_ordinary(p)) for p in _parts(text)) if text else 0


def windows(text: str, size: int, overlap: int, path: str = TOKENIZER) -> list[str]:
    """Windows of size tokens, each starting size - overlap after the one before; stripped, blank ones left out. A window
    that begins or ends within a character loses that part of it."""
    ids = [i for p in _parts(text) for i in encoding(path).encode_ordinary(p)]
    step = max(1, size - overlap)
    return [w for w in (encoding(path).decode(ids[i : i + size], errors="ignore").strip() for i in range(0, len(ids), step)) if w]


def with_tokens(rows: DataFrame, text: str = "text", path: str = TOKENIZER, name: str = "tokens") -> DataFrame:
    """rows without their text, with its size."""
    keep = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = [count(t, path) for t in b.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(sizes, pa.int64())], names=[*keep, name])

    ship(rows.sparkSession)
    schema = T.StructType([*(rows.schema[c] for c in keep), T.StructField(name, T.LongType())])
    return rows.select(*keep, F.col(text)).mapInArrow(run, schema)
