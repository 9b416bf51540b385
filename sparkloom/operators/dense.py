"""Dense retrieval: hash embeddings and exact nearest neighbours in blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.sparse import Best, top
from sparkloom.plans.shared import materialize, ship

DIM = 768
#: Questions that are read at once. A block is one pass over the rows; blocks of sparse vectors (at most one in so many
#: numbers isn't 0) go together, up to so many questions.
BLOCK, SPARSE, TOGETHER = 4096, 16, 1 << 16
TILE = 256  # questions multiplied at once

Embed = Callable[[list[str]], np.ndarray]


@lru_cache(maxsize=1 << 17)
def _slot(ch: str, dim: int) -> tuple[int, float]:
    h = hashlib.md5(ch.encode("utf-8", "surrogatepass")).hexdigest()
    return int(h[:8], 16) % dim, 1.0 if int(h[8:10], 16) % 2 == 0 else -1.0


def hash_embed(texts: list[str | None], dim: int = DIM) -> np.ndarray:
    """A row for each text: its characters fall on signed places by hash, and the sum has length 1. Null and empty texts
    are zero vectors. Each different character is hashed once for all texts."""
    codes = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    seen = np.zeros(0x110000, bool)
    seen[codes] = True
    known = np.flatnonzero(seen)
    which = np.zeros(0x110000, np.int32)
    which[known] = np.arange(len(known))
    which = which[codes]
    slots = [_slot(chr(c), dim) for c in known]
    place, sign = np.array([s[0] for s in slots], np.int64), np.array([s[1] for s in slots])
    row = np.repeat(np.arange(len(texts)), [len(t or "") for t in texts])
    out = np.bincount(row * dim + place[which], sign[which], len(texts) * dim).reshape(len(texts), dim) if len(codes) else np.zeros((len(texts), dim))
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norms == 0, 1, norms)


def _vectors(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows whose vector is whole, and the vectors, by the length that most have."""
    rows = batch.column(column)
    lengths = np.asarray(rows.value_lengths().fill_null(0))
    dim = int(np.bincount(lengths).argmax()) if len(lengths) else 0
    kept = np.nonzero(lengths == dim)[0] if dim else np.zeros(0, int)
    flat = rows.take(pa.array(kept)).flatten() if len(kept) else pa.array([], pa.float64())
    table = np.asarray(flat.fill_null(np.nan), dtype=np.float64).reshape(len(kept), dim)
    whole = ~np.isnan(table).any(axis=1)
    return kept[whole], table[whole]


def nearest(questions: DataFrame, rows: DataFrame, k: int = 5, doc_id: str = "vec_id", vector: str | None = "embedding", text: str | None = None, embed: Embed = hash_embed, cosine: bool = False, earlier_only: bool = False) -> DataFrame:
    """question_id, doc_id, score, rank: the k rows with the largest inner product (or cosine) with each question
    (question_id, vector), exactly. Rows bring a vector, or a text that is embedded batch by batch and never stored.
    Questions are taken in blocks; every block is compared with all rows in one pass, and only the k best of a task leave
    it. earlier_only: only rows with an id below the question's. Rows without a vector, or with one of another length or
    with nulls, are left out. Scores are rounded to six decimals; ties go to the smaller id."""
    spark = rows.sparkSession
    ship(spark)
    asked = questions.where(F.col("vector").isNotNull()).select("question_id", "vector")
    asked = materialize(asked, "asked")  # read once for each block
    blocks = max(1, -(-asked.count() // BLOCK))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("question_id"), F.lit(blocks)))
    source = rows.select(F.col(doc_id).alias("doc_id"), *([F.col(vector).alias("x")] if text is None else [F.col(text).alias("x")])).coalesce(spark.sparkContext.defaultParallelism)
    found, waiting = None, []

    def compared(ids: np.ndarray, vectors: np.ndarray | list) -> None:
        nonlocal found
        sent = spark.sparkContext.broadcast((ids, vectors))
        part = source.mapInArrow(_compare(sent, k, text is not None, embed, cosine, earlier_only), "question_id bigint, doc_id bigint, score double")
        found = part if found is None else found.unionByName(part)

    def together() -> None:
        if waiting:
            compared(np.concatenate([ids for ids, _ in waiting]), [v for _, vectors in waiting for v in vectors])
            waiting.clear()

    for b in range(blocks):
        block = asked.where(F.col("block") == b).select("question_id", "vector").toArrow()
        if not block.num_rows:
            continue
        ids = np.asarray(block.column("question_id"))
        table = np.array(block.column("vector").to_pylist(), dtype=np.float64)
        if cosine:
            table = _unit(table)
        if table.ndim < 2 or not table.size or np.count_nonzero(table) * SPARSE > table.size:  # NaN isn't 0 either
            compared(ids, table)
            continue
        waiting.append((ids, [(table.shape[1], at, v[at]) for v in table for at in [np.flatnonzero(v).astype(np.int32)]]))
        if sum(len(i) for i, _ in waiting) >= TOGETHER:
            together()
    together()
    if found is None:
        return spark.createDataFrame([], "question_id bigint, doc_id bigint, score double, rank int")
    return materialize(top(found, k), "nearest")


def _unit(x: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norms == 0, 1, norms)


def _compare(sent, k: int, is_text: bool, embed: Embed, cosine: bool, earlier_only: bool):
    """Compares rows with the questions sent: their ids and a table of vectors, or of each vector its length and the
    places and values of the numbers that aren't 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = sent.value
        best = Best(len(ids), k)

        def add(q: int, at: np.ndarray, scores: np.ndarray, doc: np.ndarray) -> None:
            scores, doc = np.round(scores, 6) + 0.0, doc[at]
            on = np.isfinite(scores) & (scores >= best.least(q))
            if earlier_only:
                on &= doc < ids[q]
            if on.any():
                best.add(q, scores[on], doc[on])

        for b in batches:
            if is_text:
                kept, x = np.arange(b.num_rows), embed(b.column("x").to_pylist())
            else:
                kept, x = _vectors(b, "x")
            if not len(kept):
                continue
            doc = np.asarray(b.column("doc_id"))[kept]
            x = _unit(x) if cosine else x
            if isinstance(vectors, np.ndarray):
                if vectors.ndim < 2 or x.shape[1] != vectors.shape[1]:
                    continue
                for lo in range(0, len(ids), TILE):
                    for q, scores in enumerate(vectors[lo : lo + TILE] @ x.T, lo):
                        at = np.flatnonzero(scores >= best.least(q) - 1e-6)
                        if len(at):
                            add(q, at, scores[at], doc)
                continue
            # Rows of numbers of half the size rule out nearly all; what is left is scored in full. Each of the products
            # and sums is off by a share of 6e-8 of at most the product of the lengths.
            across = np.ascontiguousarray(x.T, dtype=np.float32)
            longest = np.linalg.norm(x, axis=1).max()
            for q, (dim, places, values) in enumerate(vectors):
                if dim != x.shape[1]:
                    continue
                scores = values.astype(np.float32) @ across[places]
                off = 1e-6 + (len(places) + 4) * 1.2e-7 * longest * np.sqrt(values @ values)
                at = np.flatnonzero(scores >= best.least(q) - off)
                if len(at):
                    add(q, at, x[at[:, None], places] @ values, doc)
        yield from best.batches(ids)

    return run
