"""What models do behind small interfaces, with offline defaults."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.operators.dense import hash_embed


class Embedder(Protocol):
    def embed(self, texts: list[str | None]) -> np.ndarray: ...


class Reranker(Protocol):
    def score(self, question: str, texts: list[str]) -> list[float]: ...


class Chat(Protocol):
    def answer(self, prompt: str) -> str: ...


class HashEmbedder:
    """The offline default: hash embeddings."""

    def __init__(self, dim: int = 768):
        self.dim = dim

    def embed(self, texts: list[str | None]) -> np.ndarray:
        return hash_embed(texts, self.dim)


def embed(rows: DataFrame, row_id: str, text: str, make: Callable[[], Embedder] = HashEmbedder) -> DataFrame:
    """row_id, embedding. The model is made once for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for b in batches:
            table = model.embed(b.column(1).to_pylist()).astype(np.float32)
            offsets = np.arange(len(table) + 1, dtype=np.int32) * (table.shape[1] if len(table) else 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(table.ravel()))], names=["row_id", "embedding"])

    kind = rows.schema[row_id].dataType.simpleString()
    return rows.select(F.col(row_id).alias("row_id"), text).mapInArrow(run, f"row_id {kind}, embedding array<float>").withColumnRenamed("row_id", row_id)


def ask(rows: DataFrame, row_id: str, prompt: str, make: Callable[[], Chat]) -> DataFrame:
    """row_id, answer, error: a failing call is a row with an error, so that the caller may fall back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for b in batches:
            answers, errors = [], []
            for p in b.column(1).to_pylist():
                try:
                    answers.append(model.answer(p))
                    errors.append(None)
                except Exception as e:  # noqa: BLE001
                    answers.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(answers, pa.string()), pa.array(errors, pa.string())], names=["row_id", "answer", "error"])

    kind = rows.schema[row_id].dataType.simpleString()
    return rows.select(F.col(row_id).alias("row_id"), prompt).mapInArrow(run, f"row_id {kind}, answer string, error string").withColumnRenamed("row_id", row_id)


def rerank_scores(hits: DataFrame, make: Callable[[], Reranker]) -> DataFrame:
    """question_id, doc_id, model_score of hits (question_id, doc_id, question, text); nothing where the model fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = make()
        for b in batches:
            scores: list[float | None] = []
            for q, t in zip(b.column("question").to_pylist(), b.column("text").to_pylist()):
                try:
                    scores.append(float(model.score(q, [t])[0]))
                except Exception:  # noqa: BLE001
                    scores.append(None)
            yield pa.RecordBatch.from_arrays([b.column("question_id"), b.column("doc_id"), pa.array(scores, pa.float64())], names=["question_id", "doc_id", "model_score"])

    return hits.select("question_id", "doc_id", "question", "text").mapInArrow(run, "question_id bigint, doc_id bigint, model_score double").where("model_score IS NOT NULL")


def json_in(reply: str | None) -> Any:
    """The first JSON object of a model's reply: in a fence, else at the first brace from which one can be read."""
    t = reply or ""
    fenced = t.split("```")[1::2]
    for part in [f.removeprefix("json").strip() for f in fenced] + [t]:
        at = part.find("{")
        while at >= 0:
            try:
                return json.JSONDecoder().raw_decode(part, at)[0]
            except ValueError:
                at = part.find("{", at + 1)
    return None


def read_replies(rows: DataFrame, row_id: str, reply: str) -> DataFrame:
    """row_id and the JSON object of each reply as text of JSON, null where there is none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [json_in(r) for r in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([None if f is None else json.dumps(f, ensure_ascii=False) for f in found], pa.string())], names=["row_id", "found"])

    kind = rows.schema[row_id].dataType.simpleString()
    return rows.select(F.col(row_id).alias("row_id"), reply).mapInArrow(run, f"row_id {kind}, found string").withColumnRenamed("row_id", row_id)
