"""Reading level of each document.

Method: smoothed unigram language models, one for each level, trained on the labelled texts; a document gets the level
with the highest posterior likelihood. Units are words of Latin letters and, for Chinese, every two characters in a row.
Counts are smoothed by adding ALPHA to each, over the vocabulary of all levels. Where a document is labelled several times
each label counts its part. Levels follow the text alone; lang and source are not used.

The models are fitted on at most MAX_LABELLED labelled documents (those with the smallest hashes of their ids), which also
bounds the units they hold; all units of these documents count. Every document gets a level. Without any
labels the levels are seeded by a formula over sentence and word lengths.

Null texts, and texts without a unit, get the level that is most frequent among the labels. Labels outside 1 to 5 and
labels of unknown documents are ignored; copies of a label count once. An empty table gives an empty result; a doc_id that
occurs twice gets a level for each of its rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.plans.shared import materialize, ship, small

ALPHA = 0.5
MAX_LABELLED = 50_000
LEVELS = 5
FORMULA_SEED = 20_000  # documents that a formula labels where there are no labels

_PART = re.compile("[a-z]+|[一-鿿]+")


def units(text: str | None) -> list[str]:
    out: list[str] = []
    for part in _PART.findall((text or "").lower()):
        if part.isascii():
            out.append(part)
        else:
            out += [part[i : i + 2] for i in range(len(part) - 1)] or [part]
    return out


def formula(text: str | None) -> int:
    """A level by the length of sentences and words, for want of labels."""
    t = text or ""
    sentences = max(1, len(re.findall(r"[。！？!?]|\.\s", t)))
    words = re.findall(r"[A-Za-z]+|[一-鿿]", t)
    if not words:
        return 3
    latin = [w for w in words if w.isascii()]
    score = len(words) / sentences / (12 if len(latin) * 2 > len(words) else 18)
    score += (sum(map(len, latin)) / len(latin) - 4) / 3 if latin else 0.0
    return int(min(LEVELS, max(1, round(1 + 2 * score))))


class Model:
    """Log likelihoods of units by level."""

    def __init__(self, counts: dict[str, list[float]], weights: list[float]):
        self.weights = weights
        table = np.array(list(counts.values()) or np.zeros((0, LEVELS)), dtype=float).reshape(-1, LEVELS)
        size = max(1, len(counts))
        self.unseen = np.log(ALPHA / (table.sum(axis=0) + ALPHA * size))
        self.place = {u: i for i, u in enumerate(counts)}
        self.logs = np.log((table + ALPHA) / (table.sum(axis=0) + ALPHA * size)) - self.unseen
        share = (np.array(weights, dtype=float) + 1e-9) / (sum(weights) + LEVELS * 1e-9)
        self.prior = np.log(share)

    def score(self, text: str | None) -> np.ndarray:
        """Log posteriors but for a constant. A unit that no level knows tells nothing."""
        found = [self.place[u] for u in units(text) if u in self.place]
        return self.prior + self.logs[found].sum(axis=0) + len(found) * self.unseen

    def level(self, text: str | None) -> tuple[int, float]:
        """The level, and how far its log posterior is above the next; ties go to the lower level."""
        s = self.score(text)
        best = int(np.argmax(s))
        return best + 1, float(s[best] - np.partition(s, -2)[-2])


def train(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Counts are summed over the cluster; what comes to the driver are the units of at most max_labelled documents."""
    given = labels.where(f"reading_level BETWEEN 1 AND {LEVELS} AND doc_id IS NOT NULL").select("doc_id", "reading_level", *(["rater"] if "rater" in labels.columns else [])).distinct()
    by = given.groupBy("doc_id").agg(*(F.count_if(F.col("reading_level") == k).cast("double").alias(f"l{k}") for k in range(1, LEVELS + 1)), F.count(F.lit(1)).alias("n"))
    by = by.select("doc_id", *((F.col(f"l{k}") / F.col("n")).alias(f"l{k}") for k in range(1, LEVELS + 1)), F.xxhash64("doc_id").alias("h"))
    by = materialize(by, "labels")
    if by.count() > max_labelled:
        by = materialize(by.orderBy("h", "doc_id").limit(max_labelled), "labels")
    names = [f"l{k}" for k in range(1, LEVELS + 1)]
    texts = documents.where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text")
    # Labels first: only labelled texts are moved.
    known = materialize(texts.join(small(by).drop("h"), "doc_id").dropDuplicates(["doc_id"]), "labelled")
    weights = list(known.agg(*(F.coalesce(F.sum(n), F.lit(0.0)) for n in names)).first())
    if not sum(weights):
        seeds = documents.where("text IS NOT NULL").select("text").orderBy(F.xxhash64("text")).limit(FORMULA_SEED)
        pick = F.pandas_udf(lambda texts: texts.map(formula), "int")
        known = seeds.withColumn("f", pick("text")).select(F.lit(0).alias("doc_id"), "text", *((F.col("f") == k).cast("double").alias(f"l{k}") for k in range(1, LEVELS + 1)))
        weights = list(known.agg(*(F.coalesce(F.sum(n), F.lit(0.0)) for n in names)).first())

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for t, *w in zip(b.column("text").to_pylist(), *(b.column(n).to_pylist() for n in names)):
                w = np.array(w)
                for u, c in Counter(units(t)).items():
                    if u in sums:
                        sums[u] += c * w
                    else:
                        sums[u] = c * w
            if len(sums) > 100_000:
                yield flush(sums)
        if sums:
            yield flush(sums)

    def flush(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
        table = np.array(list(sums.values()))
        out = pa.RecordBatch.from_arrays([pa.array(list(sums)), *(pa.array(table[:, k]) for k in range(LEVELS))], names=["unit", *names])
        sums.clear()
        return out

    counted = known.select("text", *names).mapInArrow(tally, "unit string, " + ", ".join(f"{n} double" for n in names))
    counted = counted.groupBy("unit").agg(*(F.sum(n).alias(n) for n in names))
    rows = counted.toArrow().to_pydict()
    return Model({u: list(c) for u, *c in zip(rows["unit"], *(rows[n] for n in names))}, weights)


def levels(documents: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """doc_id, reading_level and margin of every document."""
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(train(documents, labels, **settings))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            got = [model.level(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.int32()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "reading_level", "margin"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, reading_level int, margin double")


def profile(leveled: DataFrame, documents: DataFrame) -> DataFrame:
    """Documents and characters by source and level."""
    rows = documents.select("doc_id", F.regexp_replace(F.lower(F.trim("source")), r"[\s\-]+", "_").alias("source"), F.coalesce(F.length("text"), F.lit(0)).alias("chars"))
    return leveled.join(rows, "doc_id").groupBy("source", "reading_level").agg(F.count(F.lit(1)).alias("documents"), F.sum("chars").alias("chars"))
