"""Scores of answers and of retrieval."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Similarities from which a sentence or a context counts. Fixed values.
SUPPORTED, RELEVANT, RECALLED, RECALLED_SENTENCE = 0.35, 0.22, 0.20, 0.25

_TOKEN = re.compile(r"[a-z0-9]+|[一-鿿]")


def similarity(a: str | None, b: str | None) -> float:
    """Cosine of token counts; 0 if either has no token."""
    x, y = Counter(_TOKEN.findall((a or "").lower())), Counter(_TOKEN.findall((b or "").lower()))
    if not x or not y:
        return 0.0
    dot = sum(n * y[t] for t, n in x.items() if t in y)
    return dot / math.sqrt(sum(n * n for n in x.values()) * sum(n * n for n in y.values()))


def sentences(text: str | None) -> list[str]:
    return [s for s in (p.strip() for p in re.split(r"[。！？!?;\n]+", text or "")) if len(s) >= 4]


def _best(text: str, others: list[str]) -> float:
    return max((similarity(text, o) for o in others), default=0.0)


def faithfulness(answer: str | None, contexts: list[str]) -> float:
    """Share of the answer's sentences that a context, or all together, support. 0 without sentences or contexts."""
    said = sentences(answer)
    if not said or not contexts:
        return 0.0
    return sum(_best(s, [*contexts, "\n".join(contexts)]) >= SUPPORTED for s in said) / len(said)


def context_precision(question: str | None, answer: str | None, reference: str | None, contexts: list[str], references: list[str]) -> float:
    """Average precision of the contexts in their order; one is relevant if it is like the question, the answer, the
    reference or a reference context."""
    against = [t for t in (question, answer, reference, *references) if t]
    hits, total = 0, 0.0
    for place, c in enumerate(contexts, 1):
        if _best(c, against) >= RELEVANT:
            hits += 1
            total += hits / place
    return total / hits if hits else 0.0


def context_recall(reference: str | None, contexts: list[str], references: list[str]) -> float:
    """Share of the reference contexts, or without any of the reference's sentences, that a context is like."""
    wanted, least = ([r for r in references if r], RECALLED) if any(references) else (sentences(reference), RECALLED_SENTENCE)
    if not wanted or not contexts:
        return 0.0
    return sum(_best(w, contexts) >= least for w in wanted) / len(wanted)


def answer_scores(rows: DataFrame, row_id: str) -> DataFrame:
    """row_id and the four scores of rows with question, answer, reference (text) and contexts, reference_contexts (arrays
    of text). Nulls are empty; null elements are left out."""
    names = ["faithfulness", "answer_relevancy", "context_precision", "context_recall"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list[float]] = [[] for _ in names]
            for q, a, ref, ctx, refs in zip(*(b.column(c).to_pylist() for c in ("question", "answer", "reference", "contexts", "reference_contexts"))):
                ctx, refs = [c for c in ctx or [] if c], [c for c in refs or [] if c]
                for col, v in zip(out, (faithfulness(a, ctx), similarity(q, a), context_precision(q, a, ref, ctx, refs), context_recall(ref, ctx, refs))):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([b.column("row_id"), *(pa.array(c, pa.float64()) for c in out)], names=["row_id", *names])

    kind = rows.schema[row_id].dataType.simpleString()
    src = rows.select(F.col(row_id).alias("row_id"), "question", "answer", "reference", "contexts", "reference_contexts")
    return src.mapInArrow(run, f"row_id {kind}, " + ", ".join(f"{n} double" for n in names)).withColumnRenamed("row_id", row_id)


def mean(c: Column) -> Column:
    """Mean of the values that are numbers; 0 of none."""
    return F.coalesce(F.avg(F.nanvl(c.cast("double"), F.lit(None).cast("double"))), F.lit(0.0))


def retrieval_scores(hits: DataFrame, positives: DataFrame, questions: DataFrame) -> DataFrame:
    """question_id, hit, recall, reciprocal_rank. hits: question_id, rank, label, of which a label counts once for each
    question, at its first rank; positives: question_id, label. A question without hits has zeros, one without positives a
    recall of 0."""
    known = positives.where("label IS NOT NULL").select("question_id", "label").distinct()
    size = known.groupBy("question_id").agg(F.count(F.lit(1)).alias("wanted"))
    got = hits.groupBy("question_id", "label").agg(F.min("rank").alias("rank")).join(known, ["question_id", "label"], "left_semi")
    by = got.groupBy("question_id").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("found"))
    all_ = questions.select("question_id").distinct().join(by, "question_id", "left").join(size, "question_id", "left")
    return all_.select("question_id", F.col("first").isNotNull().cast("int").alias("hit"), F.coalesce(F.col("found") / F.col("wanted"), F.lit(0.0)).alias("recall"), F.coalesce(1.0 / F.col("first"), F.lit(0.0)).alias("reciprocal_rank"))


def citations(answer: Column) -> Column:
    """Numbers in square brackets, each once, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce(answer, F.lit("")), F.lit(r"\[(\d{1,6})\]"), F.lit(1)), lambda x: x.cast("int")))


def citation_scores(answers: DataFrame, hits: DataFrame, positives: DataFrame) -> DataFrame:
    """question_id, cited, right, precision. answers: question_id, answer; hits: question_id, rank, label. A citation is
    right if the hit of that rank has one of the question's positive labels."""
    cited = answers.select("question_id", F.explode_outer(citations(F.col("answer"))).alias("rank"))
    labels = cited.join(hits.select("question_id", "rank", "label"), ["question_id", "rank"], "left")
    judged = labels.join(positives.select("question_id", "label").distinct().withColumn("ok", F.lit(1)), ["question_id", "label"], "left")
    by = judged.groupBy("question_id").agg(F.count("rank").alias("cited"), F.count("ok").alias("right"))
    return by.withColumn("precision", F.when(F.col("cited") == 0, 0.0).otherwise(F.col("right") / F.col("cited")))


def gate(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """metric, actual, least, passed; a metric that is missing counts 0."""
    return thresholds.join(metrics, "metric", "left").select("metric", F.coalesce("value", F.lit(0.0)).alias("actual"), "least", (F.coalesce("value", F.lit(0.0)) >= F.col("least")).alias("passed"))


def drift(before: DataFrame, now: DataFrame, limits: DataFrame) -> DataFrame:
    """metric, before, now, drop of the metrics that dropped by more than their limit (metric, most, relative). Metrics
    without a value on either side raise nothing."""
    both = before.select("metric", F.col("value").alias("before")).join(now.select("metric", F.col("value").alias("now")), "metric").join(limits, "metric")
    drop = F.when(F.col("relative"), F.try_divide(F.col("before") - F.col("now"), F.col("before"))).otherwise(F.col("before") - F.col("now"))
    return both.withColumn("drop", drop).where("drop > most").select("metric", "before", "now", "drop")
