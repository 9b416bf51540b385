"""Fused retrieval from dense and sparse hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkloom.operators.sparse import Index, index, top
from sparkloom.plans.shared import materialize

#: Weights of reciprocal ranks, dense score, sparse score and coverage. Fixed values.
WEIGHTS = (0.55, 0.25, 0.15, 0.05)
RRF_K = 60


def min_max(x: Column, low: Column, high: Column) -> Column:
    """x within the range of the scores; 0 if there is no range. Beyond the range it is below 0 or above 1."""
    return F.when(high - low <= 1e-8, 0.0).otherwise((x - low) / (high - low))


def fuse(questions: DataFrame, docs: DataFrame, dense: DataFrame, sparse: DataFrame, k: int = 6, keep: int = 12, rrf_k: int = RRF_K, doc_id: str = "doc_id", text: str = "text", rerank: DataFrame | None = None, rerank_weight: float = 0.65, known: Index | None = None) -> DataFrame:
    """question_id, doc_id, score, rank. dense, sparse: question_id, doc_id, score, rank. A document missing on one side
    has score 0 there, which is taken through the range of the scores that are there. Coverage is the share of the
    question's distinct tokens that the document holds, counted by the numbers of the terms asked (known: the index, if
    there is one), so no text is moved. The best keep documents may be ranked again by a model's scores
    (rerank: question_id, doc_id, model_score); what the model doesn't score stays as it is."""
    side = lambda df, s: df.select("question_id", "doc_id", F.col("score").alias(f"{s}_score"), F.col("rank").alias(f"{s}_rank"))
    both = side(dense, "dense").join(side(sparse, "sparse"), ["question_id", "doc_id"], "full_outer")
    per = W.partitionBy("question_id")  # at most the hits of both sides
    zero = F.lit(0.0)
    norm = lambda s: min_max(F.coalesce(f"{s}_score", zero), F.coalesce(F.min(f"{s}_score").over(per), zero), F.coalesce(F.max(f"{s}_score").over(per), zero))
    rrf = F.coalesce(1.0 / (rrf_k + F.col("dense_rank")), zero) + F.coalesce(1.0 / (rrf_k + F.col("sparse_rank")), zero)
    scored = both.select("question_id", "doc_id", rrf.alias("rrf"), norm("dense").alias("d"), norm("sparse").alias("s"))
    known = known or index(questions, docs, doc_id, text)
    asked = materialize(questions.sparkSession.createDataFrame(known.asked).select("question_id", F.array_distinct("terms").alias("q")), "asked")
    wanted = scored.join(asked, "question_id").join(known.held.select("doc_id", "terms"), "doc_id")
    share = F.when(F.size("q") == 0, 0.0).otherwise(F.size(F.array_intersect("q", "terms")) / F.size("q"))
    a, b, c, d = WEIGHTS
    first = top(wanted.select("question_id", "doc_id", F.round(a * F.col("rrf") + b * F.col("d") + c * F.col("s") + d * share, 6).alias("score")), max(keep, k))
    return top((first if rerank is None else reranked(first, rerank, rerank_weight)).drop("rank"), k)


def reranked(hits: DataFrame, model: DataFrame, weight: float) -> DataFrame:
    """Scores mixed with a model's scores, taken through their range within the question."""
    alpha = max(0.0, min(1.0, weight))
    per = W.partitionBy("question_id")
    joined = hits.join(model, ["question_id", "doc_id"], "left")
    norm = min_max(F.col("model_score"), F.min("model_score").over(per), F.max("model_score").over(per))
    return joined.withColumn("score", F.coalesce((1 - alpha) * F.col("score") + alpha * norm, F.col("score"))).drop("model_score")


def context(hits: DataFrame, docs: DataFrame, budget: int = 3000, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """question_id, context: the texts of a question's hits in rank order, up to the first that exceeds the budget of
    characters. Hits are few for each question."""
    rows = hits.join(docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text")), "doc_id")
    used = F.sum(F.length("text")).over(W.partitionBy("question_id").orderBy("rank"))
    kept = rows.withColumn("used", used).where(F.col("used") <= budget)
    return kept.groupBy("question_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]), "\n\n").alias("context"))
