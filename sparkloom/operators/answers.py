"""From hits to answers: what of a hit is shown, an answer without a model, and the whole pipeline. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.operators import hybrid

SNIPPET, SHOWN, SHOWN_CHARS = 240, 3, 120
# What an answer without a model says.
NOTHING = "根据当前检索内容无法确认。"
UNNAMED = "未知车系"


def semantic_text(brand: Column, name: Column, kind: Column, body: Column) -> Column:
    """The text of a record that is embedded: brand, name and type in one line (blanks stay where one lacks), then the body."""
    part = lambda c: T.strip(F.coalesce(c, F.lit("")))
    return T.strip(F.concat(T.strip(F.concat_ws(" ", part(brand), part(name), part(kind))), F.lit("\n"), part(body)))


def shown_hits(hits: DataFrame, docs: DataFrame, doc_id: str = "doc_id", chars: int = SNIPPET) -> DataFrame:
    """question_id, rank, doc_id, score, title, url, series_id and the first characters of the text of hits. docs must have
    each id once."""
    about = docs.select(F.col(doc_id).alias("doc_id"), *(F.coalesce(c, F.lit("")).alias(c) for c in ("title", "url", "series_id")), F.substring(F.coalesce("text", F.lit("")), 1, chars).alias("snippet"))
    return hits.select("question_id", "rank", "doc_id", "score").join(about, "doc_id")


def plain_answers(questions: DataFrame, shown: DataFrame) -> DataFrame:
    """question_id, answer: the titles and snippets of the first SHOWN hits of each question as a list; a question without
    hits gets NOTHING."""
    title = F.when(F.col("title") == "", UNNAMED).otherwise(F.col("title"))
    line = F.concat(F.col("rank").cast("string"), F.lit(". "), title, F.lit(": "), T.strip(F.substring("snippet", 1, SHOWN_CHARS)))
    lines = shown.where(F.col("rank") <= SHOWN).groupBy("question_id").agg(F.sort_array(F.collect_list(F.struct("rank", line.alias("line")))).alias("lines"))
    head = F.concat(F.lit("基于检索内容，和“"), F.coalesce("question", F.lit("")), F.lit("”最相关的信息如下："))
    text = F.concat_ws("\n", head, F.array_join(F.transform("lines", lambda x: x["line"]), "\n"), F.lit("如果你愿意，我可以继续围绕这几款车做价格、配置或对比分析。"))
    return questions.select("question_id", "question").join(lines, "question_id", "left").select("question_id", F.when(F.col("lines").isNull(), NOTHING).otherwise(text).alias("answer"))


def answered(questions: DataFrame, docs: DataFrame, hits: DataFrame, budget: int = 3000, doc_id: str = "doc_id", replies: DataFrame | None = None) -> DataFrame:
    """question_id, context, answer, by, sources: each question with the context of its hits within the budget of
    characters, a model's reply (question_id, answer, error) where there is one, else the plain answer, and the series of
    its hits, each once, in rank order."""
    shown = shown_hits(hits, docs, doc_id)
    plain = plain_answers(questions, shown).withColumnRenamed("answer", "plain")
    context = hybrid.context(hits, docs, budget, doc_id)
    sources = first_distinct(shown.select("question_id", "rank", F.col("series_id").alias("label")))
    out = plain.join(context, "question_id", "left").join(sources, "question_id", "left")
    if replies is not None:
        out = out.join(replies.where("answer IS NOT NULL").select("question_id", "answer"), "question_id", "left")
    said = F.col("answer") if replies is not None else F.lit(None).cast("string")
    return out.select(
        "question_id", F.coalesce("context", F.lit("")).alias("context"), F.coalesce(said, F.col("plain")).alias("answer"), F.when(said.isNotNull(), "model").otherwise("plain").alias("by"),
        F.coalesce("labels", F.array().cast("array<string>")).alias("sources"),
    )


def first_distinct(hits: DataFrame, n: int | None = None) -> DataFrame:
    """question_id, labels: the labels of a question's hits (question_id, rank, label), each once, in the order of their
    first hits, at most n. Empty ones are left out."""
    once = hits.where("label IS NOT NULL AND label != ''").groupBy("question_id", "label").agg(F.min("rank").alias("rank"))
    labels = F.transform(F.sort_array(F.collect_list(F.struct("rank", "label"))), lambda x: x["label"])
    return once.groupBy("question_id").agg((F.slice(labels, 1, n) if n else labels).alias("labels"))
