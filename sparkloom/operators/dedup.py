"""Exact and normalised duplicates, first come first kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text as T


def duplicate_labels(rows: DataFrame, row_id: str, text: str, accepted: Column | None = None) -> DataFrame:
    """row_id, label and matched_id. The first accepted row (all are, unless told) of each normalised text is kept; later
    ones are exact_content if their text equals its text, else normalized_text. Null and empty texts are one text. Only
    groups of several rows are joined back, combined before the shuffle."""
    hashed = rows.select(F.col(row_id).alias("id"), T.content_hash(F.col(text)).alias("content"), T.normal_hash(F.col(text)).alias("normal"), (F.lit(True) if accepted is None else F.coalesce(accepted, F.lit(False))).alias("ok"))
    first = F.min(F.when(F.col("ok"), F.struct("id", "content"))).alias("first")
    groups = hashed.groupBy("normal").agg(F.count(F.lit(1)).alias("n"), first).where("n > 1 AND first IS NOT NULL").drop("n")
    later = F.col("id") > F.col("first.id")
    label = F.when(later, F.when(F.col("content") == F.col("first.content"), "exact_content").otherwise("normalized_text")).otherwise("none")
    return hashed.join(groups, "normal", "left").select(F.col("id").alias(row_id), F.coalesce(label, F.lit("none")).alias("label"), F.when(later, F.col("first.id")).alias("matched_id"))


def against_manifest(rows: DataFrame, manifest: DataFrame, row_id: str, text: str) -> DataFrame:
    """row_id, label and matched_id against accepted texts: manifest has kind (content or normal), hash and matched_id.
    A hit by content comes before one by normalised text; of several the smallest id counts."""
    hashed = rows.select(F.col(row_id).alias("id"), T.content_hash(F.col(text)).alias("content"), T.normal_hash(F.col(text)).alias("normal"))
    by = manifest.groupBy("kind", "hash").agg(F.min("matched_id").alias("m"))
    exact = by.where("kind = 'content'").select(F.col("hash").alias("content"), F.col("m").alias("by_content"))
    loose = by.where("kind = 'normal'").select(F.col("hash").alias("normal"), F.col("m").alias("by_normal"))
    label = F.when(F.col("by_content").isNotNull(), "exact_content").when(F.col("by_normal").isNotNull(), "normalized_text").otherwise("none")
    joined = hashed.join(exact, "content", "left").join(loose, "normal", "left")
    return joined.select(F.col("id").alias(row_id), label.alias("label"), F.coalesce("by_content", "by_normal").alias("matched_id"))


def last_written(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key by the order given: an upsert. Rows with a null key are one key."""
    best = F.max(F.struct(*order, *(c for c in rows.columns if c not in (*order, key)))).alias("b")
    out = rows.groupBy(key).agg(best)
    return out.select(*(F.col(c) if c == key else F.col(f"b.{c}") for c in rows.columns))
