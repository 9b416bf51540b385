"""Sinks: JSON lines, flat parquet, stores of chunks, runs, queries and vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.plans.shared import materialize


def json_lines(rows: DataFrame, path: str, append: bool = False) -> None:
    rows.write.mode("append" if append else "overwrite").json(path)


def flat(rows: DataFrame) -> DataFrame:
    """Structs, arrays and maps as JSON text, other columns as they are."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return rows.select(*(F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in rows.schema))


def flat_parquet(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    flat(rows).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


EXPORTED = ("source", "url", "title", "series_id", "brand_name", "car_type", "model_count", "news_count", "chunk_index", "total_chunks", "tokens", "crawl_timestamp")


def training_items(items: DataFrame, path: str) -> None:
    """The exported metadata and the text of items (metadata, text)."""
    items.select(*(F.col(f"metadata.{c}").alias(c) for c in EXPORTED), "text").write.mode("overwrite").parquet(path)


#: Columns of the summary of clean records: group of the record, or none, and field.
SUMMARY = [("", f) for f in ("schema_version", "source", "entity_type")] + [("series", f) for f in ("series_id", "series_name", "brand_name", "sub_brand_name", "car_type", "city_name")]
SUMMARY += [("pricing", f) for f in ("dealer_price_range", "official_price_range", "latest_owner_price", "lowest_owner_price")] + [("scores", f) for f in ("total_score", "total_review_count")]
SUMMARY += [("stats", f) for f in ("model_count", "dimension_group_count", "image_group_count", "news_count")]


def clean_summary(records: DataFrame, record: str = "record") -> DataFrame:
    """The 19 columns of the summary, as text, of clean records in JSON, one row for each; JSON that can't be read gives
    nulls."""
    return records.select(*(F.get_json_object(record, "$." + ".".join(filter(None, (group, field)))).alias(field) for group, field in SUMMARY))


def export_clean_summary(records: DataFrame, path: str, record: str = "record") -> None:
    clean_summary(records, record).write.mode("overwrite").parquet(path)


def whole(c: Column, default: int) -> Column:
    return F.coalesce(c.try_cast("int"), F.lit(default))


def chunk_rows(rows: DataFrame) -> DataFrame:
    """Chunks as the store keeps them: texts trimmed of nulls, positions -1 and sizes 0 where they are no numbers."""
    texts = ("source", "series_id", "title", "url", "text", "metadata_json")
    return rows.select(
        "record_id", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in texts), whole(F.col("chunk_index"), -1).alias("chunk_index"),
        whole(F.col("total_chunks"), 0).alias("total_chunks"), whole(F.col("tokens"), 0).alias("tokens"),
    )


def refresh(rows: DataFrame, path: str) -> None:
    """Replace a store with rows that may have been read from it."""
    materialize(rows, "refresh").write.mode("overwrite").parquet(path)


def log(spark: SparkSession, path: str, row: dict, schema: str) -> None:
    """Append one row to a log of runs or queries."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(path)


def save_vectors(rows: DataFrame, path: str, doc_id: str = "record_id", vector: str = "embedding", dim: int | None = None) -> int:
    """Write vectors, all of one length, and return it. Rows without a vector are left out; vectors of several lengths are
    an error, before anything is written."""
    kept = rows.where(F.col(vector).isNotNull())
    ends = kept.agg(F.min(F.size(vector)).alias("lo"), F.max(F.size(vector)).alias("hi")).first()
    if ends.hi is not None and (ends.lo != ends.hi or dim not in (None, ends.hi)):
        raise ValueError(f"vectors of {ends.lo} to {ends.hi} numbers, wanted {dim or 'one length'}")
    kept.write.mode("overwrite").parquet(path)
    return ends.hi or 0


def load_vectors(spark: SparkSession, path: str, dim: int | None = None, vector: str = "embedding") -> DataFrame:
    """A saved table of vectors, probed against the length that questions have."""
    rows = spark.read.parquet(path)
    probe = rows.select(F.size(vector).alias("n")).first()
    if dim is not None and probe and probe.n != dim:
        raise ValueError(f"the index has {probe.n} numbers a vector, the question {dim}")
    return rows


def by_series(rows: DataFrame, path: str, key: str = "series_id") -> None:
    """One folder of JSON lines for each series."""
    rows.write.mode("overwrite").partitionBy(key).json(path)


def governed(results: DataFrame, folder: str) -> None:
    """Write results (decision, steps, ...) once and send them to the audit, step, review and repair tables."""
    kept = materialize(results, "governed")
    kept.drop("steps").write.mode("append").json(f"{folder}/audit")
    kept.select("trace_id", F.explode("steps").alias("step")).select("trace_id", "step.*").write.mode("append").json(f"{folder}/steps")
    for decision in ("review", "repair"):
        kept.where(F.col("decision") == decision).drop("steps").write.mode("append").json(f"{folder}/{decision}")


def without_news(raw: Column, keys: Sequence[str]) -> Column:
    """A raw page's JSON whose page lacks the keys; the rest keeps its values, as text of JSON."""
    page = F.from_json(F.get_json_object(raw, "$.props.pageProps"), "map<string,string>")
    kept = F.map_filter(page, lambda k, v: ~k.isin(list(keys)))
    return F.to_json(kept)


def decisions(results: DataFrame, decision: str = "decision", scores: Sequence[str] = ()) -> DataFrame:
    """decision, n, and the sum and mean (four decimals) of each score, of the whole log."""
    sums = [c for s in scores for c in (F.round(F.sum(s), 4).alias(f"sum_{s}"), F.round(F.avg(s), 4).alias(f"avg_{s}"))]
    return results.groupBy(F.col(decision).alias("decision")).agg(F.count(F.lit(1)).alias("n"), *sums)


def running_summary(steps: DataFrame) -> DataFrame:
    """step, n, total_ms, max_ms, errors, of the whole log."""
    return steps.groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.sum("ms").alias("total_ms"), F.max("ms").alias("max_ms"), F.count_if("error").alias("errors"))
