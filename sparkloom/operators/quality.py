"""Validation of items and statistics for reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.operators.ranking import ranked

REQUIRED = ("source", "url", "title", "series_id", "chunk_index", "total_chunks", "tokens")


def item_issues(required: tuple[str, ...] = REQUIRED, text: str = "text", tokens: str = "tokens") -> tuple[Column, Column]:
    """(errors, warnings) of a training item, as arrays in a fixed order. A required value lacks if it is null or empty."""
    n = F.col(tokens).try_cast("int")
    missing = [F.when(T.is_blank(F.col(f)), F.lit(f"missing:{f}")) for f in required]
    errors = [
        *missing,
        F.when(F.length(T.strip(F.coalesce(text, F.lit("")))) < 80, "short_text"),
        F.when(n.isNull(), "tokens_not_integer").when(n <= 0, "no_tokens"),
        F.when(T.garbled(F.col(text)), "garbled"),
    ]
    warnings = [F.when((n > 0) & (n < 30), "few_tokens").when(n > 1500, "many_tokens")]
    return F.array_compact(F.array(*errors)), F.array_compact(F.array(*warnings))


def validate(rows: DataFrame, row_id: str = "record_id", **settings) -> DataFrame:
    """row_id, is_valid, errors and warnings of training items."""
    errors, warnings = item_issues(**settings)
    return rows.select(row_id, (F.size(errors) == 0).alias("is_valid"), errors.alias("errors"), warnings.alias("warnings"))


def record_issues(series: dict[str, Column], prices: tuple[Column, ...], models: Column, total: Column, car_ids: Column, news_titles: Column) -> tuple[Column, Column]:
    """(issues, warnings) of a clean record, as arrays in a fixed order: series fields that lack, no price, no model, a
    garbled name; a total score outside 0 to 500, repeated car ids, news without a title. series: by field, series_name
    among them; models: their number; total: a number or null; car_ids, news_titles: arrays."""
    issues = [*(F.when(T.is_blank(c), F.lit(f"series.{f} missing")) for f, c in series.items())]
    issues.append(F.when(F.forall(F.array(*prices), lambda p: p.isNull() | (p == "")), "price missing"))
    issues.append(F.when(F.coalesce(models, F.lit(0)) <= 0, "no models"))
    issues.append(F.when(T.garbled(series["series_name"]), "series_name garbled"))
    repeated, untitled = duplicates_in(car_ids), F.size(F.filter(F.coalesce(news_titles, F.array().cast("array<string>")), lambda t: t.isNull() | (t == "")))
    warnings = [F.when((total < 0) | (total > 500), "total_score out of range"), F.when(repeated > 0, F.concat(F.lit("repeated car_id: "), repeated.cast("string"))), F.when(untitled > 0, F.concat(F.lit("untitled news: "), untitled.cast("string")))]
    return F.array_compact(F.array(*issues)), F.array_compact(F.array(*warnings))


def report_summary(validations: DataFrame, items: DataFrame, dropped: int = 0, series: str = "series_id") -> DataFrame:
    """One row: records, valid, invalid and warned ones (is_valid, warnings), items, dropped items and the distinct series
    that items cover."""
    of_records = validations.agg(F.count(F.lit(1)).alias("series_total"), F.count_if("is_valid").alias("series_valid"), F.count_if(~F.col("is_valid")).alias("series_invalid"), F.count_if(F.size("warnings") > 0).alias("series_with_warnings"))
    of_items = items.agg(F.count(F.lit(1)).alias("items"), F.countDistinct(F.when(F.col(series) != "", F.col(series))).alias("covered_series"))
    return of_records.join(F.broadcast(of_items)).withColumn("dropped", F.lit(dropped).cast("bigint"))  # one row each


def number_stats(rows: DataFrame, value: str) -> DataFrame:
    """One row: min, max, mean and median (two decimals) of the values that are numbers; zeros if there are none."""
    zero = F.lit(0)
    return rows.agg(
        F.coalesce(F.min(value), zero).alias("min"), F.coalesce(F.max(value), zero).alias("max"),
        F.coalesce(F.round(F.avg(value), 2), F.lit(0.0)).alias("avg"), F.coalesce(F.round(F.median(value), 2), F.lit(0.0)).alias("median"),
    )


def coverage(rows: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """field, percent: the share of rows (two decimals) in which a field is neither null nor empty. 0 of no rows."""
    sums = rows.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(c).alias(name) for name, c in fields.items()))
    pairs = F.map_from_arrays(F.array(*(F.lit(f) for f in fields)), F.array(*(F.col(f"`{f}`") for f in fields)))
    flat = sums.select("n", F.explode(pairs).alias("field", "have"))
    return flat.select("field", F.when(F.col("n") == 0, 0.0).otherwise(F.round(100.0 * F.col("have") / F.col("n"), 2)).alias("percent"))


def histogram(rows: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """bin (from 0), low, high, n: equal bins between the least and the greatest value, which falls into the last one.
    Nulls are left out; a single value has one bin."""
    x = rows.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("x"))
    ends = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    placed = x.join(F.broadcast(ends), F.col("x") >= F.col("lo"))  # one row of ends
    bin_ = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col("x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))), F.lit(bins - 1)))
    width = (F.col("hi") - F.col("lo")) / bins
    out = placed.groupBy(bin_.cast("int").alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
    return out.select("bin", (F.col("lo") + width * F.col("bin")).alias("low"), (F.col("lo") + width * (F.col("bin") + 1)).alias("high"), "n")


def duration_stats(rows: DataFrame, group: str, row_id: str, value: str) -> DataFrame:
    """group, n, avg, median, p95 and max. p95 is the value at place max(floor(0.95 n) - 1, 0) in order; it is found by
    rank, so no group is gathered into one task. Nulls in group or value are left out."""
    x = rows.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(group, F.col(value).alias("v"), row_id)
    stats = x.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("v"), 4).alias("avg"), F.max("v").alias("max"))
    places = ranked(x, group, "v", row_id).join(stats.select(group, "n"), group)
    at = F.col("rank")
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    picked = places.groupBy(group).agg(
        F.max(F.when(at == F.greatest(F.floor(F.col("n") * 0.95) - 1, F.lit(0)), F.col("v"))).alias("p95"),
        ((F.max(F.when(at == low, F.col("v"))) + F.max(F.when(at == high, F.col("v")))) / 2).alias("median"),
    )
    return stats.join(picked, group).select(group, "n", "avg", F.round("median", 4).alias("median"), "p95", "max")


def duplicates_in(values: Column) -> Column:
    """How many elements of an array repeat another; nulls and empty ones don't count."""
    kept = F.filter(values, lambda v: v.isNotNull() & (v.cast("string") != ""))
    return F.size(kept) - F.size(F.array_distinct(kept))
