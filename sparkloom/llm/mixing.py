"""Mixing sources to target weights.

Method: hash-threshold histograms. Sizes are summed by source and hash bucket; for each source the budget that is left
after whole repeats becomes a threshold on the hash of the record id: the buckets below it are taken, and only the bucket
that holds the boundary is refined, level by level, until it holds one record. Records are then filtered by comparing
their hash with the threshold of their source; nothing is sorted. Thresholds are nested: a larger budget takes a superset.

The total is, unless given, the largest at which every source that has records reaches its share within its repeats, the
sources without records apart. A source that falls short of its share at a given total gives all it may.

Defined results. Sources are compared by their name in lower case with blanks and hyphens as underscores; null and
unknown sources have no target and are left out, as are records of size 0. A record id should be unique; equal ids are
chosen together. Repeats below one are one; a null share is 0. Empty tables give an empty mix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkloom.llm import tokens
from sparkloom.plans.shared import materialize

#: Bits of the hash that a level of the histogram resolves.
BITS = 12
#: Bits of the hash that are used.
DEPTH = 60


def source_name(source: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(source)), r"[\s\-]+", "_")


def _place(row_id: str) -> Column:
    """The hash of a record id as a number below 2^DEPTH."""
    return F.shiftrightunsigned(F.xxhash64(F.col(row_id), F.lit(9)), 64 - DEPTH)


def thresholds(sized: DataFrame, budgets: dict[str, int]) -> dict[str, int]:
    """For each source the number below which the places of its chosen records lie, so that their sizes come as near to
    the budget as whole records allow. sized: source, place, tokens. Every pass brings at most 2^BITS sums a source to the
    driver; the first reads all records, the later ones only boundary buckets."""
    known = {s: (0, 0, b) for s, b in budgets.items() if b > 0}  # prefix of the boundary bucket, its bits, what is left
    done = {s: 0 for s, b in budgets.items() if b <= 0}
    while known:
        within = F.lit(False)
        bucket = F.lit(None).cast("bigint")
        for s, (prefix, bits, _) in known.items():
            here = (F.col("source") == s) & (F.shiftright("place", DEPTH - bits) == prefix)
            within |= here
            bucket = F.when(here, F.shiftright("place", max(0, DEPTH - bits - BITS)).bitwiseAND(F.lit((1 << BITS) - 1))).otherwise(bucket)
        sums = sized.where(within).groupBy("source", bucket.alias("bucket")).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")).collect()
        by: dict[str, list[tuple[int, int, int]]] = {s: [] for s in known}
        for r in sums:
            by[r.source].append((r.bucket, r.tokens, r.n))
        for s in list(known):
            prefix, bits, left = known.pop(s)
            got = bits + BITS
            for b, size, n in sorted(by[s]):
                if size <= left:
                    left -= size
                    continue
                if n == 1 or got >= DEPTH:
                    take = size - left < left  # the boundary record is taken if that is nearer
                    done[s] = ((prefix << BITS) + b + take) << (DEPTH - got)
                else:
                    known[s] = ((prefix << BITS) + b, got, left)
                break
            else:
                done[s] = ((prefix + 1) << (DEPTH - bits)) if bits else 1 << DEPTH
    return done


def mix(rows: DataFrame, targets: DataFrame, row_id: str = "doc_id", total: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(chosen, report). rows: row_id, source, tokens. chosen: row_id, source, tokens, repeats. report: source, target,
    available and reached tokens, target_share, share and max_repeats. Targets are few: one row for each source."""
    spark = rows.sparkSession
    wanted = {r.source: r for r in targets.where("source IS NOT NULL").groupBy(source_name(F.col("source")).alias("source")).agg(F.sum(F.coalesce("target_share", F.lit(0.0))).alias("share"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(1))).alias("repeats")).collect()}
    sized = rows.where("tokens > 0").select(row_id, source_name(F.col("source")).alias("source"), _place(row_id).alias("place"), "tokens").where(F.col("source").isin(list(wanted)))
    have = {r.source: r.tokens for r in sized.groupBy("source").agg(F.sum("tokens").alias("tokens")).collect()}
    if total is None:
        limits = [have[s] * wanted[s].repeats / wanted[s].share for s in have if wanted[s].share > 0]
        total = math.floor(min(limits, default=0))
    whole: dict[str, int] = {}
    rest: dict[str, int] = {}
    for s, size in have.items():
        budget = min(round(wanted[s].share * total), size * wanted[s].repeats)
        whole[s], rest[s] = divmod(budget, size)
    below = thresholds(sized, rest)
    once = extra = F.lit(0)
    for s in have:
        once = F.when(F.col("source") == s, whole[s]).otherwise(once)
        extra = F.when((F.col("source") == s) & (F.col("place") < below[s]), 1).otherwise(extra)
    chosen = sized.withColumn("repeats", (once + extra).cast("int")).where("repeats > 0").select(row_id, "source", "tokens", "repeats")
    reached = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("reached"), F.count(F.lit(1)).alias("records"))
    plan = spark.createDataFrame([(s, float(w.share), int(w.repeats), int(have.get(s, 0))) for s, w in wanted.items()], "source string, target_share double, max_repeats int, available bigint")
    sums = plan.join(reached, "source", "left").select("source", "target_share", "max_repeats", "available", F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("reached", F.lit(0)).alias("reached"))
    everything = F.sum("reached").over(W.partitionBy(F.lit(0)))  # one row for each source
    report = sums.withColumn("share", F.round(F.col("reached") / F.nullif(everything, F.lit(0)), 6))
    return chosen, report


def mix_documents(documents: DataFrame, targets: DataFrame, total: int | None = None, tokenizer: str = tokens.TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """mix, with the sizes of documents.text in tokens."""
    sized = materialize(tokens.with_tokens(documents.select("doc_id", "source", "text"), path=tokenizer), "sizes")
    return mix(sized, targets, "doc_id", total)
