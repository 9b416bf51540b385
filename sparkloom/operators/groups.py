"""Rows within groups: the best n, a representative with merged texts, round robin, running budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def best(rows: DataFrame, group: str, n: int, *order: Column) -> DataFrame:
    """The first n rows of each group in the order given, with their place from 1. The limit is applied before the
    shuffle, so a large group sends n rows from each partition."""
    return rows.withColumn("place", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("place") <= max(1, n))


def profile(rows: DataFrame, group: str, row_id: str, scores: list[str], text: str, order: tuple[Column, ...], top: int = 3, least: int = 2) -> DataFrame:
    """One row for each group of at least ``least`` rows: n, the means of the scores (over sums of four decimals, so that they don't hang on the order of rows), the id of the best
    row and the texts of the best ``top`` rows joined by blank lines."""
    sums = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *((F.round(F.sum(s), 4) / F.count(s)).alias(f"avg_{s}") for s in scores)).where(F.col("n") >= least)
    firsts = best(rows, group, top, *order).groupBy(group).agg(F.sort_array(F.collect_list(F.struct("place", F.col(row_id).alias("id"), F.coalesce(text, F.lit("")).alias("t")))).alias("b"))
    return sums.join(firsts, group).select(group, "n", *(f"avg_{s}" for s in scores), F.get("b", F.lit(0))["id"].alias("best_id"), F.array_join(F.transform("b", lambda x: x["t"]), "\n\n").alias("merged"))


def round_robin(rows: DataFrame, order: str, choices: list[str], name: str) -> DataFrame:
    """Each row gets the choices in turn, in the order given; rows are numbered without a window over all of them."""
    from sparkloom.operators.ranking import ranked

    numbered = ranked(rows.withColumn("_all", F.lit(0)), "_all", order, name="_n")
    return numbered.withColumn(name, F.element_at(F.array(*map(F.lit, choices)), (F.col("_n") % len(choices)).cast("int") + 1)).drop("_all", "_n")


def within_budget(rows: DataFrame, group: str, order: tuple[Column, ...], size: Column, budget: int) -> DataFrame:
    """Rows of each group in order up to the first whose running size exceeds the budget. Meant for groups that were
    limited before."""
    used = F.sum(size).over(W.partitionBy(group).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn("used", used).where(F.col("used") <= budget)


def split_counts(rows: DataFrame, split: str, group: str) -> DataFrame:
    """split, rows and distinct groups."""
    return rows.groupBy(split).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(group).alias("groups"))
