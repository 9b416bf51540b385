"""Filling fixed-capacity containers with items.

Method: length-histogram planning. Items are counted by size, at most as many sizes as the capacity; best-fit decreasing
is carried out over the counts, where all containers of equal history are one range of container numbers; and the items
take the planned slots by joining on their rank within their size. The plan has a row for each step, not for each item.

An item larger than the capacity is split into full parts and a rest; no other item is split. Items of size 0 (null, empty
texts) take no space and are left out. Ties within a size go by item id. Every remaining item or part is in exactly one
container, and no container holds more than its capacity. An empty table gives no containers.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import tokens
from sparkloom.operators.ranking import ranked
from sparkloom.plans.shared import materialize, small

CAPACITY = 2048


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """(size, first rank, count, first container): items of a size with the ranks first rank and on go one each into
    count containers from first container on. Best fit: each into the fullest container that takes it."""
    steps: list[tuple[int, int, int, int]] = []
    ranges: dict[int, list[tuple[int, int]]] = {}  # space left: ranges (first container, count)
    spaces: list[int] = []
    opened = 0

    def put(space: int, first: int, count: int) -> None:
        if count and space:
            if space not in ranges:
                ranges[space] = []
                insort(spaces, space)
            ranges[space].append((first, count))

    for size in sorted(histogram, reverse=True):
        left, rank = histogram[size], 0
        while left:
            i = bisect_left(spaces, size)
            if i < len(spaces):
                space = spaces[i]
                first, count = ranges[space].pop()
                if not ranges[space]:
                    del ranges[space]
                    spaces.pop(i)
                n = min(left, count)
                put(space, first + n, count - n)
            else:
                # As many new containers as the rest fills, each with as many items of the size as it takes.
                each = capacity // size
                n = max(1, left // each)
                space, first = capacity, opened
                opened += n
                for k in range(1, min(each, left // n)):
                    steps.append((size, rank, n, first))
                    rank, left, space = rank + n, left - n, space - size
                n = min(n, left)
            steps.append((size, rank, n, first))
            rank, left = rank + n, left - n
            put(space - size, first, n)
    return steps


def items(rows: DataFrame, row_id: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """row_id, part (from 0), tokens: the items of rows with a size (tokens), those above the capacity in parts."""
    parts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("tokens") - 1) / capacity))
    cut = rows.where("tokens > 0").select(row_id, "tokens", F.explode(parts).alias("part"))
    return cut.select(row_id, F.col("part").cast("int").alias("part"), F.least(F.col("tokens") - F.col("part") * capacity, F.lit(capacity)).cast("int").alias("tokens"))


def fill(rows: DataFrame, row_id: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """container_id, row_id, part, tokens: the items of rows (row_id, tokens) in containers."""
    numbered = ranked(items(rows, row_id, capacity), "tokens", row_id, "part")
    counts = numbered.groupBy("tokens").agg(F.count(F.lit(1)).alias("n")).collect()  # at most capacity rows
    steps = plan({r.tokens: r.n for r in counts}, capacity)
    spark = rows.sparkSession
    planned = spark.createDataFrame(steps, "size int, first_rank bigint, n bigint, first_container bigint")
    # The plan grows with the number of sizes, not of items.
    inside = (F.col("tokens") == F.col("size")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("n"))
    placed = numbered.join(small(materialize(planned, "plan")), inside)
    return placed.select((F.col("first_container") + F.col("rank") - F.col("first_rank")).alias("container_id"), row_id, "part", "tokens")


def fill_documents(documents: DataFrame, capacity: int = CAPACITY, tokenizer: str = tokens.TOKENIZER) -> DataFrame:
    """fill, with the sizes of documents.text in tokens."""
    sized = materialize(tokens.with_tokens(documents.select("doc_id", "text"), path=tokenizer), "sizes")
    return fill(sized, "doc_id", capacity)


def fill_report(filled: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """container_id, items, used, unused and fill of every container."""
    by = filled.groupBy("container_id").agg(F.count(F.lit(1)).alias("items"), F.sum("tokens").alias("used"))
    return by.select("container_id", "items", "used", (F.lit(capacity) - F.col("used")).alias("unused"), F.round(F.col("used") / capacity, 6).alias("fill"))
