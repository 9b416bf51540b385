"""Row numbers within groups of any size, without a window that puts a group into one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.plans.shared import materialize, ship, small


def ranked(rows: DataFrame, group: str, *order: str, name: str = "rank") -> DataFrame:
    """rows with their number (from 0) within the group, in the order of the columns given, which should be unique; ties
    are numbered in any order. The group must not be null. Rows are range-partitioned by group and order, numbered within
    their partition, and moved on by what earlier partitions hold of their group: one row for each partition and group
    that continues, which is all that is looked up."""
    parted = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("_part", F.spark_partition_id())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = None, 0
        for b in batches:
            at = []
            for g in b.column(group).to_pylist():
                held, n = (g, n + 1) if g == held else (g, 0)
                at.append(n)
            yield b.append_column("_place", pa.array(at, pa.int64()))

    ship(rows.sparkSession)
    schema = T.StructType([*parted.schema.fields, T.StructField("_place", T.LongType())])
    placed = materialize(parted.mapInArrow(number, schema), "ranked")
    held = placed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("n"))
    # One row for each partition and group: what comes before is a running sum over the few partitions of a group.
    before = F.coalesce(F.sum("n").over(W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    skips = materialize(held.select(group, "_part", before.alias("skip")).where("skip > 0"), "skips")
    out = placed.join(small(skips), [group, "_part"], "left")
    return out.select(*rows.columns, (F.col("_place") + F.coalesce("skip", F.lit(0))).alias(name))
