"""Streams: windowed sums with late data, deduplication within a watermark and against all that was accepted, and state
by session."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sparkloom.plans.shared import shared_dir


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table's files as a stream, with the schema of what is there."""
    schema = spark.read.parquet(f"{folder}/{table}.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/{table}.parquet*")
    zoneless = [f.name for f in schema if f.dataType.typeName() == "timestamp_ntz"]  # event time must have a zone
    return rows.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def windows(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """start, event_type, n, total of tumbling windows; rows later than the watermark are left out."""
    by = events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "event_type")
    return by.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def once(events: DataFrame, key: str, late: str = "1 hour") -> DataFrame:
    """The first row of each key within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """user_id, start, end, n of sessions that end after a gap."""
    by = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("w"))
    return by.agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def ingest_new(batch: DataFrame, accepted: str, key: str) -> None:
    """For foreachBatch: append the rows whose key has not been accepted, one of each."""
    spark = batch.sparkSession
    new = batch.dropDuplicates([key])
    try:
        new = new.join(spark.read.parquet(accepted).select(key), key, "left_anti")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    new.write.mode("append").parquet(accepted)


def running_totals(events: DataFrame) -> DataFrame:
    """user_id, n, total after each batch: state by key, held by the engine."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for f in frames:
            n, total = n + len(f), total + float(f["value"].fillna(0).sum())
        state.update((n, total))
        yield pd.DataFrame({"user_id": [key[0]], "n": [n], "total": [total]})

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, mode: str = "append", keys: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """Run a stream over all that is there now, and read what it wrote to the shared folder. In complete mode the last batch
    stands; in update mode each batch is kept with its number, and of a key the last one stands."""
    spark = stream.sparkSession
    path = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True)
    if mode == "append":
        writer.format("parquet").option("path", f"{path}/rows").start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{path}/rows")
    if mode == "complete":
        writer.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{path}/rows")).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(f"{path}/rows")
    writer.foreachBatch(lambda df, n: df.withColumn("_batch", F.lit(n)).write.mode("overwrite").parquet(f"{path}/rows/{n}")).start().awaitTermination()
    rest = [c for c in stream.columns if c not in keys]
    rows = spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("_batch", T.IntegerType())])).parquet(f"{path}/rows/*")
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("last")).select(*keys, "last.*")
    return last.select(*stream.columns)
