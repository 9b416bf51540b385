"""Session helpers: shared working tables, size-checked broadcasts, table reading."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a written table up to which joins may broadcast it; beyond it both sides are shuffled.
BROADCAST_BYTES = 32 << 20
_SHIPPED: set[str] = set()
#: Paths of the tables written in this process.
_WRITTEN: list[str] = []


def ship(spark: SparkSession) -> bool:
    """Send this package to the workers, once for each application, unless their Python path has it already (they get the
    driver's PYTHONPATH and, in local mode, its working folder)."""
    root = Path(__file__).resolve().parents[2]
    known = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p] + [os.getcwd()]
    app = spark.sparkContext.applicationId
    if app in _SHIPPED or root in {Path(p).resolve() for p in known}:
        return False
    _SHIPPED.add(app)
    packed = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="sparkloom-code-")) / "sparkloom"), "zip", root, "sparkloom")
    spark.sparkContext.addPyFile(packed)  # Spark's own file server takes it from the driver to the executors
    return True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (spark.checkpoint.dir). Only in local mode, where it is unset, one of our own; on a
    cluster a folder of one machine would hold but a part of each table, so there it is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="sparkloom-")
        spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, survives the loss of executors, and gives the
    optimizer real sizes."""
    spark = df.sparkSession
    ship(spark)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_parts(df: DataFrame, name: str, by: list[str]) -> list[str]:
    """Write df to the shared folder, a folder and, about, a file for each value of the columns by; the files' paths."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.repartition(*by).sortWithinPartitions(*by).write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).inputFiles()


def release(spark: SparkSession) -> int:
    """Delete the tables written so far in this session, once their readers are done; returns how many there were."""
    conf, n = spark._jsc.hadoopConfiguration(), len(_WRITTEN)
    while _WRITTEN:
        p = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        p.getFileSystem(conf).delete(p, True)
    return n


def size_of(df: DataFrame) -> int:
    """Bytes of the files below a materialized table."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    total = 0
    for f in df.inputFiles():
        p = jvm.org.apache.hadoop.fs.Path(f)
        total += p.getFileSystem(conf).getFileStatus(p).getLen()
    return total


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A materialized table, marked for broadcast if its files are below the limit; otherwise as it is (shuffle join)."""
    return F.broadcast(df) if size_of(df) <= limit else df
