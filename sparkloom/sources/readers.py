"""Scans: JSON lines, pages, directories of files, vectors, small state files."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions import text

#: What a chunk carries besides its text.
METADATA = "source string, url string, title string, series_id string, brand_name string, car_type string, model_count int, news_count int, chunk_index int, total_chunks int, tokens int, crawl_timestamp string"
ITEM = f"metadata struct<{METADATA.replace(' string', ':string').replace(' int', ':int')}>, text string"


def json_lines(spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType = ITEM) -> DataFrame:
    """Rows of one or several JSON lines files with a declared schema. Blank lines are skipped, values of a wrong type are
    null, lines that can't be read are rows of nulls. Several inputs are one table with all rows."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json([paths] if isinstance(paths, str) else list(paths))


def line_count(spark: SparkSession, path: str) -> int:
    """Lines that aren't blank."""
    return spark.read.text(path).where(F.trim("value") != "").count()


def pages(spark: SparkSession, folder: str, pattern: str = "series_*.html") -> DataFrame:
    """series_id, path and html of the page files in a folder, by the number in their names."""
    files = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(folder, wholetext=True)
    name = F.col("_metadata.file_name")
    return files.select(F.regexp_extract(name, r"series_(\d+)\.", 1).alias("series_id"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))


def raw_files(spark: SparkSession, folder: str, pattern: str = "series_*.json") -> DataFrame:
    """series_id, path and text of raw JSON files."""
    files = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").text(folder, wholetext=True)
    ids = F.regexp_extract(F.col("_metadata.file_name"), r"series_(\d+)\.json$", 1)
    return files.select(ids.alias("series_id"), F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw_json")).where("series_id != ''")


def file_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct series ids in the names of page and JSON files; file contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "series_*").option("recursiveFileLookup", "true").load(folder).select("path")
    return files.select(F.regexp_extract("path", r"series_(\d+)\.(?:json|html)$", 1).alias("series_id")).where("series_id != ''").distinct()


def embedded_json(html_pages: DataFrame, key: str, html: str) -> DataFrame:
    """key and the JSON in each page's script; null where there is none."""
    return html_pages.select(key, text.next_data(F.col(html)).alias("raw_json"))


def linked_ids(html_pages: DataFrame, html: str) -> DataFrame:
    """Distinct series ids linked in the pages."""
    return html_pages.select(F.explode(text.series_ids(F.col(html))).alias("series_id")).distinct()


def first_by(rows: DataFrame, order: str, most: int) -> DataFrame:
    """The first rows by a column: an early stop that doesn't hang on the order of reading."""
    return rows.orderBy(order).limit(most)


def latest_file(spark: SparkSession, folder: str, pattern: str = "*") -> str | None:
    """Path of the file changed last."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path", "modificationTime")
    row = files.orderBy(F.desc("modificationTime"), F.desc("path")).first()
    return row.path if row else None


def state(path: str | Path, default: Any = None) -> Any:
    """A small JSON document beside the driver; the default if it is missing or broken."""
    try:
        return json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return {} if default is None else default
