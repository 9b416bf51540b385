"""Fetching through an injected fetcher, and discovery of what to fetch. Nothing here opens a connection by itself."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text
from sparkloom.plans.shared import materialize

#: Returns status and body of a URL, or raises.
Fetcher = Callable[[str], tuple[int, bytes]]


@dataclass
class Policy:
    """Retries with growing waits, and a least distance between requests of one task."""

    retries: int = 3
    distance: float = 0.8
    jitter: tuple[float, float] = (0.1, 0.4)
    longest: float = 8.0
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    _last: float | None = field(default=None, repr=False)

    def _throttle(self) -> None:
        if self._last is not None and (wait := self.distance - (self.clock() - self._last)) > 0:
            self.sleep(wait)
        self._last = self.clock()

    def fetch(self, fetcher: Fetcher, url: str) -> tuple[int | None, bytes | None, str | None]:
        """(status, body, error). Refusals other than 429 are final; other failures are tried again."""
        status = error = None
        for attempt in range(1, max(1, self.retries) + 1):
            self._throttle()
            try:
                status, body = fetcher(url)
                error = None if status < 400 else f"status {status}"
            except Exception as e:  # noqa: BLE001
                status, body, error = None, None, f"{type(e).__name__}: {e}"
            if error is None:
                return status, body, None
            if status is not None and 400 <= status < 500 and status != 429:
                break
            if attempt < self.retries:
                self.sleep(min(2.0 ** (attempt - 1), self.longest) + random.uniform(*self.jitter))
        return status, None, error


def fetch(urls: DataFrame, url: str, fetcher: Fetcher, policy: Callable[[], Policy] = Policy, tasks: int = 1) -> DataFrame:
    """url, status, body, error. tasks bounds how many fetch at once; a failure is a row, not an exception."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = policy()
        for b in batches:
            got = [p.fetch(fetcher, u) for u in b.column(0).to_pylist()]
            cols = [pa.array([g[i] for g in got], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["url", "status", "body", "error"])

    known = urls.select(F.col(url).alias("url")).where("url IS NOT NULL").distinct()
    return known.repartition(tasks).mapInArrow(run, "url string, status int, body binary, error string")


def frontier(seeds: DataFrame, expand: Callable[[DataFrame], DataFrame], target: int, most_rounds: int) -> DataFrame:
    """series_id, round: breadth first from the seeds. Each round expands what is new and keeps what hasn't been seen; it
    ends at the target, at the last round, or when nothing is new. Rounds are written, so lineage doesn't grow."""
    seen = materialize(seeds.select("series_id").where("series_id IS NOT NULL").distinct().withColumn("round", F.lit(0)), "frontier")
    fresh, total = seen, seen.count()
    for n in range(1, most_rounds + 1):
        if total >= target or fresh.isEmpty():
            break
        new = expand(fresh.select("series_id")).select("series_id").distinct().join(seen.select("series_id"), "series_id", "left_anti")
        fresh = materialize(new.withColumn("round", F.lit(n)), "frontier")
        seen, total = materialize(seen.union(fresh), "seen"), total + fresh.count()
    return seen.orderBy("round", "series_id").limit(target)


def from_entry_pages(templates: list[str], pages: int, fetcher: Fetcher, urls: DataFrame, **settings) -> DataFrame:
    """Distinct series ids found on the numbered pages of the entry templates ({page}). urls: an empty frame of the session."""
    spark = urls.sparkSession
    asked = spark.createDataFrame([(t,) for t in templates], "template string").select(F.explode(F.sequence(F.lit(1), F.lit(pages))).alias("n"), "template")
    asked = asked.select(F.replace("template", F.lit("{page}"), F.col("n").cast("string")).alias("url"))
    got = fetch(asked, "url", fetcher, **settings).where("error IS NULL").select(F.decode("body", "UTF-8").alias("html"))
    return got.select(F.explode(text.series_ids(F.col("html"))).alias("series_id")).distinct()


def assemble(home: DataFrame, *modules: DataFrame, key: str = "series_id") -> DataFrame:
    """The pages of a series side by side: its home page's JSON and that of each module (null where it is missing)."""
    out = home.select(key, F.col("raw_json").alias("home_json"))
    for i, m in enumerate(modules):
        out = out.join(m.select(key, F.col("raw_json").alias(f"module_{i}_json")), key, "left")
    return out
