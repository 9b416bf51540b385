"""The shared folder and the optional subpackage."""

import pytest

from sparkloom.plans import shared


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


class _Session:
    sparkContext = _Context()

    class conf:
        @staticmethod
        def get(name, default):
            return default


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(_Session())


def test_update_mode_keeps_the_last_row_of_each_key(spark, tmp_path):
    from sparkloom.streaming import events

    folder = tmp_path / "in" / "events.parquet"
    for i in range(3):
        spark.createDataFrame([(u, float(i)) for u in range(i + 1)], "user_id long, value double").coalesce(1).write.mode("append").parquet(str(folder))
    rows = spark.readStream.schema("user_id long, value double").option("maxFilesPerTrigger", 1).parquet(str(folder))
    got = {r.user_id: (r.n, r.total) for r in events.drain(events.running_totals(rows), "update").collect()}
    assert got == {0: (3, 3.0), 1: (2, 3.0), 2: (1, 2.0)}
