import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("shared"))).config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


#: Names that operators use inside, put beside the columns they read.
CLASHES = ["id", "a", "b", "key", "tid", "len", "row", "mark", "place", "rank", "n", "row_id", "at", "part", "size", "x", "y", "h", "g", "s", "first", "since", "held", "segs", "spot", "star", "value", "values", "bucket", "level"]


@pytest.fixture
def clash():
    from pyspark.sql import functions as F

    def add(df):
        return df.withColumns({c: F.lit("other") for c in CLASHES if c not in {x.lower() for x in df.columns}})

    return add
