"""A query and its SQL over the same files."""

import os

import pandas as pd


def _plain(frame: pd.DataFrame) -> list[tuple]:
    def value(x):
        if x is None or x is pd.NaT or isinstance(x, float) and x != x:
            return None
        if isinstance(x, pd.Timestamp):
            return x.tz_convert(None) if x.tzinfo else x
        if isinstance(x, bool) or type(x).__name__ == "bool":
            return bool(x)
        return round(float(x), 6) if isinstance(x, (int, float)) or hasattr(x, "dtype") and x.ndim == 0 else str(x)

    frame = frame[sorted(frame.columns)].astype(object)
    return sorted((tuple(value(x) for x in r) for r in frame.where(frame.notna(), None).itertuples(index=False)), key=str)


def compare(spark, folder, query, sql):
    rows = query(spark, folder)
    if not sql:
        assert rows.count() >= 0
        return
    import duckdb

    base = duckdb.connect()
    base.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            base.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{folder}/{f}'")
    ours, theirs = rows.toPandas(), base.execute(sql).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert _plain(ours) == _plain(theirs)
