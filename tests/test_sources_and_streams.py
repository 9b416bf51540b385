import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkloom.operators import dense
from sparkloom.sources import fetch, providers, readers, sinks
from sparkloom.streaming import events


def test_json_lines_and_state(spark, tmp_path):
    a, b = tmp_path / "a.jsonl", tmp_path / "b.jsonl"
    a.write_text('{"metadata": {"tokens": 5, "title": "x"}, "text": "t"}\n\n{"metadata": {"tokens": "no"}, "text": "u"}\n')
    b.write_text('{"text": "v"}\n')
    rows = readers.json_lines(spark, [str(a), str(b)]).collect()
    assert sorted(r.text for r in rows) == ["t", "u", "v"] and readers.line_count(spark, str(a)) == 2
    assert readers.state(tmp_path / "none.json") == {} and readers.state(a, 5) == 5
    sinks.json_lines(spark.range(2), str(tmp_path / "out"))
    sinks.json_lines(spark.range(1), str(tmp_path / "out"), append=True)
    assert spark.read.json(str(tmp_path / "out")).count() == 3


def test_pages(spark, tmp_path):
    (tmp_path / "series_12.html").write_text('<script id="__NEXT_DATA__">{"x": 1}</script> /auto/series/9')
    (tmp_path / "series_13.html").write_text("nothing")
    (tmp_path / "series_14.json").write_text('{"y": 2}')
    pages = readers.pages(spark, str(tmp_path))
    assert {r.series_id: r.raw_json for r in readers.embedded_json(pages, "series_id", "html").collect()} == {"12": '{"x": 1}', "13": None}
    assert [r.series_id for r in readers.linked_ids(pages, "html").collect()] == ["9"]
    assert {r.series_id for r in readers.file_ids(spark, str(tmp_path)).collect()} == {"12", "13", "14"}
    assert [r.raw_json for r in readers.raw_files(spark, str(tmp_path)).collect()] == ['{"y": 2}']
    assert readers.latest_file(spark, str(tmp_path)).startswith("file:")


def test_flat_sinks_and_stores(spark, tmp_path):
    df = spark.createDataFrame([(1, {"a": "b"}, [1, 2], ("x",))], "i int, m map<string,string>, l array<int>, s struct<c:string>")
    assert tuple(sinks.flat(df).first()) == (1, '{"a":"b"}', "[1,2]", '{"c":"x"}')
    path = str(tmp_path / "store")
    spark.range(5).write.parquet(path)
    sinks.refresh(spark.read.parquet(path).where("id > 2"), path)
    assert spark.read.parquet(path).count() == 2
    sinks.log(spark, str(tmp_path / "log"), {"run": "a", "n": 1}, "run string, n int")
    sinks.log(spark, str(tmp_path / "log"), {"run": "b", "n": 2}, "run string, n int")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    vectors = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "record_id bigint, embedding array<double>")
    assert sinks.save_vectors(vectors, str(tmp_path / "v")) == 2 and sinks.load_vectors(spark, str(tmp_path / "v"), 2).count() == 1
    with pytest.raises(ValueError):
        sinks.load_vectors(spark, str(tmp_path / "v"), 3)
    with pytest.raises(ValueError):
        sinks.save_vectors(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], vectors.schema), str(tmp_path / "w"))


def test_fetch_retries_and_gives_up():
    calls, waits = [], []

    def fetcher(url):
        calls.append(url)
        if url == "flaky" and len(calls) < 3:
            raise OSError("down")
        return {"flaky": (200, b"ok"), "gone": (404, b""), "busy": (429, b"")}[url]

    policy = fetch.Policy(sleep=waits.append, clock=lambda: 0.0)
    assert policy.fetch(fetcher, "flaky") == (200, b"ok", None) and len(calls) == 3
    calls.clear()
    assert policy.fetch(fetcher, "gone")[2] == "status 404" and len(calls) == 1
    calls.clear()
    assert policy.fetch(fetcher, "busy")[2] == "status 429" and len(calls) == 3


def _page(url):
    n = int(url.rsplit("/", 1)[1])
    if n == 3:
        raise OSError("x")
    return 200, f"/auto/series/{2 * n} /auto/series/{2 * n + 1}".encode()


def test_fetch_and_frontier(spark):
    quick = lambda: fetch.Policy(retries=1, distance=0.0)
    rows = fetch.fetch(spark.createDataFrame([("u/1",), ("u/3",), ("u/1",), (None,)], "url string"), "url", _page, quick).collect()
    assert {r.url: r.error is None for r in rows} == {"u/1": True, "u/3": False}

    def expand(ids):
        got = fetch.fetch(ids.select(F.concat(F.lit("u/"), "series_id").alias("url")), "url", _page, quick)
        return readers.linked_ids(got.where("error IS NULL").select(F.decode("body", "UTF-8").alias("html")), "html")

    found = fetch.frontier(spark.createDataFrame([("1",)], "series_id string"), expand, target=6, most_rounds=5).collect()
    assert {r.series_id: r["round"] for r in found} == {"1": 0, "2": 1, "3": 1, "4": 2, "5": 2} | {r.series_id: 3 for r in found if r["round"] == 3} and len(found) == 6
    ids = fetch.from_entry_pages(["u/{page}"], 2, _page, spark.range(0), policy=quick).collect()
    assert {r.series_id for r in ids} == {"2", "3", "4", "5"}


def test_providers(spark):
    rows = spark.createDataFrame([(1, "车"), (2, None)], "i bigint, t string")
    got = {r.i: r.embedding for r in providers.embed(rows, "i", "t").collect()}
    assert got[1][137] == -1.0 and not any(got[2]) and len(got[1]) == dense.DIM

    class Moody:
        def answer(self, prompt):
            if prompt == "bad":
                raise RuntimeError("no")
            return prompt.upper()

    out = {r.i: (r.answer, r.error) for r in providers.ask(spark.createDataFrame([(1, "hi"), (2, "bad")], "i bigint, p string"), "i", "p", Moody).collect()}
    assert out[1] == ("HI", None) and out[2][0] is None and "no" in out[2][1]
    assert providers.json_in('say ```json\n{"a": 1}\n``` {"b": 2}') == {"a": 1} and providers.json_in('x { y {"b": 2} z') == {"b": 2} and providers.json_in(None) is None


T0 = datetime(2026, 1, 1)


def _events(spark, folder, rows, name):
    spark.createDataFrame([(i, T0 + timedelta(minutes=m), u, "click", v) for i, m, u, v in rows], "event_id bigint, ts timestamp, user_id bigint, event_type string, value double").coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_streams(spark, tmp_path):
    _events(spark, tmp_path, [(1, 0, 1, 1.0), (2, 30, 1, 2.0), (3, 70, 2, None), (3, 71, 2, 5.0)], "events")
    got = events.drain(events.windows(events.read(spark, str(tmp_path), "events")), "complete").orderBy("start").collect()
    assert [(r.n, r.total) for r in got] == [(2, 3.0), (2, 5.0)]
    assert events.drain(events.once(events.read(spark, str(tmp_path), "events"), "event_id")).count() == 3
    totals = events.drain(events.running_totals(events.read(spark, str(tmp_path), "events")), "update").collect()
    assert {r.user_id: (r.n, r.total) for r in totals} == {1: (2, 3.0), 2: (2, 5.0)}
    assert events.drain(events.sessions(events.read(spark, str(tmp_path), "events"), "20 minutes"), "append").count() >= 0


def test_ingest_takes_each_key_once(spark, tmp_path):
    path = str(tmp_path / "accepted")
    for ids in ([1, 2, 2], [2, 3]):
        events.ingest_new(spark.createDataFrame([(i,) for i in ids], "k bigint"), path, "k")
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    assert json.dumps(path)


def test_written_tables_are_released(spark):
    from sparkloom.plans import shared

    df = shared.materialize(spark.range(3), "range")
    assert df.count() == 3 and shared.size_of(df) > 0
    path = df.inputFiles()[0]
    assert shared.release(spark) >= 1 and shared.release(spark) == 0
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
