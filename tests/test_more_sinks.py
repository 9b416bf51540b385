from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.operators import hybrid, quality
from sparkloom.sources import fetch, providers, readers, sinks


def test_training_items_and_folders(spark, tmp_path):
    meta = "struct<" + ", ".join(f"{c}:{'int' if c in ('model_count', 'news_count', 'chunk_index', 'total_chunks', 'tokens') else 'string'}" for c in sinks.EXPORTED) + ">"
    values = tuple(1 if c in ("model_count", "news_count", "chunk_index", "total_chunks", "tokens") else c for c in sinks.EXPORTED)
    items = spark.createDataFrame([(values, "body"), (None, None)], f"metadata {meta}, text string")
    sinks.training_items(items, str(tmp_path / "items"))
    rows = spark.read.parquet(str(tmp_path / "items"))
    assert rows.columns == [*sinks.EXPORTED, "text"] and rows.count() == 2
    sinks.by_series(spark.createDataFrame([("1", "a"), ("2", "b")], "series_id string, t string"), str(tmp_path / "series"))
    assert {p.name for p in (tmp_path / "series").iterdir() if p.is_dir()} == {"series_id=1", "series_id=2"}
    assert [r.t for r in readers.first_by(spark.createDataFrame([(2, "b"), (1, "a")], "k int, t string"), "k", 1).collect()] == ["a"]


def test_store_rows_have_defaults(spark):
    names = ["record_id", "source", "series_id", "title", "url", "text", "metadata_json", "chunk_index", "total_chunks", "tokens"]
    df = spark.createDataFrame([(1, None, "9", None, None, None, None, "x", "3", None)], ", ".join(f"{n} {'bigint' if n == 'record_id' else 'string'}" for n in names))
    r = sinks.chunk_rows(df).first()
    assert (r.source, r.series_id, r.chunk_index, r.total_chunks, r.tokens) == ("", "9", -1, 3, 0)


def test_governed_results_go_to_their_tables(spark, tmp_path):
    df = spark.createDataFrame([("t1", "review", [("route", 5, False), ("dedup", 7, True)]), ("t2", "accept", [])], "trace_id string, decision string, steps array<struct<step:string,ms:int,error:boolean>>")
    sinks.governed(df, str(tmp_path))
    assert spark.read.json(f"{tmp_path}/audit").count() == 2 and spark.read.json(f"{tmp_path}/review").count() == 1
    got = {r.step: (r.n, r.total_ms, r.errors) for r in sinks.running_summary(spark.read.json(f"{tmp_path}/steps")).collect()}
    assert got == {"route": (1, 5, 0), "dedup": (1, 7, 1)}


class Longer:
    def score(self, question, texts):
        if "bad" in texts[0]:
            raise RuntimeError
        return [float(len(t)) for t in texts]


def test_reranking_fails_open(spark):
    hits = spark.createDataFrame([(1, 1, 0.9, 1), (1, 2, 0.8, 2), (1, 3, 0.7, 3)], "question_id bigint, doc_id bigint, score double, rank int")
    texts = spark.createDataFrame([(1, "a"), (2, "aaaa"), (3, "bad")], "doc_id bigint, text string")
    model = providers.rerank_scores(hits.join(texts, "doc_id").withColumn("question", F.lit("q")), Longer)
    got = {r.doc_id: round(r.score, 4) for r in hybrid.reranked(hits, model, 0.5).collect()}
    assert got == {1: 0.45, 2: 0.9, 3: 0.7}


def test_small_functions(spark):
    r = spark.range(1).select(T.clamp(F.lit("1.5")).alias("a"), T.clamp(F.lit("x"), 0.3).alias("b"), T.clamp(F.lit(None)).alias("c"), quality.duplicates_in(F.array(F.lit("a"), F.lit("a"), F.lit(""), F.lit(None))).alias("d"), T.is_falsy(F.lit(0), "number").alias("e"), T.is_blank(F.lit(0)).alias("f")).first()
    assert tuple(r) == (1.0, 0.3, 0.0, 1, True, False)
    home = spark.createDataFrame([("1", "{}"), ("2", "{}")], "series_id string, raw_json string")
    got = fetch.assemble(home, home.where("series_id = '1'"), home.limit(0)).collect()
    assert {(r.series_id, r.module_0_json, r.module_1_json) for r in got} == {("1", "{}", None), ("2", None, None)}
