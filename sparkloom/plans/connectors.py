"""Queries of sources and sinks, with their SQL: what is written is read again, what is fetched comes from a made-up site."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.operators import records
from sparkloom.plans.catalog import _STRIP, query
from sparkloom.plans.shared import shared_dir, table
from sparkloom.sources import fetch, providers, readers, sinks


def _path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- pages and records


def _raw_pages(spark, d) -> DataFrame:
    """A raw page for each clean record, with one whole model, one without an id, and two equal sizes."""
    name = F.col("series_name")
    car = F.struct(F.concat(F.col("clean_id").cast("string"), F.lit("1")).alias("car_id"), name.alias("name"), F.col("official_price").alias("price"), F.array(F.lit("热")).alias("tags"), F.struct(F.array(F.lit("b1"), F.lit("b2")).alias("base_config")).alias("car_config"))
    none = F.struct(F.lit(None).cast("string").alias("car_id"), F.lit("x").alias("name"), F.lit("1").alias("price"), F.array().cast("array<string>").alias("tags"), F.struct(F.array().cast("array<string>").alias("base_config")).alias("car_config"))
    info = lambda c: F.struct(c.alias("info"))
    models = F.struct(F.array(F.struct(F.array(info(car), info(none)).alias("data"))).alias("tab_list"))
    size = F.struct(F.lit(4500).alias("length"), F.lit(1800).alias("width"), F.lit(1500).alias("height"), F.lit(2700).alias("wheelbase"), F.array(F.lit("1"), F.lit("2")).alias("car_id_list"))
    head = F.struct("brand_name", "sub_brand_name", "car_type", F.col("dealer_price_range").alias("dealer_price"), F.col("official_price"))
    page = F.struct(F.col("series_id").alias("seriesId"), name.alias("seriesName"), F.coalesce("city_name", F.lit("全国")).alias("cityName"), head.alias("seriesHomeHead"), F.struct((F.col("clean_id") % 5).alias("score")).alias("scoreSimpleInfo"), models.alias("carModelsData"), F.struct(F.array(size, size).alias("space")).alias("overviewData"))
    rows = table(spark, d, "dcd_cleaner").select("clean_id", "series_id", "series_name", "brand_name", "sub_brand_name", "car_type", "city_name", "official_price", "dealer_price_range").distinct()
    return rows.select("clean_id", F.when(F.col("clean_id") % 11 == 0, "{broken").otherwise(F.to_json(F.struct(F.struct(page.alias("pageProps")).alias("props")))).alias("raw"))


_C = "c AS (SELECT DISTINCT clean_id, series_id, series_name, brand_name, sub_brand_name, car_type, city_name, official_price, dealer_price_range FROM dcd_cleaner)"
_NULLED = lambda c: f"CASE WHEN clean_id % 11 <> 0 THEN {c} END"


@query(f"""WITH {_C} SELECT clean_id, clean_id % 11 = 0 AS failed, {_NULLED("coalesce(series_id, '')")} AS series_id, {_NULLED("CASE WHEN coalesce(series_name, '') = '' THEN '未知车系' ELSE series_name END")} AS series_name, {_NULLED("brand_name")} AS brand_name, {_NULLED("official_price")} AS official_price_range, {_NULLED("dealer_price_range")} AS dealer_price_range,
    {_NULLED("(clean_id % 5)::VARCHAR")} AS total_score, {_NULLED("'1'")} AS models, {_NULLED("'1'")} AS sizes, {_NULLED("clean_id || '1'")} AS car_id, {_NULLED("nullif(official_price, '')")} AS model_price, {_NULLED("'2'")} AS cars_of_size FROM c""")
def clean_records(spark, d):
    """Clean records of raw pages, some of which can't be read."""
    out = records.clean_pages(_raw_pages(spark, d), "clean_id", "raw")
    at = lambda path: F.get_json_object("record", f"$.{path}")
    fields = {"series_id": "series.series_id", "series_name": "series.series_name", "brand_name": "series.brand_name", "official_price_range": "pricing.official_price_range", "dealer_price_range": "pricing.dealer_price_range", "total_score": "scores.total_score", "models": "stats.model_count", "sizes": "stats.dimension_group_count", "car_id": "models[0].car_id", "model_price": "models[0].official_price", "cars_of_size": "dimensions[0].car_count"}
    return out.select("clean_id", F.col("error").isNotNull().alias("failed"), *(at(p).alias(n) for n, p in fields.items()))


_OR = lambda c, otherwise: f"CASE WHEN coalesce({c}, '') = '' THEN '{otherwise}' ELSE {c} END"


@query(f"""WITH {_C} SELECT clean_id, md5('# ' || {_OR("series_name", "未知车系")} || ' 车型资料' || chr(10) || chr(10) || '## 基础信息' || chr(10) || '- 品牌: ' || {_OR("brand_name", "未知")} || chr(10) || '- 子品牌: ' || {_OR("sub_brand_name", "未知")} || chr(10) || '- 车型类别: ' || {_OR("car_type", "未知")} || chr(10) || '- 城市基准: ' || {_OR("city_name", "全国")} || chr(10) || chr(10)
    || '## 价格信息' || chr(10) || '- 经销商报价区间: ' || {_OR("dealer_price_range", "暂无报价")} || chr(10) || '- 官方指导价区间: ' || {_OR("official_price", "暂无指导价")}) AS head, '- 长宽高/轴距: 4500/1800/1500/2700 mm，覆盖车型数: 2' AS sizes, '## 车型列表 (1 款)' AS models FROM c WHERE clean_id % 11 <> 0""")
def page_markdown(spark, d):
    """The Markdown of raw pages: its head up to the official price, its line of sizes, the title of its models."""
    out = records.clean_pages(_raw_pages(spark, d), "clean_id", "raw").where("error IS NULL")
    head = F.concat(F.substring_index("markdown", "\n- 最新车主成交价", 1))
    line = lambda pattern: F.regexp_extract("markdown", f"(?m)^({pattern}.*)$", 1)
    return out.select("clean_id", F.md5(head).alias("head"), line("- 长宽高").alias("sizes"), line("## 车型列表").alias("models"))


@query("SELECT DISTINCT series_id, md5(coalesce(h.models, '')) AS home_json, m.crawls::BIGINT AS crawls FROM (SELECT series_id, min(models) AS models FROM dcd_cleaner WHERE series_id IS NOT NULL GROUP BY series_id) h LEFT JOIN (SELECT series_id, count(*) AS crawls FROM dcd_cleaner WHERE series_id % 2 = 0 GROUP BY series_id) m USING (series_id)".replace("series_id % 2", "series_id::BIGINT % 2"))
def assembled_pages(spark, d):
    """A series' home page beside a module page that half of them have."""
    rows = table(spark, d, "dcd_cleaner").where("series_id IS NOT NULL")
    home = rows.groupBy("series_id").agg(F.coalesce(F.min("models"), F.lit("")).alias("raw_json"))
    module = rows.where(F.col("series_id").try_cast("bigint") % 2 == 0).groupBy("series_id").agg(F.count(F.lit(1)).cast("string").alias("raw_json"))
    return fetch.assemble(home, module).select("series_id", F.md5("home_json").alias("home_json"), F.col("module_0_json").cast("bigint").alias("crawls"))


# --- a made-up site


def _site(url: str) -> tuple[int, bytes]:
    """Pages of series that link to the next two; every fifth is missing, every seventh fails."""
    n = int(url.rstrip("/").rsplit("/", 1)[1])
    if n % 7 == 0:
        raise TimeoutError("no answer")
    if n % 5 == 0:
        return 404, b""
    return 200, f'<a href="/auto/series/{n + 1}">a</a><a href="/auto/series/{n + 2}">b</a>'.encode()


def _listing(url: str) -> tuple[int, bytes]:
    n = int(url.rsplit("=", 1)[1])
    return 200, "".join(f'<a href="/auto/series/{10 * n + i}">x</a>' for i in range(3)).encode()


def _hasty() -> fetch.Policy:
    return fetch.Policy(retries=2, distance=0.0, sleep=lambda s: None)


@query("""WITH s AS (SELECT DISTINCT series_id::BIGINT AS n FROM dcd_cleaner WHERE series_id IS NOT NULL) SELECT n, CASE WHEN n % 7 = 0 THEN NULL WHEN n % 5 = 0 THEN 404 ELSE 200 END AS status, CASE WHEN n % 7 = 0 THEN 'TimeoutError: no answer' WHEN n % 5 = 0 THEN 'status 404' END AS error,
    CASE WHEN n % 7 <> 0 AND n % 5 <> 0 THEN (n + 1) || ',' || (n + 2) END AS linked FROM s""")
def fetched_pages(spark, d):
    """Pages of all series, with failures as rows, and what they link to."""
    from sparkloom.functions import text as T

    urls = table(spark, d, "dcd_cleaner").where("series_id IS NOT NULL").select(F.concat(F.lit("https://site.example/auto/series/"), "series_id").alias("url"))
    got = fetch.fetch(urls, "url", _site, _hasty, tasks=4)
    linked = F.array_join(T.series_ids(F.decode("body", "UTF-8")), ",")
    return got.select(F.regexp_extract("url", r"(\d+)$", 1).cast("bigint").alias("n"), "status", "error", F.when(F.col("body").isNotNull(), linked).alias("linked"))


@query("SELECT (10 * n + i)::VARCHAR AS series_id FROM range(1, 5) a(n), range(3) b(i)")
def entry_series(spark, d):
    """Series found on the numbered pages of two entries of a made-up site."""
    empty = table(spark, d, "region").select("r_regionkey").limit(0)
    return fetch.from_entry_pages(["https://site.example/list?p={page}", "https://site.example/hot?p={page}"], 4, _listing, empty, policy=_hasty)


@query("SELECT n::VARCHAR AS series_id, floor(log2(n))::INTEGER AS round FROM range(1, 64) r(n)")
def series_frontier(spark, d):
    """Breadth first from one series, each linking to two more, for five rounds."""
    seeds = table(spark, d, "region").limit(1).select(F.lit("1").alias("series_id"))
    n = F.col("series_id").cast("bigint")
    return fetch.frontier(seeds, lambda fresh: fresh.select(F.explode(F.array(n * 2, n * 2 + 1, n).cast("array<string>")).alias("series_id")), 1000, 5)


# --- what is written is read again


_ITEM = "record_id, source, url, title, series_id, chunk_index, total_chunks, tokens, text"


@query("SELECT DISTINCT coalesce(source, '?') AS source, url, title, series_id, chunk_index, total_chunks, tokens, md5(text) AS text FROM chunks")
def items_from_lines(spark, d):
    """Training items written as JSON lines in two files and read as one table."""
    rows = table(spark, d, "chunks")
    meta = F.struct(F.coalesce("source", F.lit("?")).alias("source"), "url", "title", "series_id", "chunk_index", "total_chunks", "tokens")
    items, paths = rows.select("record_id", meta.alias("metadata"), "text"), [_path(spark, "lines") for _ in range(2)]
    for k, path in enumerate(paths):
        sinks.json_lines(items.where(F.pmod("record_id", F.lit(2)) == k).drop("record_id"), path)
    back = readers.json_lines(spark, paths)
    return back.select(*(f"metadata.{c}" for c in ("source", "url", "title", "series_id", "chunk_index", "total_chunks", "tokens")), F.md5("text").alias("text")).distinct()


@query("SELECT source, count(*) AS n, count(text) AS texts, sum(tokens)::BIGINT AS tokens FROM chunks GROUP BY source")
def exported_items(spark, d):
    """The flat export of training items."""
    rows, path = table(spark, d, "chunks"), _path(spark, "export")
    known = {c: F.col(c) if c in rows.columns else F.lit(None).cast("string") for c in sinks.EXPORTED}
    sinks.training_items(rows.select(F.struct(*(v.alias(c) for c, v in known.items())).alias("metadata"), "text"), path)
    return spark.read.parquet(path).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("text").alias("texts"), F.sum("tokens").alias("tokens"))


@query("SELECT user_id AS k, count(*) AS n, round(sum(value), 4) AS total, max(event_type) AS last FROM events WHERE user_id IS NOT NULL GROUP BY user_id")
def flat_round_trip(spark, d):
    """Nested rows written flat, by a key, and read again."""
    rows, path = table(spark, d, "events").where("user_id IS NOT NULL"), _path(spark, "flat")
    sinks.flat_parquet(rows.select("user_id", F.struct("value", "event_type").alias("about")), path)
    about = F.from_json("about", "value double, event_type string")
    back = spark.read.parquet(path).select(F.col("user_id").alias("k"), about.alias("a"))
    return back.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("a.value"), 4).alias("total"), F.max("a.event_type").alias("last"))


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type")
def folders_by_key(spark, d):
    """Rows written to a folder for each key, and read again with the key from the folders."""
    path = _path(spark, "keys")
    sinks.by_series(table(spark, d, "events").where("event_type IS NOT NULL").select("event_type", "event_id"), path, "event_type")
    return spark.read.schema("event_id bigint, event_type string").json(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT vec_id, round(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]), 4) AS size FROM embeddings")
def saved_vectors(spark, d):
    """Vectors saved, read after a probe of their length, and used."""
    path = _path(spark, "vectors")
    dim = sinks.save_vectors(table(spark, d, "embeddings"), path, "vec_id")
    rows = sinks.load_vectors(spark, path, dim)
    size = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.select("vec_id", F.round(size, 4).alias("size"))


@query("SELECT source, count(*) AS n FROM (SELECT coalesce(source, '') AS source FROM chunks WHERE coalesce(tokens, 0) > 0) GROUP BY source")
def refreshed_store(spark, d):
    """A store replaced by a part of itself."""
    path = _path(spark, "store")
    sinks.refresh(sinks.chunk_rows(table(spark, d, "chunks")), path)
    sinks.refresh(spark.read.parquet(path).where("tokens > 0"), path)
    return spark.read.parquet(path).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'run' || i AS run_id, (SELECT count(*) FROM chunks) + i AS records FROM range(3) r(i)")
def run_log(spark, d):
    """A log of runs, row by row."""
    path, n = _path(spark, "log"), table(spark, d, "chunks").count()
    for i in range(3):
        sinks.log(spark, path, {"run_id": f"run{i}", "records": n + i}, "run_id string, records bigint")
    return spark.read.parquet(path)


_DECIDED = "d AS (SELECT DISTINCT record_id, CASE WHEN json_valid(metadata_json) THEN json_extract_string(metadata_json, '$.governance_decision') END AS decision FROM chunks)"


@query(f"WITH {_DECIDED} SELECT 'audit' AS name, count(*) AS n FROM d UNION ALL SELECT 'steps', 2 * count(*) FROM d UNION ALL SELECT 'review', count(*) FROM d WHERE decision = 'review' UNION ALL SELECT 'repair', count(*) FROM d WHERE decision = 'repair'")
def governed_tables(spark, d):
    """Results written once and sent to the audit, step, review and repair tables."""
    path = _path(spark, "governed")
    rows = table(spark, d, "chunks").select("record_id", F.get_json_object("metadata_json", "$.governance_decision").alias("decision")).distinct()
    step = lambda name: F.struct(F.lit(name).alias("step"), F.lit(1.5).alias("ms"), F.lit(False).alias("error"))
    sinks.governed(rows.select(F.col("record_id").alias("trace_id"), "decision", F.array(step("clean"), step("judge")).alias("steps")), path)
    counts = [spark.read.schema("trace_id bigint").json(f"{path}/{n}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n") for n in ("audit", "steps", "review", "repair")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


# --- models behind interfaces


@query("SELECT DISTINCT clean_id, 768 AS dim, CASE WHEN coalesce(series_name, '') = '' THEN 0 ELSE 1 END::DOUBLE AS size FROM dcd_cleaner")
def embedded_names(spark, d):
    rows = table(spark, d, "dcd_cleaner").select("clean_id", "series_name").distinct()
    size = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return providers.embed(rows, "clean_id", "series_name").select("clean_id", F.size("embedding").alias("dim"), F.round(size, 3).alias("size"))


class _Parrot:
    """Stands for a model: repeats, and fails on what is blank."""

    def answer(self, prompt: str) -> str:
        if not (prompt or "").strip():
            raise ValueError("nothing asked")
        return "答：" + prompt


@query(f"SELECT DISTINCT message_id, CASE WHEN {_STRIP("coalesce(content, '')")} <> '' THEN md5('答：' || content) END AS answer, CASE WHEN {_STRIP("coalesce(content, '')")} = '' THEN 'ValueError: nothing asked' END AS error FROM messages WHERE message_id IS NOT NULL")
def asked_model(spark, d):
    """Answers of a model, a failing call as a row with its error."""
    rows = table(spark, d, "messages").where("message_id IS NOT NULL").select("message_id", "content").distinct()
    return providers.ask(rows, "message_id", "content", _Parrot).select("message_id", F.md5("answer").alias("answer"), "error").distinct()


@query("SELECT DISTINCT record_id, CASE WHEN json_valid(metadata_json) AND json_type(metadata_json) = 'OBJECT' THEN json_extract_string(metadata_json, '$.quality_tier') END AS tier FROM chunks")
def json_replies(spark, d):
    """The JSON object in a model's reply, fenced for one half and bare for the other."""
    text = F.coalesce("metadata_json", F.lit("none"))
    reply = F.when(F.col("record_id") % 2 == 0, F.concat(F.lit("Here it is:\n```json\n"), text, F.lit("\n```\nDone."))).otherwise(F.concat(F.lit("So {not this}: "), text, F.lit(" – that is all.")))
    rows = table(spark, d, "chunks").select("record_id", reply.alias("reply")).distinct()
    return providers.read_replies(rows, "record_id", "reply").select("record_id", F.get_json_object("found", "$.quality_tier").alias("tier")).distinct()
