"""Queries of composed steps, with their SQL: fused retrieval, answers, gates, dialog states, images, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.operators import answers, dedup, dialog, evaluation, groups, hybrid, images, quality, sparse
from sparkloom.plans.catalog import _BM25, _STRIP, _TOKENS, _docs, _questions, _texts, query
from sparkloom.plans.shared import materialize, small, table
from sparkloom.sources import sinks

# --- retrieval


def _bm25(text: str, name: str) -> str:
    """BM25 over a column of the chunks, as more steps behind q."""
    n = name
    return f"""{n}d AS (SELECT record_id, any_value({text}) AS text FROM chunks GROUP BY record_id), {n}t AS (SELECT record_id, {_TOKENS("text")} AS t FROM {n}d), {n}p AS (SELECT record_id, len(t) AS dl, unnest(t) AS term FROM {n}t),
    {n}tf AS (SELECT record_id, term, dl, count(*) AS tf FROM {n}p GROUP BY ALL), {n}df AS (SELECT term, count(*) AS df FROM {n}tf GROUP BY term), {n}c AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM {n}t),
    {n}s AS (SELECT question_id, record_id AS doc_id, round(sum(qtf * greatest(0.0::DOUBLE, (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))), 6) AS score FROM qt JOIN {n}df USING (term) JOIN {n}tf USING (term), {n}c GROUP BY ALL),
    {n}r AS (SELECT question_id, doc_id, score, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank FROM {n}s WHERE score > 0)"""


_SIDES = f"""{_BM25}, {_bm25("title", "w")}, x AS (SELECT * FROM wr WHERE rank <= 24), y AS (SELECT * FROM r WHERE rank <= 40),
    u AS (SELECT question_id, doc_id, x.score AS ds, x.rank AS dr, y.score AS ss, y.rank AS sr FROM x FULL JOIN y USING (question_id, doc_id)),
    m AS (SELECT *, min(ds) OVER p AS dl, max(ds) OVER p AS dh, min(ss) OVER p AS sl, max(ss) OVER p AS sh FROM u WINDOW p AS (PARTITION BY question_id)),
    v AS (SELECT question_id, doc_id, coalesce(1.0::DOUBLE / (60 + dr), 0) + coalesce(1.0::DOUBLE / (60 + sr), 0) AS rrf,
      CASE WHEN coalesce(dh, 0) - coalesce(dl, 0) <= 1e-8 THEN 0 ELSE (coalesce(ds, 0) - dl) / (dh - dl) END AS dn, CASE WHEN coalesce(sh, 0) - coalesce(sl, 0) <= 1e-8 THEN 0 ELSE (coalesce(ss, 0) - sl) / (sh - sl) END AS sn FROM m),
    qk AS (SELECT question_id, list_distinct({_TOKENS("question")}) AS k FROM q),
    f AS (SELECT question_id, doc_id, round(0.55::DOUBLE * rrf + 0.25::DOUBLE * dn + 0.15::DOUBLE * sn + 0.05::DOUBLE * CASE WHEN len(k) = 0 THEN 0 ELSE len(list_intersect(k, {_TOKENS("text")}))::DOUBLE / len(k) END, 6) AS score FROM v JOIN qk USING (question_id) JOIN d ON d.record_id = doc_id),
    g AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank FROM f)"""


def _fused(spark, d, k: int) -> DataFrame:
    q, docs = _questions(spark, d).select("question_id", "question"), _texts(spark, d)
    titles = table(spark, d, "chunks").groupBy("record_id").agg(F.min("title").alias("text"))
    known = sparse.index(q, docs, "record_id")
    return hybrid.fuse(q, docs, sparse.bm25(q, titles, 24, "record_id"), sparse.bm25(q, docs, 40, "record_id", known=known), k=k, doc_id="record_id", known=known)


@query(f"WITH {_SIDES} SELECT question_id, doc_id, score, rank::INTEGER AS rank FROM g WHERE rank <= 6")
def fused_top(spark, d):
    """Two rankings, by title and by text, fused: reciprocal ranks, both scores through their ranges, coverage."""
    return _fused(spark, d, 6)


@query(f"""WITH {_SIDES}, h AS (SELECT *, (doc_id % 7)::DOUBLE AS model FROM g WHERE rank <= 12), n AS (SELECT *, min(model) OVER p AS lo, max(model) OVER p AS hi FROM h WINDOW p AS (PARTITION BY question_id)),
    z AS (SELECT question_id, doc_id, 0.35::DOUBLE * score + 0.65::DOUBLE * CASE WHEN hi - lo <= 1e-8 THEN 0 ELSE (model - lo) / (hi - lo) END AS score FROM n),
    o AS (SELECT question_id, doc_id, round(score, 6) AS score, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank FROM z) SELECT question_id, doc_id, score, rank::INTEGER AS rank FROM o WHERE rank <= 6""")
def reranked_top(spark, d):
    """fused_top, its twelve best mixed with a model's scores (here the id's remainder by 7)."""
    first = materialize(_fused(spark, d, 12), "first")
    model = first.select("question_id", "doc_id", (F.col("doc_id") % 7).cast("double").alias("model_score"))
    return sparse.top(hybrid.reranked(first.drop("rank"), model, 0.65), 6).withColumn("score", F.round("score", 6))


@query(f"""WITH {_BM25}, e AS (SELECT record_id, any_value(coalesce(text, '')) AS text FROM chunks GROUP BY record_id), h AS (SELECT question_id, rank, text, sum(length(text)) OVER (PARTITION BY question_id ORDER BY rank) AS used FROM r JOIN e ON doc_id = e.record_id WHERE rank <= 6)
    SELECT question_id, md5(string_agg(text, chr(10) || chr(10) ORDER BY rank)) AS context, count(*) AS parts FROM h WHERE used <= 3000 GROUP BY question_id""")
def question_contexts(spark, d):
    hits = sparse.bm25(_questions(spark, d), _texts(spark, d), 6, "record_id")
    docs = materialize(_of_hits(_texts(spark, d), hits).dropDuplicates(["record_id"]), "docs")
    used = hits.join(docs.select(F.col("record_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), "doc_id")
    kept = groups.within_budget(used, "question_id", (F.col("rank"),), F.length("text"), 3000).groupBy("question_id").agg(F.count(F.lit(1)).alias("parts"))
    return hybrid.context(hits, docs, 3000, "record_id").join(kept, "question_id").select("question_id", F.md5("context").alias("context"), "parts")


_ABOUT = "i AS (SELECT record_id, coalesce(any_value(title), '') AS title, coalesce(any_value(url), '') AS url, coalesce(any_value(series_id), '') AS series_id, substr(coalesce(any_value(text), ''), 1, 240) AS snippet FROM chunks GROUP BY record_id)"


def _of_hits(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """The rows that are hits, chosen before anything of theirs is shuffled."""
    ids = materialize(hits.select(F.col("doc_id").alias("record_id")).distinct(), "ids")
    return rows.join(small(ids), "record_id", "left_semi")


def _about(spark, d, hits: DataFrame) -> DataFrame:
    rows = table(spark, d, "chunks").select("record_id", "title", "url", "series_id", "text")
    return materialize(_of_hits(rows, hits).dropDuplicates(["record_id"]), "about")


@query(f"WITH {_BM25}, {_ABOUT} SELECT question_id, doc_id, rank::INTEGER AS rank, score, title, url, series_id, md5(snippet) AS snippet FROM r JOIN i ON doc_id = i.record_id WHERE rank <= 6")
def shown_hits(spark, d):
    hits = sparse.bm25(_questions(spark, d), _texts(spark, d), 6, "record_id")
    return answers.shown_hits(hits, _about(spark, d, hits), "record_id").withColumn("snippet", F.md5("snippet"))


@query(f"""WITH {_BM25}, {_ABOUT}, l AS (SELECT question_id, rank, rank || '. ' || CASE WHEN title = '' THEN '{answers.UNNAMED}' ELSE title END || ': ' || {_STRIP("substr(snippet, 1, 120)")} AS line FROM r JOIN i ON doc_id = i.record_id WHERE rank <= 3),
    a AS (SELECT question_id, string_agg(line, chr(10) ORDER BY rank) AS lines FROM l GROUP BY question_id), oo AS (SELECT question_id, series_id, min(rank) AS rank FROM r JOIN i ON doc_id = i.record_id WHERE rank <= 6 AND series_id <> '' GROUP BY ALL),
    o AS (SELECT question_id, string_agg(series_id, ',' ORDER BY rank) AS sources FROM oo GROUP BY question_id)
    SELECT question_id, CASE WHEN lines IS NULL THEN '{answers.NOTHING}' ELSE '基于检索内容，和“' || question || '”最相关的信息如下：' || chr(10) || lines || chr(10) || '如果你愿意，我可以继续围绕这几款车做价格、配置或对比分析。' END AS answer, 'plain' AS by, coalesce(sources, '') AS sources
    FROM q LEFT JOIN a USING (question_id) LEFT JOIN o USING (question_id)""")
def plain_answers(spark, d):
    """The whole pipeline without a model: hits, context, answer, sources."""
    q = _questions(spark, d).select("question_id", "question")
    hits = sparse.bm25(q, _texts(spark, d), 6, "record_id")
    return answers.answered(q, _about(spark, d, hits), hits, doc_id="record_id").select("question_id", "answer", "by", F.array_join("sources", ",").alias("sources"))


@query(f"""WITH {_BM25}, h AS (SELECT question_id, rank, series_id AS label FROM r JOIN d ON doc_id = record_id WHERE rank <= 6),
    cc AS (SELECT q.question_id, q.label, unnest([1, 3, 9]) AS rank FROM q), j AS (SELECT cc.question_id, (h.label = cc.label)::INTEGER AS ok FROM cc LEFT JOIN h ON cc.question_id = h.question_id AND cc.rank = h.rank)
    SELECT question_id, count(*) AS cited, coalesce(sum(ok), 0)::BIGINT AS right, coalesce(sum(ok), 0)::DOUBLE / count(*) AS precision FROM j GROUP BY question_id""")
def citation_precision(spark, d):
    """Answers that cite the hits 1, 3 and 9 (the last is none of six), against the series asked for."""
    q, docs = _questions(spark, d), _docs(spark, d)
    hits = sparse.bm25(q, _texts(spark, d), 6, "record_id").join(docs.select(F.col("record_id").alias("doc_id"), F.col("series_id").alias("label")), "doc_id")
    said = q.select("question_id", F.concat(F.lit("见 [1]、[3] 和 [1][9]："), "question").alias("answer"))
    plain = said.withColumn("answer", F.regexp_replace("answer", r"：.*$", ""))
    return evaluation.citation_scores(plain, hits, q.select("question_id", "label"))


@query("""WITH m AS (SELECT 'garbled' AS metric, avg((text LIKE '%�%')::INTEGER) AS value FROM chunks UNION ALL SELECT 'texts', avg((coalesce(text, '') <> '')::INTEGER) FROM chunks UNION ALL SELECT 'tokens', avg((tokens > 0)::INTEGER) FROM chunks),
    t(metric, least) AS (VALUES ('texts', 0.9::DOUBLE), ('tokens', 0.999), ('missing', 0.1)) SELECT metric, round(coalesce(value, 0), 6) AS actual, least, coalesce(value, 0) >= least AS passed FROM t LEFT JOIN m USING (metric)""")
def quality_gate(spark, d):
    """Shares of the chunks against thresholds; a metric that is missing counts 0."""
    share = lambda name, c: table(spark, d, "chunks").agg(F.avg(c.cast("int")).alias("value")).select(F.lit(name).alias("metric"), "value")
    metrics = share("texts", F.coalesce("text", F.lit("")) != "").unionByName(share("tokens", F.col("tokens") > 0))
    least = spark.createDataFrame([("texts", 0.9), ("tokens", 0.999), ("missing", 0.1)], "metric string, least double")
    return evaluation.gate(metrics, least).withColumn("actual", F.round("actual", 6))


@query("""WITH r AS (SELECT run_id, built_at, row_number() OVER (ORDER BY built_at) AS p, count(*) OVER () AS n FROM build_runs), c AS (SELECT p * 2 > n AS late, c.* FROM chunks c JOIN r USING (run_id)),
    s AS (SELECT late, count(*)::DOUBLE AS rows, avg(tokens) AS tokens, avg((asset_split = 'train')::INTEGER) AS train, avg(length(text)) AS chars FROM c GROUP BY late),
    u AS (SELECT late, unnest(['rows', 'tokens', 'train', 'chars']) AS metric, unnest([rows, tokens, train, chars]) AS value FROM s),
    l(metric, most, relative) AS (VALUES ('rows', 0.0001::DOUBLE, true), ('tokens', 0.0::DOUBLE, true), ('train', 0.0::DOUBLE, false), ('chars', 0.0::DOUBLE, true)),
    b AS (SELECT metric, x.value AS before, y.value AS now, most, CASE WHEN relative THEN (x.value - y.value) / x.value ELSE x.value - y.value END AS "drop" FROM u x JOIN u y USING (metric) JOIN l USING (metric) WHERE NOT x.late AND y.late)
    SELECT metric, round(before, 6) AS before, round(now, 6) AS now, round("drop", 6) AS "drop" FROM b WHERE "drop" > most""")
def run_drift(spark, d):
    """Metrics of the later half of the runs that dropped against the earlier half."""
    from pyspark.sql import Window as W

    one = W.partitionBy(F.lit(0))  # one row for each run
    runs = table(spark, d, "build_runs").select("run_id", (F.row_number().over(one.orderBy("built_at")) * 2 > F.count(F.lit(1)).over(one)).alias("late"))
    by = table(spark, d, "chunks").join(F.broadcast(runs), "run_id").groupBy("late").agg(F.count(F.lit(1)).cast("double").alias("rows"), F.avg("tokens").alias("tokens"), F.avg((F.col("asset_split") == "train").cast("int")).alias("train"), F.avg(F.length("text")).alias("chars"))
    flat = by.unpivot("late", ["rows", "tokens", "train", "chars"], "metric", "value")
    limits = spark.createDataFrame([("rows", 0.0001, True), ("tokens", 0.0, True), ("train", 0.0, False), ("chars", 0.0, True)], "metric string, most double, relative boolean")
    out = evaluation.drift(flat.where("NOT late"), flat.where("late"), limits)
    return out.select("metric", *(F.round(c, 6).alias(c) for c in ("before", "now", "drop")))


@query(f"""WITH {_BM25} SELECT question_id, string_agg(label, ',' ORDER BY rank) AS labels FROM (SELECT question_id, label, rank, row_number() OVER (PARTITION BY question_id ORDER BY rank) AS p FROM (SELECT question_id, series_id AS label, min(rank) AS rank FROM r JOIN d ON doc_id = record_id WHERE rank <= 10 AND series_id <> '' GROUP BY ALL)) WHERE p <= 3 GROUP BY question_id""")
def hit_series(spark, d):
    """The first three different series of each question's hits."""
    docs = _docs(spark, d)
    hits = sparse.bm25(_questions(spark, d), _texts(spark, d), 10, "record_id").join(docs.select(F.col("record_id").alias("doc_id"), F.col("series_id").alias("label")), "doc_id")
    return answers.first_distinct(hits, 3).withColumn("labels", F.array_join("labels", ","))


@query(f"""SELECT DISTINCT clean_id, md5({_STRIP(f"{_STRIP("concat_ws(' ', trim(coalesce(brand_name, '')), trim(coalesce(series_name, '')), trim(coalesce(car_type, '')))")} || chr(10) || trim(coalesce(price_note, ''))")}) AS text FROM dcd_cleaner""")
def semantic_texts(spark, d):
    rows = table(spark, d, "dcd_cleaner")
    return rows.select("clean_id", F.md5(answers.semantic_text(F.col("brand_name"), F.col("series_name"), F.col("car_type"), F.col("price_note"))).alias("text")).distinct()


@query("""WITH t AS (SELECT DISTINCT record_id, text, asset_split FROM chunks), h AS (SELECT record_id, md5(coalesce(text, '')) AS c, md5(lower(trim(regexp_replace(coalesce(text, ''), '[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g')))) AS n, asset_split FROM t),
    c AS (SELECT c, min(record_id) AS m FROM h WHERE asset_split = 'train' GROUP BY c), n AS (SELECT n, min(record_id) AS m FROM h WHERE asset_split = 'train' GROUP BY n)
    SELECT DISTINCT record_id, CASE WHEN c.m IS NOT NULL THEN 'exact_content' WHEN n.m IS NOT NULL THEN 'normalized_text' ELSE 'none' END AS label, coalesce(c.m, n.m) AS matched_id FROM h LEFT JOIN c USING (c) LEFT JOIN n USING (n) WHERE asset_split = 'test'""")
def manifest_labels(spark, d):
    """Test chunks against a manifest of train chunks, by content and by normalised text."""
    chunks = table(spark, d, "chunks")
    train = chunks.where("asset_split = 'train'")
    entry = lambda kind, h: train.select(F.lit(kind).alias("kind"), h.alias("hash"), F.col("record_id").alias("matched_id"))
    known = entry("content", T.content_hash(F.col("text"))).unionByName(entry("normal", T.normal_hash(F.col("text"))))
    return dedup.against_manifest(chunks.where("asset_split = 'test'"), known, "record_id", "text").distinct()


# --- dialog


_TIME = r"""CASE WHEN regexp_full_match(c, '\d{1,18}') THEN c::BIGINT * 1000 WHEN regexp_full_match(c, '\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|z|[+-]\d{2}(:?\d{2})?)?')
    THEN epoch_us(try_cast(CASE WHEN regexp_matches(c, '\d{2}:\d{2}.*([Zz]|[+-]\d{2}(:?\d{2})?)$') THEN c ELSE c || '+00:00' END AS TIMESTAMPTZ)) END"""
_LISTED = lambda words: "[" + ", ".join(f"CASE WHEN contains(t, '{raw}') THEN '{name}' END" for raw, name in words) + "]"
_ONE = lambda words: "CASE " + " ".join(f"WHEN contains(lower(t), '{w.lower()}') THEN '{w}'" for w in words) + " END"


def _turns(spark, d) -> DataFrame:
    rows = table(spark, d, "messages").where("session_id IS NOT NULL AND message_id IS NOT NULL").withColumn("at", T.instant(F.col("created_at"))).where("at IS NOT NULL")
    first = rows.groupBy("message_id").agg(F.min(F.struct("at", "session_id", F.coalesce("content", F.lit("")).alias("content"))).alias("m")).select("message_id", "m.*")
    # Times of a session that are equal are told apart by the id: the order is a number all the same.
    from sparkloom.operators.ranking import ranked

    return ranked(first, "session_id", "at", "message_id", name="turn")


_TURNS = rf"""m AS (SELECT message_id, session_id, coalesce(content, '') AS content, trim(created_at, ' ' || chr(9) || chr(10)) AS c FROM messages WHERE session_id IS NOT NULL AND message_id IS NOT NULL),
    w AS (SELECT *, {_TIME} AS moment FROM m), k AS (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY moment, session_id, content) AS copy FROM w WHERE moment IS NOT NULL),
    t AS (SELECT session_id, message_id, {_STRIP("content")} AS t, row_number() OVER (PARTITION BY session_id ORDER BY moment, message_id) - 1 AS turn FROM k WHERE copy = 1)"""


@query(rf"""WITH {_TURNS}, n AS (SELECT *, try_cast(regexp_extract(t, '{dialog._RANGE}', 1) AS DOUBLE) AS a, try_cast(regexp_extract(t, '{dialog._RANGE}', 2) AS DOUBLE) AS b, try_cast(regexp_extract(t, '{dialog._SINGLE}', 1) AS DOUBLE) AS o FROM t),
    s AS (SELECT session_id, turn, CASE WHEN a IS NOT NULL THEN least(a, b) WHEN o IS NOT NULL THEN 0 END AS lo, CASE WHEN a IS NOT NULL THEN greatest(a, b) ELSE o END AS hi, CASE WHEN a IS NOT NULL THEN printf('%g-%g万', least(a, b), greatest(a, b)) ELSE printf('%g万内', o) END AS bt,
      {_ONE(dialog.ENERGY)} AS en, {_ONE(dialog.CAR_TYPES)} AS ct, {_LISTED((w, w) for w in dialog.BRANDS)} AS br, {_LISTED(dialog.FOCUS.items())} AS fo FROM n),
    f AS (SELECT session_id, 'f' AS kind, name, min(turn * 100 + i) AS place FROM (SELECT session_id, turn, unnest(fo) AS name, unnest(range(len(fo))) AS i FROM s) WHERE name IS NOT NULL GROUP BY ALL
      UNION ALL SELECT session_id, 'b', name, min(turn * 100 + i) FROM (SELECT session_id, turn, unnest(br) AS name, unnest(range(len(br))) AS i FROM s) WHERE name IS NOT NULL GROUP BY ALL),
    g AS (SELECT *, row_number() OVER (PARTITION BY session_id, kind ORDER BY place) AS nth FROM f),
    h AS (SELECT s.session_id, s.turn, string_agg(name, '/' ORDER BY place) FILTER (kind = 'f' AND nth <= 6) AS focus_points, string_agg(name, '/' ORDER BY place) FILTER (kind = 'b' AND nth <= 5) AS brands FROM s JOIN g ON s.session_id = g.session_id AND g.place < (s.turn + 1) * 100 GROUP BY ALL),
    l AS (SELECT session_id, turn, last_value(lo IGNORE NULLS) OVER p AS budget_min, last_value(hi IGNORE NULLS) OVER p AS budget_max, last_value(CASE WHEN hi IS NOT NULL THEN bt END IGNORE NULLS) OVER p AS budget_text, last_value(en IGNORE NULLS) OVER p AS energy_type, last_value(ct IGNORE NULLS) OVER p AS car_type FROM s
      WINDOW p AS (PARTITION BY session_id ORDER BY turn ROWS UNBOUNDED PRECEDING))
    SELECT l.*, coalesce(focus_points, '') AS focus_points, coalesce(brands, '') AS brands FROM l LEFT JOIN h USING (session_id, turn)""")
def preference_fold(spark, d):
    """Preferences after each turn of a session, in order of time."""
    folded = dialog.fold_preferences(_turns(spark, d))
    return folded.withColumns({c: F.array_join(c, "/") for c in ("focus_points", "brands")})


_HAS = lambda t, words: f"regexp_matches({t}, '{'|'.join(words)}')"


def _advice(said: str, value: str, lacks: str, before: str, words) -> str:
    return f"CASE WHEN {lacks} AND {_HAS(said, words)} THEN '{before}{value}' ELSE '' END"


@query(rf"""WITH m AS (SELECT DISTINCT message_id, {_STRIP("coalesce(content, '')")} AS t FROM messages WHERE message_id IS NOT NULL),
    p AS (SELECT *, regexp_extract(t, '({dialog.PRONOUNS})', 1) AS w FROM m), n AS (SELECT *, CASE WHEN w <> '' THEN substr(t, 1, instr(t, w) - 1) || '甲车' || substr(t, instr(t, w) + length(w)) ELSE t END AS a FROM p),
    x AS (SELECT *, regexp_extract(a, '{dialog._WITH}', 1) AS y, regexp_extract(a, '{dialog._TWO}', 1) AS z FROM n), g AS (SELECT *, {_STRIP("CASE WHEN y <> '' THEN y ELSE z END")} AS target FROM x),
    r AS (SELECT *, CASE WHEN target <> '' AND NOT contains(a, '甲车') THEN '甲车 和 ' || target || ' 对比' ELSE a END AS s0 FROM g),
    r1 AS (SELECT *, s0 || {_advice("s0", "10-12万", "NOT contains(s0, '万')", "，预算", dialog.ADVICE)} AS s1 FROM r),
    r2 AS (SELECT *, s1 || {_advice("s1", "插混", "NOT " + _HAS("s1", dialog.ENERGY), "，偏向", dialog.ADVICE)} AS s2 FROM r1),
    r3 AS (SELECT *, s2 || {_advice("s2", "SUV", "NOT contains(lower(s2), 'suv')", "，车型偏好", dialog.ADVICE)} AS s3 FROM r2),
    r4 AS (SELECT *, s3 || {_advice("s3", "空间/油耗/动力", "NOT contains(s3, '重点关注')", "，重点关注", dialog.ADVICE[:3])} AS s4 FROM r3)
    SELECT message_id, s4 AS text, concat_ws(',', CASE WHEN s0 <> t THEN 'rewritten' END, CASE WHEN s1 <> s0 THEN 'budget' END, CASE WHEN s2 <> s1 THEN 'energy_type' END, CASE WHEN s3 <> s2 THEN 'car_type' END, CASE WHEN s4 <> s3 THEN 'focus_points' END) AS reasons FROM r4""")
def rewritten_queries(spark, d):
    """Messages rewritten with a thing in focus and known preferences."""
    rows = table(spark, d, "messages").where("message_id IS NOT NULL").select("message_id", "content").distinct()
    known = F.struct(F.lit("10-12万").alias("budget_text"), F.lit("插混").alias("energy_type"), F.lit("SUV").alias("car_type"), F.array(*map(F.lit, ("空间", "油耗", "动力", "配置"))).alias("focus_points"))
    out = dialog.enrich(rows, "content", F.lit("甲车"), known)
    return out.select("message_id", F.col("rewritten").alias("text"), F.array_join("reasons", ",").alias("reasons")).distinct()


@query(rf"""WITH m AS (SELECT DISTINCT message_id, {_STRIP("coalesce(content, '')")} AS t FROM messages WHERE message_id IS NOT NULL)
    SELECT DISTINCT message_id, concat_ws('、', CASE WHEN NOT regexp_matches(t, '{dialog._RANGE}') AND NOT regexp_matches(t, '{dialog._SINGLE}') THEN '预算' END, CASE WHEN {_ONE(dialog.ENERGY)} IS NULL THEN '能源类型' END, CASE WHEN {_ONE(dialog.CAR_TYPES)} IS NULL THEN '车型类别' END) AS missing FROM m""")
def missing_slots(spark, d):
    rows = table(spark, d, "messages").where("message_id IS NOT NULL").select("message_id", dialog.missing_slots(dialog.preferences(F.col("content"))).alias("m"))
    return rows.select("message_id", F.array_join("m", "、").alias("missing")).distinct()


@query(rf"""WITH {_TURNS}, r AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY turn DESC) AS back FROM t) SELECT session_id, message_id, turn FROM r WHERE back <= 6""")
def recent_messages(spark, d):
    """The last six messages of each session."""
    return groups.best(_turns(spark, d), "session_id", 6, F.desc("turn")).select("session_id", "message_id", "turn")


# --- images: pages are built from the series at hand


_COLORS = ("白", "黑", "灰", "蓝")


def _pages(spark, d) -> DataFrame:
    """A raw page for each clean record: with modules where the id is even, else with a gallery, group covers and a floor."""
    i = F.col("clean_id").cast("string")
    url = lambda name, end=".jpg": F.concat(F.lit(f"//img.example/{name}/"), i, F.lit(end))
    sample = lambda k: F.struct(url(k).alias("image_url"), F.col("clean_id").alias("car_id"), F.array(*map(F.lit, _COLORS)).alias("available_color_names"))
    module = lambda k, name: F.struct(F.lit(name).alias("category_name"), F.array(sample(k), sample(k + "2")).alias("selected_images"))
    modules = F.when(F.col("clean_id") % 2 == 0, F.struct(module("wg", "外观").alias("wg"), module("ns", "").alias("ns")))
    gallery = F.array(F.struct(url("g", ".png").alias("image_url"), F.lit("wg").alias("category")), F.struct(F.lit("").alias("image_url"), F.lit("x").alias("category")), F.struct(url("h", "").alias("image_url"), F.lit("kj").alias("category")))
    head = F.struct(F.col("brand_name"), url("cover").alias("cover_url"), gallery.alias("series_image_info_list"), F.array(F.struct(url("p").alias("CoverPicUrl"), F.lit("NS").alias("Category"))).alias("pics_summary_info"))
    floor = F.struct(F.array(F.struct(F.lit("gft").alias("category"), F.lit("官方图").alias("text"), F.array(F.struct(url("f").alias("url"), F.lit(640).alias("width"), F.lit(480).alias("height"), F.lit("红").alias("color_name"))).alias("image_list"))).alias("floor_image_list"))
    page = F.struct(F.col("series_id").alias("seriesId"), F.col("series_name").alias("seriesName"), head.alias("seriesHomeHead"), floor.alias("imageFloorData"), modules.alias("selectedImageModules"))
    rows = table(spark, d, "dcd_cleaner").select("clean_id", "series_id", "series_name", "brand_name").distinct()
    return rows.select("clean_id", F.to_json(F.struct(F.struct(page.alias("pageProps")).alias("props"))).alias("raw"))


_MENTIONS = """c AS (SELECT DISTINCT clean_id, coalesce(series_id, '') AS series_id, CASE WHEN coalesce(series_name, '') = '' THEN '未知车系' ELSE series_name END AS series_name, coalesce(brand_name, '') AS brand_name FROM dcd_cleaner),
    v(section, role, rank, name, ending, category, category_name, even, odd, width, height, color_name) AS (VALUES ('series_cover', 'cover', 0, 'cover', '.jpg', 'cover', '封面', true, true, 0, 0, ''),
      ('module_wg', 'module_sample', 0, 'wg', '.jpg', 'wg', '外观', true, false, 0, 0, '白,黑,灰'), ('module_wg', 'module_sample', 1, 'wg2', '.jpg', 'wg', '外观', true, false, 0, 0, '白,黑,灰'),
      ('module_ns', 'module_sample', 0, 'ns', '.jpg', 'ns', '内饰', true, false, 0, 0, '白,黑,灰'), ('module_ns', 'module_sample', 1, 'ns2', '.jpg', 'ns', '内饰', true, false, 0, 0, '白,黑,灰'),
      ('series_gallery', 'gallery', 0, 'g', '.png', 'wg', '外观', false, true, 0, 0, ''), ('series_gallery', 'gallery', 2, 'h', '', 'kj', 'kj', false, true, 0, 0, ''),
      ('image_floor_cover', 'group_cover', 0, 'p', '.jpg', 'ns', '内饰', false, true, 0, 0, ''), ('image_floor', 'gallery', 0, 'f', '.jpg', 'gft', '官方图', false, true, 640, 480, '红')),
    a AS (SELECT c.*, v.* EXCLUDE (even, odd, name, ending), 'https://img.example/' || name || '/' || clean_id || ending AS url FROM c JOIN v ON CASE WHEN clean_id % 2 = 0 THEN even ELSE odd END),
    b AS (SELECT *, substr(sha1(series_id || '|' || url || '|' || section || '|' || role), 1, 16) AS asset_id FROM a)"""


@query(f"""WITH {_MENTIONS}, s AS (SELECT *, ('0x' || substr(asset_id, 1, 8))::BIGINT / 4294967295.0 AS p FROM b)
    SELECT clean_id, asset_id, section, role, rank, url, category, category_name, width, height, color_name, CASE WHEN p < 0.1 THEN 'test' WHEN p < 0.2 THEN 'val' ELSE 'train' END AS split,
      CASE WHEN url LIKE '%.jpg' THEN '.jpg' WHEN url LIKE '%.png' THEN '.png' ELSE '.bin' END AS extension, regexp_matches(url, '[.](jpg|png)$') AS image_like FROM s""")
def image_assets(spark, d):
    rows = images.assets(_pages(spark, d), "clean_id", "raw")
    return rows.select("clean_id", "asset_id", "section", "role", "rank", "url", "category", "category_name", "width", "height", "color_name", "split", "extension", "image_like")


_SAID = " ".join(f"WHEN '{k}' THEN '{v.split('{}')[0]}' || g || '{v.split('{}')[1]}'" for k, v in images._SAYS.items()) + f" ELSE '{images._SAYS_ELSE.split('{}')[0]}' || g || '{images._SAYS_ELSE.split('{}')[1]}'"


@query(f"""WITH {_MENTIONS}, e AS (SELECT *, CASE WHEN brand_name = '' THEN '未知品牌' ELSE brand_name END AS g FROM b)
    SELECT DISTINCT asset_id, image_section, status, md5('车系: ' || series_name || '。品牌: ' || g || '。图片类别: ' || category_name || '。' || said) AS text FROM (SELECT *, section AS image_section, CASE WHEN rank = 1 THEN 'ok' ELSE 'fallback' END AS status, CASE WHEN rank = 1 THEN '模型所见' ELSE
      '这是一张' || series_name || CASE category_name {_SAID} END || ' 图片类别为' || category_name || '，来源于' || section || '，角色为' || role || '。 已知颜色信息为' || CASE WHEN color_name = '' THEN '颜色信息未标注' ELSE color_name END || '。' || CASE WHEN width > 0 THEN ' 图片分辨率约为' || width || 'x' || height || '。' ELSE '' END END AS said FROM e)""")
def image_captions(spark, d):
    """Captions of a model where it gave any (here for the second samples), else by rule."""
    rows = images.assets(_pages(spark, d), "clean_id", "raw")
    model = rows.where("rank = 1").select("asset_id", F.lit(" 模型所见 ").alias("text"))
    return images.caption_records(rows, captions=model).select("asset_id", "image_section", "status", F.md5("text").alias("text")).distinct()


@query(f"WITH {_MENTIONS} SELECT category_name, count(*) AS captions, count(*) FILTER (rank <> 1) AS fallbacks FROM b GROUP BY category_name")
def caption_counts(spark, d):
    rows = images.assets(_pages(spark, d), "clean_id", "raw")
    model = rows.where("rank = 1").select("asset_id", F.lit("模型所见").alias("text"))
    return images.caption_summary(images.caption_records(rows, captions=model))


@query(f"""WITH {_MENTIONS} SELECT DISTINCT asset_id, md5('车系: ' || series_name || chr(10) || '品牌: ' || CASE WHEN brand_name = '' THEN '未知品牌' ELSE brand_name END || chr(10) || '图片类别: ' || category_name || chr(10) || '来源角色: ' || role || chr(10) || '补充要求: ' ||
      CASE category_name {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in images._LOOKS.items())} ELSE '{images._LOOKS_ELSE}' END || chr(10) || chr(10) || '请生成适合向量检索和问答引用的中文 caption。') AS prompt FROM b""")
def caption_prompts(spark, d):
    return images.assets(_pages(spark, d), "clean_id", "raw").select("asset_id", F.md5(images.caption_prompt()).alias("prompt")).distinct()


@query(f"WITH {_MENTIONS}, m AS (SELECT url, section, rank, '/f/' || clean_id AS local_path, clean_id AS bytes FROM b WHERE clean_id % 3 = 0) SELECT DISTINCT asset_id, local_path, bytes FROM b LEFT JOIN m USING (url, section, rank)")
def images_on_disk(spark, d):
    """Assets with what a manifest of fetched images knows of them."""
    rows = images.assets(_pages(spark, d), "clean_id", "raw")
    manifest = rows.where("clean_id % 3 = 0").select("url", "section", "rank", F.concat(F.lit("/f/"), F.col("clean_id").cast("string")).alias("local_path"), F.col("clean_id").alias("bytes"))
    return images.with_manifest(rows, manifest).select("asset_id", "local_path", "bytes").distinct()


@query(f"WITH {_MENTIONS} SELECT section, role, count(*) AS n, count(DISTINCT series_id) AS groups FROM b GROUP BY ALL")
def image_counts(spark, d):
    return images.assets(_pages(spark, d), "clean_id", "raw").groupBy("section", "role").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("series_id").alias("groups"))


# --- reports and records


_RECORD = f"""SELECT DISTINCT clean_id, series_id, series_name, brand_name, car_type, official_price, dealer_price_range FROM dcd_cleaner"""
_FIELDS = ("series_id", "series_name", "brand_name", "car_type")
_BAD_NAME = f"CASE WHEN coalesce(series_name, '') = '' THEN true ELSE (length(series_name) - length(translate(series_name, '{T.GARBLED}', '')))::DOUBLE / length(series_name) > 0.03 END"
_ISSUES = f"""concat_ws(',', {", ".join(f"CASE WHEN coalesce({f}, '') = '' THEN 'series.{f} missing' END" for f in _FIELDS)}, CASE WHEN coalesce(official_price, '') = '' AND coalesce(dealer_price_range, '') = '' THEN 'price missing' END, CASE WHEN clean_id % 10 = 0 THEN 'no models' END, CASE WHEN {_BAD_NAME} THEN 'series_name garbled' END)"""
_WARNED = "concat_ws(',', CASE WHEN clean_id % 700 > 500 THEN 'total_score out of range' END, CASE WHEN clean_id % 10 > 1 THEN 'repeated car_id: ' || (clean_id % 10 - 1) END, CASE WHEN clean_id % 3 = 0 THEN 'untitled news: 2' END)"


def _validated(spark, d) -> DataFrame:
    """Records with as many models, all of one id, as the id's last digit; a score and news by the id as well."""
    rows = table(spark, d, "dcd_cleaner").select("clean_id", *_FIELDS, "official_price", "dealer_price_range").distinct()
    n = (F.col("clean_id") % 10).cast("int")
    titles = F.when(F.col("clean_id") % 3 == 0, F.array(F.lit(""), F.lit(None).cast("string"), F.lit("x")))
    issues, warnings = quality.record_issues({f: F.col(f) for f in _FIELDS}, (F.col("official_price"), F.col("dealer_price_range")), n, F.col("clean_id") % 700, F.array_repeat(F.lit("7"), n), titles)
    return rows.select("clean_id", issues.alias("issues"), warnings.alias("warnings")).withColumn("is_valid", F.size("issues") == 0)


@query(f"SELECT clean_id, issues = '' AS is_valid, issues, warnings FROM (SELECT clean_id, {_ISSUES} AS issues, {_WARNED} AS warnings FROM ({_RECORD}))")
def record_validation(spark, d):
    return _validated(spark, d).withColumns({c: F.array_join(c, ",") for c in ("issues", "warnings")})


@query(f"""SELECT count(*) AS series_total, count(*) FILTER (issues = '') AS series_valid, count(*) FILTER (issues <> '') AS series_invalid, count(*) FILTER (warnings <> '') AS series_with_warnings,
    (SELECT count(*) FROM chunks) AS items, (SELECT count(DISTINCT series_id) FROM chunks WHERE series_id <> '') AS covered_series, 5::BIGINT AS dropped FROM (SELECT {_ISSUES} AS issues, {_WARNED} AS warnings FROM ({_RECORD}))""")
def quality_summary(spark, d):
    return quality.report_summary(_validated(spark, d), table(spark, d, "chunks"), 5)


@query("SELECT DISTINCT schema_version, source, entity_type, series_id, series_name, brand_name, sub_brand_name, car_type, city_name, dealer_price_range, official_price AS official_price_range, NULL::VARCHAR AS latest_owner_price, NULL::VARCHAR AS lowest_owner_price, (clean_id % 50)::VARCHAR AS total_score, NULL::VARCHAR AS total_review_count, (clean_id % 9)::VARCHAR AS model_count, '0' AS dimension_group_count, '1' AS image_group_count, NULL::VARCHAR AS news_count FROM dcd_cleaner")
def clean_summary(spark, d):
    """The summary of clean records, which are built from the columns at hand."""
    rows = table(spark, d, "dcd_cleaner")
    series = F.struct("series_id", "series_name", "brand_name", "sub_brand_name", "car_type", "city_name")
    stats = F.struct((F.col("clean_id") % 9).alias("model_count"), F.lit(0).alias("dimension_group_count"), F.lit(1).alias("image_group_count"))
    record = F.struct("schema_version", "source", "entity_type", series.alias("series"), F.struct("dealer_price_range", F.col("official_price").alias("official_price_range")).alias("pricing"), F.struct((F.col("clean_id") % 50).alias("total_score")).alias("scores"), stats.alias("stats"))
    return sinks.clean_summary(rows.select(F.to_json(record).alias("record"))).distinct()


_DECISION = "CASE WHEN json_valid(metadata_json) THEN json_extract_string(metadata_json, '$.governance_decision') END"
_SCORE = "try_cast(CASE WHEN json_valid(metadata_json) THEN json_extract_string(metadata_json, '$.quality_score') END AS DOUBLE)"


@query(f"SELECT decision, count(*) AS n, round(sum(score), 4) AS sum_score, round(avg(score), 4) AS avg_score FROM (SELECT {_DECISION} AS decision, {_SCORE} AS score FROM chunks) GROUP BY decision")
def decision_summary(spark, d):
    rows = table(spark, d, "chunks").select(F.get_json_object("metadata_json", "$.governance_decision").alias("decision"), F.get_json_object("metadata_json", "$.quality_score").try_cast("double").alias("score"))
    return sinks.decisions(rows, scores=["score"])


@query("SELECT event_type AS step, count(*) AS n, round(sum(value), 4) AS total_ms, max(value) AS max_ms, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY event_type")
def step_summary(spark, d):
    rows = table(spark, d, "events").select(F.col("event_type").alias("step"), F.col("value").alias("ms"), (F.col("event_type") == "error").alias("error"))
    return sinks.running_summary(rows).withColumn("total_ms", F.round("total_ms", 4))


@query(f"SELECT DISTINCT record_id, greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce({_SCORE} * 2 - 0.5, 0.5))) AS score FROM chunks")
def clamped_scores(spark, d):
    value = (F.get_json_object("metadata_json", "$.quality_score").try_cast("double") * 2 - 0.5).cast("string")
    return table(spark, d, "chunks").select("record_id", T.clamp(value, 0.5).alias("score")).distinct()


@query("""SELECT DISTINCT clean_id, CASE WHEN models IS NULL OR models = '' THEN NULL ELSE md5(models) END AS data, string_split(series_id, '')[1] || '1' AS linked FROM dcd_cleaner WHERE series_id <> ''""")
def page_parts(spark, d):
    """The JSON that a page carries in its script, and the series it links to, each once."""
    page = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">'), F.coalesce("models", F.lit("")), F.lit("</script><a href='/auto/series/"), F.substring("series_id", 1, 1), F.lit("1'>a</a><a href='/auto/series/"), F.substring("series_id", 1, 1), F.lit("1'>b</a>"))
    rows = table(spark, d, "dcd_cleaner").where("series_id != ''").select("clean_id", page.alias("html"))
    return rows.select("clean_id", F.md5(T.next_data(F.col("html"))).alias("data"), F.array_join(T.series_ids(F.col("html")), ",").alias("linked")).distinct()


@query("SELECT array_to_string(list_sort(list_distinct(list(event_type))), ',') AS kinds FROM events WHERE event_type IS NOT NULL")
def event_kinds(spark, d):
    return table(spark, d, "events").where("event_type IS NOT NULL").agg(F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("kinds"))
