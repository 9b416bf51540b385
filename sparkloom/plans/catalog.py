"""Queries of the core operators by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.functions import tokens
from sparkloom.operators import chunking, dedup, dense, dialog, evaluation, groups, hybrid, quality, records, shredding, sparse, units
from sparkloom.plans.shared import materialize, small, table
from sparkloom.sources import sinks
from sparkloom.streaming import events as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: White space as in functions.text, for the SQL of texts.
_WS = T.SPACE
_STRIP = lambda c: f"regexp_replace(regexp_replace({c}, '^{_WS}+', ''), '{_WS}+$', '')"
_FORM = f"lower({_STRIP(f"regexp_replace(coalesce(text, ''), '{_WS}+', ' ', 'g')")})"
_TOKENS = lambda c: f"regexp_extract_all(lower(coalesce({c}, '')), '{T.TOKEN}')"


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name or f.__name__] = f
        if sql:
            SQL[name or f.__name__] = sql
        return f

    return add


# --- problems of the core


@query()
def p6_found(spark, d):
    return units.prices_in_yuan(table(spark, d, "dcd_cleaner"), "clean_id", ["official_price", "dealer_price_range"], "price_note").drop("certain").distinct()


@query()
def p6_certainty(spark, d):
    """Prices by field and whether one choice of units is best."""
    rows = units.prices_in_yuan(table(spark, d, "dcd_cleaner"), "clean_id", ["official_price", "dealer_price_range"], "price_note")
    return rows.groupBy("field_name", "certain").agg(F.count(F.lit(1)).alias("n"))


@query("""
    WITH r AS (SELECT DISTINCT clean_id, CASE WHEN json_valid(models) THEN models::JSON END AS m, CASE WHEN json_valid(dimensions) THEN dimensions::JSON END AS d FROM dcd_cleaner),
    o AS (SELECT clean_id, CASE WHEN json_type(m) = 'VARCHAR' THEN try_cast(m->>'$' AS JSON) ELSE m END AS m, CASE WHEN json_type(d) = 'VARCHAR' THEN try_cast(d->>'$' AS JSON) ELSE d END AS d FROM r),
    x AS (SELECT clean_id, unnest(CASE WHEN json_type(m) = 'ARRAY' THEN json_extract(m, '$[*]') WHEN json_exists(m, '$.tab_list') THEN json_extract(m, '$.tab_list[*].data[*].info')
      WHEN json_exists(m, '$.car_id') OR json_exists(m, '$.name') THEN [m] WHEN json_type(m) = 'OBJECT' THEN json_extract(m, '$.*') END) AS x FROM o),
    c AS (SELECT clean_id, x, x->>'$.car_id' AS car_id, x->'$.tags' AS tags, coalesce(x->'$.base_config', x->'$.car_config.base_config') AS base FROM x WHERE json_type(x) = 'OBJECT' AND coalesce(x->>'$.car_id', '') <> ''),
    l AS (SELECT clean_id, car_id, unnest([{'child': 'tag', 'v': tags}, {'child': 'base_config', 'v': base}]) AS s FROM c),
    g AS (SELECT clean_id, CASE WHEN json_type(d) = 'ARRAY' THEN d WHEN json_exists(d, '$.space') THEN d->'$.space' WHEN json_type(d) = 'OBJECT' THEN to_json([d]) END AS d FROM o)
    SELECT clean_id, 'model' AS child, car_id, 0 AS item_no FROM c
    UNION SELECT clean_id, s.child, car_id, unnest(CASE WHEN json_type(s.v) = 'ARRAY' THEN generate_series(0, json_array_length(s.v)::BIGINT - 1) WHEN json_type(s.v) = 'VARCHAR' THEN [0::BIGINT] END)::INTEGER FROM l
    UNION SELECT clean_id, 'dimension', '', unnest(generate_series(0, json_array_length(d)::BIGINT - 1))::INTEGER FROM g WHERE json_type(d) = 'ARRAY'""")
def p7_found(spark, d):
    rows = shredding.series_tables(table(spark, d, "dcd_cleaner"), ["model", "tag", "base_config", "dimension"])
    return rows.select("clean_id", "child", "car_id", "item_no").distinct()


for _child in shredding.TABLES:
    QUERIES[f"p7_{_child}"] = lambda spark, d, child=_child: shredding.child_table(table(spark, d, "dcd_cleaner"), child)


# --- duplicates and hashes


@query(f"""
    WITH h AS (SELECT doc_id, md5(coalesce(text, '')) AS content, md5({_FORM}) AS normal FROM documents),
    f AS (SELECT normal, min(doc_id) AS first_id, arg_min(content, doc_id) AS first_content FROM h GROUP BY normal)
    SELECT doc_id, CASE WHEN doc_id = first_id THEN 'none' WHEN content = first_content THEN 'exact_content' ELSE 'normalized_text' END AS label,
           CASE WHEN doc_id > first_id THEN first_id END AS matched_id
    FROM h JOIN f USING (normal)""")
def duplicate_labels(spark, d):
    return dedup.duplicate_labels(table(spark, d, "documents"), "doc_id", "text")


@query("""
    WITH h AS (SELECT DISTINCT md5(coalesce(text, '')) AS h, record_id FROM chunks WHERE asset_split = 'train'), f AS (SELECT h, min(record_id) AS m FROM h GROUP BY h)
    SELECT DISTINCT record_id, CASE WHEN m IS NULL THEN 'none' ELSE 'exact_content' END AS label, m AS matched_id
    FROM chunks LEFT JOIN f ON md5(coalesce(text, '')) = h WHERE asset_split = 'test'""")
def manifest_hits(spark, d):
    chunks = table(spark, d, "chunks")
    known = chunks.where("asset_split = 'train'").select(F.lit("content").alias("kind"), T.content_hash(F.col("text")).alias("hash"), F.col("record_id").alias("matched_id"))
    return dedup.against_manifest(chunks.where("asset_split = 'test'"), known, "record_id", "text").distinct()


@query("""
    WITH r AS (SELECT DISTINCT session_id, user_id, title, created_at, updated_at FROM sessions WHERE session_id IS NOT NULL),
    l AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY updated_at DESC, created_at DESC, user_id DESC, title DESC) AS p FROM r)
    SELECT session_id, updated_at FROM l WHERE p = 1""")
def latest_sessions(spark, d):
    rows = table(spark, d, "sessions").where("session_id IS NOT NULL")
    return dedup.last_written(rows, "session_id", "updated_at", "created_at", "user_id", "title").select("session_id", "updated_at")


@query(f"""
    SELECT doc_id, md5(coalesce(text, '')) AS content, md5({_FORM}) AS normal FROM documents""")
def text_hashes(spark, d):
    return table(spark, d, "documents").select("doc_id", T.content_hash(F.col("text")).alias("content"), T.normal_hash(F.col("text")).alias("normal"))


# --- quality


_GARBLED = f"CASE WHEN coalesce(text, '') = '' THEN true ELSE (length(text) - length(translate(text, '{T.GARBLED}', '')))::DOUBLE / length(text) > 0.03 END"


@query(f"""
    SELECT record_id, errors = '' AS is_valid, errors, warnings FROM (SELECT record_id,
      concat_ws(',', {", ".join(f"CASE WHEN {c} IS NULL OR {c}::VARCHAR = '' THEN 'missing:{c}' END" for c in quality.REQUIRED)},
        CASE WHEN length({_STRIP("coalesce(text, '')")}) < 80 THEN 'short_text' END,
        CASE WHEN tokens IS NULL THEN 'tokens_not_integer' WHEN tokens <= 0 THEN 'no_tokens' END, CASE WHEN {_GARBLED} THEN 'garbled' END) AS errors,
      CASE WHEN tokens > 0 AND tokens < 30 THEN 'few_tokens' WHEN tokens > 1500 THEN 'many_tokens' ELSE '' END AS warnings FROM chunks)""")
def item_validation(spark, d):
    rows = quality.validate(table(spark, d, "chunks"))
    return rows.select("record_id", "is_valid", F.array_join("errors", ",").alias("errors"), F.array_join("warnings", ",").alias("warnings"))


@query("SELECT coalesce(min(tokens), 0) AS min, coalesce(max(tokens), 0) AS max, coalesce(round(avg(tokens), 2), 0) AS avg, coalesce(round(median(tokens), 2), 0) AS median FROM chunks")
def token_stats(spark, d):
    return quality.number_stats(table(spark, d, "chunks"), "tokens")


_COVERED = ("series_id", "series_name", "brand_name", "sub_brand_name", "car_type", "city_name", "official_price", "dealer_price_range", "models", "dimensions", "pricing", "scores")


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, CASE WHEN count(*) = 0 THEN 0.0 ELSE round(100.0 * count(*) FILTER ({c} <> '') / count(*), 2) END::DOUBLE AS percent FROM dcd_cleaner" for c in _COVERED))
def field_coverage(spark, d):
    return quality.coverage(table(spark, d, "dcd_cleaner"), {c: ~T.is_blank(F.col(c)) for c in _COVERED})


@query("""
    WITH e AS (SELECT min(tokens)::DOUBLE AS lo, max(tokens)::DOUBLE AS hi FROM chunks),
    b AS (SELECT CASE WHEN hi = lo THEN 0 ELSE least(floor((tokens - lo) * 10 / (hi - lo)), 9) END::INTEGER AS bin, lo, hi FROM chunks, e WHERE tokens IS NOT NULL)
    SELECT bin, lo + (hi - lo) / 10 * bin AS low, lo + (hi - lo) / 10 * (bin + 1) AS high, count(*) AS n FROM b GROUP BY bin, lo, hi""")
def token_histogram(spark, d):
    return quality.histogram(table(spark, d, "chunks"), "tokens")


@query("""
    WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) - 1 AS p, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL)
    SELECT event_type, max(n) AS n, round(avg(value), 4) AS avg, round(median(value), 4) AS median, max(value) FILTER (p = greatest(floor(n * 0.95) - 1, 0)) AS p95, max(value) AS max FROM r GROUP BY event_type""")
def event_durations(spark, d):
    return quality.duration_stats(table(spark, d, "events"), "event_type", "event_id", "value")


@query("SELECT source, coalesce(asset_split, 'none') AS split, count(*) AS rows, count(DISTINCT series_id) AS groups FROM chunks GROUP BY ALL")
def source_splits(spark, d):
    return table(spark, d, "chunks").groupBy("source", F.coalesce("asset_split", F.lit("none")).alias("split")).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("series_id").alias("groups"))


# --- text


@query(f"SELECT doc_id, len({_TOKENS('text')})::INTEGER AS tokens, len(list_distinct({_TOKENS('text')}))::INTEGER AS kinds FROM documents")
def token_counts(spark, d):
    t = T.tokens(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(t).alias("tokens"), F.size(F.array_distinct(t)).alias("kinds"))


@query(f"SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '{T.SENTENCE_END}'), lambda s: length({_STRIP('s')}) >= 4))::INTEGER AS sentences FROM documents")
def sentence_counts(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(T.sentences(F.col("text"))).alias("sentences"))


@query(r"""
    WITH w AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '\r\n|[\n\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}]', chr(10), 'g') AS t FROM documents)
    SELECT doc_id, CASE WHEN t = '' THEN 0 ELSE length(t) - length(replace(t, chr(10), '')) + CASE WHEN t LIKE '%' || chr(10) THEN 0 ELSE 1 END END::INTEGER AS lines,
           (length(t) - length(replace(t, '。', '')))::INTEGER AS stops FROM w""")
def line_counts(spark, d):
    return table(spark, d, "documents").select("doc_id", T.line_count(F.col("text")).alias("lines"), T.occurrences(F.col("text"), "。").alias("stops"))


@query(r"""
    SELECT DISTINCT record_id, substr(sha1(concat_ws('|', coalesce(series_id, ''), coalesce(trim(url), ''), coalesce(chunk_index::VARCHAR, ''))), 1, 16) AS asset_id,
      regexp_extract(coalesce(url, ''), '/auto/series/(\d+)', 1) AS linked, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS path FROM chunks""")
def url_parts(spark, d):
    rows = table(spark, d, "chunks").select("record_id", T.stable_id(F.col("series_id"), T.url(F.col("url")), F.col("chunk_index")).alias("asset_id"), F.coalesce(F.get(T.series_ids(F.col("url")), F.lit(0)), F.lit("")).alias("linked"), T.url_path(F.col("url")).alias("path"))
    return rows.distinct()


@query("""
    WITH s AS (SELECT DISTINCT source, record_id, ('0x' || substr(sha1(record_id::VARCHAR), 1, 8))::BIGINT / 4294967295.0 AS p FROM chunks)
    SELECT source, CASE WHEN p < 0.1 THEN 'test' WHEN p < 0.2 THEN 'val' ELSE 'train' END AS split, count(*) AS n FROM s GROUP BY ALL""")
def hash_splits(spark, d):
    rows = table(spark, d, "chunks").select("source", "record_id").distinct()
    return rows.groupBy("source", T.hash_split(F.sha1(F.col("record_id").cast("string"))).alias("split")).agg(F.count(F.lit(1)).alias("n"))


# --- chunking


@query(f"""
    WITH s AS (SELECT doc_id, text, unnest(generate_series(0, (length(text) - 1) // 320)) AS window_no FROM documents WHERE length(text) > 0),
    w AS (SELECT doc_id, window_no::INTEGER AS window_no, (window_no * 320)::INTEGER AS start, {_STRIP("substring(text, window_no * 320 + 1, 400)")} AS piece FROM s)
    SELECT doc_id, window_no, start, md5(piece) AS piece FROM w WHERE piece <> ''""")
def char_windows(spark, d):
    return chunking.char_windows(table(spark, d, "documents"), "doc_id", "text").withColumn("piece", F.md5("piece"))


@query(r"""
    WITH l AS (SELECT doc_id, unnest(string_split(regexp_replace(coalesce(text, ''), '\r\n|[\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}]', chr(10), 'g'), chr(10))) AS line, generate_subscripts(string_split(regexp_replace(coalesce(text, ''), '\r\n|[\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}]', chr(10), 'g'), chr(10)), 1) AS n FROM documents),
    h AS (SELECT *, regexp_matches(line, '^[ \t]{0,3}#{1,6}[ \t]+\S') AS head, sum(regexp_matches(line, '^[ \t]{0,3}#{1,6}[ \t]+\S')::INT) OVER (PARTITION BY doc_id ORDER BY n) AS s FROM l),
    g AS (SELECT doc_id, s, coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (head), '') AS heading, coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT head), '') AS body FROM h GROUP BY doc_id, s),
    k AS (SELECT doc_id, s, """ + _STRIP("heading") + " AS heading, " + _STRIP("body") + """ AS body FROM g)
    SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1)::INTEGER AS section_no, heading, md5(body) AS body FROM k WHERE heading <> '' OR body <> ''""")
def text_sections(spark, d):
    return chunking.sections(table(spark, d, "documents"), "doc_id", "text").withColumn("body", F.md5("body"))


@query()
def chunk_texts(spark, d):
    return chunking.chunk_texts(table(spark, d, "documents"), "doc_id", "text", limit=500).select("doc_id", "chunk_index", "total_chunks", "size", F.md5("chunk").alias("chunk"))


@query()
def chunk_tokens(spark, d):
    """As chunk_texts, measured and cut in tokens of a public tokenizer."""
    out = chunking.chunk_texts(table(spark, d, "documents"), "doc_id", "text", limit=200, measure=tokens.count, windows=tokens.windows)
    return out.select("doc_id", "chunk_index", "total_chunks", "size", F.md5("chunk").alias("chunk"))


# --- retrieval: the titles of the chunks whose id is divisible by 50 are the questions, against all chunks


def _questions(spark, d) -> DataFrame:
    rows = table(spark, d, "chunks").where("record_id % 50 = 0 AND title IS NOT NULL AND title != ''")
    return rows.groupBy(F.col("title").alias("question")).agg(F.min("record_id").alias("question_id"), F.min("series_id").alias("label"))


def _docs(spark, d) -> DataFrame:
    return table(spark, d, "chunks").select("record_id", "text", "series_id").dropDuplicates(["record_id"])


def _texts(spark, d) -> DataFrame:
    """As _docs, copies among them: for bm25, which takes each id once."""
    return table(spark, d, "chunks").select("record_id", "text")


def _labelled(spark, d, hits: DataFrame) -> DataFrame:
    """The hits with the series of their rows as label. The rows are chosen before their series are shuffled."""
    ids = materialize(hits.select("doc_id").distinct(), "ids")
    rows = table(spark, d, "chunks").select(F.col("record_id").alias("doc_id"), "series_id").join(small(ids), "doc_id", "left_semi")
    labels = materialize(rows.groupBy("doc_id").agg(F.first("series_id", ignorenulls=True).alias("label")), "labels")
    return hits.join(small(labels), "doc_id")


_Q = "q AS (SELECT title AS question, min(record_id) AS question_id, min(series_id) AS label FROM chunks WHERE record_id % 50 = 0 AND title IS NOT NULL AND title <> '' GROUP BY title)"
_D = "d AS (SELECT record_id, any_value(text) AS text, any_value(series_id) AS series_id FROM chunks GROUP BY record_id)"
_BM25 = f"""{_Q}, {_D}, t AS (SELECT record_id, {_TOKENS("text")} AS t FROM d), p AS (SELECT record_id, len(t) AS dl, unnest(t) AS term FROM t),
    tf AS (SELECT record_id, term, dl, count(*) AS tf FROM p GROUP BY ALL), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term), c AS (SELECT count(*) AS n, avg(len(t)) AS avgdl FROM t),
    qt AS (SELECT question_id, term, count(*) AS qtf FROM (SELECT question_id, unnest({_TOKENS("question")}) AS term FROM q) GROUP BY ALL),
    s AS (SELECT question_id, record_id AS doc_id, round(sum(qtf * greatest(0.0::DOUBLE, (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))), 6) AS score FROM qt JOIN df USING (term) JOIN tf USING (term), c GROUP BY ALL),
    r AS (SELECT question_id, doc_id, score, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)"""


@query(f"WITH {_BM25} SELECT question_id, doc_id, score, rank::INTEGER AS rank FROM r WHERE rank <= 10")
def bm25_top(spark, d):
    return sparse.bm25(_questions(spark, d), _texts(spark, d), 10, "record_id")


@query(f"""WITH p AS (SELECT doc_id, unnest({_TOKENS("text")}) AS term FROM documents), tf AS (SELECT doc_id, term, count(*) AS tf FROM p GROUP BY ALL)
    SELECT term, count(*) AS df, sum(tf)::BIGINT AS tf FROM tf GROUP BY term""")
def term_stats(spark, d):
    return sparse.term_stats(table(spark, d, "documents"))


@query(f"""WITH {_BM25}, h AS (SELECT question_id, series_id AS label, min(rank) AS rank FROM r JOIN d ON doc_id = record_id WHERE rank <= 10 GROUP BY ALL)
    SELECT q.question_id, (h.rank IS NOT NULL)::INTEGER AS hit, CASE WHEN h.rank IS NULL THEN 0 ELSE 1 END::DOUBLE AS recall, coalesce(1.0::DOUBLE / h.rank, 0) AS reciprocal_rank FROM q LEFT JOIN h ON q.question_id = h.question_id AND q.label = h.label""")
def retrieval_scores(spark, d):
    q = _questions(spark, d)
    hits = _labelled(spark, d, sparse.bm25(q, _texts(spark, d), 10, "record_id"))
    return evaluation.retrieval_scores(hits, q.select("question_id", "label"), q)


@query("""
    WITH s AS (SELECT q.vec_id AS question_id, e.vec_id AS doc_id, round(list_inner_product(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) + 0.0 AS score FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank FROM s) SELECT question_id, doc_id, score, rank::INTEGER AS rank FROM r WHERE rank <= 5""")
def nearest_vectors(spark, d):
    rows = table(spark, d, "embeddings")
    return dense.nearest(rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("vector")), rows)


@query("""
    WITH s AS (SELECT q.vec_id AS question_id, e.vec_id AS doc_id, round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 6) AS score, q.label AS a, e.label AS b FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0 AND e.vec_id < q.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank FROM s)
    SELECT question_id, doc_id, score, score >= CASE WHEN a = b THEN 0.88 ELSE 0.94 END AS duplicate FROM r WHERE rank = 1""")
def semantic_duplicates(spark, d):
    """The nearest earlier vector, and whether it is near enough: nearer where the labels differ."""
    rows = table(spark, d, "embeddings")
    asked = rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("vector"), "label")
    hits = dense.nearest(asked, rows, 1, cosine=True, earlier_only=True).drop("rank")
    both = hits.join(asked.select("question_id", F.col("label").alias("a")), "question_id").join(rows.select(F.col("vec_id").alias("doc_id"), F.col("label").alias("b")), "doc_id")
    return both.select("question_id", "doc_id", "score", (F.col("score") >= F.when(F.col("a") == F.col("b"), 0.88).otherwise(0.94)).alias("duplicate"))


@query()
def hybrid_top(spark, d):
    from sparkloom.sources.providers import embed

    asked = _questions(spark, d).select("question_id", "question")
    docs = materialize(_docs(spark, d), "docs")  # read by both sides and for the coverage

    vectors = embed(asked, "question_id", "question").select("question_id", F.col("embedding").alias("vector"))
    near = dense.nearest(vectors, docs, 24, "record_id", text="text")
    known = sparse.index(asked, docs, "record_id")
    return hybrid.fuse(asked, docs, near, sparse.bm25(asked, docs, 40, "record_id", known=known), doc_id="record_id", known=known)


# --- evaluation


@query(f"""
    WITH d AS (SELECT record_id, any_value(title) AS title, any_value(text) AS text FROM chunks GROUP BY record_id),
    a AS (SELECT record_id, term, count(*) AS n FROM (SELECT record_id, unnest({_TOKENS("title")}) AS term FROM d) GROUP BY ALL),
    b AS (SELECT record_id, term, count(*) AS n FROM (SELECT record_id, unnest({_TOKENS("text")}) AS term FROM d) GROUP BY ALL),
    x AS (SELECT record_id, sum(n * n) AS v FROM a GROUP BY ALL), y AS (SELECT record_id, sum(n * n) AS v FROM b GROUP BY ALL),
    z AS (SELECT record_id, sum(a.n * b.n) AS v FROM a JOIN b USING (record_id, term) GROUP BY ALL)
    SELECT record_id, round(coalesce(z.v / sqrt(x.v * y.v), 0), 6) AS similarity FROM d LEFT JOIN x USING (record_id) LEFT JOIN y USING (record_id) LEFT JOIN z USING (record_id)""")
def title_similarity(spark, d):
    rows = table(spark, d, "chunks").select("record_id", "title", "text").dropDuplicates(["record_id"])
    none = F.lit(None).cast("array<string>")
    src = rows.select("record_id", F.col("title").alias("question"), F.col("text").alias("answer"), F.lit(None).cast("string").alias("reference"), none.alias("contexts"), none.alias("reference_contexts"))
    return evaluation.answer_scores(src, "record_id").select("record_id", F.round("answer_relevancy", 6).alias("similarity"))


@query()
def answer_scores(spark, d):
    """Chunks as answers to their titles, with the neighbours of the same run and series as contexts."""
    rows = table(spark, d, "chunks").where("chunk_index IS NOT NULL").select("record_id", "run_id", "series_id", "chunk_index", "title", "text").dropDuplicates(["record_id"])
    near = rows.groupBy("run_id", "series_id", "chunk_index").agg(F.max_by("text", "record_id").alias("near"))
    after = near.select("run_id", "series_id", (F.col("chunk_index") + 1).alias("chunk_index"), F.col("near").alias("before"))
    ahead = near.select("run_id", "series_id", (F.col("chunk_index") - 1).alias("chunk_index"), F.col("near").alias("behind"))
    keys = ["run_id", "series_id", "chunk_index"]
    src = rows.join(after, keys, "left").join(ahead, keys, "left")
    src = src.select("record_id", F.col("title").alias("question"), F.col("text").alias("answer"), F.col("before").alias("reference"), F.array("before", "behind").alias("contexts"), F.array("behind").alias("reference_contexts"))
    return evaluation.answer_scores(src, "record_id")


# --- groups


_METRICS = ("quality_score", "rag_readiness", "route_confidence")
_META = ", ".join(f"try_cast(CASE WHEN json_valid(metadata_json) THEN json_extract_string(metadata_json, '$.{m}') END AS DOUBLE) AS {m}" for m in _METRICS)
_G = f"g AS (SELECT DISTINCT record_id, series_id, chunk_index, coalesce(text, '') AS text, {_META} FROM chunks WHERE series_id IS NOT NULL)"


def _scored(spark, d) -> DataFrame:
    meta = F.from_json("metadata_json", ", ".join(f"{m} double" for m in _METRICS))
    rows = table(spark, d, "chunks").where("series_id IS NOT NULL").select("record_id", "series_id", "chunk_index", F.coalesce("text", F.lit("")).alias("text"), meta.alias("m"))
    return rows.select("record_id", "series_id", "chunk_index", "text", "m.*").distinct()


def _order() -> tuple:
    return F.desc_nulls_last("quality_score"), F.asc_nulls_last("chunk_index"), F.col("record_id")


@query(f"""WITH {_G}, b AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY quality_score DESC NULLS LAST, chunk_index NULLS LAST, record_id) AS place FROM g)
    SELECT series_id, record_id, place::INTEGER AS place FROM b WHERE place <= 8""")
def series_best(spark, d):
    return groups.best(_scored(spark, d), "series_id", 8, *_order()).select("series_id", "record_id", "place")


@query(f"""WITH {_G}, b AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY quality_score DESC NULLS LAST, chunk_index NULLS LAST, record_id) AS place FROM g)
    SELECT series_id, count(*) AS n, {", ".join(f"round(sum({m}), 4) / count({m}) AS avg_{m}" for m in _METRICS)}, max(record_id) FILTER (place = 1) AS best_id, md5(string_agg(text, chr(10) || chr(10) ORDER BY place) FILTER (place <= 3)) AS merged
    FROM b GROUP BY series_id HAVING count(*) >= 2""")
def series_profiles(spark, d):
    return groups.profile(_scored(spark, d), "series_id", "record_id", list(_METRICS), "text", _order()).withColumn("merged", F.md5("merged"))


@query("SELECT coalesce(asset_split, 'none') AS split, count(*) AS rows, count(DISTINCT series_id) AS groups FROM chunks GROUP BY ALL")
def split_summary(spark, d):
    return groups.split_counts(table(spark, d, "chunks").withColumn("split", F.coalesce("asset_split", F.lit("none"))), "split", "series_id")


@query("""
    WITH l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events WHERE user_id IS NOT NULL),
    u AS (SELECT *, sum(coalesce(value, 0)) OVER (PARTITION BY user_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS used FROM l WHERE place <= 8) SELECT user_id, event_id, place::INTEGER AS place FROM u WHERE used <= 100""")
def last_events(spark, d):
    rows = groups.best(table(spark, d, "events").where("user_id IS NOT NULL"), "user_id", 8, F.desc("ts"), F.desc("event_id"))
    return groups.within_budget(rows, "user_id", (F.col("place"),), F.coalesce("value", F.lit(0.0)), 100).select("user_id", "event_id", "place")


@query("""
    WITH s AS (SELECT DISTINCT series_id FROM dcd_cleaner WHERE series_id IS NOT NULL), n AS (SELECT series_id, (row_number() OVER (ORDER BY series_id) - 1) % 4 AS i FROM s)
    SELECT series_id, ['价格', '配置', '空间', '油耗'][i + 1] AS topic FROM n""")
def question_topics(spark, d):
    ids = table(spark, d, "dcd_cleaner").where("series_id IS NOT NULL").select("series_id").distinct()
    return groups.round_robin(ids, "series_id", ["价格", "配置", "空间", "油耗"], "topic")


# --- dialog


@query(f"""
    WITH m AS (SELECT DISTINCT message_id, content, {_STRIP("coalesce(content, '')")} AS t FROM messages WHERE message_id IS NOT NULL),
    c AS (SELECT *, regexp_extract(t, '{dialog._WITH}', 1) AS a, regexp_extract(t, '{dialog._TWO}', 1) AS b FROM m)
    SELECT message_id, CASE WHEN t = '' THEN 'clarify' WHEN regexp_matches(t, '{"|".join(dialog.COMPARE)}') OR regexp_matches(t, '{dialog._WITH}') THEN 'compare' WHEN regexp_matches(t, '{"|".join(dialog.RECOMMEND)}') THEN 'recommend'
      WHEN regexp_matches(t, '{"|".join(dialog.FOLLOW_UP)}') THEN 'follow_up' ELSE 'fact_qa' END AS route, {_STRIP("CASE WHEN a <> '' THEN a ELSE b END")} AS target FROM c""")
def dialog_routes(spark, d):
    rows = table(spark, d, "messages").where("message_id IS NOT NULL").select("message_id", "content").distinct()
    return rows.select("message_id", dialog.route(F.col("content"), True).alias("route"), dialog.compare_target(F.col("content")).alias("target"))


def _first(words, ignore_case=False):
    return "CASE " + " ".join(f"WHEN contains({'lower(t)' if ignore_case else 't'}, '{w.lower() if ignore_case else w}') THEN '{w}'" for w in words) + " END"


@query(f"""
    WITH m AS (SELECT DISTINCT message_id, content, {_STRIP("coalesce(content, '')")} AS t FROM messages WHERE message_id IS NOT NULL),
    n AS (SELECT *, try_cast(regexp_extract(t, '{dialog._RANGE}', 1) AS DOUBLE) AS a, try_cast(regexp_extract(t, '{dialog._RANGE}', 2) AS DOUBLE) AS b, try_cast(regexp_extract(t, '{dialog._SINGLE}', 1) AS DOUBLE) AS c FROM m)
    SELECT message_id, CASE WHEN a IS NOT NULL THEN least(a, b) WHEN c IS NOT NULL THEN 0 END AS budget_min, CASE WHEN a IS NOT NULL THEN greatest(a, b) ELSE c END AS budget_max, {_first(dialog.ENERGY)} AS energy_type, {_first(dialog.CAR_TYPES, True)} AS car_type,
      concat_ws('/', {", ".join(f"CASE WHEN contains(t, '{raw}') THEN '{name}' END" for raw, name in dialog.FOCUS.items())}) AS focus FROM n""")
def dialog_preferences(spark, d):
    rows = table(spark, d, "messages").where("message_id IS NOT NULL").select("message_id", "content").distinct()
    return rows.select("message_id", dialog.preferences(F.col("content")).alias("p")).select("message_id", "p.budget_min", "p.budget_max", "p.energy_type", "p.car_type", F.array_join("p.focus_points", "/").alias("focus"))


# --- records and stores


@query()
def series_markdown(spark, d):
    rows = records.series_markdown(table(spark, d, "dcd_cleaner"))
    return rows.select("clean_id", F.length("markdown").alias("chars"), T.line_count(F.col("markdown")).alias("lines"), F.md5("markdown").alias("markdown")).distinct()


@query("""
    SELECT DISTINCT record_id, coalesce(source, '') AS source, coalesce(series_id, '') AS series_id, coalesce(title, '') AS title, coalesce(url, '') AS url, coalesce(text, '') AS text, coalesce(metadata_json, '') AS metadata_json,
      coalesce(chunk_index, -1) AS chunk_index, coalesce(total_chunks, 0) AS total_chunks, coalesce(tokens, 0) AS tokens FROM chunks""")
def store_chunks(spark, d):
    return sinks.chunk_rows(table(spark, d, "chunks")).distinct()


@query("""
    WITH c AS (SELECT run_id, count(*) AS n, count(DISTINCT record_id) AS ids FROM chunks WHERE run_id IS NOT NULL GROUP BY run_id)
    SELECT b.run_id, records_count, coalesce(n, 0) AS stored, coalesce(ids, 0) AS distinct_records, records_count = coalesce(n, 0) AS matches FROM build_runs b LEFT JOIN c USING (run_id)""")
def run_counts(spark, d):
    held = table(spark, d, "chunks").where("run_id IS NOT NULL").groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("record_id").alias("ids"))
    stored = F.coalesce("n", F.lit(0))
    return table(spark, d, "build_runs").join(held, "run_id", "left").select("run_id", "records_count", stored.alias("stored"), F.coalesce("ids", F.lit(0)).alias("distinct_records"), (F.col("records_count") == stored).alias("matches"))


# --- streams


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE ts IS NOT NULL GROUP BY ALL")
def stream_windows(spark, d):
    return streams.drain(streams.windows(streams.read(spark, d, "events")), "complete").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("SELECT user_id, count(*) AS n, round(sum(coalesce(value, 0)), 4) AS total FROM events WHERE user_id IS NOT NULL GROUP BY user_id")
def stream_totals(spark, d):
    rows = streams.read(spark, d, "events").where("user_id IS NOT NULL")
    return streams.drain(streams.running_totals(rows), "update").withColumn("total", F.round("total", 4))


def entry(spark: SparkSession, d: str) -> DataFrame:
    return duplicate_labels(spark, d)


def queries() -> dict[str, Query]:
    from sparkloom.plans import composed, connectors  # noqa: F401  (they register their queries here)

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(SQL)
