"""Core operators on small fixtures, against plain Python or worked examples."""

import hashlib
import json
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.functions import text as T
from sparkloom.operators import chunking, dedup, dense, dialog, evaluation, groups, hybrid, images, quality, ranking, records, sparse

ODD = [None, "", "  ", " A　b \n", "x\x1cy", "é É", "a" * 200_000]


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(column(F.col("t")).alias("r")).first().r


@pytest.mark.parametrize("t", ODD + ["a\nb\n", "a\r\nb", "\n", "a b", "x\x0by\x85"])
def test_text_functions_equal_python(spark, t):
    plain = t or ""
    assert one(spark, t, T.dedup_form) == " ".join(plain.split()).lower()
    assert one(spark, t, lambda c: T.strip(F.coalesce(c, F.lit("")))) == plain.strip()
    assert one(spark, t, T.line_count) == len(plain.splitlines())
    assert one(spark, t, T.content_hash) == hashlib.md5(plain.encode()).hexdigest()


def test_garbled_and_tokens(spark):
    assert one(spark, None, T.garbled) is True and one(spark, "", T.garbled) is True
    assert one(spark, "Ã" + "a" * 40, T.garbled) is False and one(spark, "Ã" + "a" * 20, T.garbled) is True
    assert one(spark, "Ab1 车漆-C", T.tokens) == ["ab1", "车", "漆", "c"] and one(spark, None, T.tokens) == []
    assert one(spark, "短。够长的句子！ab\nlong one", T.sentences) == ["够长的句子", "long one"]


def test_ids_urls_and_splits(spark):
    parts = ["900001", "https://example.com/alpha-wg-1.jpg", "module_wg", "module_sample"]
    got = spark.range(1).select(T.stable_id(*map(F.lit, parts)).alias("i")).withColumn("s", T.hash_split(F.col("i"))).first()
    assert (got.i, got.s) == ("29f33676ade970cd", "val")
    assert one(spark, " //a.b/c ", T.url) == "https://a.b/c" and one(spark, None, T.url) == ""
    assert [one(spark, u, T.file_extension) for u in ("http://x/a.JPG?q=1", "http://x/a.image", "http://x/a", None)] == [".jpg", ".jpg", ".bin", ".bin"]
    page = '<a href="/auto/series/12">x</a> /auto/series/7 /auto/series/12 <script id="__NEXT_DATA__" type="x">{"a":\n1}</script>'
    assert one(spark, page, T.series_ids) == ["12", "7"] and one(spark, page, T.next_data) == '{"a":\n1}' and one(spark, "none", T.next_data) is None


def test_duplicates_first_accepted_wins(spark, clash):
    rows = [(1, "A b", False), (2, "a  B", True), (3, "a  B", True), (4, "A b", True), (5, None, True), (6, "", True), (7, "other", None)]
    df = clash(spark.createDataFrame(rows, "doc bigint, text string, ok boolean"))
    got = {r.doc: (r.label, r.matched_id) for r in dedup.duplicate_labels(df, "doc", "text", F.col("ok")).collect()}
    assert got == {1: ("none", None), 2: ("none", None), 3: ("exact_content", 2), 4: ("normalized_text", 2), 5: ("none", None), 6: ("exact_content", 5), 7: ("none", None)}
    empty = spark.createDataFrame([], df.schema)
    assert dedup.duplicate_labels(empty, "doc", "text").count() == 0
    manifest = spark.createDataFrame([("content", hashlib.md5(b"A b").hexdigest(), 9), ("normal", hashlib.md5(b"a b").hexdigest(), 8)], "kind string, hash string, matched_id bigint")
    hits = {r.doc: (r.label, r.matched_id) for r in dedup.against_manifest(df, manifest, "doc", "text").collect()}
    assert hits[1] == ("exact_content", 9) and hits[2] == ("normalized_text", 8) and hits[7] == ("none", None)


def test_validation_edges(spark):
    rows = [(1, 0, 5, 30, "x" * 80), (2, 0, 5, 29, " " + "x" * 79), (3, None, 5, 0, "x" * 80), (4, 0, 5, None, "x" * 80), (5, 0, 5, 1501, "x" * 80), (6, 0, 5, 100, None)]
    df = spark.createDataFrame([(i, "s", "u", "t", "9", c, n, k, x) for i, c, n, k, x in rows], "record_id bigint, source string, url string, title string, series_id string, chunk_index int, total_chunks int, tokens int, text string")
    got = {r.record_id: (r.is_valid, r.errors, r.warnings) for r in quality.validate(df).collect()}
    assert got[1] == (True, [], []) and got[5] == (True, [], ["many_tokens"])
    assert got[2] == (False, ["short_text"], ["few_tokens"]) and got[3][1] == ["missing:chunk_index", "no_tokens"]
    assert got[4][1] == ["missing:tokens", "tokens_not_integer"] and got[6][1] == ["short_text", "garbled"]


def test_statistics(spark):
    values = spark.createDataFrame([(i, "g", v) for i, v in enumerate([1, 2, 3, 10, None])], "i bigint, g string, v int")
    assert tuple(quality.number_stats(values, "v").first()) == (1, 10, 4.0, 2.5)
    empty = spark.createDataFrame([], values.schema)
    assert tuple(quality.number_stats(empty, "v").first()) == (0, 0, 0.0, 0.0)
    assert quality.histogram(empty, "v").count() == 0 and quality.duration_stats(empty, "g", "i", "v").count() == 0
    eleven = spark.createDataFrame([(i, "g", i) for i in range(1, 12)], "i bigint, g string, v int")
    r = quality.duration_stats(eleven, "g", "i", "v").first()
    assert (r.n, r.p95, r.median, r.max) == (11, 10, 6.0, 11)
    assert [h.n for h in quality.histogram(eleven, "v", 5).orderBy("bin").collect()] == [2, 2, 2, 2, 3]
    assert {r.field: r.percent for r in quality.coverage(values, {"v": F.col("v").isNotNull()}).collect()} == {"v": 80.0}
    assert {r.percent for r in quality.coverage(empty, {"v": F.col("v").isNotNull()}).collect()} == {0.0}


def test_ranks_of_a_hot_group(spark, clash):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.5 else f"g{rng.randrange(9)}", rng.randrange(50), i) for i in range(5000)]
    df = clash(spark.createDataFrame(rows, "g string, v int, i bigint").repartition(7)).drop("rank")
    got = {r.i: r["rank"] for r in ranking.ranked(df.select("g", "v", "i"), "g", "v", "i").collect()}
    by = {}
    for g, v, i in sorted(rows, key=lambda x: (x[0], x[1], x[2])):
        assert got[i] == by.setdefault(g, 0)
        by[g] += 1
    assert ranking.ranked(spark.createDataFrame([], "g string, v int"), "g", "v").count() == 0


DOCS = [(0, "red car fast car"), (1, "blue car slow"), (2, "green bike fast fast"), (3, None), (4, "")]


def test_bm25_by_hand(spark):
    docs = spark.createDataFrame(DOCS[:3], "doc_id bigint, text string")
    q = spark.createDataFrame([(7, "fast car car"), (8, ""), (9, None), (10, "unknown")], "question_id bigint, question string")
    got = {r.doc_id: (r.score, r["rank"]) for r in sparse.bm25(q, docs).collect()}
    assert got == {0: (2.242034, 1), 1: (1.306931, 2), 2: (0.832808, 3)}
    assert sparse.bm25(q, spark.createDataFrame([], docs.schema)).count() == 0
    assert sparse.postings(spark.createDataFrame(DOCS, docs.schema)).select("doc_id").distinct().count() == 3


def shuffled(spark):
    """Rows that were shuffled so far."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_bm25_scores_documents_whole(spark, monkeypatch):
    """Against every pair's score, with ties, copies of rows and parts of few postings; the pairs aren't shuffled."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(40)]
    shares = 1 / np.arange(1, 41)
    texts = {i: " ".join(rng.choice(words, rng.integers(0, 12), p=shares / shares.sum())) for i in range(400)}
    asked = {i: " ".join(rng.choice(words, rng.integers(1, 5))) for i in range(60)}
    monkeypatch.setattr(sparse, "POSTINGS", 300)
    monkeypatch.setattr(sparse, "BLOCK", 25)
    docs = spark.createDataFrame([*texts.items(), *list(texts.items())[:20]], "doc_id bigint, text string").repartition(7)
    before = shuffled(spark)
    got = sparse.bm25(spark.createDataFrame([*asked.items()], "question_id bigint, question string"), docs, 5).collect()
    moved = shuffled(spark) - before
    tf = {i: Counter(t.split()) for i, t in texts.items()}
    df, avgdl = Counter(w for c in tf.values() for w in c), sum(c.total() for c in tf.values()) / len(tf)
    weight = {w: (len(tf) - n + 0.5) / (n + 0.5) for w, n in df.items()}
    by = {}
    for r in got:
        by.setdefault(r.question_id, []).append((r["rank"], r.doc_id, r.score))
    pairs = 0
    for q, text in asked.items():
        score = {i: sum(n * weight[w] * c[w] * 2.5 / (c[w] + 1.5 * (0.25 + 0.75 * c.total() / avgdl)) for w, n in Counter(text.split()).items() if c[w]) for i, c in tf.items()}
        pairs += sum(s > 0 for s in score.values())
        want = sorted((-round(s, 6), i) for i, s in score.items() if s > 0)[:5]
        assert [(i, s) for _, i, s in sorted(by.get(q, []))] == [(i, pytest.approx(-s, abs=2e-6)) for s, i in want]
    assert moved < pairs / 2


def test_hash_embedding(spark):
    assert dense.hash_embed(["ab车"], 8).tolist() == [[0, 0, 0, 0, 0, 0, 1, 0]]
    v = dense.hash_embed(["车", None, ""], 768)
    assert v[0][137] == -1 and not v[1].any() and not v[2].any()


def test_nearest_is_exact_with_ties_and_odd_vectors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    table = rng.normal(size=(300, 8)).round(2)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(table)] + [(900, None), (901, []), (902, [1.0]), (903, [None] * 8), (904, [float(x) for x in table[3]])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    monkeypatch.setattr(dense, "BLOCK", 3)
    q = df.where("vec_id % 50 = 0 AND vec_id < 300").select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("vector"))
    got = dense.nearest(q, df, 4).collect()
    every = {i: v for i, v in rows if v and len(v) == 8 and None not in v}
    for i in range(0, 300, 50):
        want = sorted(((-round(float(np.dot(every[i], v)), 6), j) for j, v in every.items()))[:4]
        assert [(r.doc_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.question_id == i] == [(j, -s) for s, j in want]
    assert dense.nearest(q.limit(0), df).count() == 0


def test_nearest_embeds_rows_once_for_sparse_questions(spark, monkeypatch):
    """Blocks of sparse vectors go together in one pass; the result is exact, ties and earlier ids too."""
    monkeypatch.setattr(dense, "BLOCK", 3)
    made = spark.sparkContext.accumulator(0)

    def embed(texts):
        made.add(len(texts))
        return dense.hash_embed(texts)

    rng = random.Random(3)
    texts = {i: "".join(rng.choice("甲乙丙丁戊己庚辛壬癸") for _ in range(rng.randrange(0, 9))) for i in range(200)}
    rows = spark.createDataFrame([*texts.items()], "doc_id bigint, text string").repartition(3)
    v = dict(zip(texts, dense.hash_embed([*texts.values()])))
    q = spark.createDataFrame([(i, v[i].tolist()) for i in range(0, 200, 20)], "question_id bigint, vector array<double>")
    got = dense.nearest(q, rows, 4, "doc_id", text="text", embed=embed).collect()
    for i in range(0, 200, 20):
        want = sorted((-round(float(v[i] @ x), 6) + 0.0, j) for j, x in v.items())[:4]
        assert [(r.doc_id, r.score) for r in sorted(got, key=lambda r: r["rank"]) if r.question_id == i] == [(j, -s) for s, j in want]
    assert made.value == len(texts)


def test_fusion_by_hand(spark):
    q = spark.createDataFrame([(1, "zz")], "question_id bigint, question string")
    docs = spark.createDataFrame([(i, "text") for i in range(3)], "doc_id bigint, text string")
    side = "question_id bigint, doc_id bigint, score double, rank int"
    sp = spark.createDataFrame([(1, 0, 2.2420343559, 1), (1, 1, 1.3069306931, 2)], side)
    normal = hybrid.fuse(q, docs, spark.createDataFrame([(1, 0, 0.9, 1), (1, 1, 0.8, 2)], side), sp).collect()
    assert {r.doc_id: r.score for r in normal} == {0: 0.418033, 1: 0.017742}
    missing = hybrid.fuse(q, docs, spark.createDataFrame([(1, 0, 0.9, 1), (1, 2, 0.8, 2)], side), sp).collect()
    assert {r.doc_id: round(r.score, 4) for r in missing} == {0: 0.418, 1: -1.9911, 2: -0.2008}


def test_context_stops_at_the_first_overflow(spark):
    hits = spark.createDataFrame([(1, i, 1.0, i + 1) for i in range(3)], "question_id bigint, doc_id bigint, score double, rank int")
    docs = spark.createDataFrame([(0, "aaaa"), (1, "bbbbbb"), (2, "c")], "doc_id bigint, text string")
    assert hybrid.context(hits, docs, 9).first().context == "aaaa"


def test_windows_and_sections(spark):
    df = spark.createDataFrame([(1, "abcdefghij"), (2, ""), (3, None), (4, "   ")], "i bigint, t string")
    assert [r.piece for r in chunking.char_windows(df, "i", "t", 6, 2).orderBy("start").collect()] == ["abcdef", "efghij", "ij"]
    df = spark.createDataFrame([(1, "intro\n# A\nx\n\n## B\n"), (2, "# only"), (3, "plain"), (4, None), (5, "\n\n")], "i bigint, t string")
    got = [(r.i, r.section_no, r.heading, r.body) for r in chunking.sections(df, "i", "t").orderBy("i", "section_no").collect()]
    assert got == [(1, 0, "", "intro"), (1, 1, "# A", "x"), (1, 2, "## B", ""), (2, 0, "# only", ""), (3, 0, "", "plain")]


def test_packed_chunks(spark):
    assert chunking.pack("# H\n\none two。 three four。 five", 24, 0) == ["# H\none two。", "# H\nthree four。\n\nfive"]
    assert chunking.pack("# H") == ["# H"] and chunking.pack(None) == [] and chunking.pack("  ") == []
    assert chunking.pack("- a\n- b。 c", 100) == ["- a\n- b。 c"]
    assert chunking.pack("x" * 50, 20, 5) == ["x" * 20, "x" * 20, "x" * 20, "x" * 5]
    df = spark.createDataFrame([(1, "甲。 乙。\n\n# 丙\n丁"), (2, None)], "i bigint, t string")
    rows = chunking.chunk_texts(df, "i", "t").orderBy("chunk_index").collect()
    assert [(r.i, r.chunk_index, r.total_chunks) for r in rows] == [(1, 0, 2), (1, 1, 2)]


def test_evaluation_scores(spark):
    assert evaluation.similarity("red car fast car", "fast car") == pytest.approx(0.8660254037844387)
    assert evaluation.similarity("", "x") == 0.0
    assert evaluation.faithfulness("red car fast。 nothing alike here", ["red car fast"]) == 0.5
    assert evaluation.context_precision("red car", None, None, ["green bike", "red car"], []) == 0.5
    assert evaluation.context_recall(None, ["red car"], ["red car", "green bike"]) == 0.5
    df = spark.createDataFrame([(1, "q", "a", None, ["c", None], None), (2, None, None, None, None, None)], "i bigint, question string, answer string, reference string, contexts array<string>, reference_contexts array<string>")
    assert evaluation.answer_scores(df, "i").count() == 2


def test_retrieval_and_citation_scores(spark):
    hits = spark.createDataFrame([(1, 1, "x"), (1, 2, "a"), (1, 3, "a"), (2, 1, "z")], "question_id bigint, rank int, label string")
    pos = spark.createDataFrame([(1, "a"), (1, "b"), (2, "y"), (3, None)], "question_id bigint, label string")
    q = spark.createDataFrame([(1,), (2,), (3,)], "question_id bigint")
    got = {r.question_id: (r.hit, r.recall, r.reciprocal_rank) for r in evaluation.retrieval_scores(hits, pos, q).collect()}
    assert got == {1: (1, 0.5, 0.5), 2: (0, 0.0, 0.0), 3: (0, 0.0, 0.0)}
    a = spark.createDataFrame([(1, "see [1] and [2], [2]"), (2, "none"), (3, None)], "question_id bigint, answer string")
    got = {r.question_id: (r.cited, r.right, r.precision) for r in evaluation.citation_scores(a, hits, pos).collect()}
    assert got == {1: (2, 1, 0.5), 2: (0, 0, 0.0), 3: (0, 0, 0.0)}
    assert spark.createDataFrame([(1.0,), (math.nan,), (None,)], "v double").select(evaluation.mean(F.col("v")).alias("m")).first().m == 1.0


def test_gate_and_drift(spark):
    m = spark.createDataFrame([("f", 0.9), ("r", 0.2)], "metric string, value double")
    least = spark.createDataFrame([("f", 0.7), ("r", 0.65), ("p", 0.6)], "metric string, least double")
    assert {r.metric: r.passed for r in evaluation.gate(m, least).collect()} == {"f": True, "r": False, "p": False}
    before = spark.createDataFrame([("success", 0.95), ("records", 800.0), ("same", 1.0)], "metric string, value double")
    now = spark.createDataFrame([("success", 0.6), ("records", 500.0), ("same", 0.95)], "metric string, value double")
    limits = spark.createDataFrame([("success", 0.1, False), ("records", 0.15, True), ("same", 0.1, False)], "metric string, most double, relative boolean")
    assert {r.metric for r in evaluation.drift(before, now, limits).collect()} == {"success", "records"}


def test_groups(spark):
    rows = [(1, "a", 0.9, "t1"), (2, "a", 0.9, None), (3, "a", None, "t3"), (4, "b", 0.5, "x")]
    df = spark.createDataFrame(rows, "i bigint, g string, s double, t string")
    order = (F.desc_nulls_last("s"), F.col("i"))
    assert [(r.i, r.place) for r in groups.best(df, "g", 2, *order).orderBy("i").collect()] == [(1, 1), (2, 2), (4, 1)]
    p = groups.profile(df, "g", "i", ["s"], "t", order).collect()
    assert [(r.g, r.n, r.avg_s, r.best_id, r.merged) for r in p] == [("a", 3, 0.9, 1, "t1\n\n\n\nt3")]
    assert [r.c for r in groups.round_robin(df, "i", ["x", "y"], "c").orderBy("i").collect()] == ["x", "y", "x", "y"]


def test_dialog(spark):
    say = lambda t, f: one(spark, t, f)
    assert say("推荐一款家用车", dialog.route) == "recommend" and say("那和银河L7比呢", dialog.route) == "compare" and say("", dialog.route) == "clarify" and say(None, dialog.route) == "clarify"
    assert say("它的价格怎么样", lambda c: dialog.route(c, True)) == "follow_up" and say("它的价格怎么样", dialog.route) == "fact_qa"
    assert say("那和银河L7比呢", dialog.compare_target) == "银河L7"
    p = say("推荐20万内的插混SUV，重点看空间和油耗", dialog.preferences)
    assert (p.budget_max, p.energy_type, p.car_type, p.focus_points) == (20.0, "插混", "SUV", ["空间", "油耗"])
    p = say("30到20万", dialog.preferences)
    assert (p.budget_min, p.budget_max) == (20.0, 30.0)
    assert say("推荐一款", lambda c: dialog.missing_slots(dialog.preferences(c))) == ["预算", "能源类型", "车型类别"]
    assert say("它的价格怎么样", lambda c: dialog.rewrite(c, F.lit("宋PLUS DM-i"))).startswith("宋PLUS DM-i")
    assert say("那和银河L7比呢", lambda c: dialog.rewrite(c, F.lit("宋PLUS DM-i"))) == "宋PLUS DM-i 和 银河L7 对比"
    turns = [("s", 1, "推荐20万内的插混SUV"), ("s", 2, "重点看空间"), ("s", 3, None), ("s", 4, "预算10到15万，看空间和油耗"), ("t", 1, "纯电"), (None, 1, "x")]
    got = {(r.session_id, r.turn): r for r in dialog.fold_preferences(spark.createDataFrame(turns, "session_id string, turn int, content string")).collect()}
    assert len(got) == 5 and (got["s", 3].budget_max, got["s", 3].focus_points) == (20.0, ["空间"])
    assert (got["s", 4].budget_min, got["s", 4].energy_type, got["s", 4].focus_points) == (10.0, "插混", ["空间", "油耗"]) and got["t", 1].budget_max is None


RAW = {"props": {"pageProps": {
    "seriesId": 900001, "seriesName": "甲车", "seriesHomeHead": {"brand_name": "甲", "cover_url": "//x/c.jpg", "official_price": "10-12万", "car_id_list": ["1"]}, "scoreSimpleInfo": {"score": 4.2, "total_review_count": 3},
    "carModelsData": {"tab_list": [{"data": [{"info": {"car_id": 1, "name": "m", "tags": ["t"], "price": "11万", "car_config": {"base_config": ["b"]}}}, {"info": {"car_id": None}}, {}]}]},
    "overviewData": {"space": [{"length": 1, "width": 2, "height": 3, "wheelbase": 4, "car_id_list": ["1", "2"]}, {"length": 1, "width": 2, "height": 3, "wheelbase": 4, "car_id_list": ["1", "2"]}]},
    "selectedImageModules": {k: {"category_name": n, "selected_images": [{"rank": r, "car_id": 1, "car_name": "m", "image_url": f"https://x/{k}{r}.jpg", "available_color_names": ["白"]} for r in (1, 2)], "available_colors": [{"color_name": "白"}]} for k, n in (("wg", "外观"), ("ns", "内饰"))},
}}}


def test_clean_records_and_markdown(spark):
    r = records.clean_record(RAW)
    assert r["series"]["series_id"] == "900001" and r["series"]["city_name"] == "全国" and r["stats"] == {"model_count": 1, "dimension_group_count": 1, "image_group_count": 2, "news_count": 0}
    assert r["models"][0]["official_price"] == "11万" and r["models"][0]["base_config"] == ["b"]
    md = records.markdown(r)
    assert md.startswith("# 甲车 车型资料\n\n## 基础信息\n- 品牌: 甲\n- 子品牌: 未知") and "颜色数 None, 示例颜色 白" in md and "- 长宽高/轴距: 1/2/3/4 mm，覆盖车型数: 2" in md
    assert records.clean_record({})["series"]["series_name"] == records.UNKNOWN_SERIES and records.clean_record({"props": []})["models"] == []
    assert records.markdown({}).count("暂无") >= 8
    df = spark.createDataFrame([("1", json.dumps(RAW)), ("2", "{"), ("3", None)], "k string, j string")
    got = {r.k: r for r in records.clean_pages(df, "k", "j").collect()}
    assert got["1"].markdown == md and got["2"].record is None and got["2"].error and got["3"].error


def test_image_assets(spark):
    df = spark.createDataFrame([("1", json.dumps(RAW)), ("2", "broken"), ("3", None)], "k string, j string")
    rows = images.assets(df, "k", "j").collect()
    assert len(rows) == 5 and {r.category_name for r in rows} == {"封面", "外观", "内饰"} and {r.split for r in rows} <= {"train", "val", "test"}
    assert all(r.image_like and r.extension == ".jpg" for r in rows) and len({r.asset_id for r in rows}) == 5
    manifest = spark.createDataFrame([("https://x/wg1.jpg", "module_wg", 0, "/f/1.jpg"), ("https://x/wg1.jpg", "module_wg", 0, "/f/2.jpg")], "url string, section string, rank int, local_path string")
    assert sum(r.local_path == "/f/1.jpg" for r in images.with_manifest(images.assets(df, "k", "j"), manifest).collect()) == 1
    assert {r.modality for r in images.caption_records(images.assets(df, "k", "j")).collect()} == {"image_caption"}


def test_hash_embedding_equals_a_plain_sum():
    texts = ["车速 120 km", None, "", "车车车", "naïve ç"]
    for t, got in zip(texts, dense.hash_embed(texts, 64)):
        want = [0.0] * 64
        for ch in t or "":
            place, sign = dense._slot(ch, 64)
            want[place] += sign
        size = sum(x * x for x in want) ** 0.5 or 1.0
        assert [round(float(x), 9) for x in got] == [round(x / size, 9) for x in want]


def test_chunks_measured_in_tokens(spark):
    from sparkloom.functions import tokens

    rows = spark.createDataFrame([(1, "# 标题\n\n" + "底盘质感不错，方向盘手感偏硬。 " * 60 + "x" * 3000), (2, None), (3, "")], "i int, t string")
    got = chunking.chunk_texts(rows, "i", "t", limit=100, measure=tokens.count, windows=tokens.windows).collect()
    assert len(got) > 5 and {r.i for r in got} == {1} and all(r.size == tokens.count(r.chunk) for r in got) and max(r.size for r in got) <= 110
    assert all(r.chunk.startswith("# 标题") for r in got)


def test_preferences_of_a_session_over_many_partitions(spark):
    turns = [("s", i, {0: "预算20万内，纯电", 7: "看空间，比亚迪", 400: "看油耗和动力", 800: "10到15万", 900: "丰田，SUV"}.get(i, "嗯")) for i in range(1000)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = dialog.fold_preferences(spark.createDataFrame(turns, "session_id string, turn int, content string"))
        got = {r.turn: r for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(got) == 1000 and got[500].focus_points == ["空间", "油耗", "动力"] and got[500].budget_text == "20万内" and got[850].budget_text == "10-15万"
    assert got[999].brands == ["比亚迪", "丰田"] and got[999].car_type == "SUV" and got[999].energy_type == "纯电" and got[3].focus_points == []


def test_modules_look_up_cars_and_colors():
    page = {"props": {"pageProps": {"query": {"seriesId": 7}, "pictureInfo": {"picture_list": [{"pic_url": ["//x/1.jpg", ""], "car_id": 5}, {"pic_url": [], "car_id": 5}, {"pic_url": ["https://x/2.jpg"], "car_id": 6, "car_name": "own"}, "odd"]}, "head": {"category_list": [
        {"key": "wg", "filter": {"color": [{"key": 1, "color_name": "白", "color": "#fff"}, {"key": "2", "color_name": "黑"}, {"key": 3, "color_name": ""}], "car": [{"car_list": [{"car_id": 5, "car_text": "五", "color_keys": [2, "1", 2, 9]}]}]}}, {"key": "ns", "filter": {"color": [{"key": 1, "color_name": "红"}]}}]}}}}
    m = images.selected_module("wg", page, "https://s")
    assert [(i["rank"], i["car_name"], i["image_url"], i["available_color_names"]) for i in m["selected_images"]] == [(0, "五", "https://x/1.jpg", ["黑", "白"]), (2, "own", "https://x/2.jpg", [])]
    assert m["sample_count"] == 2 and [c["color_name"] for c in m["available_colors"]] == ["白", "黑", ""] and m["source_url"].startswith("https://s/auto/series/7/")
    floor = images.compact_floor({"wg": m})["floor_image_list"]
    assert [(f["category"], f["pic_count"]) for f in floor] == [("wg", 2), ("ns", 0)] and floor[0]["image_list"][0]["color_name"] == "黑,白"
    assert images.selected_module("ns", None, "https://s")["selected_images"] == [] and images.page_assets([]) == []


def test_contextual_images_come_only_if_asked_for():
    page = {"props": {"pageProps": {"seriesId": 1, "sameBrandData": {"list": [{"cover_uri": "//x/a.jpg"}]}, "newestStaticNews": [{"video_info": {"cover_url": "//x/v.jpg", "width": "9"}, "image_urls": [{"url": "//x/n.jpg"}]}]}}}
    assert images.page_assets(page) == []
    assert [(a["section"], a["rank"], a["category_name"], a["width"]) for a in images.page_assets(page, True)] == [("related_series_cover", 0, "同品牌推荐", 0), ("news_cover", 0, "newest新闻封面", 9), ("news_image", 0, "newest新闻配图", 0)]
