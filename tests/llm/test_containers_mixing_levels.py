import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkloom.llm import containers, levels, mixing, tokens

DOC = "doc_id bigint, text string, source string"


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40), st.dictionaries(st.integers(1, 40), st.integers(1, 300), max_size=15))
def test_plan_places_every_item_once_within_capacity(capacity, histogram):
    histogram = {s: n for s, n in histogram.items() if s <= capacity}
    used, placed = Counter(), defaultdict(list)
    for size, rank, n, first in containers.plan(histogram, capacity):
        placed[size].append((rank, n))
        for i in range(n):
            used[first + i] += size
    assert all(v <= capacity for v in used.values()) and sorted(used) == list(range(len(used)))
    for size, n in histogram.items():
        ranks = [r for first, k in placed[size] for r in range(first, first + k)]
        assert sorted(ranks) == list(range(n))


def test_plan_is_best_fit_decreasing():
    rng = random.Random(1)
    for _ in range(100):
        sizes = [rng.randint(1, 30) for _ in range(rng.randint(1, 80))]
        spaces: list[int] = []
        for s in sorted(sizes, reverse=True):
            fits = [i for i, x in enumerate(spaces) if x >= s]
            if fits:
                spaces[min(fits, key=lambda i: spaces[i])] -= s
            else:
                spaces.append(30 - s)
        steps = containers.plan(dict(Counter(sizes)), 30)
        assert max(f + n for _, _, n, f in steps) <= len(spaces)


def test_fill_over_tables(spark, clash):
    rng = random.Random(2)
    rows = [(i, rng.choice([1, 7, 7, 7, 50, 99, 100])) for i in range(500)] + [(1000, 0), (1001, 250), (1002, 100), (1003, 101)]
    df = clash(spark.createDataFrame(rows, "doc_id bigint, tokens bigint"))
    got = containers.fill(df, "doc_id", 100).collect()
    used = Counter()
    for r in got:
        used[r.container_id] += r.tokens
    assert max(used.values()) <= 100 and sum(used.values()) == sum(n for _, n in rows)
    parts = defaultdict(list)
    for r in got:
        parts[r.doc_id].append((r.part, r.tokens))
    assert sorted(parts[1001]) == [(0, 100), (1, 100), (2, 50)] and 1000 not in parts
    assert all(len(p) == 1 for i, p in parts.items() if i < 1000)
    report = containers.fill_report(containers.fill(df, "doc_id", 100), 100).collect()
    assert len(report) == len(used) and all(r.used + r.unused == 100 for r in report)


def test_fill_documents_with_odd_texts(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "word " * 30_000, "a"), (4, "字", "b"), (5, "字", "b")]
    got = containers.fill_documents(spark.createDataFrame(rows, DOC)).collect()
    assert {r.doc_id for r in got} == {3, 4, 5} and sum(r.tokens for r in got if r.doc_id == 3) == tokens.count(rows[2][1])
    assert containers.fill_documents(spark.createDataFrame([], DOC)).count() == 0


@given(st.text(alphabet="ab 车\n\t.1", max_size=300))
@settings(max_examples=100, deadline=None)
def test_tokens_by_parts_equal_tokens_of_the_whole(text):
    old = tokens.PART
    try:
        tokens.PART = 20
        assert tokens.count(text) == len(tokens.encoding().encode_ordinary(text))
    finally:
        tokens.PART = old


TARGET = "source string, target_share double, max_repeats int"


@pytest.fixture
def sized():
    rng = random.Random(3)
    rows = [(i, rng.choice(["Big-One", "big_one", " BIG ONE "]), rng.randint(1, 40)) for i in range(3000)]
    rows += [(10_000 + i, "small", rng.randint(1, 40)) for i in range(100)] + [(20_000, "other", 5), (20_001, None, 5), (20_002, "small", 0)]
    return rows


def test_mix_reaches_its_shares(spark, sized, clash):
    targets = [("big_one", 0.7, 1), ("small", 0.2, 3), ("nothing", 0.1, 2), (None, 0.5, 1)]
    chosen, report = mixing.mix(clash(spark.createDataFrame(sized, "doc_id bigint, source string, tokens bigint")), clash(spark.createDataFrame(targets, TARGET)))
    size = {i: n for i, _, n in sized}
    reached, most = Counter(), Counter()
    for r in chosen.collect():
        reached[r.source] += size[r.doc_id] * r.repeats
        most[r.source] = max(most[r.source], r.repeats)
    rep = {r.source: r for r in report.collect()}
    assert set(rep) == {"big_one", "small", "nothing"} and rep["nothing"].reached == 0
    assert {s: rep[s].reached for s in reached} == dict(reached)
    small = sum(n for i, n in size.items() if 10_000 <= i < 20_000)
    assert reached["small"] == 3 * small and most == {"small": 3, "big_one": 1}
    assert abs(reached["big_one"] - 0.7 * 3 * small / 0.2) <= 40


def test_mix_of_a_given_total_is_nested(spark, sized):
    df = spark.createDataFrame(sized, "doc_id bigint, source string, tokens bigint")
    t = spark.createDataFrame([("big_one", 0.5, 1), ("small", 0.5, 2)], TARGET)
    picked = []
    for total in (2_000, 20_000, 10**9):
        rows = mixing.mix(df, t, total=total)[0].collect()
        picked.append({r.doc_id for r in rows if r.source == "big_one"})
        if total < 10**9:
            got = sum(r.tokens * r.repeats for r in rows if r.source == "big_one")
            assert abs(got - total / 2) <= 40
    assert picked[0] < picked[1] < picked[2] and len(picked[2]) == 3000


def test_mix_of_nothing(spark):
    none = spark.createDataFrame([], DOC)
    chosen, report = mixing.mix_documents(none, spark.createDataFrame([("a", 1.0, 1)], TARGET))
    assert chosen.count() == 0 and [r.reached for r in report.collect()] == [0]
    assert mixing.mix_documents(spark.createDataFrame([(1, "x y", "a")], DOC), spark.createDataFrame([], TARGET))[0].count() == 0


LABEL = "doc_id bigint, reading_level int, rater string"
WORDS = {1: "妈妈很好。小车红红的。", 2: "昨天朋友试了一下说空调凉快。", 3: "说到悬架滤震，长途自驾时表现明显好于平均水准。", 4: "标定冷却液流量后高压互锁回路饱和。", 5: "判据取簧下质量与轮端等效惯量之比，其正当性须厘清。"}


def test_levels_are_learned(spark, clash):
    docs, labels = [], []
    for i in range(300):
        level = i % 5 + 1
        docs.append((i, WORDS[level] * (1 + i % 4), "src"))
        if i < 100:
            labels.append((i, level if i % 10 else max(1, level - 1), "a"))
    docs += [(1000, None, "s"), (1001, "", "s"), (1002, WORDS[4] * 20_000, "s"), (5, WORDS[1], "s")]
    labels += [labels[0], (5, None, "b"), (6, 9, "b"), (4242, 3, "b"), (None, 2, "b")]
    out = levels.levels(clash(spark.createDataFrame(docs, DOC)), clash(spark.createDataFrame(labels, LABEL))).collect()
    assert len(out) == len(docs) and all(1 <= r.reading_level <= 5 for r in out)
    right = sum(r.reading_level == r.doc_id % 5 + 1 for r in out if 100 <= r.doc_id < 300)
    assert right >= 195
    assert [r.reading_level for r in out if r.doc_id == 1002] == [4]


def test_levels_without_labels_or_documents(spark):
    none = spark.createDataFrame([], LABEL)
    out = levels.levels(spark.createDataFrame([(1, "The cat sat.", "a"), (2, "Notwithstanding considerable methodological heterogeneity, interdisciplinary characterisation necessitates comprehensive reconsideration", "a")], DOC), none).collect()
    assert {r.doc_id: r.reading_level for r in out}[2] > {r.doc_id: r.reading_level for r in out}[1]
    assert levels.levels(spark.createDataFrame([], DOC), none).count() == 0
