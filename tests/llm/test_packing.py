import random

from hypothesis import given, settings
from hypothesis import strategies as st

from sparkloom.llm import packing as P

SCHEMA = "record_id bigint, text string"


def check(text, limit=50, overlap=5):
    got = P.pieces(text, limit, overlap)
    assert "".join(text[c:e] for _, c, e, _ in got) == text  # without overlaps the text again
    for i, (s, c, e, n) in enumerate(got):
        assert P.size(text[s:e]) == n
        assert n <= limit or len(got) == 1
        if i:
            assert P.size(text[s:c]) == min(overlap, P.size(text[got[i - 1][1] : got[i - 1][2]]))
    assert (len(got) == 1) == (P.size(text) <= limit)
    return got


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="车漆a1 ab\n#-，。.!；", max_size=600))
def test_any_text_is_cut_into_pieces_within_the_limit(text):
    check(text)


def test_cuts_lie_at_headings_then_paragraphs_then_items_then_sentences():
    body = lambda n: "字" * n
    text = f"# 一\n{body(30)}\n# 二\n{body(45)}\n"
    assert [text[c:e][:3] for _, c, e, _ in P.pieces(text, 60, 0)] == ["# 一", "# 二"]
    text = f"{body(30)}\n\n{body(30)}\n\n{body(15)}"
    assert [e for _, _, e, _ in P.pieces(text, 50, 0)] == [32, len(text)]
    text = "".join(f"- {body(20)}\n" for _ in range(5))
    assert all(text[c] == "-" for _, c, _, _ in P.pieces(text, 50, 0))
    text = "".join(f"{body(20)}。" for _ in range(5))
    assert all(text[e - 1] == "。" for _, _, e, _ in P.pieces(text, 50, 0))


def test_size_is_runs_and_characters():
    assert P.size("ab12 c，车漆 é") == 4
    assert P.size("x" * 100_000) == 1 and P.size(None) == 0


def test_split_over_tables(spark, clash):
    rng = random.Random(1)
    long = "".join(rng.choice(["车漆质感。", "nice ride. ", "\n\n", "## 标题\n"]) for _ in range(60_000))
    rows = [(1, long), (1, long), (2, None), (3, ""), (4, "短"), (5, "字" * 501), (6, "字" * 500), (None, "字" * 600)]
    out = P.split_oversized(clash(spark.createDataFrame(rows, SCHEMA))).distinct().collect()
    assert {r.record_id for r in out} == {1, 5, None}
    ones = sorted((r for r in out if r.record_id == 1), key=lambda r: r.chunk_index)
    assert [r.chunk_index for r in ones] == list(range(ones[0].total_chunks)) and all(r.tokens <= 500 for r in ones)
    assert P.split_oversized(spark.createDataFrame([], SCHEMA)).count() == 0
