"""Units and shredding."""

import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from sparkloom.operators import shredding as S
from sparkloom.operators import units as U


def test_amounts_as_written():
    cases = {
        "10.76 - 14.68万": (107600, 146800), "约13.49万（含税）": (134900, 134900), "5座版 20.52—26.21万": (205200, 262100), "CNY 63,200": (63200, 63200), "¥59.7k至63.2K": (59700, 63200), "15万1700元—21万7800元": (151700, 217800),
        "１２．９５至２０．３９万": (129500, 203900), "163600元-22.19万": (163600, 221900), "(万元) 8.91-13.98": (89100, 139800), "单位万 21.30": (213000, 213000), "301.1K至295.2k": (295200, 301100), "10.49W-6.94W": (69400, 104900),
        "二十五万三千二百元 至 二十九万三千五百元": (253200, 293500), "三十万零五百元": (300500, 300500), "人民币十一万六千六百元": (116600, 116600), "2026款 25.75万": (257500, 257500), "60.0千元": (60000, 60000), "181200~241000rmb": (181200, 241000),
        "待定": None, "-": None, "": None, None: None, "5座版": None, "128.6-202.1": (128600, 202100), "24.16-27.99": (241600, 279900),
    }
    for text, want in cases.items():
        got = U.price_row([text], None)[0]
        assert (got and got[:2]) == want, text


def test_notes_and_identities_decide_between_units():
    assert U.noted_unit("prices in thousand CNY") == 1000 and U.noted_unit("单位：元") == 1 and U.noted_unit("报价按万计") == 10_000 and U.noted_unit("最终以门店为准") is None
    wide = (1.0, 1e9)
    assert U.price_row(["120", "118000"], "单位：元", wide)[0][:2] == (120_000, 120_000)
    assert U.price_row(["120", None], None, wide)[0][2] is False
    assert U.price_row(["50", "50.1万"], None)[0] is not None


def test_choose_units_by_a_physical_identity():
    # mass (kg) = density (kg/m3) * volume (m3): a mass in grams and a volume in litres
    identity = {0: 1.0, 1: -1.0, 2: -1.0}
    got = U.choose_units([2500.0, 1000.0, 2.5], [[1.0, 1e-3], [1.0], [1.0, 1e-3]], [identity])
    assert got.factors in {(1.0, 1.0, 1.0), (1e-3, 1.0, 1e-3)} and not got.unique
    got = U.choose_units([2500.0, 1000.0, 2.5], [[1e-3, 1.0], [1.0], [1e-3]], [identity])
    assert got.factors == (1e-3, 1.0, 1e-3) and got.unique
    assert U.choose_units([5.0], [[1.0]], [], [(10.0, 20.0)]) is None


@given(st.integers(10_001, 99_999_999))
def test_numbers_in_characters(n):
    digits, small = "零一二三四五六七八九", ["", "十", "百", "千"]

    def part(x):
        out, zero = "", False
        for i, c in enumerate(str(x)):
            place = len(str(x)) - 1 - i
            if c == "0":
                zero = True
            else:
                out += ("零" if zero and out else "") + digits[int(c)] + small[place]
                zero = False
        return out

    high, low = divmod(n, 10_000)
    word = part(high) + "万" + (("零" if low and low < 1000 else "") + part(low) if low else "")
    assert U.written_number(word) == n


def test_prices_over_tables(spark, clash):
    rows = [(1, "10万", None, None), (1, "10万", None, None), (2, None, None, "万"), (3, "x" * 100_000, "9.9万 - 8.8万", None), (None, "12.5", "125000", "单位万"), (4, "9元", "", "")]
    df = clash(spark.createDataFrame(rows, "clean_id bigint, official_price string, dealer_price_range string, price_note string"))
    got = {(r.clean_id, r.field_name, r.low_yuan, r.high_yuan) for r in U.prices_in_yuan(df, "clean_id", ["official_price", "dealer_price_range"], "price_note").collect()}
    assert got == {(1, "official_price", 100000, 100000), (3, "dealer_price_range", 88000, 99000), (None, "official_price", 125000, 125000), (None, "dealer_price_range", 125000, 125000), (4, "official_price", 90000, 90000)}
    assert U.prices_in_yuan(spark.createDataFrame([], df.schema), "clean_id", ["official_price"], "price_note").count() == 0


SPEC = {"a": str, "list": [{"b": str, "tags": [str], "deep": [{"c": str, "d": [str]}]}], "one": {"e": str}}
LEAF = st.one_of(st.none(), st.text(max_size=3))
RECORD = st.fixed_dictionaries({}, optional={
    "a": LEAF, "one": st.one_of(st.none(), st.fixed_dictionaries({"e": LEAF})),
    "list": st.one_of(st.none(), st.lists(st.fixed_dictionaries({}, optional={"b": LEAF, "tags": st.lists(LEAF, max_size=3), "deep": st.lists(st.fixed_dictionaries({"c": LEAF, "d": st.lists(LEAF, max_size=2)}), max_size=2)}), max_size=3)),
})


@settings(max_examples=300, deadline=None)
@given(RECORD)
def test_tables_from_levels_equal_a_plain_walk(record):
    columns = S.shred(SPEC, record)
    items = record.get("list") or []
    assert [(at, r.get(("b",))) for at, r in S.reconstruct(SPEC, columns, ("list",))] == [((i,), x.get("b")) for i, x in enumerate(items)]
    assert [(at, r.get(())) for at, r in S.reconstruct(SPEC, columns, ("list", "tags"))] == [((i, k), t) for i, x in enumerate(items) for k, t in enumerate(x.get("tags") or [])]
    assert [(at, r.get(("c",))) for at, r in S.reconstruct(SPEC, columns, ("list", "deep"))] == [((i, k), t["c"]) for i, x in enumerate(items) for k, t in enumerate(x.get("deep") or [])]
    want = [((i, k, m), v) for i, x in enumerate(items) for k, t in enumerate(x.get("deep") or []) for m, v in enumerate(t["d"])]
    assert [(at, r.get(())) for at, r in S.reconstruct(SPEC, columns, ("list", "deep", "d"))] == want


MODEL = {"car_id": 7, "name": "x", "tags": "家用", "base_config": ["a", "b"], "year": "2025款", "follower_rate": "3%"}


def test_shapes_of_models_are_one(spark, clash):
    raw = {**{k: v for k, v in MODEL.items() if k != "base_config"}, "car_config": {"base_config": ["a", "b"]}, "follower_rate": {"text": "3%"}}
    shapes = [[MODEL], MODEL, {"k0": MODEL}, {"tab_list": [{"data": None}, {"data": [{"info": raw}, {"ad": 1}, {"info": None}]}]}, json.dumps([MODEL])]
    dims = [[{"length_mm": 1}, {"length_mm": "2"}], {"length_mm": 1}, {"space": [{"length": 1, "car_id_list": ["1", "2"]}]}, {"space": None}, []]
    rows = [(i, json.dumps(m), json.dumps(d), None, "{}") for i, (m, d) in enumerate(zip(shapes, dims))]
    rows += [(9, '[{"car_id": 1', "null", "", "x"), (10, None, None, None, None), (11, json.dumps([{**MODEL, "car_id": ""}, {**MODEL, "car_id": None}]), '"x"', "[]", "1"), rows[0]]
    df = clash(spark.createDataFrame(rows, "clean_id bigint, models string, dimensions string, pricing string, scores string"))
    got = {tuple(r) for r in S.series_tables(df, ["model", "tag", "base_config", "dimension"]).select("clean_id", "child", "car_id", "item_no").collect()}
    want = {(i, c, "7", k) for i in range(5) for c, k in (("model", 0), ("tag", 0), ("base_config", 0), ("base_config", 1))}
    want |= {(0, "dimension", "", 0), (0, "dimension", "", 1), (1, "dimension", "", 0), (2, "dimension", "", 0)}
    assert got == want
    models = S.child_table(df, "model").collect()
    assert len(models) == 5 and {(m.name, m.year, m.follower_rate) for m in models} == {("x", 2025, "3%")}
    assert {r.car_count for r in S.child_table(df, "dimension").where("clean_id = 2").collect()} == {2}
    for child in S.TABLES:
        assert S.child_table(spark.createDataFrame([], df.schema), child).count() == 0


def test_deep_and_large_json():
    assert S.parse("[" * 100_000) is None
    big = json.dumps([{"car_id": str(i), "tags": [str(k) for k in range(20)]} for i in range(2000)])
    assert sum(1 for _ in S.series_rows({"models": big}, ["tag"])) == 40_000
    random.seed(0)


def test_identities_decide_where_the_unit_is_open():
    """13.4 may be thousands or ten thousands; the other price tells. Alone only the bounds do, and the row is flagged."""
    assert U.price_row(["13.4", "12.9万"], None)[0] == (134_000, 134_000, True)
    assert U.price_row(["13.4", None], None)[0] == (134_000, 134_000, False)
    wide = (1_000.0, 10_000_000.0)
    assert U.price_row(["240", "251千"], None, wide)[0] == (240_000, 240_000, True)
    assert U.price_row(["240", None, "255万"], None, wide)[0][0] == 2_400_000
    assert U.price_row(["9元", None], None)[0] == (90_000, 90_000, False)  # the bounds overrule what is stated
