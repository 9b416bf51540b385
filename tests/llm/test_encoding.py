import pytest

from sparkloom.llm import encoding as E

def misread(text, codec):
    """UTF-8 read in a single-byte codec, undefined bytes as control characters."""
    return "".join(bytes([b]).decode(codec, "ignore") or chr(b) for b in text.encode("utf-8"))


CLEAN = ["鲲砾V70越野版", "说到中控屏的响应，系统升级以后表现明显好于平均水准。", "Øresta K52 – a naïve reading, “close enough” for the café’s crew, 26 °C"]


@pytest.mark.parametrize("written,read", [("utf-8", "latin-1"), ("utf-8", "mac_roman"), ("utf-8", "cp1251"), ("utf-8", "gb18030"), ("utf-8", "cp932"), ("gb18030", "latin-1"), ("gb18030", "utf-8")])
@pytest.mark.parametrize("text", CLEAN)
def test_wrong_encodings_are_found_and_restored(text, written, read):
    bad = text.encode(written).decode(read, "replace")
    found, back = E.restore(bad)
    assert found
    if E.LOST not in bad and E.LOST not in back and read not in ("gb18030", "cp932"):
        assert back == text


def test_twice_wrong():
    bad = CLEAN[1]
    for _ in range(2):
        bad = misread(bad, "cp1252")
    assert E.restore(bad) == (True, CLEAN[1])


@pytest.mark.parametrize("text", [
    *CLEAN, None, "", "   ", "plain ASCII", "Ção Águia Âmbar, edição 7530: câmbio automático, direção leve", "Überarbeitete Federung, größere Türen; façade très élégante, garçon ravi, ça roule",
    "подвеска мягкая, салон тихий, запас хода 500 км, шум 60 дБ", "後席も広い。試乗会では静かさが話題になった。テスト番号4221", "Señor piloto probó el año; Ångström, æther, ðe þorn. £7122 ± 815 µm © ® °C §4 ¤.",
    "龘黻纛齉爨靐", "Façonne G60", "Ñandeo N69", "Škorva T16", "全角１２３ＡＢＣ",
])
def test_foreign_words_signs_and_rare_characters_stay(text):
    assert E.restore(text) == (False, text)


def test_places_within_a_text():
    bad = CLEAN[1] + misread(CLEAN[1], "mac_roman") + "原文。"
    assert E.restore(bad) == (True, CLEAN[1] * 2 + "原文。")


def test_tables(spark, clash):
    names = [(i, f"s{i % 5}", n) for i, n in enumerate(["鲲砾V70", "鲲砾V70".encode().decode("cp1251"), "岚湾H11", "岚湾H11".encode().decode("cp1251"), None, "", "汀野K20", "汀野K20".encode().decode("cp1251")])]
    names = [(i, "s1" if i < 2 else "s2" if i < 4 else "s3", n) for i, _, n in names]
    series = clash(spark.createDataFrame(names + [names[1]], "clean_id bigint, series_id string, series_name string"))
    assert E.learn(series) == [("utf-8", "cp1251")]
    chunks = [(1, CLEAN[1]), (2, misread(CLEAN[1], "cp1251")), (2, misread(CLEAN[1], "cp1251")), (3, None), (4, "坏�字"), (5, "长文" * 100_000), (None, "è½¦æ¼†è´¨æ„Ÿ")]
    out = E.garbled_records(clash(spark.createDataFrame(chunks, "record_id bigint, text string")), series).distinct().collect()
    assert {(r.src_table, r.row_id) for r in out} == {("chunks", 2), ("chunks", 4), ("chunks", None), ("dcd_cleaner", 1), ("dcd_cleaner", 3), ("dcd_cleaner", 7)}
    by = {(r.src_table, r.row_id): r for r in out}
    assert by["chunks", 2].restored == CLEAN[1] and by["chunks", 2].whole
    assert not by["chunks", 4].whole
    assert by["chunks", None].restored == by["chunks", None].garbled  # found, but no twin taught that mapping


def test_empty(spark):
    chunks, series = spark.createDataFrame([], "record_id bigint, text string"), spark.createDataFrame([], "clean_id bigint, series_id string, series_name string")
    assert E.garbled_records(chunks, series).count() == 0
