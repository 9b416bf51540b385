"""Mappings outside READ_AS are learned from twins and find the remaining records."""

import pytest

from sparkloom.llm import encoding


@pytest.mark.parametrize("written, read", [("gb18030", "mac_roman"), ("utf-8", "cp437"), ("gb18030", "cp437")])
def test_a_reading_outside_the_list_is_learned(spark, written, read):
    garble = lambda t: t.encode(written).decode(read)
    clean = ["中央大王 X1", "大小山水 Y2", "人工公司 Z3"]
    names = [(i, f"s{i % 3}", t if i < 3 else garble(t)) for i, t in enumerate(clean * 2)]
    series = spark.createDataFrame(names, "clean_id bigint, series_id string, series_name string")
    chunks = spark.createDataFrame([(1, garble("上天大地") + " fine"), (2, "上天大地 fine"), (3, "café")], "record_id bigint, text string")
    got = {(r.src_table, r.row_id): r.restored for r in encoding.garbled_records(chunks, series).collect()}
    assert set(got) == {("dcd_cleaner", 3), ("dcd_cleaner", 4), ("dcd_cleaner", 5), ("chunks", 1)}
    assert got["chunks", 1] == "上天大地 fine"


def test_only_learned_mappings_find_unless_the_listed_ones_may(spark):
    clean, garble = ["鲲砾V70 123", "岚湾H11 456", "汀野K20 789"], lambda t: t.encode().decode("mac_roman")
    rows = spark.createDataFrame([(i, f"2026 {t} 试驾报告") for i, t in enumerate(clean)] + [(10 + i, f"2026 {garble(t)} {garble('试驾报告')}") for i, t in enumerate(clean[:2])] + [(20, garble("方向盘手感"))], "record_id bigint, text string")
    none = spark.createDataFrame([], "clean_id bigint, series_id string, series_name string")
    assert encoding.learn(none, rows) == [("utf-8", "mac_roman")]  # by twins among the texts
    got = {r.row_id: r.restored for r in encoding.garbled_records(rows, none, listed=False).collect()}
    assert got == {10: "2026 鲲砾V70 123 试驾报告", 11: "2026 岚湾H11 456 试驾报告", 20: "方向盘手感"}
    alone = rows.where("record_id = 20")
    assert encoding.garbled_records(alone, none, listed=False).count() == 0
    assert [r.row_id for r in encoding.garbled_records(alone, none).collect()] == [20]


def test_a_hot_skeleton_gives_as_many_twins_as_texts(spark):
    names = [(i, "s", chr(0x4E00 + i) + "型") for i in range(300)] + [(400, "s", "甲型".encode().decode("cp1251"))]
    rows = spark.createDataFrame(names, "clean_id bigint, series_id string, series_name string")
    assert encoding._twins(rows, ["series_id"], "series_name", 0).count() == 300
