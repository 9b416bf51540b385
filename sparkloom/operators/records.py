"""Clean records from raw pages, and their Markdown."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.operators import shredding as S

UNKNOWN_SERIES = "未知车系"
NEWS = ("newest", "guide", "newcar", "evaluating", "original")
MOST_NEWS, MOST_SAMPLES = 10, 5
MOST_MODELS_SHOWN, MOST_NEWS_SHOWN = 30, 20

#: Sections of the Markdown with their lines: label, part of the record, field, what stands for nothing. Fixed values.
LINES: list[tuple[str, list[tuple[str, str, str, str]]]] = [
    ("基础信息", [("品牌", "series", "brand_name", "未知"), ("子品牌", "series", "sub_brand_name", "未知"), ("车型类别", "series", "car_type", "未知"), ("城市基准", "series", "city_name", "全国")]),
    ("价格信息", [
        ("经销商报价区间", "pricing", "dealer_price_range", "暂无报价"), ("官方指导价区间", "pricing", "official_price_range", "暂无指导价"), ("最新车主成交价", "pricing", "latest_owner_price", "暂无"),
        ("最低车主成交价", "pricing", "lowest_owner_price", "暂无"), ("最低成交城市", "pricing", "lowest_owner_city_name", "暂无"), ("询价量级", "pricing", "query_price_count", "暂无"),
    ]),
    ("评分信息", [
        ("综合评分", "scores", "total_score", "0"), ("评价人数", "scores", "total_review_count", "0"), ("舒适性", "scores", "comfort_score", "0"), ("外观", "scores", "appearance_score", "0"), ("配置", "scores", "configuration_score", "0"),
        ("操控", "scores", "control_score", "0"), ("动力", "scores", "power_score", "0"), ("空间", "scores", "space_score", "0"), ("内饰", "scores", "interiors_score", "0"),
    ]),
]
MODEL_LINES = [("年款", "year", "未知"), ("官方价格", "official_price", "暂无"), ("经销商价格", "dealer_price", "暂无"), ("标签", "tags", "暂无"), ("基础配置", "base_config", "暂无"), ("亮点配置", "highlights_config", "暂无"), ("关注度", "follower_rate", "暂无"), ("图片数", "picture_count", "0")]


def _group(value: Any) -> dict:
    return value if isinstance(value, dict) else {}


def _rows(value: Any) -> list:
    return value if isinstance(value, list) else []


def clean_record(raw: Any, source: str = "web") -> dict[str, Any]:
    """The clean record of a raw page's JSON. Parts of a wrong kind count as missing; models lack neither id nor position;
    equal dimension groups are one, at their first place."""
    page = _group(_group(_group(raw).get("props")).get("pageProps"))
    head, price, score = (_group(page.get(k)) for k in ("seriesHomeHead", "carPriceCard", "scoreSimpleInfo"))
    models = [m for m in map(_model, S._models(_group(page.get("carModelsData")) or None)) if m.get("car_id")]
    groups = [d for d in S._dimensions({"space": _rows(_group(page.get("overviewData")).get("space"))}) if d]
    dimensions = list({json.dumps(d, sort_keys=True, ensure_ascii=False): d for d in reversed([{f: d.get(f) for f in S.DIMENSION_FIELDS} for d in groups])}.values())[::-1]
    modules = _group(page.get("selectedImageModules"))
    images = _images(page, modules)
    news = [] if modules else [n for kind in NEWS for n in _news(kind, page)]
    sid = page.get("seriesId") or head.get("series_id")
    return {
        "schema_version": "v1", "source": source, "entity_type": "car_series",
        "series": {
            "series_id": "" if sid is None else str(sid), "series_name": page.get("seriesName") or head.get("series_name") or UNKNOWN_SERIES, **{k: head.get(k) for k in ("brand_name", "sub_brand_name", "car_type")},
            "city_name": page.get("cityName", "全国"), "cover_url": head.get("cover_url") or price.get("cover_url"), "car_id_list": _rows(head.get("car_id_list")),
        },
        "pricing": {
            "dealer_price_range": head.get("dealer_price"), "official_price_range": head.get("official_price"),
            **{k: price.get(k) for k in ("latest_owner_price", "lowest_owner_price", "lowest_owner_city_name")}, "query_price_count": price.get("query_price_count_en"),
        },
        "scores": {k: score.get("score" if k == "total_score" else k, 0 if k == "total_review_count" else None) for k in S.SCORE_FIELDS},
        "dimensions": dimensions, "images": images, "models": models, "news": news,
        "stats": {"model_count": len(models), "dimension_group_count": len(dimensions), "image_group_count": len(images), "news_count": len(news)},
    }


def _model(m: Any) -> dict[str, Any]:
    m = _group(m)
    price = m.get("official_price_str") or m.get("price") or m.get("official_price")
    lists = {k: [v for v in _rows(m.get(k)) if isinstance(v, str)] for k in ("tags", "base_config", "highlights_config")}
    return {"car_id": str(m["car_id"]) if m.get("car_id") else None, **{f: m.get(f) for f in S.MODEL_FIELDS}, **lists, "official_price": price}


def _images(page: dict, modules: dict) -> list[dict[str, Any]]:
    out = []
    for key in ("wg", "ns"):
        if m := _group(modules.get(key)):
            samples = [_group(s) for s in _rows(m.get("selected_images"))[:MOST_SAMPLES]]
            colors = [c.get("color_name") for c in map(_group, _rows(m.get("available_colors"))[:MOST_SAMPLES])]
            out.append({"category": key, "category_name": m.get("category_name"), "required_view": m.get("required_view"), "sample_count": len(_rows(m.get("selected_images"))), "sample_models": [s["car_name"] for s in samples if s.get("car_name")], "sample_colors": [c for c in colors if c]})
    if modules:
        return out
    floor = _group(page.get("imageFloorData"))
    for item in map(_group, _rows(floor.get("floor_head_list")) or _rows(floor.get("floor_image_list"))):
        colors = [c.get("color_name") if isinstance(c, dict) else c for c in _rows(item.get("color_list") or item.get("colors"))]
        if item.get("category") or item.get("category_name"):
            out.append({"category": item.get("category"), "category_name": item.get("category_name"), "color_count": len(colors), "sample_colors": [c for c in colors[:MOST_SAMPLES] if isinstance(c, str)]})
    return out


def _news(kind: str, page: dict) -> Iterator[dict[str, Any]]:
    for n in map(_group, _rows(page.get(f"{kind}StaticNews"))[:MOST_NEWS]):
        user = _group(n.get("user_info"))
        yield {"category": kind, "title": n.get("title"), "publish_time": n.get("publish_time"), "watch_or_read_count": n.get("watch_or_read_count") or 0, "has_video": bool(n.get("has_video")), "author": user.get("name"), "author_verified": user.get("verified_content")}


def markdown(record: dict[str, Any]) -> str:
    """The Markdown of a clean record. Empty values show what stands for nothing; None in a dimension or color count is
    shown as such."""
    series, stats = _group(record.get("series")), _group(record.get("stats"))
    blocks = [f"# {series.get('series_name', UNKNOWN_SERIES)} 车型资料"]
    for title, lines in LINES:
        blocks.append("\n".join([f"## {title}", *(f"- {label}: {_group(record.get(part)).get(field) or none}" for label, part, field, none in lines)]))
    sizes = [f"- 长宽高/轴距: {'/'.join(str(d.get(f)) for f in S.DIMENSION_FIELDS[:4])} mm，覆盖车型数: {d.get('car_count')}" for d in map(_group, _rows(record.get("dimensions")))]
    blocks.append("\n".join(["## 尺寸信息", *(sizes or ["- 暂无尺寸信息"])]))
    pictures = [f"- {i.get('category_name') or i.get('category')}: 颜色数 {i.get('color_count')}, 示例颜色 {', '.join(_rows(i.get('sample_colors'))) or '暂无'}" for i in map(_group, _rows(record.get("images")))]
    blocks.append("\n".join(["## 图片与颜色信息", *(pictures or ["- 暂无图片分类信息"])]))
    models = [_model_lines(_group(m)) for m in _rows(record.get("models"))[:MOST_MODELS_SHOWN]]
    blocks.append("\n".join([f"## 车型列表 ({stats.get('model_count', 0)} 款)", "\n\n".join(models) or "- 暂无具体车型列表信息"]))
    last = [f"## 新闻内容 ({stats.get('news_count', 0)} 条)"]
    for n in map(_group, _rows(record.get("news"))[:MOST_NEWS_SHOWN]):
        last.append(f"- [{n.get('category')}] {n.get('title')} | 作者: {n.get('author') or '未知'} | 阅读/播放: {n.get('watch_or_read_count') or 0} | 视频: {'是' if n.get('has_video') else '否'}")
    if len(last) == 1:
        last.append("- 暂无新闻内容")
    # The model list ends in a blank line of its own, without models the news follow at once.
    news = "\n".join(last)
    return ("\n\n".join(blocks) + ("\n\n" if models else "\n") + news).strip()


def _model_lines(m: dict[str, Any]) -> str:
    shown = {k: " | ".join(v) if isinstance(v, list) else v for k, v in m.items()}
    return "\n".join([f"### {m.get('name') or '未知车型'}", *(f"- {label}: {shown.get(field) or none}" for label, field, none in MODEL_LINES)])


def clean_pages(pages: DataFrame, key: str, raw_json: str, source: str = "web") -> DataFrame:
    """key, record (JSON), markdown, error of raw pages. JSON that can't be read gives an error and no record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            records, texts, errors = [], [], []
            for t in b.column(1).to_pylist():
                try:
                    r = clean_record(json.loads(t), source)
                    records.append(json.dumps(r, ensure_ascii=False))
                    texts.append(markdown(r))
                    errors.append(None)
                except (TypeError, ValueError, RecursionError) as e:
                    records.append(None)
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.string()) for c in (records, texts, errors))], names=["key", "record", "markdown", "error"])

    kind = pages.schema[key].dataType.simpleString()
    out = pages.select(F.col(key).alias("key"), raw_json).mapInArrow(run, f"key {kind}, record string, markdown string, error string")
    return out.withColumnRenamed("key", key)


def series_markdown(rows: DataFrame, row_id: str = "clean_id") -> DataFrame:
    """row_id, markdown of rows with the four JSON columns and the names."""
    names = ["series_id", "series_name", "brand_name", "sub_brand_name", "car_type", "city_name"]
    parts = list(S.SHAPES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            cols = {c: b.column(c).to_pylist() for c in names + parts}
            for i in range(b.num_rows):
                read = {p: S.SHAPES[p](S.parse(cols[p][i])) for p in parts}
                models = [m for m in map(_model, read["models"]) if m["car_id"]]
                record = {"series": {n: cols[n][i] for n in names}, "pricing": read["pricing"], "scores": read["scores"], "dimensions": [d for d in read["dimensions"] if d], "models": models, "stats": {"model_count": len(models)}}
                out.append(markdown(record))
            yield pa.RecordBatch.from_arrays([b.column("row_id"), pa.array(out, pa.string())], names=["row_id", "markdown"])

    kind = rows.schema[row_id].dataType.simpleString()
    src = rows.select(F.col(row_id).alias("row_id"), *names, *parts)
    return src.mapInArrow(run, f"row_id {kind}, markdown string").withColumnRenamed("row_id", row_id)
