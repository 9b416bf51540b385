"""Deeply nested semi-structured records as related flat tables.

Method: columnar shredding. Every record is written as one sequence of (repetition level, definition level, value) for each
leaf path; tables are reconstructed for each repeated ancestor from the level sequences alone: a repetition level tells
which ancestor goes on, a definition level how much of the path is present. Rows keep the positions of all their repeated
ancestors, which link children to parents.

A specification is a dict of fields, a list of one specification (repeated), or ``str`` (a leaf, kept as text).

The tables of the car series come from four JSON columns of several shapes, which are first brought into one: a list of
models may be an object by key, a single object, tabs with data, or the whole once more as a JSON string; dimension groups
may be a list, a single object or below ``space``.

Defined results. Null, empty and cut-off JSON gives no rows, as does JSON of another shape. Scalars become text, booleans
true or false; a value of a wrong kind is null. A bare value where a list is expected is a list of one; null is none. A
model without a car_id (null or empty) is dropped with all below it. Keys that the specification lacks are ignored. Copies
of a row give equal rows, which are kept once. An empty table gives empty tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Spec = Any  # dict[str, Spec] | list[Spec] | type[str]
Entry = tuple[int, int, str | None]


def _scalar(value: Any) -> str | None:
    if value is None or isinstance(value, (dict, list)):
        return None
    if isinstance(value, bool):
        return "true" if value else "false"
    return value if isinstance(value, str) else json.dumps(value)


def _leaves(spec: Spec, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    if spec is str:
        return [path]
    if isinstance(spec, list):
        return _leaves(spec[0], path)
    return [leaf for name, below in spec.items() for leaf in _leaves(below, (*path, name))]


def shred(spec: Spec, record: Any) -> dict[tuple[str, ...], list[Entry]]:
    """The level sequence of each leaf path of a record."""
    columns: dict[tuple[str, ...], list[Entry]] = {leaf: [] for leaf in _leaves(spec)}

    def absent(below: Spec, path: tuple[str, ...], rep: int, defined: int) -> None:
        for leaf in _leaves(below, path):
            columns[leaf].append((rep, defined, None))

    def write(below: Spec, value: Any, path: tuple[str, ...], rep: int, defined: int, depth: int) -> None:
        if below is str:
            text = _scalar(value)
            columns[path].append((rep, defined + (text is not None), text))
        elif isinstance(below, list):
            items = value if isinstance(value, list) else [] if value is None else [value]
            if not items:
                absent(below, path, rep, defined)
            for i, item in enumerate(items):
                write(below[0], item, path, depth + 1 if i else rep, defined + 1, depth + 1)
        elif isinstance(value, dict):
            for name, field in below.items():
                write(field, value.get(name), (*path, name), rep, defined + 1, depth)
        else:
            absent(below, path, rep, defined)

    write(spec, record, (), 0, 0, 0)
    return columns


def _levels(spec: Spec, path: tuple[str, ...]) -> tuple[int, int]:
    """Repetition depth, and the definition level at which the last step of a path is present."""
    depth = defined = 0
    for i in range(len(path) + 1):
        while isinstance(spec, list):
            depth, defined, spec = depth + 1, defined + 1, spec[0]
        if i < len(path):
            spec, defined = spec[path[i]], defined + 1
    return depth, defined


def reconstruct(spec: Spec, columns: dict[tuple[str, ...], list[Entry]], ancestor: tuple[str, ...]) -> list[tuple[tuple[int, ...], dict[tuple[str, ...], str | None]]]:
    """A row for each instance of a repeated ancestor (or of a group, as its single row): the positions of its repeated
    ancestors and its own, and the leaves that occur once in it."""
    depth, defined = _levels(spec, ancestor)
    rows: dict[tuple[int, ...], dict[tuple[str, ...], str | None]] = {}
    for leaf, entries in columns.items():
        if leaf[: len(ancestor)] != ancestor:
            continue
        single = _levels(spec, leaf)[0] == depth
        at = [0] * (depth + 1)
        for k, (rep, level, value) in enumerate(entries):
            if rep > depth:
                continue  # inside the instance at hand
            if k:
                at[rep] += 1
                at[rep + 1 :] = [0] * (depth - rep)
            if level >= defined:
                row = rows.setdefault(tuple(at[1:]), {})
                if single:
                    row[leaf[len(ancestor) :]] = value
    return sorted(rows.items())


MODEL_FIELDS = ("name", "year", "brand_name", "series_name", "official_price", "dealer_price", "owner_price", "picture_count", "is_new", "is_hot", "follower_rate")
DIMENSION_FIELDS = ("length_mm", "width_mm", "height_mm", "wheelbase_mm", "car_count")
PRICING_FIELDS = ("dealer_price_range", "official_price_range", "latest_owner_price", "lowest_owner_price", "lowest_owner_city_name", "query_price_count")
SCORE_FIELDS = ("total_score", "total_review_count", "comfort_score", "appearance_score", "configuration_score", "control_score", "power_score", "space_score", "interiors_score")
SERIES: dict[str, Spec] = {
    "models": [{"car_id": str, **dict.fromkeys(MODEL_FIELDS, str), "tags": [str], "base_config": [str], "highlights_config": [str]}],
    "dimensions": [dict.fromkeys(DIMENSION_FIELDS, str)],
    "pricing": dict.fromkeys(PRICING_FIELDS, str),
    "scores": dict.fromkeys(SCORE_FIELDS, str),
}


def parse(text: str | None) -> Any:
    """The value of a JSON text; of a JSON string that itself holds JSON, the inner one. None if it can't be read."""
    try:
        value = json.loads(text) if text else None
        return json.loads(value) if isinstance(value, str) and value[:1] in "[{" else value
    except (ValueError, RecursionError):
        return None


def _model(value: Any) -> Any:
    """A model of either shape, with the raw page's parts where the clean record has them."""
    if not isinstance(value, dict):
        return value
    parts, rate = value.get("car_config"), value.get("follower_rate")
    out = {**(parts if isinstance(parts, dict) else {}), **{k: v for k, v in value.items() if k != "car_config"}}
    if isinstance(rate, dict):
        out["follower_rate"] = rate.get("text")
    return out


def _models(value: Any) -> list[Any]:
    if isinstance(value, dict):
        if "tab_list" in value:
            tabs = value["tab_list"] if isinstance(value["tab_list"], list) else []
            rows = [row for tab in tabs if isinstance(tab, dict) and isinstance(tab.get("data"), list) for row in tab["data"] if isinstance(row, dict)]
            return [_model(row["info"]) if isinstance(row.get("info"), dict) else row if "car_id" in row else None for row in rows]
        single = "car_id" in value or "name" in value or not any(isinstance(v, dict) for v in value.values())
        value = [value] if single else list(value.values())
    return [_model(v) for v in value] if isinstance(value, list) else []


def _dimensions(value: Any) -> list[Any]:
    if isinstance(value, dict):
        value = value["space"] if "space" in value else [value] if value else []
    if not isinstance(value, list):
        return []
    out = []
    for v in value:
        if isinstance(v, dict):
            cars = v.get("car_id_list")
            raw = {f"{k}_mm": v[k] for k in ("length", "width", "height", "wheelbase") if k in v}
            v = {**raw, **({"car_count": len(cars)} if isinstance(cars, list) else {}), **v}
        out.append(v if isinstance(v, dict) else None)
    return out


def _pricing(value: Any) -> Any:
    if not isinstance(value, dict):
        return None
    owner = value.get("owner")
    return {**(owner if isinstance(owner, dict) else {}), **{k: v for k, v in value.items() if k != "owner"}}


def _scores(value: Any) -> Any:
    inner = value.get("scoreSimpleInfo") if isinstance(value, dict) else None
    return inner if isinstance(inner, dict) else value if isinstance(value, dict) and value else None


SHAPES: dict[str, Callable[[Any], Any]] = {"models": _models, "dimensions": _dimensions, "pricing": _pricing, "scores": _scores}
#: Child tables: where they lie, and the leaves they carry.
TABLES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "model": (("models",), MODEL_FIELDS),
    "tag": (("models", "tags"), ()),
    "base_config": (("models", "base_config"), ()),
    "highlights_config": (("models", "highlights_config"), ()),
    "dimension": (("dimensions",), DIMENSION_FIELDS),
    "pricing": (("pricing",), PRICING_FIELDS),
    "scores": (("scores",), SCORE_FIELDS),
}


def series_rows(record: dict[str, str | None], tables: list[str]) -> Iterator[tuple[str, str, int, list[str | None]]]:
    """(child, car_id, item_no, values) of a record of JSON texts."""
    columns = shred(SERIES, {name: SHAPES[name](parse(text)) for name, text in record.items()})
    cars = {at[0]: leaves.get(("car_id",)) for at, leaves in reconstruct(SERIES, columns, ("models",))}
    for child in tables:
        path, fields = TABLES[child]
        for at, leaves in reconstruct(SERIES, columns, path):
            below = path[0] == "models"
            car = cars.get(at[0]) if below else ""
            if below and not car:
                continue
            item = 0 if child in ("model", "pricing", "scores") else at[-1]
            yield child, car, item, [leaves.get((f,)) for f in fields] if fields else [leaves.get(())]


def series_tables(rows: DataFrame, tables: list[str], row_id: str = "clean_id") -> DataFrame:
    """row_id, child, car_id, item_no, values: the rows of the child tables named, one record at a time."""
    needed = list(dict.fromkeys(TABLES[t][0][0] for t in tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(5)]
            texts = [b.column(1 + k).to_pylist() for k in range(len(needed))]
            for i, *given in zip(b.column(0).to_pylist(), *texts):
                for child in series_rows(dict(zip(needed, given)), tables):
                    for col, v in zip(cols, (i, *child)):
                        col.append(v)
            types = [b.schema.field(0).type, pa.string(), pa.string(), pa.int32(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["row_id", "child", "car_id", "item_no", "values"])

    kind = rows.schema[row_id].dataType.simpleString()
    flat = rows.select(F.col(row_id).alias("row_id"), *needed)
    out = flat.mapInArrow(run, f"row_id {kind}, child string, car_id string, item_no int, values array<string>")
    return out.withColumnRenamed("row_id", row_id)


def child_table(rows: DataFrame, child: str, row_id: str = "clean_id") -> DataFrame:
    """One child table with its columns: numbers as numbers where they are read as such, else null."""
    path, fields = TABLES[child]
    long = series_tables(rows, [child], row_id)
    keys = [row_id] + (["car_id"] if path[0] == "models" else []) + (["item_no"] if child in ("tag", "base_config", "highlights_config", "dimension") else [])
    if not fields:
        return long.select(*keys, F.get("values", F.lit(0)).alias("value")).distinct()
    out = []
    for k, name in enumerate(fields):
        value = F.get("values", F.lit(k))
        if name in ("length_mm", "width_mm", "height_mm", "wheelbase_mm", "car_count", "picture_count", "total_review_count"):
            value = value.try_cast("double").cast("bigint")
        elif name == "year":
            value = F.regexp_extract(value, r"(\d{4})", 1).try_cast("int")
        elif name.endswith("_score"):
            value = value.try_cast("double")
            value = F.when(value > 5, value / 100).otherwise(value)  # 345 and 3.45 both occur
        elif name in ("is_new", "is_hot"):
            value = value.try_cast("boolean")
        out.append(value.alias(name))
    return long.select(*keys, *out).distinct()
