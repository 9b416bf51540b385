"""Quantities recorded in different units.

Method: identities among columns. Each recorded number has candidate units; the identities say that sums of logarithms of
columns are zero (mass = density times volume: log mass - log density - log volume = 0). Of the combinations of units
within the bounds the one with the least sum of absolute log residuals is chosen, and a row is flagged where another
combination is as good.

For prices the identity is that the official price and the dealer's price of a row are nearly equal, low with low and high
with high. A unit stated in the value leaves one candidate; a unit in the note, or none, leaves all those that keep the price
within WIDE times the bounds, the noted one first among equals. The combination with the least residual stands if it is the
only one and within the bounds; otherwise the best one within the bounds is taken and flagged as uncertain, and so is a
row whose stated unit the bounds overrule.

Defined results. Null and empty texts and texts without an amount are no prices. A single amount is low and high; a range
written the wrong way round is turned. Numbers that count doors, seats, model years or cars on sale are no amounts. Full
copies of a row come out once. Amounts that no unit brings within the bounds are left out. An empty table gives an empty
result.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

YUAN, THOUSAND, TEN_THOUSAND = 1, 1_000, 10_000
BOUNDS = (50_000.0, 500_000.0)
#: Candidates may lie so many times outside the bounds; the identities then choose, and the bounds only verify.
WIDE = 50
#: Residuals that count as equal.
TOLERANCE = 1e-9
#: What a combination costs for each column whose unit is not the noted one: less than any real residual.
UNNOTED = 1e-6


@dataclass(frozen=True)
class Choice:
    factors: tuple[float, ...]
    residual: float
    unique: bool


def choose_units(
    values: Sequence[float],
    candidates: Sequence[Sequence[float]],
    identities: Sequence[Mapping[int, float]],
    bounds: Sequence[tuple[float, float]] | None = None,
    noted: Sequence[float | None] | None = None,
) -> Choice | None:
    """The factors, one for each value, that are within bounds and have the least sum of absolute log residuals over the
    identities (coefficients by position of the value); None if no combination is within bounds."""
    allowed = []
    for i, (v, factors) in enumerate(zip(values, candidates)):
        low, high = bounds[i] if bounds else (0.0, math.inf)
        allowed.append([f for f in dict.fromkeys(factors) if low * (1 - 1e-12) <= v * f <= high * (1 + 1e-12) and v * f > 0])
    scored = []
    for factors in itertools.product(*allowed):
        logs = [math.log(v * f) for v, f in zip(values, factors)]
        cost = sum(abs(sum(c * logs[i] for i, c in identity.items())) for identity in identities)
        cost += sum(UNNOTED for f, n in zip(factors, noted or ()) if n is not None and n != f)
        scored.append((cost, factors))
    if not scored:
        return None
    scored.sort(key=lambda x: x[0])
    return Choice(scored[0][1], scored[0][0], len(scored) == 1 or scored[1][0] - scored[0][0] > TOLERANCE)


_DIGITS = {c: i for i, c in enumerate("零一二三四五六七八九")} | {"〇": 0, "两": 2}
_TENS = {"十": 10, "百": 100, "千": 1000}
_WRITTEN = re.compile("[零〇一二两三四五六七八九十百千万]{2,}")
_NUMBER = r"\d{1,3}(?:,\d{3})+(?:\.\d+)?|\d+(?:\.\d+)?"
_UNIT = r"万元|万|w(?![a-z])|千元|千|k(?![a-z])|元整|元|块|yuan|rmb|cny"
_AMOUNT = re.compile(rf"(?P<number>{_NUMBER})\s*(?P<unit>{_UNIT})?(?P<other>款|座|年|门|台|人|期|折|%|次|天|月|成)?")
_BESIDES = re.compile(rf"(?P<number>\d{{1,5}}(?:\.\d+)?)\s*(?P<unit>千|百)?(?:元整|元|块)?")
_SAID_BEFORE = re.compile(r"(万|千|元)(?:元)?\s*(?:计|\)|为单位|:|\s|$)")


def _factor(unit: str | None) -> int | None:
    if not unit:
        return None
    return TEN_THOUSAND if unit[0] in "万w" else THOUSAND if unit[0] in "千k" else YUAN


def written_number(word: str) -> int:
    """A number in Chinese characters, such as 二十五万三千二百."""
    total = part = digit = 0
    last = 1
    for c in word:
        if c in _DIGITS:
            digit = _DIGITS[c]
            if c in "零〇":
                last = 10
        elif c in _TENS:
            part += (digit or 1) * _TENS[c]
            digit, last = 0, _TENS[c]
        else:
            total, part, digit, last = (total + part + digit) * TEN_THOUSAND, 0, 0, TEN_THOUSAND
    # 二十五万三 means 253,000: a last digit without a place takes the next lower one.
    return total + part + digit * (max(1, last // 10) if last > 10 and word[-1] in _DIGITS and word[-2] not in "零〇" else 1)


def noted_unit(note: str | None) -> int | None:
    """The unit that a free note states for the prices, if any."""
    n = unicodedata.normalize("NFKC", note or "").lower()
    if re.search(r"万|10k|10,?000|ten.thousand|\bw\b", n):
        return TEN_THOUSAND
    if re.search(r"千|thousand|\bk\b|1,?000", n):
        return THOUSAND
    return YUAN if re.search(r"元|yuan|cny|rmb|no.scaling", n) else None


def amounts(text: str | None) -> list[tuple[float, int | None]]:
    """The amounts that a text states, each with its factor to yuan, or None if the text doesn't say."""
    t = unicodedata.normalize("NFKC", text or "").lower()
    t = _WRITTEN.sub(lambda m: str(written_number(m.group())) + ("" if t[m.end() : m.end() + 1] == "元" else "元") if set(m.group()) & set("十百千万") else m.group(), t)
    found: list[tuple[float, int | None, bool]] = []
    first = at = None
    while m := _AMOUNT.search(t, at or 0):
        at = m.end()
        if m["other"] and not m["unit"]:
            continue
        first = m.start() if first is None else first
        value, factor = float(m["number"].replace(",", "")), _factor(m["unit"])
        # 25万1900元, 25万3千: what follows ten thousands at once belongs to them.
        if m["unit"] == "万" and (more := _BESIDES.match(t, at)):
            value = value * TEN_THOUSAND + float(more["number"]) * {"千": 1000, "百": 100}.get(more["unit"], 1)
            factor, at = YUAN, more.end()
        found.append((value, factor, "," in m["number"]))
    if not found:
        return []
    before = t[:first]
    said = _SAID_BEFORE.search(before + " ") or re.search("单位\\s*[:为]?\\s*(万|千|元)", before)
    default = _factor(said[1]) if said else None
    signed = bool(re.search(r"[¥$]|cny|rmb|人民币", before))
    out: list[tuple[float, int | None]] = []
    for i, (value, factor, commas) in enumerate(found):
        if factor is None:
            factor = default
        if factor is None:
            factor = next((f for _, f, _ in found[i + 1 :] if f is not None), None)  # 16-21万: the unit is at the end
        if factor is None and i and found[0][1] is not None:
            factor = found[0][1]
        if factor is None and (commas or signed and value >= BOUNDS[0]):
            factor = YUAN
        out.append((value, factor))
    return out


def price_row(fields: Sequence[str | None], note: str | None, bounds: tuple[float, float] = BOUNDS) -> list[tuple[int, int, bool] | None]:
    """Low and high in yuan and whether the units are certain, for each field; None where it states no price."""
    hint = noted_unit(note)
    values, candidates, notes, place, overruled = [], [], [], {}, False
    wide = (bounds[0] / WIDE, bounds[1] * WIDE)
    for k, text in enumerate(fields):
        for j, (value, factor) in enumerate(amounts(text)):
            inside = lambda f, b: b[0] <= value * f * (1 + 1e-12) and value * f <= b[1] * (1 + 1e-12)  # noqa: E731, B023
            options = [factor] if factor is not None and inside(factor, bounds) else [f for f in (YUAN, THOUSAND, TEN_THOUSAND) if inside(f, wide)]
            if any(inside(f, bounds) for f in options):
                overruled |= factor is not None and factor not in options or len(options) > 1 and factor is not None
                place[k, j] = len(values)
                values.append(value)
                candidates.append(options)
                notes.append(hint if factor is None else None)
    if not values:
        return [None] * len(fields)
    ends = {k: [i for (f, _), i in place.items() if f == k] for k in range(len(fields))}
    identities: list[dict[int, float]] = []
    stated = [v for v in ends.values() if v]
    for a, b in itertools.combinations(stated, 2):
        identities += [{a[0]: 1.0, b[0]: -1.0}, {a[-1]: 1.0, b[-1]: -1.0}]
    for v in stated:
        identities += [{x: 1.0, y: -1.0} for x, y in zip(v, v[1:])]
    choice = choose_units(values, candidates, identities, [wide] * len(values), notes)
    certain = choice.unique and not overruled and all(bounds[0] <= v * f * (1 + 1e-12) and v * f <= bounds[1] * (1 + 1e-12) for v, f in zip(values, choice.factors))
    if not certain:
        choice = choose_units(values, candidates, identities, [bounds] * len(values), notes)
    out: list[tuple[int, int, bool] | None] = []
    for k in range(len(fields)):
        got = sorted(round(values[i] * choice.factors[i]) for i in ends[k])
        out.append((got[0], got[-1], certain) if got else None)
    return out


def prices_in_yuan(rows: DataFrame, row_id: str, fields: Sequence[str], note: str, bounds: tuple[float, float] = BOUNDS) -> DataFrame:
    """row_id, field_name, low_yuan, high_yuan, certain: a row for each price stated in a field."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in range(5)]
            ids, notes = b.column(0).to_pylist(), b.column(1).to_pylist()
            texts = [b.column(2 + k).to_pylist() for k in range(len(fields))]
            for i, n, *given in zip(ids, notes, *texts):
                for name, got in zip(fields, price_row(given, n, bounds)):
                    if got:
                        for col, v in zip(cols, (i, name, *got)):
                            col.append(v)
            types = [b.schema.field(0).type, pa.string(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["row_id", "field_name", "low_yuan", "high_yuan", "certain"])

    kind = rows.schema[row_id].dataType.simpleString()
    flat = rows.select(F.col(row_id).alias("row_id"), F.col(note).alias("note"), *(F.col(f).alias(f"f{k}") for k, f in enumerate(fields))).distinct()
    out = flat.mapInArrow(run, f"row_id {kind}, field_name string, low_yuan bigint, high_yuan bigint, certain boolean")
    return out.withColumnRenamed("row_id", row_id)
