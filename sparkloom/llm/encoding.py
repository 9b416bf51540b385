"""Garbled text from wrong character encoding.

Method: garbled records are joined with clean near-twins, that is names of one series, or chunk texts, that are equal once all
non-ASCII characters are stripped; the garbled and the clean runs of characters between the ASCII anchors are aligned, and
each alignment votes for the transformations (written in one encoding, read in another, once or twice) that turn the clean
characters into the garbled ones. Transformations with enough votes are the learned mappings; they are inverted over all
remaining records, names and texts. A span is replaced only where the inverse is unambiguous: UTF-8 sequences are
self-checking, two-byte ones must give at least two characters or a letter that the names use.

A record is found if any span of it inverts by a learned mapping, or if it holds U+FFFD, which only a failed decoding leaves.
With ``listed`` the inverses of READ_AS find as well, learned or not. Where bytes were lost, the part that can be restored is
restored and the record is marked as not whole.

Nulls and empty texts are never garbled. Foreign words, accents, signs and rare characters have no inverse and stay as
they are. Full copies come out once. Empty tables give an empty result; without twins nothing is learned,
and records are found by the listed inverses alone, and not restored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from encodings.aliases import aliases
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.plans.shared import materialize, ship, small

#: What text may have been written in, and read in, by name of Python's codecs.
READ_AS = {
    "utf-8": ["cp1252", "mac_roman", "cp1251", "gb18030", "cp932"],
    "gb18030": ["cp1252", "utf-8"],
}
MIN_VOTES = 2
#: Used to find, not to restore, where no votes are in: inverses that check themselves or that need two characters.
ALWAYS = [(w, r) for w, readings in READ_AS.items() for r in readings]

LOST = "�"
_UTF8 = re.compile(rb"[\xC2-\xDF][\x80-\xBF]|[\xE0-\xEF][\x80-\xBF]{2}|[\xF0-\xF4][\x80-\xBF]{3}")
_UTF8_THREE = re.compile(rb"[\xE2-\xEF][\x80-\xBF]{2}")
_RUN = re.compile(r"[^\x00-\x7f]+")
#: Letters and signs that a lone inverted pair of bytes may stand for.
_LONE = re.compile("[À-ÖØ-öø-ÿŠšŽžŒœŸ°±–—‘’“”…]")
_SINGLE = ("cp1252", "mac_roman", "cp1251")


@lru_cache
def _bytes_of(codec: str) -> dict[str, int]:
    """Characters to bytes of a single-byte codec; undefined bytes stand for the control characters of their number, and
    cp1252 takes those of latin-1 besides its own."""
    table = {}
    for b in range(0x80, 0x100):
        try:
            table[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            table[chr(b)] = b
    if codec == "cp1252":
        for b in range(0x80, 0xA0):
            table.setdefault(chr(b), b)
    return table


@lru_cache
def _in_gb2312() -> frozenset[str]:
    return frozenset(bytes([a, b]).decode("gb2312") for a in range(0xB0, 0xF8) for b in range(0xA1, 0xFF) if (a, b) not in {(0xD7, x) for x in range(0xFA, 0xFF)})


@lru_cache
def _common() -> frozenset[str]:
    """The first level of GB 2312: the characters in everyday use."""
    return frozenset(c for c in _in_gb2312() if c.encode("gb2312")[0] < 0xD8)


@lru_cache
def _lone_beside_letter() -> str:
    """Characters of GB 2312 beside a Latin letter whose bytes are a letter or a sign in UTF-8."""
    lone = ""
    for c in sorted(_in_gb2312()):
        try:
            lone += c if _LONE.fullmatch(c.encode("gb2312").decode("utf-8")) else ""
        except UnicodeDecodeError:
            pass
    return f"(?<=[A-Za-z])[{lone}](?![^\x00-\x7f])|(?<![^\x00-\x7f])[{lone}](?=[A-Za-z])"


@lru_cache
def _suspicious() -> re.Pattern:
    """Characters outside ASCII, GB 2312 and its punctuation, and single ones that stand for a letter."""
    plain = "".join(re.escape(c) for c in sorted(_in_gb2312()))
    return re.compile(f"[^\x00-\x7f{plain}，。；：、（）！？“”‘’…—　％．０-９Ａ-Ｚａ-ｚ]|{_lone_beside_letter()}")


def _to_bytes(run: str, codec: str) -> bytes | None:
    """The bytes that were read as run; lost ones as 0xFF. None if the codec can't have given a character."""
    if codec in _SINGLE:
        table = _bytes_of(codec)
        got = [0xFF if c == LOST else ord(c) if c < "\x80" else table.get(c) for c in run]
        return None if None in got else bytes(got)
    out = b""
    for part in re.split(f"({LOST})", run):
        try:
            out += b"\xff" if part == LOST else part.encode(codec)
        except UnicodeEncodeError:
            return None
    return out


def _from_utf8(raw: bytes) -> str:
    return raw.replace(b"\xff", LOST.encode()).decode("utf-8", "replace")


@lru_cache
def _runs(codec: str) -> re.Pattern:
    return re.compile("[" + "".join(re.escape(c) for c in sorted(_bytes_of(codec))) + LOST + "]+")


def _letter(c: str) -> bool:
    return c.isascii() and c.isalpha()


def _utf8_single(text: str, codec: str) -> list[tuple[int, int, str]]:
    """Spans (start, end, restored) written in UTF-8 and read in a single-byte codec. UTF-8 checks itself; what is cut off
    or lost may be a quarter of a longer span."""
    spans = []
    for m in _runs(codec).finditer(text):
        raw = _to_bytes(m.group(), codec)
        covered = sum(len(x) for x in _UTF8.findall(raw))
        if covered >= 2 and (covered == len(raw) or len(raw) >= 6 and covered >= 0.75 * len(raw)):
            spans.append((m.start(), m.end(), _from_utf8(raw)))
    return spans


#: Two characters of three bytes at least, and what may be lost between them.
_UTF8_CHAIN = re.compile(rb"(?:\xFF|[\x80-\xBF]\xFF){0,2}(?:[\xE2-\xE9\xEF\xFF][\x80-\xBF\xFF]{2}|[\xC2-\xDF][\x80-\xBF\xFF]|\xFF|[\x00-\x7F]){2,}")


def _utf8_multi(text: str, codec: str) -> list[tuple[int, int, str]]:
    """As _utf8_single for codecs of two bytes a character, which may have swallowed an ASCII character at the end."""
    spans = []
    for m in _RUN.finditer(text):
        run = m.group()
        parts = [_to_bytes(c, codec) for c in run]
        at = 0
        while at < len(parts):
            if parts[at] is None:
                at += 1
                continue
            end = at
            while end < len(parts) and parts[end] is not None:
                end += 1
            raw = b"".join(parts[at:end])
            starts, n = {}, 0
            for k in range(at, end):
                starts[n] = k
                n += len(parts[k])
            starts[n] = end
            for x in _UTF8_CHAIN.finditer(raw):
                lo, hi = x.start(), x.end()
                while lo not in starts:
                    lo += 1
                while hi not in starts:
                    hi -= 1
                piece = raw[lo:hi]
                read = run[starts[lo] : starts[hi]]
                if hi - lo >= 6 and len(_UTF8_THREE.findall(piece)) >= 2 and sum(c >= "\u2e80" for c in read) * 2 >= len(read):
                    spans.append((m.start() + starts[lo], m.start() + starts[hi], _from_utf8(piece)))
            at = end
        if len(run) <= 2 and None not in parts and (m.start() and _letter(text[m.start() - 1]) or _letter(text[m.end() : m.end() + 1])):
            raw = b"".join(parts)
            back = raw.decode("utf-8", "replace")
            if LOST not in back and _LONE.fullmatch(back[0]) and all(c.isascii() or _LONE.fullmatch(c) for c in back):
                spans.append((m.start(), m.end(), back))
    return spans


_GB_UNIT = re.compile(rb"[\x81-\xFE][\x30-\x39][\x81-\xFE][\x30-\x39]|[\x81-\xFE][\x40-\x7E\x80-\xFE]")
_PUNCTUATION = "，。；：、（）！？“”‘’…—《》　"


def _gb_single(text: str, codec: str) -> list[tuple[int, int, str]]:
    """Spans written in GB 18030 and read in a single-byte codec: two units and more, or one that is a letter with an
    accent or a sign which GB 18030 has in its own rows."""
    table = _bytes_of(codec)
    raw = bytes(b if (b := ord(c) if c < "\x80" else table.get(c, 0x0A)) is not None else 0x0A for c in text)
    spans, alone, group = [], [], []

    def close() -> None:
        if group:
            got = [raw[i:j].decode("gb18030", "replace") for i, j in group]
            good = sum(len(c) == 1 and (c in _in_gb2312() or c in _PUNCTUATION or bool(_LONE.fullmatch(c))) for c in got)
            high = all(b >= 0x80 for i, j in group for b in raw[i:j])
            one = group[0]
            lone = len(got) == 1 and good == 1 and (one[1] - one[0] == 4 or text[one[0]] in "\xa1\xa8" and bool(_LONE.fullmatch(got[0])))
            if lone or len(got) >= 2 and (good >= 0.75 * len(got) if len(got) > 2 else good == 2 and high):
                spans.append((group[0][0], group[-1][1], "".join(got)))
            elif len(got) == good and high:
                alone.append((group[0][0], group[-1][1], "".join(got)))
            group.clear()

    for m in _GB_UNIT.finditer(raw):
        if group and group[-1][1] != m.start():
            close()
        group.append((m.start(), m.end()))
    close()
    return spans + alone if spans else []  # a lone unit is too weak a sign by itself


_ODD = "\u0250-\u0390\u03cf-\u03ff\u0460-\u048f\u0492-\u07ff"
_ODD_RUN = re.compile(f"[\u0080-\u07ff{LOST}]*[{_ODD}][\u0080-\u07ff{LOST}]*")


def _gb_utf8(text: str) -> list[tuple[int, int, str]]:
    """Spans written in GB 18030 and read in UTF-8 that happen to be valid: letters of scripts that nobody mixes."""
    spans = []
    for m in _ODD_RUN.finditer(text):
        raw = m.group().replace(LOST, "").encode("utf-8")
        back = raw.decode("gb18030", "replace")
        if sum(c in _in_gb2312() or c in _PUNCTUATION for c in back) >= 0.5 * len(back):
            spans.append((m.start(), m.end(), back if LOST not in m.group() else m.group()))
    return spans


def _replace(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for start, end, new in sorted(spans):
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]])


@lru_cache
def _hint(written: str, codec: str) -> re.Pattern:
    """What a text must hold for the mapping to have a span in it."""
    if (written, codec) == ("gb18030", "utf-8"):
        return re.compile(f"[{_ODD}]")
    if codec not in _SINGLE:
        known = "".join(re.escape(c) for c in sorted(_in_gb2312()))
        return re.compile(f"{LOST}|[^\x00-\xff{known}，。；：、（）！？“”‘’…—　]|{_lone_beside_letter()}")
    chars = lambda lo, hi: "[" + "".join(re.escape(c) for c, b in _bytes_of(codec).items() if lo <= b <= hi) + "]"
    if written == "utf-8":
        return re.compile(chars(0xC2, 0xF4) + chars(0x80, 0xBF))
    return re.compile(f"{chars(0x81, 0xFE)}{{2}}|[\xa1\xa8][@-~]|[\x81-\x84][0-9]")


@lru_cache
def _codecs() -> tuple[str, ...]:
    """All of Python's codecs for text."""
    known = []
    for codec in sorted(set(aliases.values())):
        try:
            if "aA1".encode(codec) == b"aA1":
                known.append(codec)
        except (LookupError, UnicodeError):
            pass
    return tuple(c.replace("utf_8", "utf-8") for c in known if c not in ("utf_7", "unicode_escape", "raw_unicode_escape", "utf_8_sig"))


def _encoded(runs: list[str]) -> dict[str, list[bytes]]:
    """The bytes of the runs in each codec that has them all."""
    out = {}
    for codec in _codecs():
        try:
            out[codec] = [r.encode(codec) for r in runs]
        except UnicodeError:
            pass
    return out


def _any_votes(garbled: str, clean: str) -> set[tuple[str, str]]:
    """Of all of Python's codecs those pairs that turn the clean runs into the garbled ones: the bytes are the same."""
    g, c = _RUN.findall(garbled), _RUN.findall(clean)
    if not g or len(g) != len(c) or g == c or _suspicious().search(clean) or not _suspicious().search(garbled):
        return set()
    read, written = _encoded(g), _encoded(c)
    return {(w, r) for w, x in written.items() for r, y in read.items() if x == y and w != r}


@lru_cache(maxsize=1 << 16)
def _has(codec: str, char: str) -> bool:
    try:
        return bool(char.encode(codec))
    except UnicodeError:
        return False


def _any_spans(text: str, written: str, codec: str) -> list[tuple[int, int, str]]:
    """Spans that a learned mapping outside READ_AS inverts whole: to two characters and more, all in everyday use."""
    spans = []
    for m in _RUN.finditer(text):
        at, end = m.span()
        while at < end:
            stop = at
            while stop < end and _has(codec, text[stop]):
                stop += 1
            if stop > at and _suspicious().search(text[at:stop]):
                try:
                    back = text[at:stop].encode(codec).decode(written)
                except UnicodeError:
                    back = ""
                if len(back) >= 2 and all(c in _common() or c in _PUNCTUATION for c in back):
                    spans.append((at, stop, back))
            at = stop + 1
    return spans


def _spans(text: str, written: str, codec: str) -> list[tuple[int, int, str]]:
    if codec not in READ_AS.get(written, ()):
        return _any_spans(text, written, codec)
    if not _hint(written, codec).search(text):
        return []
    if written == "utf-8":
        return (_utf8_single if codec in _SINGLE else _utf8_multi)(text, codec)
    return _gb_utf8(text) if codec == "utf-8" else _gb_single(text, codec)


def restore(text: str | None, mappings: list[tuple[str, str]] = ALWAYS) -> tuple[bool, str | None]:
    """Whether the text is garbled, and the text as far as the mappings restore it. In each round the mapping whose spans
    cover most is inverted, so that text read wrongly twice is restored twice."""
    if not text or text.isascii() or not _suspicious().search(text):
        return False, text
    garbled = LOST in text
    for _ in range(6):
        tried = [_spans(text, *m) for m in mappings]
        best = max(tried, key=lambda spans: sum(end - start for start, end, _ in spans), default=[])
        if not best:
            break
        garbled, before, text = True, text, _replace(text, best)
        if text == before:
            break
    return garbled, text


def _skeleton(column: str) -> Column:
    return F.regexp_replace(column, r"[^\x00-\x7f]+", "")


def _votes(garbled: str, clean: str) -> set[tuple[str, str]]:
    """Transformations that turn the clean runs into the garbled ones, aligned between their ASCII anchors."""
    g, c = _RUN.findall(garbled), _RUN.findall(clean)
    if not g or len(g) != len(c):
        return set()
    out = set()
    for written, readings in READ_AS.items():
        for codec in readings:
            ok = 0
            for x, y in zip(g, c):
                now = y
                for _ in range(2):
                    raw = now.encode(written, "replace")
                    if codec in _SINGLE:
                        chars = {b: ch for ch, b in _bytes_of(codec).items()}
                        other = "".join(chr(b) if b < 0x80 else chars[b] for b in raw)
                        latin = raw.decode("latin-1") if codec == "cp1252" else other
                        now = latin if latin == x else other
                    else:
                        now = raw.decode(codec, "replace")
                    if now == x or LOST in x and LOST in now and re.sub(f"{LOST}+", LOST, now) == re.sub(f"{LOST}+", LOST, x):
                        ok += 1
                        break
            if ok == len(g):
                out.add((written, codec))
    return out


def _told(x: str, y: str) -> list[tuple[str, str]]:
    """The transformations that turn the clean one of two twins into the other, if one of them is clean."""
    for garbled, clean in ((x, y), (y, x)):
        if not restore(clean)[0] and (got := _votes(garbled, clean)):
            return sorted(got)
    return sorted(_any_votes(x, y) or _any_votes(y, x))


def _twins(rows: DataFrame, group: list[str], text: str, least: int) -> DataFrame:
    """x, y: each distinct text with one of those that differ from it in their non-ASCII runs alone, the one that most rows
    hold, then the shortest: a group of any size gives as many twins as it has texts. Skeletons of less than least
    characters are no sign of a twin."""
    flat = rows.where(F.col(text).isNotNull() & F.col(text).rlike(r"[^\x00-\x7f]")).select(*(F.col(g).alias(f"g{i}") for i, g in enumerate(group)), F.col(text).alias("t"))
    keys = [f"g{i}" for i in range(len(group))] + ["bones"]
    hashed = flat.withColumn("bones", _skeleton("t")).where(F.length("bones") >= least)
    hashed = hashed.withColumns({"bones": F.xxhash64("bones", F.regexp_count("t", F.lit(r"[^\x00-\x7f]+"))), "h": F.xxhash64("t")})
    # Texts are moved only where a skeleton has several of them.
    texts = hashed.groupBy(*keys, "h").agg(F.count(F.lit(1)).alias("n"), F.length(F.first("t")).alias("size")) if least else hashed.groupBy(*keys, "h", "t").agg(F.count(F.lit(1)).alias("n")).withColumn("size", F.length("t"))
    best = texts.groupBy(*keys).agg(F.min(F.struct(-F.col("n"), "size", "h")).alias("best"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select(*keys, F.col("best.h").alias("best"))
    best = small(materialize(best, "skeletons"))
    several = hashed.join(best, keys).groupBy(*keys, "best", "h").agg(F.first("t").alias("t"))
    y = several.where("h = best").select(*keys, F.col("t").alias("y"))
    return several.where("h != best").join(y, keys).select(F.col("t").alias("x"), "y")


def learn(names: DataFrame, texts: DataFrame | None = None, group: str = "series_id", text: str = "series_name", min_votes: int = MIN_VOTES) -> list[tuple[str, str]]:
    """The mappings supported by at least min_votes twins that no better supported one explains, the best supported first.
    Twins are names of one series, or whole texts (column text), that differ in their non-ASCII runs alone; those that no
    mapping of READ_AS explains vote for pairs of any of Python's codecs. What comes to the driver is a count for each set of
    mappings that explains some twin."""
    twins = _twins(names, [group], text, 0)
    if texts is not None:
        twins = twins.union(_twins(texts, [], "text", 12))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            told = [_told(x, y) for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist())]
            told = [" ".join(f"{w}>{r}" for w, r in t) for t in told if t]
            if told:
                yield pa.RecordBatch.from_arrays([pa.array(told)], names=["told"])

    counted = twins.mapInArrow(vote, "told string").groupBy("told").agg(F.count(F.lit(1)).alias("n"))
    left = {tuple(tuple(m.split(">")) for m in r.told.split(" ")): r.n for r in counted.collect()}
    found: list[tuple[str, str]] = []
    while left:
        votes: dict[tuple[str, str], int] = {}
        for told, n in left.items():
            for m in told:
                votes[m] = votes.get(m, 0) + n
        best = min(votes, key=lambda m: (-votes[m], m))
        if votes[best] < min_votes:
            break
        found.append(best)
        left = {told: n for told, n in left.items() if best not in told}
    return found


def repair(rows: DataFrame, row_id: str, text: str, mappings: list[tuple[str, str]], listed: bool = True) -> DataFrame:
    """row_id, garbled text, restored text and whether it is whole, for the garbled rows alone. Texts are restored with the
    mappings given. listed: texts are found with the self-checking inverses of READ_AS as well, though not restored."""
    others = [m for m in ALWAYS if m not in mappings] if listed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep, new = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                found, back = restore(t, mappings)
                if found or others and restore(t, others)[0]:
                    keep.append(i)
                    new.append(back)
            if keep:
                whole = [LOST not in t for t in new]
                picked = b.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([picked.column(0), picked.column(1), pa.array(new, pa.string()), pa.array(whole)], names=["row_id", "garbled", "restored", "whole"])

    return rows.where(F.col(text).isNotNull()).select(row_id, text).mapInArrow(run, "row_id bigint, garbled string, restored string, whole boolean")


def garbled_records(chunks: DataFrame, series: DataFrame, listed: bool = True) -> DataFrame:
    """src_table, row_id, garbled, restored, whole: the garbled names and texts, with mappings learned from twins among the
    names and among the texts. listed: see repair; without it a record is found by a learned mapping or by U+FFFD."""
    ship(series.sparkSession)
    mappings = learn(series, chunks)
    names = repair(series, "clean_id", "series_name", mappings, listed).withColumn("src_table", F.lit("dcd_cleaner"))
    texts = repair(chunks, "record_id", "text", mappings, listed).withColumn("src_table", F.lit("chunks"))
    return names.unionByName(texts).select("src_table", "row_id", "garbled", "restored", "whole")
