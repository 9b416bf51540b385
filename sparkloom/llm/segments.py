"""Segment index for edit distance over canonical texts.

Two texts are near-same when both keep at least ``min_chars`` letters and digits (after NFKC and lower case) and at most
``max_share`` of the longer one's characters must be inserted, deleted or replaced to get the other.

Each distinct canonical text stores a fixed number of segments with its length and their positions. Segments begin at
local minima of a hash over three characters, so that the segments of two texts agree again right after an edit and a
probe needs one substring per segment, not one per possible shift. A pair becomes a candidate when it shares at least
two segments, or one that hardly any other text holds, with compatible lengths and positions. Postings are shuffled once,
by key; a task reads its sorted keys as a stream, whatever their size.

Segments held by more than ``HOT`` texts are not paired: each holder is tried with the earliest one and with one of the run
before its own. That alone finds the repeats of most families of near-copies, but not all.

Segments are quick, but no guarantee: a pair may share none. ``every_candidate`` guarantees every pair: all pairs of
compatible lengths are compared, in blocks, by parity bits of their bags of characters, whose difference is a lower bound
of the edits, and Latin and long texts by their beginnings; what isn't ruled out goes to bounded edit distance. Tiles whose lengths or whose numbers of letters or digits
lie too far apart are passed over. Its work grows as the square of the texts of about equal length, whatever they share.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.plans.shared import materialize, materialize_parts, ship, small

MIN_CHARS = 60
MAX_SHARE = 0.12
#: A segment begins at a minimum among 2 * window + 1 neighbours: 13 characters on average in texts of less than SHORT
#: characters, 17 in others. The minima of the wider window are among those of the narrower one.
WINDOWS = (6, 8)
SHORT = 180
SEGMENTS = 16  # stored for each text: those with the smallest hashes, all if there are fewer
HOT = 200  # holders beyond which a segment is not paired
SCARCE = 4  # holders up to which one shared segment makes a candidate
FEW = 104  # characters below which one shared segment makes a candidate
STARS = 4  # one in so many hot segments is used for stars

#: Bits of the bag of characters of a text below SHORT_BAG characters; they double as the length doubles, so that they fold.
BAG_BITS = 256
SHORT_BAG = 320
DOUBLED = 6  # times at most
TWOS = 4  # times as many bits has the bag of pairs of characters
LATIN = 3  # a text has that bag if one in so many of its characters is a Latin letter, of which there are few, or if it is long
MULTIPLIED = 4096  # bits of a bag that are multiplied at most
BLOCK = 20_000  # texts of one side of a block of pairs, about, and fewer of long ones
COSTLY = 400  # characters from which on a pair costs more, by the fourth power, as more pairs are left and more of them compared
TASK_PAIRS = 400_000_000  # pairs of a task, about
TILE = 512  # texts multiplied at once
BESIDE = 8  # tiles of one side that are kept while all of the other pass by
#: Bits of a bag that may be multiplied, half the standard deviations that are to be between the bound and
#: bits at random, and the share of the bound of which there are always enough.
SIZES = [n * k // 2 for n in (64 << i for i in range(7)) for k in (2, 3)][:-1]
SURE, TIMES = 1.25, 4

#: Part of a text, and characters from which on it is used, that is compared before the whole.
BEGINNING, LONG = 0.2, 200
WAITING = 1 << 16  # pairs that are gathered before their beginnings are compared
ABREAST, AT_LEAST = 4096, 16  # pairs that are compared at once at most, and at least for each word of their beginnings

#: What a sketch has besides its segments.
ABOUT = ["bag", "twos", "head", "letters", "digits"]

_NOT_ALNUM = re.compile(r"[\W_]+")
_U = np.uint64
_M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
_POWERS = np.array([pow(0xD6E8FEB86659FD93, i, 1 << 64) for i in range(4096)], np.uint64)
_ALNUM: np.ndarray | None = None
_SIMPLE: np.ndarray | None = None
#: Ranges of code points most of which NFKC leaves alone or turns into signs only.
_PLAIN = [(0, 0x250), (0x400, 0x530), (0x2000, 0x2070), (0x3000, 0x3040), (0x4E00, 0xA000), (0xFF00, 0xFF66)]


def canonical(text: str | None) -> str:
    """Letters and digits of the text after NFKC and lower case."""
    return _NOT_ALNUM.sub("", unicodedata.normalize("NFKC", text).lower()) if text else ""


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(29))) * _M1
    x = (x ^ (x >> _U(32))) * _M2
    return x ^ (x >> _U(30))


def _alnum() -> np.ndarray:
    global _ALNUM
    if _ALNUM is None:
        _ALNUM = np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)
        _ALNUM[0] = True  # the separator of texts
    return _ALNUM


def _simple() -> np.ndarray:
    """Code points that NFKC leaves as they are, or whose NFKC has neither letters nor digits; a text of these alone needs no
    normalization, for none of them combines with another."""
    global _SIMPLE
    if _SIMPLE is None:
        _SIMPLE = np.zeros(0x110000, bool)
        for c in (chr(i) for lo, hi in _PLAIN for i in range(lo, hi)):
            n = unicodedata.normalize("NFKC", c)
            _SIMPLE[ord(c)] = (n == c or not any(x.isalnum() for x in n)) and not any(map(unicodedata.combining, n))
    return _SIMPLE


def _codes(joined: str) -> np.ndarray:
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum over the 2 * w + 1 neighbours of each element."""
    pad = np.full(w, np.iinfo(x.dtype).max, x.dtype)
    cur, size, want = np.concatenate([pad, x, pad]), 1, 2 * w + 1
    while size * 2 <= want:
        cur, size = np.minimum(cur[:-size], cur[size:]), size * 2
    return np.minimum(cur[: len(cur) - (want - size)], cur[want - size :]) if size < want else cur


def _kept(texts: list[str], min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the texts that keep min_chars, the code points of their canonical forms in one array, and their lengths."""
    texts = [t.replace("\0", "") for t in texts]
    joined = "\0".join(texts) + "\0"
    codes = _codes(joined)
    odd = np.add.reduceat(~_simple()[codes], np.concatenate([[0], np.nonzero(codes == 0)[0][:-1] + 1]))
    if odd.any():
        joined = "\0".join(unicodedata.normalize("NFKC", t) if x else t for t, x in zip(texts, odd)) + "\0"
    codes = _codes(joined.lower())
    codes = codes[_alnum()[codes]]
    ends = np.nonzero(codes == 0)[0]
    lengths = np.diff(np.concatenate([[-1], ends])) - 1
    kept = lengths >= max(1, min_chars)
    return np.nonzero(kept)[0], codes[codes != 0][np.repeat(kept, lengths)], lengths[kept]


def _hashes(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64 bits for each character and for each text."""
    m = _mix(codes.astype(np.uint64) + _M2)
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(m)) - np.repeat(first, lengths)
    return m, _mix(np.add.reduceat(m * _POWERS[place % 4096] + _mix(place.astype(np.uint64) >> _U(12)), first) ^ lengths.astype(np.uint64))


def _segments(m: np.ndarray, lengths: np.ndarray, windows: tuple[int, int], segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The packed segments of each text (48 bits of hash, 16 bits of relative position), flat with offsets."""
    doc_start = np.concatenate([[0], np.cumsum(lengths)])
    gram = (_mix(m + np.roll(m, -1) * _U(3) + np.roll(m, -2) * _U(7)) >> _U(32)).astype(np.uint32)
    # Nothing may hang on the texts beside a text: no gram reaches into the next one, and a gap as wide as the window
    # keeps their minima apart.
    none = np.uint32(0xFFFFFFFF)
    last = doc_start[1:] - 1
    gram[last] = none
    gram[np.maximum(last - 1, doc_start[:-1])] = none
    at = np.arange(len(m)) + np.repeat(np.arange(len(lengths)), lengths) * max(windows)
    spread = np.full(len(m) + len(lengths) * max(windows), none)
    spread[at] = gram
    least = np.where(np.repeat(lengths < SHORT, lengths), *(_window_min(spread, w)[at] for w in windows))
    begins = (gram == least) & (gram != none)
    begins[doc_start[:-1]] = True
    starts = np.nonzero(begins)[0]
    place = np.arange(len(m)) - np.repeat(starts, np.diff(np.append(starts, len(m))))
    seg = _mix(np.add.reduceat(m * _POWERS[place % 4096] + _mix(place.astype(np.uint64) >> _U(12)), starts))
    doc = np.repeat(np.arange(len(lengths)), lengths)[starts]
    relative = ((starts - doc_start[doc]) * 65536 // lengths[doc]).astype(np.uint64)
    packed = ((seg >> _U(16)) << _U(16)) | relative
    order = np.lexsort((packed, doc))
    packed, doc = packed[order], doc[order]
    first = np.searchsorted(doc, np.arange(len(lengths)))
    stay = np.arange(len(doc)) - first[doc] < segments
    same = np.concatenate([[False], (packed[1:] >> _U(16) == packed[:-1] >> _U(16)) & (doc[1:] == doc[:-1])])
    stay &= ~same  # a segment repeated within a text is stored once
    packed, doc = packed[stay], doc[stay]
    return packed.view(np.int64), np.searchsorted(doc, np.arange(len(lengths) + 1))


def sketch_texts(texts: list[str], windows: tuple[int, int] = WINDOWS, segments: int = SEGMENTS, min_chars: int = MIN_CHARS):
    """For each text that keeps min_chars: its place in the list, a 64-bit hash of its canonical form, the length, and the
    packed segments (48 bits of hash, 16 bits of relative position), flat with offsets."""
    kept, codes, lengths = _kept(texts, min_chars)
    if not len(kept):
        return kept, np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
    m, text_hash = _hashes(codes, lengths)
    return kept, text_hash, lengths, *_segments(m, lengths, windows, segments)


def _bag_bits(lengths: np.ndarray) -> np.ndarray:
    return BAG_BITS << np.searchsorted([SHORT_BAG << k for k in range(DOUBLED)], lengths, side="right")


def _bags(m: np.ndarray, lengths: np.ndarray, times: int) -> list[bytes]:
    """For each text the parities of how many of its hashes m fall on each bit. m: a hash for each character."""
    out: list[bytes] = [b""] * len(lengths)
    first = np.cumsum(lengths) - lengths
    of = _bag_bits(lengths) * times
    for bits in np.unique(of):
        places = np.nonzero(of == bits)[0]
        step = max(1, (1 << 21) // int(bits))
        for lo in range(0, len(places), step):
            some = places[lo : lo + step]
            n = lengths[some]
            at = np.arange(n.sum()) + np.repeat(first[some] - (np.cumsum(n) - n), n)
            bit = (m[at] >> _U(17)).astype(np.int64) & (int(bits) - 1)
            odd = (np.bincount(np.repeat(np.arange(len(some)), n) * int(bits) + bit, minlength=len(some) * int(bits)) & 1).astype(np.uint8)
            for i, x in zip(some, np.packbits(odd.reshape(len(some), -1), axis=1)):
                out[i] = x.tobytes()
    return out


def _numbered(m: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each m and of how many like it the text has had, text by text but in no order within."""
    doc = np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths)
    token = np.sort((doc << _U(40)) | (m >> _U(24)))
    begins = np.nonzero(np.concatenate([[True], token[1:] != token[:-1]]))[0]
    nth = np.arange(len(token)) - np.repeat(begins, np.diff(np.append(begins, len(token))))
    return _mix((token & _U((1 << 40) - 1)) + (nth.astype(np.uint64) + _U(1)) * _M2)


def _ones(m: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """The bag of characters of each text."""
    return _bags(_numbered(m, lengths), lengths, 1)


def _twos(m: np.ndarray, lengths: np.ndarray, on: np.ndarray) -> list[bytes]:
    """The bag of pairs of characters in a row of the texts that are on; the last character of a text has 0 after it."""
    after = np.roll(m, -1)
    after[np.cumsum(lengths) - 1] = 0
    pairs = _mix(m + after * _U(5))[np.repeat(on, lengths)]
    some = iter(_bags(_numbered(pairs, lengths[on]), lengths[on], TWOS) if on.any() else [])
    return [next(some) if x else b"" for x in on]


def _words(lengths: np.ndarray) -> np.ndarray:
    """Words of 64 characters that cover BEGINNING."""
    return np.ceil(lengths * BEGINNING / 64).astype(np.int64)


def _heads(codes: np.ndarray, lengths: np.ndarray, on: np.ndarray) -> pa.Array:
    """The beginning of each text that is on, a byte below 128 for each character, as far as a text within MAX_SHARE may ask
    for it. Letters and digits of ASCII keep bytes of their own; others may share one, which makes a distance only smaller."""
    longest = lengths / (1 - MAX_SHARE)
    n = np.where(on, np.minimum(lengths, 64 * _words(longest) + (longest * MAX_SHARE).astype(np.int64) + 1), 0)
    ends = np.cumsum(n)
    c = codes[np.arange(ends[-1]) + np.repeat(np.cumsum(lengths) - lengths - (ends - n), n)]
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(((c ^ (c >> 7)) & 127).astype(np.uint8))])


def _parts(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about so many bytes of text."""
    size = np.cumsum(pa.compute.binary_length(batch.column(text)).to_numpy(zero_copy_only=False)) // (4 << 20)
    cuts = [0, *(np.nonzero(np.diff(size))[0] + 1), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        yield batch.slice(lo, hi - lo)


def sketches(rows: DataFrame, carried: list[str], text: str = "text", indexed: bool = True, min_chars: int = MIN_CHARS, **settings) -> DataFrame:
    """One row for each row whose text keeps enough characters: the carried columns, tid, len, segs (none unless indexed),
    the bags of characters and of pairs of them, the beginning, and the numbers of ASCII letters and of ASCII digits."""
    fields = [rows.schema[c] for c in carried]
    windows, segments = settings.get("windows", WINDOWS), settings.get("segments", SEGMENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in _parts(b, text)):
            kept, codes, lengths = _kept(batch.column(text).to_pylist(), min_chars)
            if len(kept):
                m, tid = _hashes(codes, lengths)
                segs, offsets = _segments(m, lengths, windows, segments) if indexed else (np.zeros(0, np.int64), np.zeros(len(kept) + 1, np.int64))
                first = np.cumsum(lengths) - lengths
                count = lambda on: pa.array(np.add.reduceat(on, first, dtype=np.int64).astype(np.int32))
                cols = [batch.column(c).take(pa.array(kept)) for c in carried]
                cols += [pa.array(tid.view(np.int64)), pa.array(lengths.astype(np.int32))]
                cols += [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(segs))]
                letters, digits = count((codes >= 97) & (codes <= 122)), count((codes >= 48) & (codes <= 57))
                alike = (letters.to_numpy() * LATIN >= lengths) | (lengths >= 2 * SHORT_BAG)
                cols += [pa.array(_ones(m, lengths), pa.binary()), pa.array(_twos(m, lengths, alike), pa.binary()), _heads(codes, lengths, alike), letters, digits]
                yield pa.RecordBatch.from_arrays(cols, names=[*carried, "tid", "len", "segs", *ABOUT])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "tid bigint, len int, segs array<bigint>, bag binary, twos binary, head binary, letters int, digits int"])
    return rows.where(F.col(text).isNotNull()).select(*carried, text).mapInArrow(run, schema)


#: Bits that are carried along at once.
TOGETHER = 1 << 18


def _unpacked(n: int, size: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(n.to_bytes((size + 7) // 8, "little"), np.uint8), bitorder="little")[:size].astype(np.int32)


def _packed(on: np.ndarray) -> int:
    return int.from_bytes(np.packbits(on, bitorder="little").tobytes(), "little")


def _may_begin(some: list[str], b: str, limits: list[int]) -> np.ndarray:
    """Which of the texts the beginning of b leaves within their limit of b. The beginning of a text that it is aligned with
    is no longer than both allow, and of the rests at least the difference in length remains. One run over the beginning of
    b fills the last column of the table of edit distances of all texts, side by side in one number, a 0 between them."""
    cut = int(len(b) * BEGINNING)
    heads = [a[: cut + limit] for a, limit in zip(some, limits)]
    size = np.array([len(h) for h in heads])
    ends = np.cumsum(size + 1)  # the place after each head's 0
    first, total = ends - size - 1, int(ends[-1])
    codes = np.frombuffer("".join(h + "\0" for h in heads).encode("utf-32-le", "surrogatepass"), np.uint32)
    full, ones = _packed(codes != 0), np.zeros(total, bool)
    ones[first] = True
    base, masks = _packed(ones), {c: _packed(codes == ord(c)) for c in set(b[:cut])}
    up, down = full, 0
    for ch in b[:cut]:
        eq = masks[ch]
        vert = eq | down
        diag = ((((eq & up) + up) ^ up) | eq) & full
        rise, fall = (down | (~(diag | up) & full)) << 1 & full | base, (up & diag) << 1 & full
        up, down = fall | (~(vert | rise) & full), rise & vert
    steps = np.cumsum(_unpacked(up, total) - _unpacked(down, total))
    edits = cut + steps - np.repeat(np.concatenate([[0], steps[ends[:-1] - 1]]), size + 1)
    rows = np.arange(total) - np.repeat(first, size + 1) + 1
    lengths, limit = np.array([len(a) for a in some]), np.array(limits)
    rest = np.abs((np.repeat(lengths, size + 1) - rows) - (len(b) - cut))
    cost = np.where(codes != 0, edits + rest, 1 << 30)
    nothing = cut + np.abs(lengths - (len(b) - cut))  # no row at all
    return np.minimum(np.minimum.reduceat(cost, first), nothing) <= limit


def within(a: str, b: str, limit: int) -> int | None:
    """Edit distance of a and b if at most limit, else None. Bit-parallel over whole strings of any length."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return None
    lo, hi = 0, min(len(a), len(b))
    while lo < hi and a[lo : (mid := (lo + hi + 1) // 2)] == b[lo:mid]:
        lo = mid
    while hi > lo and a[lo] == b[lo]:
        lo += 1
    a, b = a[lo:], b[lo:]
    cut, most = 0, min(len(a), len(b))
    while cut < most and a[-1 - cut] == b[-1 - cut]:
        cut += 1
    if cut:
        a, b = a[:-cut], b[:-cut]
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b) if len(b) <= limit else None
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score, left = full, 0, len(a), len(b)
    for ch in b:
        eq = masks.get(ch, 0)
        vert = eq | down
        diag = (((eq & up) + up) ^ up) | eq
        rise, fall = down | (~(diag | up) & full), up & diag
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        left -= 1
        if score - left > limit:
            return None
        rise, fall = ((rise << 1) | 1) & full, (fall << 1) & full
        up, down = fall | (~(vert | rise) & full), rise & vert
    return score if score <= limit else None


def _near(x: list[str], y: list[str], max_share: float) -> list[bool]:
    """Which pairs are within the share: by the beginnings of long texts, those of one y together; then by characters
    regardless of order, which are a lower bound; then by edit distance."""
    limit = [int(max_share * max(len(p), len(q)) + 1e-9) for p, q in zip(x, y)]
    may = np.ones(len(x), bool)
    by: dict[str, list[int]] = {}
    for i, q in enumerate(y):
        if x[i] != q and len(q) >= LONG:
            by.setdefault(q, []).append(i)
    for q, places in by.items():
        step = max(1, TOGETHER // (len(q) // 2 + 1))
        for lo in range(0, len(places), step):
            some = places[lo : lo + step]
            may[some] = _may_begin([x[i] for i in some], q, [limit[i] for i in some])

    def one(p: str, q: str, most: int) -> bool:
        c, d = Counter(p), Counter(q)
        return max((c - d).total(), (d - c).total()) <= most and within(p, q, most) is not None

    return [bool(m) and one(p, q, n) for m, p, q, n in zip(may, x, y, limit)]


def near_same(a: str, b: str, max_share: float = MAX_SHARE, min_chars: int = MIN_CHARS) -> bool:
    """The exact definition, over two raw texts."""
    x, y = canonical(a), canonical(b)
    longer = max(len(x), len(y))
    return min(len(x), len(y)) >= min_chars and within(x, y, int(max_share * longer + 1e-9)) is not None


def written_sketches(rows: DataFrame, carried: list[str], text: str = "text", **settings) -> DataFrame:
    """sketches, materialized, with a number for each row."""
    ship(rows.sparkSession)
    return materialize(sketches(rows, carried, text, **settings).withColumn("row", F.monotonically_increasing_id()), "sketches")


def distinct_texts(sketched: DataFrame, own: Column, of_all: Column, row_id: str = "record_id") -> tuple[DataFrame, DataFrame]:
    """(texts, copied) of written sketches. texts: one row for each distinct canonical text: id (a row id that holds it),
    tid, len, mark, segs and ABOUT. copied: tid, len, id and mark of the texts that several rows hold; only
    those are looked up by text, so segments aren't shuffled for it. own: the mark of a row alone; of_all: of all rows of a
    text, an aggregate. A row id must determine its text."""
    held = sketched.groupBy("tid", "len").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first_row"), of_all.alias("mark")).where("n > 1").drop("n")
    firsts = sketched.select(F.col("row").alias("first_row"), F.col(row_id).alias("id"))
    copied = materialize(firsts.join(small(materialize(held, "held")), "first_row"), "copied")
    about = ["segs", *ABOUT]
    mine = sketched.select("tid", "len", "row", F.col(row_id).alias("own_id"), own.alias("own_mark"), *about)
    joined = mine.join(small(copied), ["tid", "len"], "left").where("first_row IS NULL OR first_row = row")
    texts = joined.select(F.coalesce("id", "own_id").alias("id"), "tid", "len", F.coalesce("mark", "own_mark").alias("mark"), *about)
    return texts, copied.select("tid", "len", "id", "mark")


#: Bits of a posting's number: the key (45), the place relative to the text (7) and the logarithm of the length (12).
_PLACE, _LENGTH = 7, 12
_LOW = _PLACE + _LENGTH
_STEP = 0.005  # of the logarithm of the length


def postings(texts: DataFrame, rank: Column) -> DataFrame:
    """(w, id, rank): in one number a segment's hash, its place and its text's length; its text; and the text's rank."""
    flat = texts.select("id", rank.cast("int").alias("rank"), F.least(F.floor(F.log("len") / _STEP), F.lit((1 << _LENGTH) - 1)).cast("bigint").alias("size"), F.explode("segs").alias("s"))
    place = F.shiftright(F.col("s").bitwiseAND(F.lit(0xFFFF)), 16 - _PLACE)
    w = F.shiftleft(F.shiftright("s", _LOW), _LOW) + F.shiftleft(place.cast("bigint"), _LENGTH) + F.col("size")
    return flat.select(w.alias("w"), "id", "rank")


def _compatible(la: np.ndarray, pa_: np.ndarray, lb: np.ndarray, pb: np.ndarray, max_share: float) -> np.ndarray:
    """Whether a near-same pair may share a segment at these places: what is before it, and what is after it, differ in
    length by no more than the edits, taken together."""
    longer = np.maximum(la, lb)
    return np.abs(pa_ - pb) + np.abs((la - pa_) - (lb - pb)) <= longer * (max_share + 2 * _STEP + 2.0 ** (2 - _PLACE)) + 2


def _group_pairs(w: np.ndarray, ids: np.ndarray, rank: np.ndarray, hot: int, max_share: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of ids of whole keys, with their weight. w: sorted."""
    key = w >> _LOW
    begins = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
    held = np.diff(np.append(begins, len(w)))
    length = np.exp((w & ((1 << _LENGTH) - 1)) * _STEP)
    place = (((w >> _LENGTH) & ((1 << _PLACE) - 1)) + 0.5) * 2.0**-_PLACE * length
    for n in np.unique(held[(held > 1) & (held <= hot)]):
        first = begins[held == n]
        i, j = np.triu_indices(n, 1)
        step = max(1, 1_000_000 // len(i))
        for lo in range(0, len(first), step):
            x, y = ((first[lo : lo + step, None] + k).ravel() for k in (i, j))
            on = rank[x] != rank[y]
            x, y = x[on], y[on]
            on = _compatible(length[x], place[x], length[y], place[y], max_share)
            x, y = x[on], y[on]
            enough = (n <= SCARCE) | (np.minimum(length[x], length[y]) < FEW)
            yield ids[x], ids[y], np.where(enough, 2, 1)
    for lo, n in zip(begins[held > hot], held[held > hot]):
        if _mix(np.array([key[lo]]).view(np.uint64))[0] % _U(STARS) == 0:
            yield from _star(ids[lo : lo + n], rank[lo : lo + n])


def _star(ids: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each holder of a hot segment with the earliest one, and with the first one of the rank before its own."""
    order = np.lexsort((ids, rank))
    ids, rank = ids[order], rank[order]
    begins = np.nonzero(np.concatenate([[True], rank[1:] != rank[:-1]]))[0]
    if len(begins) > 1:
        later = np.arange(begins[1], len(ids))
        before = ids[begins[np.searchsorted(begins, later, side="right") - 2]]
        other = before != ids[0]
        yield np.full(len(later), ids[0]), ids[later], np.ones(len(later), np.int64)
        yield before[other], ids[later][other], np.ones(int(other.sum()), np.int64)


def candidates(stored: DataFrame, max_share: float = MAX_SHARE, hot: int = HOT) -> DataFrame:
    """Candidate pairs (a, b), a < b, of texts of different rank that share segments. stored: postings. A task reads its
    keys sorted, as a stream: of a key that is larger than a batch no more than a batch is held."""

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros(0, np.int64)] * 3
        waiting: list[pa.RecordBatch] = []

        def run(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            now = [np.concatenate([h, *(b.column(k).to_numpy() for b in waiting)]) for k, h in enumerate(held)]
            waiting.clear()
            if not len(now[0]):
                return
            key = now[0] >> _LOW
            # The last key may go on in the next batch, unless it fills all that is held.
            cut = len(key) if last else int(np.searchsorted(key, key[-1]))
            cut = cut or len(key)
            held = [c[cut:] for c in now]
            for x, y, weight in _group_pairs(*(c[:cut] for c in now), hot, max_share):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(weight.astype(np.int32))], names=["a", "b", "weight"])

        for b in batches:
            waiting.append(b)
            if sum(x.num_rows for x in waiting) >= 200_000:
                yield from run(False)
        yield from run(True)

    keyed = stored.repartition(F.shiftright("w", _LOW)).sortWithinPartitions("w")
    pairs = keyed.mapInArrow(pair, "a bigint, b bigint, weight int")
    return pairs.groupBy("a", "b").agg(F.sum("weight").alias("n")).where("n >= 2").select("a", "b")


def likely(pairs: DataFrame, bags: DataFrame, max_share: float = MAX_SHARE) -> DataFrame:
    """The pairs (a, b) that their bags don't rule out. bags: id, len, bag, materialized."""
    held = small(bags).select("id", "len", "bag")
    both = pairs.join(held.toDF("a", "a_len", "a_bag"), "a").join(held.toDF("b", "b_len", "b_bag"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            la, lb = (b.column(c).to_numpy().astype(np.int64) for c in ("a_len", "b_len"))
            limit, apart = (max_share * np.maximum(la, lb) + 1e-9).astype(np.int64), np.abs(la - lb)
            x, y = b.column("a_bag").to_pylist(), b.column("b_bag").to_pylist()
            flips = np.zeros(len(la), np.int64)
            size = np.array([(len(p), len(q)) for p, q in zip(x, y)]).reshape(-1, 2)
            for m, n in np.unique(size, axis=0):
                at = np.nonzero((size == (m, n)).all(axis=1))[0]
                p, q = (_fold(np.frombuffer(b"".join(s[i] for i in at), np.uint8).reshape(len(at), -1), int(min(m, n)) * 8) for s in (x, y))
                flips[at] = _flips(np.ascontiguousarray(p), np.ascontiguousarray(q))
            yield b.select(["a", "b"]).filter(pa.array((apart <= limit) & (flips <= 2 * limit - apart)))

    return both.select("a", "b", "a_len", "b_len", "a_bag", "b_bag").mapInArrow(run, "a bigint, b bigint")


def verified(pairs: DataFrame, rows: DataFrame, row_id: str = "record_id", text: str = "text", max_share: float = MAX_SHARE) -> DataFrame:
    """The pairs (a, b) that are near-same by bounded edit distance over whole texts. pairs: materialized; rows: the table
    the ids come from. Only texts of pairs are moved."""
    ids = materialize(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ids")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([canonical(t) for t in batch.column(1).to_pylist()])], names=["id", "text"])

    held = rows.where(F.col(text).isNotNull()).select(F.col(row_id).alias("row_id"), F.col(text).alias("row_text"))
    held = held.join(small(ids), F.col("row_id") == F.col("id")).select("id", "row_text").mapInArrow(clean, "id bigint, text string").dropDuplicates(["id"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            yield batch.select(["a", "b"]).filter(pa.array(_near(x, y, max_share), pa.bool_()))

    x = held.select(F.col("id").alias("a"), F.col("text").alias("x"))
    y = held.select(F.col("id").alias("b"), F.col("text").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(check, "a bigint, b bigint")


def links(texts: DataFrame, rank: Column, bags: DataFrame, rows: DataFrame, row_id: str = "record_id", text: str = "text", **settings) -> DataFrame:
    """Verified links (a, b) between texts of different rank that share segments, materialized. bags: see likely."""
    tried = materialize(candidates(postings(texts, rank), **settings), "tried")
    return materialize(verified(materialize(likely(tried, bags), "likely"), rows, row_id, text), "links")


def _fold(packed: np.ndarray, bits: int) -> np.ndarray:
    """The parities over fewer bits: those of the halves, combined. A bit is the hash's remainder by a power of two."""
    while packed.shape[1] * 8 > bits:
        half = packed.shape[1] // 2
        packed = packed[:, :half] ^ packed[:, half:]
    return packed


def _flips(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64) ^ y.view(np.uint64)).sum(axis=1, dtype=np.int64)


def _fewer(packed: np.ndarray, bits: int) -> np.ndarray:
    """As _fold, over a power of two of bits or one and a half times one; of the latter only the last third is folded more."""
    while packed.shape[1] * 4 >= bits:
        packed = _fold(packed, packed.shape[1] * 4)
    if packed.shape[1] * 8 <= bits:
        return packed
    half = packed.shape[1] // 2
    return np.concatenate([packed[:, :half], _fold(packed[:, half:], half * 4)], axis=1)


def _enough(most: int, there: int, twos: bool) -> int:
    """Bits, of those that are there, that leave few pairs of unlike texts within most. Pairs of characters of Latin texts
    have much in common, so that more bits are needed for them to differ apart."""
    return next((n for n in SIZES if n >= there or n > TIMES * most or not twos and n / 2 - SURE * n**0.5 > most), SIZES[-1])


class _Side:
    """Texts of a block, in an order that keeps the ranges of a tile small."""

    def __init__(self, table: pa.Table, on: np.ndarray, bits: int):
        table = table.filter(pa.array(on))
        col = lambda c: table.column(c).to_numpy()
        length, letters = col("len").astype(np.int64), col("letters").astype(np.int64)
        share = letters // max(1, int(length.min(initial=MIN_CHARS) * MAX_SHARE / 2))
        alike = pa.compute.binary_length(table.column("twos")).to_numpy() > 0
        self.order = np.lexsort((np.where(share % 2, -length, length), share, alike))  # up and down, as a tile may have two shares
        self.ask, self.answer = (col(c)[self.order] for c in ("ask", "answer"))
        self.place = np.nonzero(on)[0][self.order]  # in the table
        self.about = np.stack([length, letters, col("digits").astype(np.int64)])[:, self.order]
        self.bag, _ = self._folded(table.column("bag").to_pylist(), bits)
        self.twos, self.alike = self._folded(table.column("twos").to_pylist(), bits * TWOS)
        other = int((~alike).sum())  # no tile has texts of both kinds
        self.starts = np.concatenate([np.arange(0, other, TILE), np.arange(other, len(self.place), TILE)])
        self.ends = np.append(self.starts[1:], len(self.place))
        self.low, self.high = (f.reduceat(self.about, self.starts, axis=1) if len(self.place) else self.about for f in (np.minimum, np.maximum))
        self.signs: dict[tuple[int, bool, int, int], np.ndarray] = {}

    def _folded(self, raw: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The bags in a table of as many bits, and which texts have one."""
        raw = [raw[i] for i in self.order]
        size = np.array([len(r) for r in raw])
        out = np.zeros((len(raw), bits // 8), np.uint8)
        for n in np.unique(size[size > 0]):
            at = np.nonzero(size == n)[0]
            out[at] = _fold(np.frombuffer(b"".join(raw[i] for i in at), np.uint8).reshape(len(at), n), bits)
        return out, size > 0

    def multiplied(self, k: int, twos: bool, bits: int, rows: int = 1) -> np.ndarray:
        """The bits of a tile as signs, or so many rows of it in one."""
        key = k, twos, bits, rows
        if key not in self.signs:
            if sum(n // r for _, _, n, r in self.signs) > 1 << 13:
                self.signs.clear()
            few = _fewer((self.twos if twos else self.bag)[self.starts[k] : self.ends[k]], bits)
            signs = np.unpackbits(few, axis=1).astype(np.float32) * 2 - 1
            if rows > 1:
                signs = np.concatenate([signs, np.zeros((-len(signs) % rows, bits), np.float32)])
                signs = sum(signs[r::rows] * np.float32(_apart(bits) ** r) for r in range(rows))
            self.signs[key] = signs
        return self.signs[key]


def _rows(bits: int) -> int:
    """Rows that one row of 24-bit numbers holds, so that their products with signs can be told apart."""
    return 3 if bits <= 128 else 2 if bits <= 1024 else 1


def _apart(bits: int) -> int:
    return 2 * bits + 8


def _above(product: np.ndarray, bits: int, rows: int, least: int, space: tuple[np.ndarray, np.ndarray]) -> Iterator[np.ndarray]:
    """Where the products of each of the rows that were multiplied in one are at least so much. product is used up."""
    for r in range(rows - 1, -1, -1):
        by = float(_apart(bits) ** r)
        part, over = space[0][: len(product)], space[1][: len(product)]
        yield np.flatnonzero(np.greater_equal(product, least * by - by / 2 if r else least, out=over))
        if r:
            np.multiply(product, np.float32(1 / by), out=part)
            np.rint(part, out=part)
            np.multiply(part, np.float32(by), out=part)
            np.subtract(product, part, out=product)


def _tiles(a: _Side, b: _Side, same: bool, max_share: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places (asking, answering) of the pairs that the bags don't rule out, and how many bits differ. same: b is a, and each
    pair comes once."""
    space = np.empty(TILE * TILE, np.float32), np.empty(TILE * TILE, np.float32), np.empty(TILE * TILE, bool)  # new memory for each tile costs more than its use
    for first in range(0, len(b.starts), BESIDE):
        for i in range(len(a.starts)):
            for j in range(max(first, i) if same else first, min(first + BESIDE, len(b.starts))):
                yield from _tile(a, b, i, j, same, max_share, space)


def _tile(a: _Side, b: _Side, i: int, j: int, same: bool, max_share: float, space: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    most = int(max_share * max(a.high[0, i], b.high[0, j]) + 1e-9)
    gaps = np.maximum(a.low[:, i] - b.high[:, j], b.low[:, j] - a.high[:, i])
    if gaps.max() > most:
        return
    # An edit changes two bits of a bag, but one if it changes the length, and there are as many of these as the lengths
    # differ by; of pairs of characters it changes four, or three.
    twos = bool(a.alike[a.starts[i]] and b.alike[b.starts[j]])
    most = (4 if twos else 2) * most - max(0, int(gaps[0]))
    bits = _enough(most, min(MULTIPLIED, 8 * (a.twos if twos else a.bag).shape[1]), twos)
    rows = _rows(bits)
    x, y = a.multiplied(i, twos, bits, rows), b.multiplied(j, twos, bits)
    product = space[0][: len(x) * len(y)]
    np.matmul(x, y.T, out=product.reshape(len(x), len(y)))
    for k, flat in enumerate(_above(product, bits, rows, bits - 2 * most, space[1:])):
        yield from _pairs(a, b, i, j, flat, rows, rows - 1 - k, same, max_share)


def _pairs(a: _Side, b: _Side, i: int, j: int, flat: np.ndarray, rows: int, row: int, same: bool, max_share: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of pairs of a tile, by their places in the products of one of the rows in one, those that nothing rules out."""
    wide = b.ends[j] - b.starts[j]
    for lo in range(0, len(flat), 1 << 17):
        p, q = np.divmod(flat[lo : lo + (1 << 17)], wide)
        p, q = p * rows + row + a.starts[i], q + b.starts[j]
        if rows > 1:
            p, q = p[p < a.ends[i]], q[p < a.ends[i]]
        if same:
            p, q = p[p < q], q[p < q]
        asks, other = a.ask[p] > b.answer[q], b.ask[q] > a.answer[p]
        on = asks | other
        p, q, asks = p[on], q[on], asks[on]
        la, lb = a.about[0, p], b.about[0, q]
        limit = (max_share * np.maximum(la, lb) + 1e-9).astype(np.int64)
        on = np.abs(a.about[:, p] - b.about[:, q]).max(axis=0) <= limit
        p, q, limit, apart, asks = p[on], q[on], limit[on], np.abs(la - lb)[on], asks[on]
        flips = _flips(a.bag[p], b.bag[q])
        on = flips <= 2 * limit - apart
        p, q, limit, apart, asks, flips = p[on], q[on], limit[on], apart[on], asks[on], flips[on]
        on = ~(a.alike[p] & b.alike[q])
        on[~on] = _flips(a.twos[p[~on]], b.twos[q[~on]]) <= (4 * limit - apart)[~on]
        m, n, asks = a.place[p[on]], b.place[q[on]], asks[on]
        if len(m):
            yield np.where(asks, m, n), np.where(asks, n, m), flips[on]


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a column, where those of a row begin, and how many there are: none of a null, as an older index has it."""
    column = pa.compute.fill_null(column, b"")
    n = pa.compute.binary_length(column).to_numpy().astype(np.int64)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8), np.cumsum(n) - n, n


def _begin_alike(heads: tuple[np.ndarray, np.ndarray, np.ndarray], length: np.ndarray, p: np.ndarray, q: np.ndarray, max_share: float) -> np.ndarray:
    """Which pairs of places p, q the beginning of q leaves within the share, as _may_begin has it; pairs whose beginnings aren't
    there, or too few of one size to be worth it, stay. The last row of the table of edit distances of many pairs is filled at once, a word of 64 characters of q and a
    character of p at a time."""
    data, first, there = heads
    words = _words(length[q])
    cut, limit = 64 * words, (max_share * np.maximum(length[p], length[q]) + 1e-9).astype(np.int64)
    last, longer = np.minimum(length[p], cut + limit), length[p] - length[q]
    may = np.ones(len(p), bool)
    able = (cut <= there[q]) & (last <= there[p]) & (there[p] > 0)
    for w in np.unique(words[able]):
        at = np.nonzero(able & (words == w))[0]
        if len(at) < AT_LEAST * w:
            continue
        at = at[np.lexsort((q[at], longer[at] // 16))]  # like differences in length, so that the paths have little to cover
        for lo in range(0, len(at), ABREAST):
            some = at[lo : lo + ABREAST]
            may[some] = _least_edits(data, first[p[some]], first[q[some]], int(w), last[some], longer[some], limit[some]) <= limit[some]
    return may


def _least_edits(data: np.ndarray, x: np.ndarray, y: np.ndarray, words: int, last: np.ndarray, longer: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """The least edits of the 64 * words bytes from y on with any number of bytes, last at most, from x on, and of the
    difference in length of what remains of the two texts, of which the first is longer by so many characters. It is right if
    it is within the limit, else above it: where the places in x and y differ by more than the limit allows, nothing is filled."""
    cut, one, top = 64 * words, _U(1), _U(63)
    before, after = int((limit - longer).max()) // 2 + 1, int((limit + longer).max()) // 2 + 1
    begins, of = np.unique(y, return_inverse=True)
    masks = np.zeros((words, len(begins) * 128), np.uint64)
    row = np.arange(len(begins)) * 128
    for i in range(cut):
        masks[i >> 6, row + data[begins + i]] |= one << _U(i & 63)
    of, n = of * 128, len(x)
    up, down = np.full((words, n), 0xFFFFFFFFFFFFFFFF, np.uint64), np.zeros((words, n), np.uint64)
    rest, end = longer + cut, min(words - 1, before // 64)
    score, least = np.full(n, 64 * (end + 1), np.int64), cut + np.abs(rest)
    vert, diag, rise, fall, eq = (np.empty(n, np.uint64) for _ in range(5))
    for j in range(1, min(int(last.max()), cut + after) + 1):
        at = of + data[np.minimum(x + j - 1, len(data) - 1)]
        plus, minus = one, _U(0)  # above the first word that is filled it rises by one
        if end < words - 1 and 64 * (end + 1) < j + before:
            end += 1
            score += 64
        for w in range(max(0, (j - after - 1) // 64), end + 1):
            u, d = up[w], down[w]
            np.take(masks[w], at, out=eq, mode="clip")
            np.bitwise_or(eq, d, out=vert)
            np.bitwise_or(eq, minus, out=eq)
            np.bitwise_and(eq, u, out=diag)
            np.add(diag, u, out=diag)
            np.bitwise_xor(diag, u, out=diag)
            np.bitwise_or(diag, eq, out=diag)
            np.bitwise_or(diag, u, out=rise)
            np.invert(rise, out=rise)
            np.bitwise_or(rise, d, out=rise)
            np.bitwise_and(u, diag, out=fall)
            entered = plus, minus
            plus, minus = rise >> top, fall >> top
            np.left_shift(rise, one, out=rise)
            np.bitwise_or(rise, entered[0], out=rise)
            np.left_shift(fall, one, out=fall)
            np.bitwise_or(fall, entered[1], out=fall)
            np.bitwise_or(vert, rise, out=u)
            np.invert(u, out=u)
            np.bitwise_or(u, fall, out=u)
            np.bitwise_and(rise, vert, out=d)
        score += plus.view(np.int64)
        score -= minus.view(np.int64)
        if end == words - 1:
            np.minimum(least, np.abs(rest - j) + score, out=least, where=j <= last)
    return least


def _block(table: pa.Table, max_share: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of ids of one block: of texts of side 0 or 2 with those of side 1, and of side 2 with each other. If the table has
    their beginnings, these rule out pairs as well."""
    if not table.num_rows:
        return
    ids, length = table.column("id").to_numpy(), table.column("len").to_numpy().astype(np.int64)
    heads = _flat(table.column("head")) if "head" in table.column_names else None
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def judged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p, q, flips = (np.concatenate(c) for c in zip(*waiting))
        waiting.clear()
        on = _begin_alike(heads, length, p, q, max_share) if heads else np.ones(len(p), bool)
        return ids[p[on]], ids[q[on]], flips[on]

    for got in _left(table, max_share):
        waiting.append(got)
        if sum(len(w[0]) for w in waiting) >= WAITING:
            yield judged()
    if waiting:
        yield judged()


def _left(table: pa.Table, max_share: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of places of one block that the bags don't rule out."""
    side, ask, answer = (table.column(c).to_numpy() for c in ("side", "ask", "answer"))
    bits = int(_bag_bits(table.column("len").to_numpy()).min())
    asks, answers = ask > answer.min(), answer < ask.max()
    kinds = [k for k in (asks & answers, asks & ~answers, answers & ~asks) if k.any()]
    low, high = ([_Side(table, k & on, bits) for k in kinds] for on in (side != 1, side == 1))
    pairs = [(a, b, False) for a in low for b in high]
    if (side == 2).any():
        pairs += [(a, b, a is b) for i, a in enumerate(low) for b in low[i:]]
    for a, b, same in pairs:
        if len(a.place) and len(b.place) and max(a.ask.max() - b.answer.min(), b.ask.max() - a.answer.min()) > 0:
            yield from _tiles(a, b, same, max_share)


def every_candidate(texts: DataFrame, max_share: float = MAX_SHARE) -> DataFrame:
    """All pairs of texts (id, len, ask, answer and ABOUT) that may be near-same and where the ask of one (a) is above the
    answer of the other (b), with the bits that tell their bags apart. No pair within max_share is missed. A band holds lengths
    within max_share of each other, so that a pair is in one band or in neighbouring ones. Bands are cut into parts by hash,
    each written once; a task reads the two parts of a block from the shared folder, for a shuffle would copy each text to
    as many blocks as there are parts beside its own, and disk would grow as the square of the texts."""
    texts = texts.withColumn("band", F.floor(F.log(F.col("len").cast("double")) / F.lit(float(-np.log(1 - max_share - 1e-6)))).cast("int"))
    held = {r.band: r.n for r in texts.groupBy("band").agg(F.count(F.lit(1)).alias("n")).collect()}
    cost = lambda band: 1 + ((1 - max_share - 1e-6) ** -band / COSTLY) ** 4
    cuts = {band: min(n, int(n * cost(band) ** 0.5 // BLOCK) + 1) for band, n in held.items()}
    if not cuts:
        return texts.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0).cast("bigint").alias("flips"))
    known = F.create_map(*(F.lit(x) for pair in cuts.items() for x in pair))
    cols = ["id", "len", *ABOUT, "ask", "answer"]
    parted = texts.withColumn("part", F.pmod(F.xxhash64("id"), known[F.col("band")]).cast("int")).select(*cols, "band", "part")
    files: dict[tuple[int, int], list[str]] = {}
    for path in materialize_parts(parted, "texts", ["band", "part"]):
        files.setdefault(tuple(int(n) for n in re.findall(r"/(?:band|part)=(\d+)", path)), []).append(path)
    work = lambda p, q: int(cost(p[0]) * (held[p[0]] / cuts[p[0]]) * (held[q[0]] / cuts[q[0]]) / (1 + (p == q))) + 1
    blocks = [(p, q) for p in sorted(files) for b in (p[0], p[0] + 1) for q in ((b, k) for k in range(cuts.get(b, 0))) if q >= p and q in files]
    most = min(TASK_PAIRS, max(sum(work(*b) for b in blocks) // 12, TASK_PAIRS // 40))
    tasks: list[tuple[int, list]] = []
    for p, q in blocks:
        n = work(p, q)
        if not tasks or tasks[-1][0] + n > most:
            tasks.append((0, []))
        tasks[-1] = tasks[-1][0] + n, [*tasks[-1][1], (files[p], None if p == q else files[q])]
    todo = [blocks for _, blocks in sorted(tasks, key=lambda t: -t[0])]  # the longest first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for mine, other in (block for batch in batches for i in batch.column(0).to_pylist() for block in todo[i]):
            table = _read(mine, cols, 0 if other else 2)
            for got in _block(pa.concat_tables([table, _read(other, cols, 1)]) if other else table, max_share):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in got], names=["a", "b", "flips"])

    return texts.sparkSession.range(0, len(todo), 1, len(todo)).mapInArrow(run, "a bigint, b bigint, flips bigint")


def _read(paths: list[str], columns: list[str], side: int) -> pa.Table:
    """The columns of files of the shared folder, and the side."""
    tables = []
    for path in paths:
        at, name = pa.fs.FileSystem.from_uri(path)
        with at.open_input_file(name) as f:
            tables.append(pa.parquet.ParquetFile(f).read(columns))
    table = pa.concat_tables(tables)
    return table.append_column("side", pa.array(np.full(table.num_rows, side, np.int32)))


def every_link(texts: DataFrame, rows: DataFrame, row_id: str = "record_id", text: str = "text") -> DataFrame:
    """All verified links (a, b), a < b, between a text and one whose answer is below its ask, materialized."""
    tried = materialize(every_candidate(texts), "every")
    return materialize(verified(tried.select("a", "b"), rows, row_id, text).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "every_link")


def some_link(texts: DataFrame, rows: DataFrame, row_id: str = "record_id", text: str = "text") -> DataFrame:
    """Verified links (a, b) such that every text a that has any, as of every_link, has one. The candidate whose bag is the
    nearest comes first; only texts that it doesn't link are compared with all of theirs. So a text that is near-same to
    thousands costs one comparison."""
    tried = materialize(every_candidate(texts), "every")
    first = materialize(tried.groupBy("a").agg(F.min_by("b", F.struct("flips", "b")).alias("b")), "nearest")
    found = materialize(verified(first, rows, row_id, text), "found")
    rest = tried.select("a", "b").join(small(found).select("a"), "a", "left_anti").join(small(first), ["a", "b"], "left_anti")
    return found.union(materialize(verified(materialize(rest, "rest"), rows, row_id, text), "others"))
