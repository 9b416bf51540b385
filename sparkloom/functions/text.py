"""Column functions over text, hashes and URLs. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.split sees it, as a class that Java and RE2 both read.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# Tokens and ends of sentences.
TOKEN = r"[a-z0-9]+|[\x{4e00}-\x{9fff}]"
SENTENCE_END = r"[。！？!?;\n]+"
#: Characters that misread text is full of. Fixed values.
GARBLED = "ÃÂåæçïðþ¤�"


def is_falsy(c: Column, kind: str) -> Column:
    """Null, empty or zero, by kind: string, number, boolean, array or map."""
    test = {"string": lambda: c == "", "number": lambda: c == 0, "boolean": lambda: ~c, "array": lambda: F.size(c) == 0, "map": lambda: F.size(c) == 0}[kind]()
    return c.isNull() | test


def is_blank(c: Column) -> Column:
    """Null or the empty string; zero is a value."""
    return c.isNull() | (c.cast("string") == "")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def dedup_form(c: Column) -> Column:
    """Lower case with white space collapsed; null as the empty text."""
    return F.lower(collapse(F.coalesce(c, F.lit(""))))


def tokens(c: Column) -> Column:
    """Runs of Latin letters and digits, and single CJK characters, of the lower-cased text."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"({TOKEN})"), F.lit(1))


def sentences(c: Column, least: int = 4) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), SENTENCE_END), strip), lambda s: F.length(s) >= least)


def line_count(c: Column) -> Column:
    """Lines as Python's splitlines counts them: an end of line at the end starts none."""
    ends = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
    whole = F.regexp_replace(F.coalesce(c, F.lit("")), ends, "\n")
    return F.when(whole == "", 0).otherwise(F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + F.when(whole.endswith("\n"), 0).otherwise(1)).cast("int")


def occurrences(c: Column, part: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(f"\\Q{part}\\E"))


def garbled(c: Column, share: float = 0.03) -> Column:
    """Empty, or more than the share of characters that misread text is full of."""
    t = F.coalesce(c, F.lit(""))
    hits = F.length(t) - F.length(F.translate(t, GARBLED, ""))
    return F.when(t == "", True).otherwise(hits / F.length(t) > share)


def content_hash(c: Column) -> Column:
    return F.md5(F.coalesce(c, F.lit("")))


def normal_hash(c: Column) -> Column:
    return F.md5(dedup_form(c))


def url(c: Column) -> Column:
    """Trimmed, with https for a URL that begins with two slashes; null as the empty text."""
    t = strip(F.coalesce(c, F.lit("")))
    return F.when(t.startswith("//"), F.concat(F.lit("https:"), t)).otherwise(t)


def url_path(c: Column) -> Column:
    """The path of a URL, empty if there is none."""
    return F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def image_like(c: Column) -> Column:
    """A web address whose path ends like an image's or names one."""
    path = F.lower(url_path(c))
    return c.rlike("^https?://") & (path.rlike(r"\.(jpg|jpeg|png|webp|gif|bmp)$") | path.rlike(r"img/|image|byteimg"))


def file_extension(c: Column, content_type: Column | None = None) -> Column:
    """By content type, else by the path's ending; .image counts as .jpg and what is unknown as .bin."""
    kinds = {"image/jpeg": ".jpg", "image/jpg": ".jpg", "image/png": ".png", "image/webp": ".webp", "image/gif": ".gif", "image/bmp": ".bmp"}
    end = F.lower(F.regexp_extract(url_path(c), r"(\.[A-Za-z0-9]+)$", 1))
    by_path = F.when(end == ".image", ".jpg").when(end.isin(".jpg", ".jpeg", ".png", ".webp", ".gif", ".bmp"), end).otherwise(".bin")
    if content_type is None:
        return by_path
    kind = F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))
    return F.coalesce(*(F.when(kind == k, v) for k, v in kinds.items()), by_path)


def stable_id(*parts: Column) -> Column:
    """16 hexadecimal digits of a hash over the parts; nulls are empty parts."""
    return F.substring(F.sha1(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))), 1, 16)


def hash_split(identifier: Column, val: float = 0.1, test: float = 0.1) -> Column:
    """train, val or test by the first 32 bits of a hexadecimal identifier."""
    place = F.conv(F.substring(identifier, 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)
    return F.when(place < test, "test").when(place < val + test, "val").otherwise("train")


def clamp(c: Column, default: float = 0.0) -> Column:
    """Between 0 and 1; what is no number is the default."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(c.try_cast("double"), F.lit(default))))


def series_ids(html: Column) -> Column:
    """Numbers of series pages linked in a page, each once."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"/auto/series/(\d+)"), F.lit(1)))


_ISO = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|z|[+-]\d{2}(:?\d{2})?)?$"


def instant(text: Column) -> Column:
    """Microseconds since 1970 of a time as written, or null. Digits only are milliseconds; no zone means UTC."""
    t = F.regexp_replace(text, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    zoned = F.when(t.rlike(r"([Zz]|[+-]\d{2}(:?\d{2})?)$") & t.rlike(r"[T ]\d{2}:\d{2}"), t).otherwise(F.concat(t, F.lit("Z")))
    zoned = F.regexp_replace(F.regexp_replace(F.upper(zoned), ",", "."), r"([+-]\d{2})(\d{2})$", "$1:$2")
    zoned = F.regexp_replace(zoned, r"(T| )(\d{2}:\d{2})(Z|[+-])", "$1$2:00$3")
    iso = F.when(t.rlike(_ISO), F.unix_micros(zoned.try_cast("timestamp")))
    return F.when(t.rlike(r"^\d{1,18}$"), t.try_cast("bigint") * 1000).otherwise(iso)


def next_data(html: Column) -> Column:
    """The JSON that a page carries in its __NEXT_DATA__ script, null if it has none."""
    found = F.regexp_extract(F.coalesce(html, F.lit("")), r"""(?s)<script[^>]*\bid=["']__NEXT_DATA__["'][^>]*>(.*?)</script>""", 1)
    return F.when(found != "", found)
