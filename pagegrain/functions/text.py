"""Scalar text rules as column expressions; offsets count code points and span ends are inclusive."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space for all rules here: ASCII and the no-break space, spelled so that other engines read it alike.
WS = r"[\s\x{a0}]"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    """Without white space at both ends; null stays null."""
    return F.regexp_replace(_c(x), rf"^{WS}+|{WS}+$", "")


def squeeze_out(x: Column | str) -> Column:
    """Without any white space, case kept; null counts as empty."""
    return F.regexp_replace(F.coalesce(_c(x), F.lit("")), f"{WS}+", "")


def squeeze_lower(x: Column | str) -> Column:
    return F.lower(squeeze_out(x))


def collapse(x: Column | str) -> Column:
    """Trimmed, runs of white space to one blank."""
    return strip(F.regexp_replace(_c(x), f"{WS}+", " "))


def normal_title(x: Column | str) -> Column:
    return F.lower(collapse(x))


def n_words(x: Column | str) -> Column:
    """Pieces between white space; null and blank have 0."""
    s = strip(F.coalesce(_c(x), F.lit("")))
    return F.when(s == "", 0).otherwise(F.size(F.split(s, f"{WS}+")))


def span_slice(text: Column | str, start: Column | str, end: Column | str) -> Column:
    """text[start..end], end inclusive and -1 for the last character; starts below 0 count as 0, empty where nothing is left."""
    t, s, e = _c(text), _c(start), _c(end)
    lo = F.greatest(s, F.lit(0))
    past = F.when(e == -1, F.length(t)).otherwise(F.greatest(e + 1, F.lit(0)))
    return F.when(past > lo, F.substring(t, lo + 1, past - lo)).otherwise(F.lit(""))


def token_estimate(x: Column | str) -> Column:
    """A quarter of the length, rounded up, 1 at least."""
    return F.greatest(F.lit(1), F.floor((F.length(F.coalesce(_c(x), F.lit(""))) + 3) / 4)).cast("long")


def first_nonempty(*xs: Column | str) -> Column:
    """The first that is neither null nor empty, else empty."""
    return F.coalesce(*[F.nullif(_c(x), F.lit("")) for x in xs], F.lit(""))


def stable_id(namespace: str, *parts: Column | str) -> Column:
    """sha256 over the namespace and the parts; null and empty parts become the word root."""
    return F.sha2(F.concat_ws("\x1f", F.lit(namespace), *[F.coalesce(F.nullif(_c(p).cast("string"), F.lit("")), F.lit("root")) for p in parts]), 256)


def fuzzy_threshold(length: Column | str) -> Column:
    """Similarity that a fuzzy match of this length needs; null where only exact matches count."""
    n = _c(length)
    return F.when(n <= 10, None).when(n <= 20, 0.99).when(n <= 50, 0.95).when(n <= 100, 0.90).otherwise(0.85)


def preserve_threshold(length: Column | str) -> Column:
    n = _c(length)
    return F.when(n < 30, 100).when(n < 60, 98).otherwise(95)


def hashed_embedding(x: Column | str, dims: int) -> Column:
    """The deterministic stand-in embedding: (length + i + 1) % 97 + 1 + sum of code points % 13, for each i below dims."""
    t = F.coalesce(_c(x), F.lit(""))
    total = F.aggregate(F.when(F.length(t) > 0, F.split(t, "(?!^)")).otherwise(F.array().cast("array<string>")), F.lit(0).cast("long"), lambda a, c: a + F.ascii(c))
    return F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda i: ((F.length(t) + i + 1) % 97 + 1 + total % 13).cast("double"))


def tiny_embedding(x: Column | str) -> Column:
    t = F.coalesce(_c(x), F.lit(""))
    total = F.aggregate(F.when(F.length(t) > 0, F.split(t, "(?!^)")).otherwise(F.array().cast("array<string>")), F.lit(0).cast("long"), lambda a, c: a + F.ascii(c))
    return F.array((F.length(t) + 1).cast("double"), (total % 97 + 1).cast("double"))


def page_of_unit(x: Column | str) -> Column:
    """The page number in a unit id of either generation (doc|p3_t0, p3_c0)."""
    return F.nullif(F.regexp_extract(_c(x), r"(?:^|\|)p(\d+)_", 1), F.lit("")).cast("int")


def unit_of_url(x: Column | str) -> Column:
    """What stands behind the # of a page address, p1_c0 where nothing does."""
    return F.coalesce(F.nullif(F.element_at(F.split(_c(x), "#"), 2), F.lit("")), F.lit("p1_c0")) if x is not None else F.lit("UNKNOWN")


def open_end(x: Column | str) -> Column:
    """Ends of 100,000,000 and more mean the last character, like -1."""
    return F.when(_c(x) >= 100_000_000, -1).otherwise(_c(x))


def data_url(content: Column | str, suffix: Column | str) -> Column:
    """Binary content as a base64 data address by file suffix."""
    mime = F.when(_c(suffix).isin(".jpg", ".jpeg"), "image/jpeg").when(_c(suffix) == ".webp", "image/webp").when(_c(suffix) == ".bmp", "image/bmp").when(_c(suffix).isin(".tif", ".tiff"), "image/tiff").otherwise("image/png")
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.base64(_c(content)))


def progress_bar(done: Column | str, total: Column | str, width: int = 20) -> Column:
    filled = F.when(_c(total) > 0, F.round(_c(done) / _c(total) * width)).otherwise(0).cast("int")
    return F.concat(F.lit("["), F.repeat(F.lit("#"), filled), F.repeat(F.lit("-"), F.lit(width) - filled), F.lit("]"))


def descriptors(title: Column | str, text: Column | str) -> list[Column]:
    """Search descriptors: title tokens, numbers, d/m/y dates, the first 3000 characters."""
    t = F.coalesce(_c(text), F.lit(""))
    return [
        F.filter(F.split(F.lower(F.coalesce(_c(title), F.lit(""))), r"[^\p{L}\p{N}_]+"), lambda w: w != "").alias("title_tokens"),
        F.regexp_extract_all(t, F.lit(r"(\d+(?:\.\d+)?)"), F.lit(1)).alias("numbers"),
        F.regexp_extract_all(t, F.lit(r"(\d{1,2}/\d{1,2}/\d{2,4})"), F.lit(1)).alias("dates"),
        F.substring(t, 1, 3000).alias("excerpt"),
    ]


def occurrences(text: Column | str, needle: Column | str) -> Column:
    """Start offsets of all non-overlapping exact occurrences, left to right; none of an empty needle.

    The text is split at the needle; the offsets are carried along in one pass over the parts.
    """
    t, n = _c(text), _c(needle)
    parts = F.split(t, F.concat(F.lit(r"\Q"), F.replace(n, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")), -1)
    none = F.array().cast("array<int>")
    start = F.struct(F.lit(0).alias("at"), none.alias("found"))
    step = lambda a, p: F.struct((a["at"] + F.length(p) + F.length(n)).alias("at"), F.array_append(a["found"], a["at"] + F.length(p)).alias("found"))
    found = F.aggregate(F.slice(parts, F.lit(1), F.size(parts) - 1), start, step, lambda a: a["found"])
    return F.when(t.isNull() | n.isNull() | (n == "") | (F.size(parts) < 2), none).otherwise(found)


def nearest(starts: Column | str, proposed: Column | str) -> Column:
    """The start closest to the proposed one, the earlier of two; null if there is none."""
    return F.array_min(F.transform(_c(starts), lambda s: F.struct(F.abs(s - _c(proposed)).alias("d"), s.alias("s"))))["s"]


def clip(x: Column | str, chars: int, redact: str | None = None) -> Column:
    """The first so many characters, after what matches ``redact`` has been blotted out; null stays null."""
    t = F.regexp_replace(_c(x), redact, "█") if redact else _c(x)
    return F.substring(t, 1, chars)


def iso_utc(ts: Column | str) -> Column:
    """A timestamp as ISO text in UTC, to the millisecond."""
    return F.concat(F.date_format(F.to_utc_timestamp(_c(ts), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+00:00"))


def zero_of(kind) -> object:
    """The empty value of a Spark type: empty text, list or map, 0, False; a struct has one for each field."""
    from pyspark.sql import types as T

    if isinstance(kind, T.StructType):
        return {f.name: zero_of(f.dataType) for f in kind}
    if isinstance(kind, T.ArrayType):
        return []
    if isinstance(kind, T.MapType):
        return {}
    if isinstance(kind, T.BooleanType):
        return False
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return 0.0
    return 0 if isinstance(kind, T.IntegralType) else "" if isinstance(kind, T.StringType) else None
