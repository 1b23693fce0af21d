"""Scalar functions: names, sizes, hashes, time stamps, boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Upper bounds (exclusive) of the size classes, with their names.
SIZE_CLASSES = ((1_000, "n<1K"), (10_000, "1K<n<10K"), (100_000, "10K<n<100K"), (1_000_000, "100K<n<1M"), (10_000_000, "1M<n<10M"))
SIZE_REST = "n>10M"
_U64_A, _U64_B = 0x9E3779B1, 0x85EBCA77


def pad(value: Column, width: Column) -> Column:
    """Zeros before ``value`` up to ``width``; a longer value stays whole."""
    text = value.cast("string")
    return F.lpad(text, F.greatest(width, F.length(text)), F.lit("0"))


def pad_width(count: Column) -> Column:
    return F.greatest(F.lit(7), F.length((count - 1).cast("string")))


def image_name(index: Column, width: Column) -> Column:
    return F.concat(pad(index, width), F.lit(".png"))


def page_name(index: Column, width: Column) -> Column:
    return F.concat(F.lit("page_"), pad(index, width), F.lit(".png"))


def preview_name(seed: Column, index: Column) -> Column:
    return F.concat(pad(F.lower(F.hex(seed)), F.lit(8)), F.lit("_"), pad(index, F.lit(6)), F.lit(".png"))


def sample_seed(seed: Column, index: Column) -> Column:
    """The seed of one sample or step: two odd multiples, mixed by exclusive or."""
    return ((seed.cast("long") + 1) * F.lit(_U64_A)).bitwiseXOR(index.cast("long") * F.lit(_U64_B))


def polygon(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(F.array(x0, y0), F.array(x1, y0), F.array(x1, y1), F.array(x0, y1))


def rotate_box(x0: Column, y0: Column, x1: Column, y1: Column, degrees: Column, cx: Column, cy: Column, dx: Column, dy: Column) -> Column:
    """The box around the four corners turned about (cx, cy) and moved by (dx, dy)."""
    c, s = F.cos(F.radians(degrees)), F.sin(F.radians(degrees))
    xs = [cx + (x - cx) * c + (y - cy) * s + dx for x in (x0, x1) for y in (y0, y1)]
    ys = [cy - (x - cx) * s + (y - cy) * c + dy for x in (x0, x1) for y in (y0, y1)]
    whole = lambda v: F.bround(F.round(v, 9), 0).cast("int")
    return F.struct(whole(F.least(*xs)).alias("x0"), whole(F.least(*ys)).alias("y0"), whole(F.greatest(*xs)).alias("x1"), whole(F.greatest(*ys)).alias("y1"))


def pixel_size(pt: Column, dpi: Column) -> Column:
    return F.greatest(F.lit(1), F.bround(pt * dpi / 72, 0).cast("int"))


def codepoint_name(cp: Column) -> Column:
    return F.concat(F.lit("U+"), pad(F.hex(cp), F.lit(4)))


def utc_stamp(text: Column) -> Column:
    """ISO time stamp in UTC with Z, seconds; null for what is no time stamp."""
    return F.date_format(F.try_to_timestamp(F.trim(text)), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def safe_int(value: Column) -> Column:
    return F.coalesce(value.try_cast("bigint"), F.lit(0).cast("bigint"))


def size_class(n: Column) -> Column:
    out = F.when(n.isNull() | (n <= 0), F.lit(None).cast("string"))
    for bound, name in SIZE_CLASSES:
        out = out.when(n < bound, F.lit(name))
    return out.otherwise(F.lit(SIZE_REST))


def human_bytes(n: Column) -> Column:
    # format_number rounds the binary value, as C and Python do; format_string doesn't.
    one = lambda places, unit, name: F.concat(F.replace(F.format_number(n.cast("double") / F.lit(unit), places), F.lit(","), F.lit("")), F.lit(f" {name}"))
    return F.when(n < 1000, F.format_string("%d B", n.cast("long"))).when(n < 1_000_000, one(1, 1e3, "KB")).when(n < 1_000_000_000, one(1, 1e6, "MB")).otherwise(one(2, 1e9, "GB"))


def plain_number(x: Column) -> Column:
    """14.0 is written 14."""
    return F.regexp_replace(x.cast("string"), r"\.0$", "")


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*$", "")


def flag(text: Column) -> Column:
    return F.lower(F.trim(text)).isin("1", "true", "yes", "on")


def is_blank(text: Column) -> Column:
    return text.isNull() | text.rlike(r"(?U)\A[\s\x1c-\x1f]*\z")


def cache_key(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 16))


def safe_filename(key: Column, longest: int = 80, head: int = 60) -> Column:
    """Forbidden characters become ``_``; a changed or long name ends with a digest of the
    key, so that different keys never share a name."""
    clean = F.regexp_replace(key, r"[<>:\x22/\\|?*\x00]", "_")
    short = F.regexp_replace(F.substring(clean, 1, head), r"[._-]+$", "")
    return F.when((clean == key) & (F.length(key) <= longest), key).otherwise(F.concat(short, F.lit("-"), F.substring(F.sha2(key, 256), 1, 16)))


def shortened(text: Column, n: int) -> Column:
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n - 1), F.lit("…"))).otherwise(text)


def corpus_name(value: Column) -> Column:
    """A struct (provider, key) as ``provider:key``, or whichever of the two there is."""
    both = value["provider"].isNotNull() & value["key"].isNotNull()
    return F.when(both, F.concat(value["provider"], F.lit(":"), value["key"])).otherwise(F.coalesce(value["provider"], value["key"]))


def stage_names(stages: Column) -> Column:
    """A list of stages (kind, name) as names: the kind where there is one."""
    return F.filter(F.transform(stages, lambda s: F.coalesce(s["kind"], s["name"])), lambda n: n.isNotNull())


def luminosity(r: Column, g: Column, b: Column) -> Column:
    return 0.299 * r + 0.587 * g + 0.114 * b


def blend(mode: str, base: Column, top: Column) -> Column:
    """Blend modes on channel values in [0, 1]."""
    multiply, screen = base * top, 1 - (1 - base) * (1 - top)
    over = lambda test: F.when(test <= 0.5, 2 * multiply).otherwise(1 - 2 * (1 - base) * (1 - top))
    try:
        return {"multiply": multiply, "screen": screen, "overlay": over(base), "hard_light": over(top)}[mode]
    except KeyError:
        raise ValueError(f"blend mode {mode!r} is unknown") from None
