"""Font coverage: what a font's tables say, and which texts it can't set."""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch

FONT_SCHEMA = "path string, family string, style string, num_glyphs int, units_per_em int, codepoints array<int>, advances array<int>, error string"


class FontError(ValueError):
    pass


def _tables(data: bytes) -> dict[str, bytes]:
    if len(data) < 12:
        raise FontError("too short for a font")
    count = struct.unpack(">H", data[4:6])[0]
    out = {}
    for i in range(count):
        tag, _, at, size = struct.unpack(">4sIII", data[12 + 16 * i : 28 + 16 * i])
        out[tag.decode("latin-1")] = data[at : at + size]
    return out


def _cmap(table: bytes) -> dict[int, int]:
    """Code point to glyph of the widest Unicode subtable, formats 4 and 12."""
    n = struct.unpack(">H", table[2:4])[0]
    best, rank = None, -1
    for i in range(n):
        platform, encoding, at = struct.unpack(">HHI", table[4 + 8 * i : 12 + 8 * i])
        kind = struct.unpack(">H", table[at : at + 2])[0]
        score = {12: 2, 4: 1}.get(kind, -1) if platform in (0, 3) else -1
        if score > rank:
            best, rank = at, score
    if best is None or rank < 0:
        return {}
    out: dict[int, int] = {}
    if rank == 2:
        groups = struct.unpack(">I", table[best + 12 : best + 16])[0]
        for g in range(groups):
            first, last, glyph = struct.unpack(">III", table[best + 16 + 12 * g : best + 28 + 12 * g])
            out.update((cp, glyph + cp - first) for cp in range(first, last + 1))
        return out
    segments = struct.unpack(">H", table[best + 6 : best + 8])[0] // 2
    read = lambda offset, sign="H": struct.unpack(f">{segments}{sign}", table[best + offset : best + offset + 2 * segments])
    ends, starts = read(14), read(16 + 2 * segments)
    deltas, ranges = read(16 + 4 * segments, "h"), read(16 + 6 * segments)
    base = best + 16 + 6 * segments
    for k in range(segments):
        for cp in range(starts[k], min(ends[k], 0xFFFE) + 1):
            if ranges[k]:
                at = base + 2 * k + ranges[k] + 2 * (cp - starts[k])
                glyph = struct.unpack(">H", table[at : at + 2])[0] if at + 2 <= len(table) else 0
                glyph = (glyph + deltas[k]) & 0xFFFF if glyph else 0
            else:
                glyph = (cp + deltas[k]) & 0xFFFF
            if glyph:
                out[cp] = glyph
    return out


def _name(table: bytes, wanted: int) -> str | None:
    count, start = struct.unpack(">HH", table[2:6])
    for i in range(count):
        platform, _, _, name, size, at = struct.unpack(">6H", table[6 + 12 * i : 18 + 12 * i])
        if name == wanted:
            raw = table[start + at : start + at + size]
            return raw.decode("utf-16-be" if platform in (0, 3) else "latin-1", "replace")
    return None


def read_font(data: bytes) -> dict:
    try:
        t = _tables(data)
        cmap = _cmap(t["cmap"])
        glyphs = struct.unpack(">H", t["maxp"][4:6])[0]
        wide = struct.unpack(">H", t["hhea"][34:36])[0]
        advance = [struct.unpack(">H", t["hmtx"][4 * i : 4 * i + 2])[0] for i in range(wide)]
        em = struct.unpack(">H", t["head"][18:20])[0]
    except (KeyError, struct.error) as e:
        raise FontError(f"not a readable font: {e}") from e
    points = sorted(cmap)
    widths = [advance[min(cmap[cp], wide - 1)] for cp in points]
    return {"family": _name(t["name"], 1), "style": _name(t["name"], 2), "num_glyphs": glyphs, "units_per_em": em, "codepoints": points, "advances": widths}


def scan_fonts(files: DataFrame) -> DataFrame:
    """A row per font file of a ``binaryFile`` scan; unreadable ones have an error."""

    def run(batches):
        for pdf in batches:
            rows = []
            for path, data in zip(pdf["path"], pdf["content"]):
                try:
                    rows.append({"path": path, **read_font(data), "error": None})
                except FontError as e:
                    rows.append({"path": path, "family": None, "style": None, "num_glyphs": 0, "units_per_em": 0, "codepoints": [], "advances": [], "error": str(e)})
            yield pd.DataFrame(rows)

    return files.select("path", "content").mapInPandas(run, FONT_SCHEMA)


def coverage(fonts: DataFrame) -> DataFrame:
    return fonts.select("path", F.explode("codepoints").alias("codepoint"))


def codepoints(text: Column) -> Column:
    return F.transform(F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")), lambda c: F.ascii(c))


def uncovered(tokens: DataFrame, covered: DataFrame, token: str = "token") -> DataFrame:
    """(token, font, missing) for the fonts that lack a character of the token.

    covered: font, chars array<string>.  The distinct characters of all tokens are held
    against each font first; on the driver that is at most one entry a code point and a
    font of the recipe.  A token then costs one look at its characters a font.
    """
    # Read twice: once for the characters, once for the tokens.
    tokens = Scratch(tokens.sparkSession, "uncovered").write(tokens.select(token))
    letters = {r[0] for r in tokens.select(F.explode(F.array_distinct(F.split(F.col(token), ""))).alias("c")).distinct().collect()} - {""}
    lists = []
    for r in covered.collect():
        known = letters & set(r["chars"])
        if known < letters:
            rest = F.translate(F.col(token), "".join(sorted(known)), "") if known else F.col(token)
            lists.append(F.struct(F.lit(r["font"]).alias("font"), rest.alias("rest")))
    if not lists:
        return tokens.select(token, F.lit("").alias("font"), F.array().cast("array<string>").alias("missing")).where("false")
    each = tokens.select(token, F.explode(F.filter(F.array(*lists), lambda x: x["rest"] != "")).alias("lack"))
    missing = F.array_sort(F.array_distinct(F.filter(F.split("lack.rest", ""), lambda c: c != "")))
    return each.select(token, "lack.font", missing.alias("missing"))


def coverage_counts(texts: Column, chars: Column) -> Column:
    unique = F.array_distinct(F.filter(F.split(texts, ""), lambda c: c != ""))
    return F.struct(F.size(F.array_intersect(unique, chars)).alias("covered"), F.size(unique).alias("total"), F.array_sort(F.array_except(unique, chars)).alias("missing"))
