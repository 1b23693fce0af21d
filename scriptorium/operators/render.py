"""Rendering: words, lines, paragraphs and pages with nested boxes, in Arrow batches.

A sample is a pure function of (seed, index, text, style); what can't be set becomes a
row with a reason, never a failed task.  Text is set unshaped, by the fonts' advances.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .images import Outlines, StageError, degrade, png_encode, rasterize, registered
from .tokenize import LINE_ENDS

BOX = "struct<x0:int,y0:int,x1:int,y1:int>"
BOXES = f"array<struct<text:string,bbox:{BOX}>>"
COLUMNS = {
    "index": "bigint", "text": "string", "status": "string", "reason": "string", "message": "string", "missing": "array<string>", "font_path": "string", "font_size_pt": "double", "dpi": "int",
    "ink": "array<int>", "background": "array<int>", "width": "int", "height": "int", "bbox": BOX, "glyphs": f"array<struct<cluster:int,bbox:{BOX}>>",
    "word_boxes": BOXES, "line_boxes": BOXES, "paragraph_boxes": BOXES, "image": "binary",
}
SCHEMA = ", ".join(f"{c} {kind}" for c, kind in COLUMNS.items())
MODES = ("word_crops", "lines", "paragraphs", "pages")


class RenderError(ValueError):
    pass


class MissingGlyph(RenderError):
    def __init__(self, missing: list[str]):
        super().__init__("characters without a glyph: " + ", ".join(f"U+{ord(c):04X}" for c in missing))
        self.missing = [f"U+{ord(c):04X}" for c in missing]


def union(boxes: Iterable[tuple]) -> tuple[int, int, int, int] | None:
    b = list(boxes)
    return (min(x[0] for x in b), min(x[1] for x in b), max(x[2] for x in b), max(x[3] for x in b)) if b else None


def moved(box: tuple, dx: int, dy: int) -> tuple[int, int, int, int]:
    return (box[0] + dx, box[1] + dy, box[2] + dx, box[3] + dy)


class Face:
    """A font at one pixel size, with its glyphs' coverage kept."""

    def __init__(self, outlines: Outlines, pixels: int):
        self.o, self.pixels, self.scale = outlines, pixels, pixels / outlines.em
        self.ascent = round(outlines.ascent * self.scale)
        self.height = round((outlines.ascent - outlines.descent) * self.scale)
        self.held: dict[str, tuple] = {}

    def glyph(self, char: str) -> tuple[np.ndarray, int, int]:
        if char not in self.held:
            self.held[char] = rasterize(self.o.contours(self.o.cmap[ord(char)]), self.scale)
        return self.held[char]

    def missing(self, text: str, spaces: bool) -> list[str]:
        return sorted({c for c in text if ord(c) not in self.o.cmap and (spaces or not c.isspace())})

    def width(self, text: str) -> float:
        return sum(self.advance(c) for c in text)

    def advance(self, char: str) -> float:
        return self.o.advance(char if ord(char) in self.o.cmap else " ") * self.scale


def wrap_words(face: Face, text: str, budget: int | None, indent: int = 0) -> list[str]:
    """Greedy filling by width; a word longer than the line stands alone."""
    out: list[str] = []
    for word in text.split():
        joined = f"{out[-1]} {word}" if out else word
        room = None if budget is None else budget - (indent if len(out) <= 1 else 0)
        if out and (room is None or face.width(joined) <= room):
            out[-1] = joined
        else:
            out.append(word)
    return out


def set_line(face: Face, text: str, extra: list[int] | None = None) -> dict:
    """Coverage of one line with its glyphs and words; the pen starts at 0, the base line
    at the face's ascent.  ``extra`` widens the spaces of a justified line."""
    if not text.strip() or "\n" in text or "\r" in text:
        raise RenderError("a line is blank or holds a line end")
    pen, spaces, placed = 0.0, 0, []
    for cluster, char in enumerate(text):
        if not char.isspace():
            cover, left, top = face.glyph(char)
            placed.append((cluster, cover, round(pen) + left, face.ascent + top))
        elif extra and spaces < len(extra):
            pen += extra[spaces]
            spaces += 1
        pen += face.advance(char)
    inked = [p for p in placed if p[1].size]
    glyphs = [(c, (x, y, x + m.shape[1], y + m.shape[0])) for c, m, x, y in inked]
    words, at = [], 0
    for word in text.split():
        start = text.index(word, at)
        at = start + len(word)
        box = union(b for c, b in glyphs if start <= c < at)
        if box:
            words.append((word, box))
    return {"ink": inked, "glyphs": glyphs, "words": words, "box": union(b for _, b in glyphs), "advance": round(pen), "text": text}


def _paint(lines: list[tuple[dict, int, int]], style: dict, pad: int, canvas: tuple[int, int] | None) -> tuple[np.ndarray, int, int]:
    boxes = [moved(x["box"], dx, dy) for x, dx, dy in lines if x["box"]]
    if not boxes:
        raise RenderError("nothing has ink")
    b = union(boxes)
    w, h = (b[2] - b[0] + 2 * pad, b[3] - b[1] + 2 * pad)
    if canvas:
        if w > canvas[0] or h > canvas[1]:
            raise RenderError(f"content of {w} x {h} is larger than the page")
        w, h = canvas
    shade = np.zeros((h, w))
    for x, dx, dy in lines:
        for _, m, left, top in x["ink"]:
            px, py = left + dx - b[0] + pad, top + dy - b[1] + pad
            part = shade[py : py + m.shape[0], px : px + m.shape[1]]
            np.maximum(part, m, out=part)
    ink, back = np.array(style["ink"], float), np.array(style["background"], float)
    grey = (ink == ink[0]).all() and (back == back[0]).all()
    image = np.rint(back[0] + (ink[0] - back[0]) * shade if grey else back + (ink - back) * shade[..., None]).astype(np.uint8)
    image = np.repeat(image[..., None], 3, axis=2) if grey else image
    return image, pad - b[0], pad - b[1]


def render(text: str, mode: str, style: dict, face: Face, layout: dict) -> dict:
    """A sample: image, bbox, glyphs, words, lines, paragraphs."""
    missing = face.missing(text, spaces=mode == "word_crops")
    if missing:
        raise MissingGlyph(missing)
    pad, budget = int(style["padding_px"]), layout.get("max_width_px")
    indent, align = int(layout.get("paragraph_indent_px") or 0), layout.get("paragraph_alignment") or "left"
    step = max(1, round(face.height * style.get("line_spacing", 1.2)))
    if mode in ("word_crops", "lines"):
        paragraphs = [[text.strip() if mode == "lines" else text]]
    else:
        blocks = _split(text, r"\n[\s\x1c-\x1f]*\n+") or [text.strip()] if mode == "pages" else [text]
        paragraphs = [wrap_words(face, b, budget, indent) if budget else (_split(b, LINE_ENDS) or [b.strip()]) for b in blocks]
    placed, groups, top = [], [], 0
    for rows in paragraphs:
        made = [set_line(face, r) for r in rows]
        widths = [x["advance"] + (indent if i == 0 else 0) for i, x in enumerate(made)]
        widest, group = max(widths), []
        for i, (x, width) in enumerate(zip(made, widths)):
            left = indent if i == 0 else 0
            slack = widest - width
            gaps = len(x["text"].split()) - 1
            if align == "justify" and i < len(made) - 1 and gaps and slack > 0:
                x = set_line(face, x["text"], [slack // gaps + (k < slack % gaps) for k in range(gaps)])
            elif align == "right":
                left += slack
            elif align == "center":
                left += slack // 2
            placed.append((x, left, top))
            group.append((x, left, top))
            top += step
        groups.append(group)
        top += max(0, round(step * style.get("paragraph_spacing", 1.0))) if mode == "pages" else 0
    image, dx, dy = _paint(placed, style, pad, tuple(layout["page_size_px"]) if mode == "pages" and layout.get("page_size_px") else None)
    line_box = lambda x, a, b: moved(x["box"], a + dx, b + dy)
    inked = [[(x, a, b) for x, a, b in g if x["box"]] for g in groups]
    return {
        "text": text,
        "image": image,
        "background": tuple(style["background"]),
        "bbox": union(line_box(*p) for g in inked for p in g),
        "glyphs": [(c, moved(b, a + dx, t + dy)) for x, a, t in placed for c, b in x["glyphs"]],
        "words": [] if mode == "word_crops" else [(w, moved(b, a + dx, t + dy)) for x, a, t in placed for w, b in x["words"]],
        "lines": [] if mode in ("word_crops", "lines") else [(x["text"], line_box(x, a, b)) for g in inked for x, a, b in g],
        "paragraphs": [] if mode in ("word_crops", "lines") else [("\n".join(x["text"] for x, _, _ in g), union(line_box(*p) for p in g)) for g in inked if g],
    }


def _split(text: str, pattern: str) -> list[str]:
    import re

    return [p.strip() for p in re.split(pattern, text) if p.strip()]


_faces: dict[tuple[str, int], Face] = {}


def _face(path: str, pixels: int, fonts: dict[str, bytes]) -> Face:
    if (path, pixels) not in _faces:
        if len(_faces) > 64:
            _faces.clear()
        _faces[path, pixels] = Face(Outlines(fonts[path]), pixels)
    return _faces[path, pixels]


def render_rows(samples: DataFrame, mode: str, fonts: dict[str, bytes], layout: dict | None = None, stages: list[dict] | None = None, seed: int = 0, columns: list[str] | None = None) -> DataFrame:
    """samples (index, text, style) -> ``SCHEMA``, or those of its columns that are named.

    ``fonts`` holds the recipe's font files, a few and of known size, for the workers.  Each
    sample is drawn and degraded whatever the columns; what no column holds isn't encoded.
    """
    if mode not in MODES:
        raise ValueError(f"layout mode {mode!r} is unknown")
    layout, stages, names = layout or {}, stages or [], columns or list(COLUMNS)
    known = registered([s["kind"] for s in stages])

    def one(index: int, text: str, style: dict) -> dict:
        row = dict.fromkeys(COLUMNS)
        row |= {"index": index, "text": text, "font_path": style["font_path"], "font_size_pt": style["font_size_pt"], "dpi": style["dpi"], "ink": list(style["ink"]), "background": list(style["background"])}
        box = lambda b: dict(zip(("x0", "y0", "x1", "y1"), b))
        try:
            pixels = max(1, round(style["font_size_pt"] * style["dpi"] / 72))
            sample = render(text, mode, style, _face(style["font_path"], pixels, fonts), layout)
        except MissingGlyph as e:
            return row | {"status": "skipped", "reason": "missing_glyph", "message": str(e), "missing": e.missing}
        except (RenderError, KeyError, ValueError) as e:
            return row | {"status": "skipped", "reason": "render_error", "message": str(e)}
        try:
            sample = degrade(sample, stages, np.random.Generator(np.random.PCG64([seed & 0x7FFFFFFF, index])), known)
        except (StageError, ValueError, TypeError) as e:
            return row | {"status": "skipped", "reason": "degradation_error", "message": str(e)}
        boxes = lambda kind: [{"text": t, "bbox": box(b)} for t, b in sample[kind]]
        h, w = sample["image"].shape[:2]
        made = {
            "bbox": lambda: box(sample["bbox"]), "glyphs": lambda: [{"cluster": c, "bbox": box(b)} for c, b in sample["glyphs"]],
            "word_boxes": lambda: boxes("words"), "line_boxes": lambda: boxes("lines"), "paragraph_boxes": lambda: boxes("paragraphs"), "image": lambda: png_encode(sample["image"]),
        }
        return row | {"status": "rendered", "width": w, "height": h} | {c: make() for c, make in made.items() if c in names}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 64):
                part = pdf.iloc[at : at + 64]
                rows = [one(int(i), t, s if isinstance(s, dict) else s.asDict()) for i, t, s in zip(part["index"], part["text"], part["style"])]
                yield pd.DataFrame(rows, columns=names).astype({c: "Int32" for c in ("width", "height") if c in names})

    return samples.select("index", "text", "style").mapInPandas(run, ", ".join(f"{c} {COLUMNS[c]}" for c in names))
