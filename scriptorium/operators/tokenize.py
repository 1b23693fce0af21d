"""Tokenizers: one text to many words, lines, paragraphs or pages."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import PY_SPACE, PY_WORD

MODES = ("word_crops", "lines", "paragraphs", "pages")
#: Where ``str.splitlines`` splits.
LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
PARAGRAPH_END = rf"(?U)\n{PY_SPACE}*\n+"
PAGE_END = rf"(?U)\n{PY_SPACE}*\n{PY_SPACE}*\n+"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)\A{PY_SPACE}+|{PY_SPACE}+\z", "")


def _parts(text: Column, end: str) -> Column:
    return F.filter(F.transform(F.split(text, end, -1), strip), lambda p: p != "")


def words(text: Column) -> Column:
    """Runs without white space, less the punctuation at both edges; none empty."""
    runs = F.regexp_extract_all(text, F.lit(f"((?U){PY_WORD}+)"), F.lit(1))
    return F.filter(F.transform(runs, lambda w: F.regexp_replace(w, r"\A\p{P}+|\p{P}+\z", "")), lambda w: w != "")


def lines(text: Column) -> Column:
    return _parts(text, LINE_ENDS)


def paragraphs(text: Column) -> Column:
    return _parts(text, PARAGRAPH_END)


def pages(text: Column) -> Column:
    return _parts(text, PAGE_END)


def tokens_of(text: Column, mode: str) -> Column:
    try:
        return {"word_crops": words, "lines": lines, "paragraphs": paragraphs, "pages": pages}[mode](text)
    except KeyError:
        raise ValueError(f"layout mode {mode!r} is unknown; known are {', '.join(MODES)}") from None


def tokenize(df: DataFrame, mode: str, text: str = "text", pos: str = "pos", token: str = "token") -> DataFrame:
    """A row per token, in order within its text."""
    return df.select("*", F.posexplode(tokens_of(F.col(text), mode)).alias(pos, token)).drop(text)


def page_paragraphs(page: Column) -> Column:
    """A page's paragraphs; a page without any is its own."""
    found = paragraphs(page)
    return F.when(F.size(found) > 0, found).otherwise(F.array(strip(page)))


def paragraph_lines(paragraph: Column) -> Column:
    found = lines(paragraph)
    return F.when(F.size(found) > 0, found).otherwise(F.array(strip(paragraph)))


def page_lines(page: Column) -> Column:
    """A page as paragraphs of lines."""
    return F.transform(page_paragraphs(page), paragraph_lines)


def word_spans(text: Column) -> Column:
    """(text, start, end) of each run without white space, by code points.

    Runs with and without white space, less those with it.  Only the runs' lengths go through
    Arrow, for running sums: a fold would copy the list with each run, and words as Python
    objects take some hundred bytes each.
    """
    runs = F.regexp_extract_all(text, F.lit(f"((?U){PY_WORD}+|{PY_SPACE}+)"), F.lit(1))
    placed = F.zip_with(runs, _running(F.transform(runs, F.length)), lambda r, e: F.struct(r.alias("text"), (e - F.length(r)).alias("start"), e.alias("end")))
    return F.filter(placed, lambda x: x["text"].rlike(rf"(?U)\A{PY_WORD}"))


def _running(sizes: Column) -> Column:
    """Running sums of each array."""

    def part(lists: pa.Array) -> pa.Array:
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        stops = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        sums = np.concatenate([[0], np.cumsum(lists.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)])
        own = (sums[1:] - np.repeat(sums[stops[:-1]], counts)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(own), mask=lists.is_null())

    @F.arrow_udf("array<int>")
    def run(lists: pa.Array) -> pa.Array:
        return pa.concat_arrays([part(lists.slice(at, 256)) for at in range(0, len(lists), 256)] or [part(lists)])

    return run(sizes)
