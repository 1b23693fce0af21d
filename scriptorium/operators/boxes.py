"""Geometry: boxes, band and range joins, pen positions, wrapping."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def claim_words(words: DataFrame, lines: DataFrame, page: str = "page") -> tuple[DataFrame, DataFrame]:
    """Each word goes to the first line (by ``line_pos``) whose rows hold the middle of
    the word's, ends included; returns (claimed, unassigned).

    words: page, word_id, y0, y1, ...; lines: page, line_pos, y0, y1.  An equi-join on the
    page keeps the band test within one page.  Both sides are dealt by page: lines are often
    exploded from a small table, and its size, which Spark goes by, doesn't count the rows
    that come out, so that it would broadcast them through the driver.
    """
    words = words.hint("merge")
    w = words.withColumn("mid", F.floor((F.col("y0") + F.col("y1")) / 2))
    band = lines.select(page, F.col("line_pos"), F.col("y0").alias("top"), F.col("y1").alias("bottom")).hint("merge")
    hits = w.join(band, (w[page] == band[page]) & (F.col("top") <= F.col("mid")) & (F.col("mid") <= F.col("bottom"))).drop(band[page])
    first = hits.groupBy(page, "word_id").agg(F.min("line_pos").alias("line_pos"))
    claimed = words.join(first, [page, "word_id"])
    return claimed, words.join(first, [page, "word_id"], "left_anti")


def glyph_words(glyphs: DataFrame, spans: DataFrame, sample: str = "sample") -> DataFrame:
    """Box of each word from its glyphs' clusters, start included and end not; words
    without ink have no row.  glyphs: sample, cluster, x0..y1; spans: sample, word, start, end.
    Dealt by sample, as in ``claim_words``."""
    on = (glyphs[sample] == spans[sample]) & (F.col("start") <= F.col("cluster")) & (F.col("cluster") < F.col("end"))
    return glyphs.join(spans.hint("merge"), on).drop(glyphs[sample]).groupBy(sample, "word").agg(*union_box())


def union_box() -> list[Column]:
    return [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")]


def as_of(points: DataFrame, marks: DataFrame, by: str, at: str, value: str) -> DataFrame:
    """``points`` with the value of the last mark at or before each, by key.

    One union and one window: no band join, so that a key with many marks costs its rows
    once.  Marks with one key and place: the greatest value counts.
    """
    names = points.columns
    left = points.select(F.struct(*names).alias("point"), F.col(by).alias("_by"), F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(marks.schema[value].dataType).alias("_value"))
    right = marks.groupBy(by, at).agg(F.max(value).alias("_value")).select(F.lit(None).cast(left.schema["point"].dataType).alias("point"), F.col(by).alias("_by"), F.col(at).alias("_at"), F.lit(0).alias("_kind"), "_value")
    w = W.partitionBy("_by").orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, 0)
    out = left.unionByName(right).withColumn("_last", F.last("_value", ignorenulls=True).over(w))
    return out.where("_kind = 1").select("point.*", F.col("_last").alias(value))


def pen_positions(glyphs: DataFrame, by: list[str], order: str, advance: str) -> DataFrame:
    """``pen``: the sum of the advances before each glyph."""
    w = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return glyphs.withColumn("pen", F.coalesce(F.sum(advance).over(w), F.lit(0)))


def stack(rows: DataFrame, by: list[str], order: str, height: str, gap: Column, padding: Column) -> DataFrame:
    """``top`` of each row of a page: padding, then heights and gaps above it."""
    w = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("top", (padding + F.coalesce(F.sum(F.col(height) + gap).over(w), F.lit(0))).cast("long"))


def line_tops(padding: Column, advance: Column, position: Column) -> Column:
    return padding + position * advance


def justify_gaps(slack: Column, gaps: Column) -> Column:
    """What each gap gets of the slack: the first ones take the remainder."""
    each, rest = F.floor(slack / gaps), slack % gaps
    return F.when(gaps > 0, F.transform(F.sequence(F.lit(0), gaps.cast("int") - 1), lambda i: (each + (i < rest).cast("int")).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def aligned(width: Column, widest: Column, alignment: str) -> Column:
    """Left edge of a line in a paragraph of that width."""
    try:
        return {"left": F.lit(0), "justify": F.lit(0), "right": widest - width, "center": F.floor((widest - width) / 2)}[alignment]
    except KeyError:
        raise ValueError(f"alignment {alignment!r} is unknown") from None


def wrap(text: Column, budget: Column, first_indent: Column | None = None, space: int = 1, measure: Callable[[str], float] = len) -> Column:
    """Greedy filling: a word goes on the line if it fits, else it starts the next one; a
    word longer than the line stands alone.  Widths come from ``measure``.

    In Arrow batches, linear in the text: a fold of expressions copies what is done with
    every line.
    """

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series, budgets: pd.Series, indents: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else filled(t, b, i, space, measure) for t, b, i in zip(texts, budgets, indents)])

    return run(text, budget, F.lit(0) if first_indent is None else first_indent)


def filled(text: str, budget: float, indent: float, space: float, measure: Callable[[str], float]) -> list[str]:
    lines, line, width, room = [], [], 0, budget - indent
    for word in text.split():
        size = measure(word)
        if line and width + space + size > room:
            lines.append(" ".join(line))
            line, room = [], budget
        width = width + space + size if line else size
        line.append(word)
    return [*lines, " ".join(line)] if line else lines


def shift(boxes: Column, dx: Column, dy: Column) -> Column:
    move = lambda b: F.struct((b["x0"] + dx).alias("x0"), (b["y0"] + dy).alias("y0"), (b["x1"] + dx).alias("x1"), (b["y1"] + dy).alias("y1"))
    return F.transform(boxes, lambda e: F.struct(e["text"].alias("text"), move(e["bbox"]).alias("bbox")))


def bad_lines(lines: Column) -> Column:
    """Whether some line is blank or holds a line end."""
    return F.exists(lines, lambda x: x.isNull() | x.rlike(r"[\n\r]") | x.rlike(r"(?U)\A\s*\z"))
