"""Line and row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tokenize import LINE_ENDS, strip


def filter_lines(text: Column, drop: list[str] | None = None, keep: list[str] | None = None, min_chars: int = 0) -> Column:
    """The lines that no ``drop`` pattern and some ``keep`` pattern finds, of
    ``min_chars`` stripped characters or more; without a rule, the text as it is."""
    if not drop and not keep and min_chars <= 0:
        return text
    kept = F.split(F.regexp_replace(text, rf"({LINE_ENDS})\z", ""), LINE_ENDS, -1)
    kept = F.when(text == "", F.array().cast("array<string>")).otherwise(kept)

    def stays(line: Column) -> Column:
        ok = F.lit(True)
        for pattern in drop or []:
            ok = ok & ~line.rlike(f"(?dU){pattern}")
        if keep:
            some = F.lit(False)
            for pattern in keep:
                some = some | line.rlike(f"(?dU){pattern}")
            ok = ok & some
        return ok & (F.length(strip(line)) >= min_chars) if min_chars > 0 else ok

    rows = F.filter(kept, stays)
    return F.when(F.size(rows) > 0, F.concat(F.array_join(rows, "\n"), F.lit("\n"))).otherwise(F.lit(""))


def present(df: DataFrame, files: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose file is there, and the names that have none."""
    return df.join(files, on, "left_semi"), df.join(files, on, "left_anti").select(on)


def pending(planned: DataFrame, manifest: DataFrame, index: str = "index") -> DataFrame:
    """What a resumed run has still to do: skipped rows are tried again."""
    return planned.join(manifest.where(F.col("status") == "rendered").select(index), index, "left_anti")


def missing_codepoints(text: Column, coverage: Column, spaces_count: bool = False) -> Column:
    """Sorted characters of ``text`` that ``coverage`` (an array) lacks."""
    chars = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    if not spaces_count:
        chars = F.filter(chars, lambda c: ~c.rlike(r"(?U)\A\s"))
    return F.array_sort(F.array_except(chars, coverage))


TRANSIENT = (408, 425, 429, 500, 502, 503, 504)


def is_transient(status: Column) -> Column:
    return status.isin(*TRANSIENT)
