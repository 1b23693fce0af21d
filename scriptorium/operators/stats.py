"""Counters, histograms, ordered concatenation, content hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: Column, top: int | None = None) -> DataFrame:
    """(value, n), the most frequent first, ties by value; nulls don't count.

    With ``top``, only so many rows, and how many values are left out (``more``).
    """
    counts = df.select(value.alias("value")).where("value is not null").groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    order = [F.desc("n"), F.asc("value")]
    if top is None:
        return counts.orderBy(*order)
    total = counts.agg(F.count(F.lit(1)).alias("all"))
    kept = counts.orderBy(*order).limit(top)
    # One row of one number: a cross join of a proven size.
    return kept.crossJoin(total).select("value", "n", F.greatest(F.col("all") - top, F.lit(0)).alias("more"))


def as_map(counts: DataFrame) -> Column:
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "n"))))


def run_counters(manifest: DataFrame) -> DataFrame:
    n = lambda test: F.count_if(test).cast("long")
    rendered = F.col("status") == "rendered"
    return manifest.agg(F.count(F.lit(1)).alias("planned"), n(rendered).alias("written"), n(F.col("status") == "skipped").alias("skipped"))


def skip_reasons(manifest: DataFrame) -> DataFrame:
    return histogram(manifest.where("status = 'skipped'"), F.coalesce("reason", F.lit("unknown")))


def detection_totals(manifest: DataFrame) -> DataFrame:
    return manifest.agg(*[F.sum(F.coalesce(F.col(f"n_{c}"), F.lit(0))).cast("long").alias(c) for c in ("lines", "words", "paragraphs")])


def unique_tokens(pending: DataFrame, rendered: DataFrame, token: str = "token", approximate: bool = False) -> DataFrame:
    both = pending.select(token).unionByName(rendered.select(token))
    count = F.approx_count_distinct(token) if approximate else F.count_distinct(token)
    return both.agg(count.cast("long").alias("tokens_unique"))


def merged_manifest(old: DataFrame, new: DataFrame, index: str = "index") -> DataFrame:
    """The manifest after a resumed run: one row per index, the new one where there is one.

    Counters come from the merged rows, so that a sample skipped first and rendered later
    counts as rendered only.
    """
    return old.join(new.select(index), index, "left_anti").unionByName(new, allowMissingColumns=True)


def metadata_summary(rows: DataFrame, unparseable: DataFrame | None = None) -> DataFrame:
    """rows, rows without text, distinct fonts, stages and corpora, unparseable lines."""
    stages = F.explode_outer(F.coalesce("degradations", F.array().cast("array<string>")))
    distinct = lambda c: F.count_distinct(c).cast("long")
    blank = F.col("text").isNull() | F.col("text").rlike(r"(?U)\A\s*\z")
    base = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(blank).cast("long").alias("rows_missing_text"), distinct("font").alias("fonts"), distinct("corpus").alias("corpora"))
    staged = rows.select(stages.alias("stage")).agg(distinct("stage").alias("stages"))
    out = base.crossJoin(staged)
    bad = unparseable.agg(F.count(F.lit(1)).alias("unparseable")) if unparseable is not None else None
    return out.crossJoin(bad) if bad is not None else out.withColumn("unparseable", F.lit(0).cast("long"))


def number_class(text: Column) -> Column:
    """Whole and broken sizes count together (14 and 14.0); true and false don't count."""
    return F.when(~F.lower(text).isin("true", "false"), text.try_cast("double"))


def concat_ordered(df: DataFrame, by: list[str], order: str, text: str, sep: str, out: str = "text") -> DataFrame:
    """One text per group, in order; empty parts are left out, an order column is kept
    while the parts travel.  For groups whose text fits in a row; ``ordered_sha`` digests
    groups of any size."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    kept = F.filter(F.transform(parts, lambda p: p["t"]), lambda t: t != "")
    return df.groupBy(*by).agg(F.array_join(kept, sep).alias(out))


def _digest(sep: str) -> Callable:
    """Rows (group, text) sorted by group: one row a group, (group, sha, parts).  A null text is
    no part; a text at a time is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, sha, parts, begun = None, None, 0, False
        row = lambda g: pa.record_batch([g, pa.array([sha.hexdigest()]), pa.array([parts], pa.int64())], names=["g", "sha", "parts"])
        for batch in batches:
            names = batch.column(0).to_pylist()
            for i, text in enumerate(batch.column(1).to_pylist()):
                if not begun or names[i] != group[0].as_py():
                    if begun:
                        yield row(group)
                    group, sha, parts, begun = batch.column(0).slice(i, 1), hashlib.sha256(), 0, True
                if text is not None:
                    sha.update((sep if parts else "").encode() + text.encode("utf-8", "surrogatepass"))
                    parts += 1
        if begun:
            yield row(group)

    return run


def ordered_sha(df: DataFrame, by: str, order: str, text: str, sep: str) -> DataFrame:
    """(by, sha, parts): SHA-256 of each group's texts in order, joined by ``sep``; empty texts
    are left out.  A group's parts pass one task one by one, none is kept."""
    rows = df.select(F.col(by).alias("g"), F.when(F.col(text) != "", F.col(text)).alias("t"), F.col(order).alias("o"))
    rows = rows.repartition("g").sortWithinPartitions("g", "o", "t")
    kind = df.schema[by].dataType.simpleString()
    return rows.select("g", "t").mapInArrow(_digest(sep), f"g {kind}, sha string, parts bigint").withColumnRenamed("g", by)


def content_sha(files: DataFrame, path: str = "path", sha: str = "sha") -> DataFrame:
    """Digest of a tree: ``path``, line end, ``sha``, line end, in byte order of the path.

    A digest is one sequence by definition: the sorted rows pass one task, one by one.
    """
    rows = files.select(F.col(path).alias("p"), F.concat(F.col(path), F.lit("\n"), F.col(sha), F.lit("\n")).alias("t"))
    rows = rows.orderBy("p", "t").select(F.lit(0).alias("g"), "t").coalesce(1)
    found = rows.mapInArrow(_digest(""), "g int, sha string, parts bigint")
    empty = hashlib.sha256().hexdigest()
    return found.agg(F.coalesce(F.max("sha"), F.lit(empty)).alias("content_sha"), F.coalesce(F.max("parts"), F.lit(0)).alias("files"))


def tree_size(files: DataFrame) -> DataFrame:
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("bytes"))


def corpus_totals(entries: DataFrame) -> DataFrame:
    failed = F.col("error").isNotNull()
    return entries.agg(
        F.count(F.lit(1)).alias("entries"), F.count_if(failed).cast("long").alias("failures"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("chars")
    )


def last_by_key(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last row of each key; combined before the shuffle, so that a hot key is cheap."""
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max(F.struct(F.col(order).alias("_order"), *rest)).alias("best"))
    return best.select(*key, *[F.col(f"best.{c}").alias(c) for c in rest]).select(*df.columns)


def first_by_key(df: DataFrame, key: list[str], order: str) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.min(F.struct(F.col(order).alias("_order"), *rest)).alias("best"))
    return best.select(*key, *[F.col(f"best.{c}").alias(c) for c in rest]).select(*df.columns)
