"""The audit log: reading, filtering, tail, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION = 1
FIELDS = ("timestamp", "recipe_name", "recipe_sha", "output_dir", "count", "seed", "workers", "rendered", "skipped", "runtime_seconds")


def read_log(lines: DataFrame, value: str = "value", line_no: str = "line_no") -> tuple[DataFrame, DataFrame]:
    """(entries, unknown versions with their counts) of a log's lines.

    A line that isn't a JSON object fails the read; a missing version is version 1, and a
    version that is a string or a truth value is unknown.
    """
    v = F.try_parse_json(value)
    kind = F.schema_of_variant(v)
    broken = v.isNull() | ~kind.startswith("OBJECT")
    checked = lines.where(F.trim(F.col(value)) != "").withColumn(
        value, F.when(broken, F.raise_error(F.concat(F.lit("audit log: not a JSON object in line "), F.col(line_no).cast("string")))).otherwise(F.col(value))
    )
    version = F.try_variant_get(F.try_parse_json(value), "$.schema_version", "variant")
    type_ = F.schema_of_variant(version)
    known = version.isNull() | ((type_ == "BIGINT") & (F.try_variant_get(F.try_parse_json(value), "$.schema_version", "long") == VERSION))
    text = lambda name: F.get_json_object(value, f"$.{name}")
    entries = checked.where(known).select(line_no, *[text(c).alias(c) for c in FIELDS])
    unknown = checked.where(~known).groupBy(F.to_json(version).alias("version")).agg(F.count(F.lit(1)).alias("n")).orderBy("version")
    return entries, unknown


def select_runs(runs: DataFrame, since: str | None = None, until: str | None = None, sha: str | None = None) -> DataFrame:
    """Inclusive bounds on the time stamp as text; a prefix of the recipe's digest in
    either case.  Plain comparisons, so that a columnar log prunes by them."""
    if since is not None:
        runs = runs.where(F.col("timestamp") >= since)
    if until is not None:
        runs = runs.where(F.col("timestamp") <= until)
    if sha:
        runs = runs.where(F.lower("recipe_sha").startswith(sha.lower()))
    return runs


def tail(runs: DataFrame, n: int, order: str = "line_no") -> DataFrame:
    """The last ``n`` rows in file order: a bounded top-n, then the order again."""
    return runs.orderBy(F.desc(order)).limit(n).orderBy(order)


def whole(value: str) -> Column:
    return F.coalesce(F.col(value).try_cast("bigint"), F.lit(0))


def summary(runs: DataFrame) -> DataFrame:
    runtime = F.col("runtime_seconds").try_cast("double")
    return runs.agg(
        F.count(F.lit(1)).alias("runs"),
        *[F.coalesce(F.sum(whole(c)), F.lit(0)).cast("long").alias(f"total_{c}") for c in ("count", "rendered", "skipped")],
        F.coalesce(F.round(F.sum(runtime), 2), F.lit(0.0)).alias("total_runtime"),
        F.count_distinct("recipe_name").cast("long").alias("recipes"),
        F.count_distinct("recipe_sha").cast("long").alias("shas"),
        F.min("timestamp").alias("first_run"),
        F.max("timestamp").alias("last_run"),
    )


def top_shas(runs: DataFrame, n: int = 3, shown: int = 12) -> DataFrame:
    counts = runs.where("recipe_sha is not null").groupBy("recipe_sha").agg(F.count(F.lit(1)).alias("runs"))
    return counts.orderBy(F.desc("runs"), F.asc("recipe_sha")).limit(n).select(F.substring("recipe_sha", 1, shown).alias("sha"), "runs")


SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in FIELDS[:4]]
    + [T.StructField(c, T.LongType()) for c in FIELDS[4:9]]
    + [T.StructField("runtime_seconds", T.DoubleType()), T.StructField("schema_version", T.IntegerType())]
)
