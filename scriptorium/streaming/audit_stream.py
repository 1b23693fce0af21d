"""Streams over the audit log: the log as a source, windows, idempotent upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import SCHEMA, VERSION


def log_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """New log files as they come; rows of an unknown version are left out."""
    raw = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).json(folder)
    return raw.where(F.coalesce("schema_version", F.lit(VERSION)) == VERSION).withColumn("ts", F.try_to_timestamp("timestamp"))


def runs_by_window(runs: DataFrame, length: str = "1 hour", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Runs, samples and seconds for each window and recipe; late rows within ``late`` count."""
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    counts = runs.withWatermark("ts", late).groupBy(window.alias("w"), "recipe_name")
    out = counts.agg(F.count(F.lit(1)).alias("runs"), F.sum("rendered").alias("rendered"), F.sum("skipped").alias("skipped"), F.sum("runtime_seconds").alias("seconds"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "recipe_name", "runs", "rendered", "skipped", "seconds")


def upsert_by_index(folder: str, index: str = "index"):
    """A ``foreachBatch`` sink: one file set per batch id, so that a batch that runs again
    replaces itself; ``read_upserts`` takes the last row of each index."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{folder}/batch={batch_id:012d}")

    return write


def read_upserts(spark: SparkSession, folder: str, index: str = "index") -> DataFrame:
    from ..operators.stats import last_by_key

    rows = spark.read.option("recursiveFileLookup", "true").parquet(folder)
    return last_by_key(rows, [index], "batch").drop("batch")
