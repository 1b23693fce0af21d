"""Published rows: labels with their manifest record, flattened and sparse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import basename
from .stats import last_by_key


def staged_rows(labels: DataFrame, manifest: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """labels (file_name, text) with the last manifest record of the image's name.

    manifest: image, line_no and the columns to carry; labels whose file isn't in
    ``files`` are left out (``missing_labels`` names them).
    """
    if files is not None:
        labels = labels.join(files, "file_name", "left_semi")
    named = manifest.withColumn("file_name", basename(F.col("image"))).drop("image")
    last = last_by_key(named, ["file_name"], "line_no").drop("line_no")
    return labels.join(last, "file_name", "left")


def missing_labels(labels: DataFrame, files: DataFrame) -> DataFrame:
    return labels.join(files, "file_name", "left_anti").select("file_name")


def sparse_json(*columns: Column) -> Column:
    """A JSON object in which null and empty lists are left out, not written."""
    return F.to_json(F.struct(*columns))


def metadata_json(rows: DataFrame) -> DataFrame:
    stages = F.when(F.size("degradations") > 0, F.col("degradations"))
    return rows.select("file_name", sparse_json(F.col("file_name"), F.col("text"), F.col("font"), F.col("font_size_pt"), stages.alias("degradations"), F.col("corpus")).alias("json"))


def required_keys(front: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, problem) of the required keys that front matter (key, value) lacks or leaves
    empty."""
    hits = keys.join(front, "key", "left")
    there = front.select("key").withColumn("there", F.lit(True))
    both = hits.join(there, "key", "left")
    empty = F.col("value").isNull() | F.trim("value").isin("", "[]", "{}")
    return both.select("key", F.when(F.col("there").isNull(), "missing").when(empty, "empty").alias("problem")).where("problem is not null").distinct()


def publish_state(local: DataFrame, remote: DataFrame) -> DataFrame:
    """new, same or changed for each repository: local (repo, sha), remote (repo, sha)."""
    r = remote.select("repo", F.col("sha").alias("remote_sha"))
    state = F.when(F.col("remote_sha").isNull(), "new").when(F.col("remote_sha") == F.col("sha"), "same").otherwise("changed")
    return local.join(r, "repo", "left").select("repo", state.alias("state"))


def name_issues(used: DataFrame, known: DataFrame) -> DataFrame:
    """Configured names that no registry has."""
    return used.join(known, "name", "left_anti")
