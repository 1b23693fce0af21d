"""Shared plumbing: table reads, scratch tables in the shared folder, constants."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..scratch import Scratch

__all__ = ["SPACE", "SPACE_BYTES", "Scratch", "column_of", "give_back", "giving_back", "table"]

#: White space of the word and line contracts, as a regex class body.
SPACE = r"\x20\x09-\x0D"
#: The same characters for ``bytes.strip``.
SPACE_BYTES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column_of(df: DataFrame, base: str) -> str:
    """``base`` or, where the input already has that column, a free variant of it."""
    names = {c.lower() for c in df.columns}
    out = base
    while out.lower() in names:
        out = f"_{out}"
    return out


def give_back() -> None:
    """Gives free memory back to the machine.

    A worker of Spark outlives its task and its stage, and both Arrow and the C library keep
    what was freed for the process's own later use: beside the executor's JVM it counts as taken.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # a C library without malloc_trim
        ctypes.CDLL(None).malloc_trim(0)


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, a function for mapInArrow, after whose last batch the worker gives memory back."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task
