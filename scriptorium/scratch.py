"""Written intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Folders made inside each open ``Scratch.dropped`` block.
_blocks: list[list[Scratch]] = []


def _local_base() -> str:
    folder = tempfile.mkdtemp(prefix="scriptorium-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


class Scratch:
    """Parquet tables under ``spark.checkpoint.dir`` that cut a plan's lineage.

    Every executor and the driver see that folder, so a lost executor loses no
    intermediate result.  Only where the setting is absent and the master is local
    (tests, a laptop) does the driver's own temporary folder serve instead.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            master = spark.sparkContext.master
            if not (master == "local" or master.startswith("local[")):
                raise RuntimeError("spark.checkpoint.dir must name a folder that the whole cluster shares")
            base = _local_base()
        self.root = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self._n = 0
        for block in _blocks:
            block.append(self)

    def next_path(self, label: str = "t") -> str:
        self._n += 1
        return f"{self.root}/{self._n:04d}-{label}"

    def write(self, df: DataFrame, label: str = "t") -> DataFrame:
        return self.spark.read.schema(df.schema).parquet(self.write_path(df, label))

    def write_path(self, df: DataFrame, label: str = "t") -> str:
        path = self.next_path(label)
        df.write.parquet(path)
        return path

    def read(self, path: str) -> DataFrame:
        return self.spark.read.parquet(path)

    def put(self, name: str, data: bytes) -> str:
        """Writes one small file; its path."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        out = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(hadoop)
        try:
            for at in range(0, len(data), 1 << 20):
                out.write(bytearray(data[at : at + (1 << 20)]))
        finally:
            out.close()
        return f"{self.root}/{name}"

    def drop(self, path: str) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)

    def drop_df(self, df: DataFrame) -> None:
        """Remove a table that ``write`` returned and no later plan reads."""
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if path.startswith((self.root, self.root.replace("file://", "file:"))):
                self.drop(path)

    @staticmethod
    @contextlib.contextmanager
    def dropped() -> Iterator[None]:
        """Removes, at its end, what all scratch folders made inside the block hold: for
        callers that write their result within it."""
        made: list[Scratch] = []
        _blocks.append(made)
        try:
            yield
        finally:
            _blocks.remove(made)
            for scratch in made:
                scratch.drop(scratch.root)
