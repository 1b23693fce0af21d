"""Line dedup over levelled sorted runs of line keys.

A run is a table of (key digest, number of documents), bucketed by key and sorted by key
within each bucket, so that runs merge bucket by bucket without an exchange or a sort.  A
new batch of documents counts its keys, merge-anti-joins the keys already known to be too
frequent and adds a run of its own at level 0; as soon as a level holds ``fanout`` runs
they are compacted into one run of the next level by outer merge joins.  A key that
reaches ``min_docs`` moves to the closed keys, one run of their own, and needs no more
counting.  At the end, every document loses the lines whose key is closed.

Keys are 128-bit digests of the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends and
with A-Z lower-cased.  A document is a row; it counts once for each of its keys.  Texts
are read twice: once for the keys, which are written, and once to drop the lines.

Defined results
---------------
* null or empty text: one empty line, which is never dropped (keys have one character
  at least); a null text stays null in ``dedup_lines``.
* repeated rows are documents of their own, also when their ids are equal or null; rows
  without an id are told apart by their text when lines are dropped.
* a very long text is one row of keys by batches; no line order is lost.
* an empty table gives an empty result; extra columns are kept, whatever their names.
"""

from __future__ import annotations

import contextlib
import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_BYTES, Scratch, column_of, giving_back

KEY, DOCS = "line_key", "line_docs"
#: Key rows of a bucket, for tables too small for a bucket a shuffle partition.
BUCKET_KEYS = 200_000


def line_key(line: bytes) -> bytes | None:
    """Digest of a line's key; None for a key without characters."""
    key = line.strip(SPACE_BYTES)
    return xxhash.xxh3_128_digest(key.lower()) if key else None


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text's digest where there is no id, batch, key) for every distinct key of each row."""
    for batch in batches:
        rows, keys, digests, room = [], [], [], 0
        missing = batch.column(0).is_null().to_pylist()
        for i, text in enumerate(batch.column(1).to_pylist()):
            own = set(map(line_key, _lines(text))) - {None}
            rows += [i] * len(own)
            keys += own
            digests += [hashlib.md5(text.encode("utf-8", "surrogatepass")).digest() if missing[i] and own else None] * len(own)
            if len(keys) - room >= 100_000 or i == batch.num_rows - 1:
                at = pa.array(rows, pa.int64())
                yield pa.record_batch([batch.column(0).take(at), pa.array(digests, pa.binary()), batch.column(2).take(at), pa.array(keys, pa.binary())], names=["id", "digest", "batch", KEY])
                rows, keys, digests = [], [], []


def keys_of(docs: DataFrame, batches: int = 1, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, digest, batch, line_key); ``batch`` by a hash of the id."""
    kind = docs.schema[id_col].dataType.simpleString()
    part = F.pmod(F.xxhash64(F.col(id_col)), F.lit(batches)).cast("int")
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), part.alias("batch")).mapInArrow(giving_back(_keys), f"id {kind}, digest binary, batch int, {KEY} binary")


@contextlib.contextmanager
def _ordered_scans(spark: SparkSession) -> Iterator[None]:
    """Plans made inside take a bucket's one sorted file for sorted."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class LineRuns:
    """The levelled runs: bucketed tables in the shared scratch folder, known to the
    session's catalog until ``close``."""

    def __init__(self, scratch: Scratch, min_docs: int = 10, fanout: int = 2, buckets: int | None = None):
        self.scratch, self.min_docs, self.fanout = scratch, min_docs, fanout
        self.spark = scratch.spark
        self.buckets = buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.closed: str | None = None
        self.tables: dict[str, str] = {}

    def _save(self, run: DataFrame, label: str) -> str:
        name, path = f"line_{label}_{uuid.uuid4().hex}", self.scratch.next_path(label)
        with _ordered_scans(self.spark):
            run.write.bucketBy(self.buckets, KEY).sortBy(KEY).option("path", path).format("parquet").saveAsTable(name)
        self.tables[name] = path
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"drop table if exists {name}")
        self.scratch.drop(self.tables.pop(name))

    def add(self, keys: DataFrame) -> None:
        """Adds the run of a batch's key rows, one for each document of a key."""
        run = keys.groupBy(KEY).agg(F.count(F.lit(1)).alias(DOCS)).repartition(self.buckets, KEY)
        if self.closed:
            run = run.join(self.spark.table(self.closed).select(KEY).hint("merge"), KEY, "left_anti")
        self._put(0, self._save(run, "run0"))

    def _put(self, level: int, run: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            self.compact(level)

    def merged(self, runs: list[str]) -> DataFrame:
        """The runs' sums, by outer merge joins."""
        out = self.spark.table(runs[0])
        for name in runs[1:]:
            other = self.spark.table(name).select(F.col(KEY).alias("other_key"), F.col(DOCS).alias("other_docs")).hint("merge")
            both = out.join(other, F.col(KEY) == F.col("other_key"), "full")
            out = both.select(F.coalesce(KEY, "other_key").alias(KEY), (F.coalesce(DOCS, F.lit(0)) + F.coalesce("other_docs", F.lit(0))).alias(DOCS))
        return out

    def compact(self, level: int) -> None:
        """Merges all runs of the levels up to ``level`` into one of the next level."""
        old = [p for runs in self.levels[: level + 1] for p in runs]
        if not old:
            return
        for k in range(level + 1):
            self.levels[k] = []
        merged = old[0] if len(old) == 1 else self._save(self.merged(old), "merged")
        enough = self.spark.table(merged).where(F.col(DOCS) >= self.min_docs)
        if self.closed:
            # A closed key meets no new run, so the two hold different keys.
            new = self._save(enough, "new")
            closed = self._save(self.merged([self.closed, new]), "closed")
            self._drop(new)
            self._drop(self.closed)
            self.closed = closed
        else:
            self.closed = self._save(enough, "closed")
        rest = self._save(self.spark.table(merged).where(F.col(DOCS) < self.min_docs), f"run{level + 1}")
        for name in {*old, merged}:
            self._drop(name)
        self._put(level + 1, rest)

    def frequent(self) -> DataFrame:
        """All keys of ``min_docs`` documents or more, as a table that outlives the runs."""
        if sum(map(len, self.levels)) > 1 or not self.closed:
            self.compact(len(self.levels) - 1)
        return self.scratch.write(self.spark.table(self.closed).select(KEY), "frequent")

    def close(self) -> None:
        for name in list(self.tables):
            self._drop(name)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, dropped = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        kept, n, gone = [], [], []
        for text, drop in zip(texts, dropped):
            lines = _lines(text)
            if drop:
                drop = set(drop)
                keep = [x for x in lines if line_key(x) not in drop]
            else:
                keep = lines
            n.append(len(lines))
            gone.append(len(lines) - len(keep))
            kept.append(b"\n".join(keep).decode("utf-8", "surrogatepass"))
        arrays = [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())]
        yield pa.record_batch([*batch.columns[2:], *arrays], names=[*batch.schema.names[2:], "line_n", "line_gone", "line_kept"])


def split_lines(docs: DataFrame, min_docs: int = 10, batches: int = 4, id_col: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with columns line_n, line_gone (numbers of lines) and line_kept (text), as
    the last three, under names with leading underscores where the input has those.

    ``batches`` splits a table that is there as a whole by a hash of the id; a growing
    corpus calls ``LineRuns.add`` with each new batch instead.
    """
    scratch = scratch or Scratch(docs.sparkSession, "linededup")
    keys = scratch.write(keys_of(docs, batches, id_col, text), "keys")
    # The count is read from the files' footers.
    runs = LineRuns(scratch, min_docs, buckets=max(1, min(int(scratch.spark.conf.get("spark.sql.shuffle.partitions")), -(-keys.count() // BUCKET_KEYS))))
    try:
        for i in range(batches):
            runs.add(keys.where(F.col("batch") == i))
        frequent = runs.frequent()
    finally:
        runs.close()
    per_doc = keys.join(frequent, KEY, "left_semi").groupBy("id", "digest").agg(F.collect_set(KEY).alias("line_drop"))
    named = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    ident, body = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text))
    own = F.when(ident.isNull(), F.unhex(F.md5(body)))
    joined = named.join(per_doc, ident.eqNullSafe(F.col("id")) & own.eqNullSafe(F.col("digest")), "left").select(body.alias("line_text"), "line_drop", *named.columns)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema)
    out = joined.mapInArrow(giving_back(_apply), f"{fields}, line_n bigint, line_gone bigint, line_kept string")
    return out.toDF(*docs.columns, *[column_of(docs, c) for c in ("line_n", "line_gone", "line_kept")])


def dedup_lines(docs: DataFrame, min_docs: int = 10, batches: int = 4) -> DataFrame:
    """The documents without their frequent lines, with the input's columns; n_chars, if
    there, follows the new text."""
    out = split_lines(docs, min_docs, batches)
    new = F.when(F.col("text").isNull(), F.lit(None)).otherwise(F.col(out.columns[-1]))
    changed = {"text": new}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.coalesce(F.length(new).cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return out.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


def line_digests(docs: DataFrame, min_docs: int = 10, batches: int = 4) -> DataFrame:
    out = split_lines(docs.select("doc_id", "text"), min_docs, batches)
    return out.select("doc_id", F.col("line_n").alias("n_lines"), F.col("line_gone").alias("n_dropped"), F.sha2(F.col("line_kept").cast("binary"), 256).alias("kept_sha256"))


def kept_sha256(lines: Iterable[bytes]) -> str:
    return hashlib.sha256(b"\n".join(lines)).hexdigest()
