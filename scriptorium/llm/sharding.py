"""Sharding by a two-pass external shuffle.

Pass one scatters the records into memory-sized buckets by a seeded hash of id and text;
pass two reads each bucket into memory, shuffles it by Fisher-Yates with a generator
seeded by (seed, bucket) and writes it.  A record's place in the shuffled whole is its
bucket's start plus its place in the bucket; place p goes to shard p mod n, slot p div n.
So the shards' numbers of rows are at most one apart: the law is ``rows``.

The buckets' starts are running sums over a table of counts; each bucket's start travels
to the bucket's task as a row ahead of its records, so that neither the driver nor a
task's closure holds a table that grows with the input.  A bucket is one task's while
there are at most ``MOST_TASKS`` of them.

Defined results
---------------
* size is the UTF-8 length plus one; a null text has size 1 and the checksum of nothing.
* rows with equal ids are told apart by their text; equal rows are interchangeable.
* rows without an id, and the rows of a bucket that many equal rows overfill, are numbered
  in a written table and scattered by that number.
* a text larger than a bucket's share makes one large bucket, which holds it once.
* an empty table gives an empty result; extra columns are kept, whatever their names;
  where the input has ``shard`` or ``slot``, the new columns take leading underscores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch, column_of

LAW = "rows"
#: Buckets at least, so that no task holds more than a small share of the records.
LEAST_BUCKETS = 96
MOST_TASKS = 1 << 16
#: A bucket of this many times its share is overfull; buckets whose sums are taken together.
OVERFULL, SPAN = 4, 4096


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """The permutation: for i from n-1 down to 1, swap i with a drawn j <= i."""
    order = np.arange(n)
    draws = np.random.Generator(np.random.PCG64([seed, bucket])).random(n)
    picks = (draws * np.arange(1, n + 1)).astype(np.int64).tolist()
    out = order.tolist()
    for i in range(n - 1, 0, -1):
        j = picks[i]
        out[i], out[j] = out[j], out[i]
    return np.array(out, dtype=np.int64)


def _shuffle(seed: int, shards: int):
    """Rows (bucket, start, columns of the input), sorted by bucket, a row with only the
    bucket's start ahead of its records."""

    def flush(bucket: int, start: int, rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(rows).drop_columns(["bucket", "start"])
        order = fisher_yates(whole.num_rows, seed, bucket)
        place = start + np.arange(whole.num_rows)
        for at in range(0, whole.num_rows, 2048):
            p = place[at : at + 2048]
            part = whole.take(pa.array(order[at : at + 2048])).append_column("shard", pa.array((p % shards).astype("int32"))).append_column("slot", pa.array(p // shards))
            yield from part.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current, start = [], None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(ids)) + 1).tolist(), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if ids[a] != current:
                    if held:
                        yield from flush(current, start, held)
                    held, current, start = [], int(ids[a]), batch.column(1)[a].as_py()
                    a += 1
                if a < b:
                    held.append(batch.slice(a, b - a))
        if held:
            yield from flush(current, start, held)

    return run


def _starts(dealt: DataFrame, scratch: Scratch) -> DataFrame:
    """(bucket, start): the number of rows in all buckets before."""
    sizes = scratch.write(dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "sizes")
    span = F.floor(F.col("bucket") / SPAN).cast("int").alias("span")
    spans = sizes.groupBy(span).agg(F.sum("n").alias("m"))  # one row for SPAN buckets
    spans = spans.select("span", F.coalesce(F.sum("m").over(W.orderBy("span").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    inner = F.coalesce(F.sum("n").over(W.partitionBy("span").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return sizes.select("bucket", "n", span).select("bucket", "span", inner.alias("inner")).join(spans, "span").select("bucket", (F.col("first") + F.col("inner")).alias("start"))


def shard(docs: DataFrame, shards: int = 8, seed: int = 20, bucket_bytes: int = 16 << 20, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with columns ``shard`` (int) and ``slot`` (long), in shuffled order."""
    scratch = Scratch(docs.sparkSession, "shards")
    named = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    ident, body = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text))
    bytes_of = F.coalesce(F.octet_length(body), F.lit(0)) + 64
    total, unnamed = named.agg(F.sum(bytes_of), F.sum(ident.isNull().cast("long"))).first()
    buckets = max(LEAST_BUCKETS, math.ceil((total or 0) / bucket_bytes))
    scatter = lambda *by: F.pmod(F.xxhash64(F.lit(seed), *by), F.lit(buckets)).cast("int").alias("bucket")
    columns = named.columns
    dealt = named.where(ident.isNotNull()).select(scatter(ident, body), *columns)
    share = max(bucket_bytes, (total or 0) / buckets)
    sizes = dealt.groupBy("bucket").agg(F.sum(bytes_of).alias("bytes"), F.count(F.lit(1)).alias("n"))
    full = scratch.write(sizes.where((F.col("bytes") > OVERFULL * share) & (F.col("n") > 1)).select("bucket"), "full")
    again = [] if full.isEmpty() else [dealt.join(full, "bucket", "left_semi").select(*columns)]
    if again:
        dealt = dealt.join(full, "bucket", "left_anti").select("bucket", *columns)
    if unnamed:
        again.append(named.where(ident.isNull()))
    for rows in again:
        numbered = scratch.write(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
        dealt = dealt.unionByName(numbered.select(scatter(F.lit("row"), F.col("row")), *columns))
    heads = _starts(dealt, scratch).select("bucket", "start", *[F.lit(None).cast(named.schema[c].dataType).alias(c) for c in columns])
    rows = heads.unionByName(dealt.select("bucket", F.lit(None).cast("long").alias("start"), *columns))
    tasks = min(buckets, MOST_TASKS)
    rows = rows.repartitionById(tasks, F.pmod(F.col("bucket"), F.lit(tasks)).cast("int"))
    rows = rows.sortWithinPartitions("bucket", F.col("start").desc_nulls_last(), ident, F.xxhash64(*columns))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema)
    out = rows.mapInArrow(_shuffle(seed, shards), f"{fields}, shard int, slot bigint")
    return out.toDF(*docs.columns, column_of(docs, "shard"), column_of(docs, "slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 8, seed: int = 20) -> None:
    """Writes the shuffled records with their slots, one folder for each shard."""
    out = shard(docs, shards, seed)
    out.write.partitionBy(out.columns[-2]).parquet(path)


def shard_digests(docs: DataFrame, shards: int = 8, seed: int = 20) -> DataFrame:
    out = shard(docs.select("doc_id", "text"), shards, seed)
    return out.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
