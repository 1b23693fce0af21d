"""URL filters over a sorted digest array.

The 64-bit xxhash keys of all rules, sorted, stand at the head of one file, followed by
the rules' full strings.  The driver writes it into the shared folder, Spark sends it once
to every machine, and tasks memory-map it.  Each url's possible rules (its host's
suffixes with the path prefixes that rules have) are probed by a vectorised binary
search, and every hit is confirmed against the rule's stored string, so that colliding
keys change nothing.

A list above ``max_index_bytes`` is joined as a table instead, with the same results.

A rule (host, path) fits its host and all subdomains if the url's path starts with the
rule's path.  The rule with the longest string wins; between rules of one length, a
blocking one, then the greater string.  A url without a rule gets the method's own
verdict: it isn't listed, so it is allowed.

Defined results
---------------
* null urls and urls without ``://`` have an empty host and path, and are allowed.
* a user or port in the authority stays part of the host; nothing is decoded.
* rules with a null host or path are none; one rule with both verdicts blocks; hosts of
  rules are compared with A-Z lower-cased.
* very long urls are cut only at rule lengths, never dropped; repeated rows are judged
  alike; an empty table or no rules give the method's verdict for every row there is.
* ``judge_urls`` keeps the input's columns and adds host, path, rule and verdict, under
  names with leading underscores where the input already has those.
"""

from __future__ import annotations

import mmap
import os
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, column_of

ALLOW, BLOCK = "allow", "block"
#: (verdict, host, path) of the production filter.
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)


#: Most bytes of a list that is sent to every machine as one file.
MAX_INDEX_BYTES = 256 << 20
_HEAD = struct.Struct("<8sqq")
_MAGIC = b"urlrules"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_AZ = str.maketrans(_UPPER, _LOWER)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_key(host: str, path: str) -> str:
    return f"{host}\x00{path}"


def rank(said: str, blocks: bool) -> tuple:
    """Which of several fitting rules wins: the greatest."""
    return len(said), blocks, said.encode()


class DigestArray:
    """Bytes of a list of rules: a head, the sorted uint64 keys, the strings' starts, one
    verdict byte each, the distinct path lengths, the strings."""

    def __init__(self, data: bytes | mmap.mmap):
        magic, n, m = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a list of url rules")
        at = _HEAD.size
        self.keys = np.frombuffer(data, "<u8", n, at)
        self.starts = np.frombuffer(data, "<u8", n + 1, at + 8 * n)
        self.lengths = np.frombuffer(data, "<u8", m, at + 16 * n + 8).tolist()
        at += 16 * n + 8 + 8 * m
        self.blocks = np.frombuffer(data, "u1", n, at)
        self._data, self._text = data, at + n

    @staticmethod
    def pack(rules: Iterable[tuple[str, str, str]]) -> bytes:
        """The bytes of (verdict, host, path) rules."""
        rows: dict[tuple[str, str], bool] = {}
        for verdict, host, path in rules:
            if host is not None and path is not None:
                key = (host.translate(_AZ), path)
                rows[key] = rows.get(key, False) or verdict == BLOCK
        listed = sorted((xxhash.xxh64_intdigest(rule_key(*k)), rule_key(*k).encode(), v) for k, v in rows.items())
        lengths = sorted({len(path) for _, path in rows})
        starts = np.cumsum([0, *[len(x[1]) for x in listed]]).astype("<u8")
        parts = [_HEAD.pack(_MAGIC, len(listed), len(lengths)), np.array([x[0] for x in listed], "<u8").tobytes(), starts.tobytes(), np.array(lengths, "<u8").tobytes(), bytes(x[2] for x in listed), *[x[1] for x in listed]]
        return b"".join(parts)

    @classmethod
    def mapped(cls, path: str) -> DigestArray:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def string(self, k: int) -> bytes:
        return self._data[self._text + int(self.starts[k]) : self._text + int(self.starts[k + 1])]

    def probe(self, candidates: list[str], keys: np.ndarray | None = None) -> list[int]:
        """Index of the rule equal to each candidate, or -1."""
        out = [-1] * len(candidates)
        if not len(self.keys) or not candidates:
            return out
        if keys is None:
            keys = np.fromiter(map(xxhash.xxh64_intdigest, candidates), "<u8", len(candidates))
        left = np.searchsorted(self.keys, keys, "left")
        for i in np.flatnonzero((left < len(self.keys)) & (self.keys[np.minimum(left, len(self.keys) - 1)] == keys)).tolist():
            k, said = int(left[i]), candidates[i].encode("utf-8", "surrogatepass")
            while k < len(self.keys) and self.keys[k] == keys[i]:
                if self.string(k) == said:
                    out[i] = k
                    break
                k += 1
        return out


def candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    labels = host.split(".") if host else []
    hosts = [".".join(labels[i:]) for i in range(len(labels))]
    return [rule_key(h, path[:n]) for h in hosts for n in lengths if n <= len(path)]


_mapped: dict[str, DigestArray] = {}


def _judge(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _mapped:  # once a worker
            _mapped[name] = DigestArray.mapped(SparkFiles.get(name))
        index = _mapped[name]
        for batch in batches:
            at, names = [], []
            hosts, paths = batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
            for i, (h, p) in enumerate(zip(hosts, paths)):
                own = candidates(h, p, index.lengths)
                at += [i] * len(own)
                names += own
            best: list[tuple | None] = [None] * batch.num_rows
            for i, said, k in zip(at, names, index.probe(names)):
                if k >= 0:
                    found = rank(said.replace("\x00", "", 1), bool(index.blocks[k]))
                    best[i] = found if best[i] is None else max(best[i], found)
            rule = [b and b[2].decode() for b in best]
            verdict = [BLOCK if b and b[1] else ALLOW for b in best]
            yield pa.record_batch([*batch.columns, pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=[*batch.schema.names, "rule", "verdict"])

    return run


def rules_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def judge_urls(pages: DataFrame, rules: DataFrame | Iterable[tuple[str, str, str]] = RULES, url: str = "url", max_index_bytes: int = MAX_INDEX_BYTES) -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``rules``: (verdict, host, path), a table or a list of any size.  A table's size is
    summed up before any of it is brought to the driver.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = list(rules)
        size = sum(len((h or "").encode()) + len((p or "").encode()) + 24 for _, h, p in rules)
        listed = lambda: rules
    else:
        size = rules.agg(F.sum(F.coalesce(F.octet_length("host"), F.lit(0)) + F.coalesce(F.octet_length("path"), F.lit(0)) + 24)).first()[0] or 0
        listed = lambda: rules.select("verdict", "host", "path").collect()
    if size > max_index_bytes:
        return judge_by_join(pages, rules if isinstance(rules, DataFrame) else rules_table(spark, rules), url)
    data = DigestArray.pack(listed())
    path = Scratch(spark, "urlrules").put(f"urlrules-{xxhash.xxh3_128_hexdigest(data)}-{os.urandom(4).hex()}", data)
    spark.sparkContext.addFile(path)
    held, names = _placed(pages, url)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema)
    return held.mapInArrow(_judge(path.rsplit("/", 1)[1]), f"{fields}, rule string, verdict string").toDF(*pages.columns, *names)


def _placed(pages: DataFrame, url: str) -> tuple[DataFrame, list[str]]:
    """The pages' columns under names of our own, with host and path; and the names of the
    four new columns."""
    names = [column_of(pages, c) for c in ("host", "path", "rule", "verdict")]
    held = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(pages.columns)], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    return held, names


def judge_by_join(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The same for a list of any size: candidates joined with the rules' strings.

    Urls are judged once each; the candidates carry no page columns.  The driver sees the
    distinct lengths of the rules' paths, at most as many as the longest has characters.
    """
    listed = rules.where("host is not null and path is not null").select(F.translate("host", _UPPER, _LOWER).alias("h"), F.col("path").alias("p"), F.coalesce(F.col("verdict") == BLOCK, F.lit(False)).alias("b"))
    listed = listed.groupBy("h", "p").agg(F.max("b").alias("b"))
    lengths = F.array(*[F.lit(r[0]) for r in listed.select(F.length("p")).distinct().collect()]).cast("array<int>")
    held, names = _placed(pages, url)
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.filter(lengths, lambda n: n <= F.length("path"))
    tries = held.select("host", "path").distinct().withColumn("h", F.explode(hosts)).withColumn("p", F.explode(F.transform(fits, lambda n: F.substring(F.col("path"), F.lit(1), n))))
    tries = tries.where("h <> ''")
    said = F.concat("h", "p")
    best = tries.join(listed, ["h", "p"]).groupBy("host", "path").agg(F.max(F.struct(F.length(said).alias("n"), "b", said.alias("rule"))).alias("best"))
    out = held.join(best, ["host", "path"], "left")
    return out.select(*[c for c in held.columns], F.col("best.rule").alias("rule"), F.when(F.col("best.b"), BLOCK).otherwise(ALLOW).alias("verdict")).toDF(*pages.columns, *names)
