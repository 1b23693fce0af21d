"""Byte-level BPE encoding and decoding.

Texts are split by the tokenizer's pattern; each distinct word of a batch is folded
once: its bytes start as single pieces, and the adjacent pair of the least rank merges
until no pair has a rank.  Ids are the ranks of the pieces that remain.  Decoding
concatenates the binary pieces of the ids.

The fold over distinct words also exists as Spark higher-order functions over a literal
rank map (``fold_words``), with the same ids at some twenty times the cost a word; the query
uses the Arrow form, see the README for figures.

Defined results
---------------
* null or empty text: no ids; the digests are those of no bytes.
* special tokens have no meaning: their strings are ordinary text.
* repeated rows and ids, very long texts: encoded row by row, whole.
* an empty table gives an empty result; extra columns are kept by ``encode`` and
  ``decode``, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column_of, give_back
from .tokens import PieceCache, slices


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: ranked merges folded over its bytes, the leftmost least first."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    get, far, n = ranks.get, len(ranks) + 1, len(word)
    at = list(range(n + 1))  # where the pieces begin; pair[i]: the rank of pieces i and i + 1 as one
    pair = [get(word[i : i + 2], far) for i in range(n - 1)]
    while pair:
        least = min(pair)
        if least == far:
            break
        i = pair.index(least)
        del at[i + 1], pair[i]
        if i < len(pair):
            pair[i] = get(word[at[i] : at[i + 2]], far)
        if i:
            pair[i - 1] = get(word[at[i - 1] : at[i + 1]], far)
    return [ranks[word[a:b]] for a, b in zip(at, at[1:])]


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for words of thousands of bytes, with a heap: n log n instead of n * n."""
    import heapq

    n = len(word)
    end, prev, nxt = [i + 1 for i in range(n)], [i - 1 for i in range(n)], [i + 1 for i in range(n)]
    alive = [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, e = heapq.heappop(heap)
        j = nxt[i] if alive[i] else n
        if not alive[i] or j >= n or end[j] != e:
            continue
        alive[j] = False
        end[i], nxt[i] = e, nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
            if (r := ranks.get(word[i : end[nxt[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[nxt[i]]))
        if prev[i] >= 0 and (r := ranks.get(word[prev[i] : e])) is not None:
            heapq.heappush(heap, (r, prev[i], e))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


_workers: dict[tuple[str, str], tuple] = {}


def worker(path: str, pattern: str) -> tuple[PieceCache, list[bytes]]:
    """This process's cache and the ids' binary pieces."""
    key = (path, pattern)
    if key not in _workers:
        import regex

        ranks, split = load_ranks(path), regex.compile(pattern)
        pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece

        def encode(words: list[str]) -> list[bytes]:
            out = []
            for w in words:
                ids: list[int] = []
                for m in split.findall(w):
                    raw = m.encode("utf-8", "surrogatepass")
                    ids += merge(raw, ranks) if len(raw) < 256 else merge_long(raw, ranks)
                out.append(array("I", ids).tobytes())
            return out

        _workers[key] = (PieceCache(encode), pieces)
    return _workers[key]


def decode_ids(ids: bytes, pieces: list[bytes]) -> bytes:
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _encode(path: str, pattern: str, full: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, pieces = worker(path, pattern)
        for big in batches:
            for batch in slices(big, 0):
                ids = cache.encode_texts([t or "" for t in batch.column(0).to_pylist()])
                rest, names = batch.columns[1:], batch.schema.names[1:]
                if full:
                    lists = [np.frombuffer(x, "<u4").astype(np.int32) for x in ids]
                    yield pa.record_batch([*rest, pa.array(lists, pa.list_(pa.int32()))], names=[*names, "bpe_ids"])
                else:
                    digest = lambda x: hashlib.sha256(x).hexdigest()
                    out = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(digest, ids), pa.string()), pa.array([digest(decode_ids(x, pieces)) for x in ids], pa.string())]
                    yield pa.record_batch([*rest, *out], names=[*names, "n_tokens", "ids_sha256", "decoded_sha256"])
                give_back()

    return run


def _apart(df: DataFrame, first: str) -> tuple[DataFrame, str]:
    """The column ``first``, then all columns under names of our own; and those as a schema."""
    named = df.select(F.col(f"`{first}`").alias("x"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    return named, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema[1:])


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with one more column, the last, an array of ids: bpe_ids or, where the input has
    that, a free variant of the name."""
    named, fields = _apart(docs, text)
    return named.mapInArrow(_encode(path, pattern, True), f"{fields}, bpe_ids array<int>").toDF(*docs.columns, column_of(docs, "bpe_ids"))


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "bpe_ids") -> DataFrame:
    """``encoded`` with one more column, the last, the ids' pieces in one binary: bpe_bytes or a
    free variant.  Null ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, pieces = worker(path, pattern)
        for batch in batches:
            out = [b"".join(map(pieces.__getitem__, x or [])) for x in batch.column(0).to_pylist()]
            yield pa.record_batch([*batch.columns[1:], pa.array(out, pa.binary())], names=[*batch.schema.names[1:], "bpe_bytes"])

    named, fields = _apart(encoded, ids)
    return named.mapInArrow(run, f"{fields}, bpe_bytes binary").toDF(*encoded.columns, column_of(encoded, "bpe_bytes"))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    own = docs.select(F.col("text").alias("x"), "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(_encode(path, pattern, False), f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def fold_words(word: Column, ranks: dict[bytes, int], buckets: int = 4096) -> Column:
    """The fold as higher-order functions, for a binary column of distinct words.

    The literal rank map is an array of small maps, chosen by a hash, since a lookup in a
    Spark map reads its keys one after another.
    """
    import json
    import zlib

    parts: list[dict[str, int]] = [{} for _ in range(buckets)]
    for piece, rank in ranks.items():
        h = piece.hex().upper()
        parts[zlib.crc32(h.encode()) % buckets][h] = rank
    table = F.from_json(F.lit(json.dumps(parts)), "array<map<string,int>>")
    rank = lambda h: F.element_at(F.get(table, F.pmod(F.crc32(h.cast("binary")), F.lit(buckets)).cast("int")), h)
    single = F.filter(F.split(F.regexp_replace(F.hex(word), "(..)", "$1 "), " "), lambda x: x != "")

    def step(acc: Column, _: Column) -> Column:
        pairs = F.zip_with(acc, F.slice(acc, F.lit(2), F.size(acc)), lambda a, b: rank(F.concat(a, b)))
        def merged(found: Column) -> Column:
            least = F.array_min(found)
            at = F.array_position(found, least).cast("int")
            both = F.concat(F.get(acc, at - 1), F.get(acc, at))
            return F.when(least.isNull(), acc).otherwise(F.concat(F.slice(acc, F.lit(1), at - 1), F.array(both), F.slice(acc, at + 2, F.size(acc))))
        return F.element_at(F.transform(F.array(pairs), merged), 1)

    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(single), F.lit(1))), single, step)
    return F.transform(folded, rank)
