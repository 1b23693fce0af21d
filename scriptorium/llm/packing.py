"""Best-fit packing of documents into sequences of at most ``capacity`` tokens.

Documents are encoded where they are read; only (id, lengths, checksums) are dealt into
packing groups.  Within a group, pieces arrive in a hashed order and go to the open bin
with the least free space that holds them: bins hang in lists by their free space, and
one bit of an integer says whether a list has bins.  At most ``open_bins`` are open; when
one more is needed, the fullest closes.

A document longer than ``capacity`` is cut: its first piece takes the remainder, the
others are full.  A full piece is a sequence by itself.

Defined results
---------------
* null text counts as empty: one piece of one token (the end token, id 0).
* rows with equal or null ids are packed one by one (pieces carry their own row's id).
* a very long text becomes many pieces, still in one task's memory once.
* an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back
from .tokens import PieceCache, slices

_PIECE = "doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"


#: Pieces that are encoded as one text; such texts in one call.
JOINED, GROUPS = 128, 16


def json_encoder(path: str):
    """Encodes distinct pieces with the ``tokenizers`` library, one thread.

    The library's cost a call is that of a dozen pieces, so that pieces are joined: one that
    begins with a single space and has no white space at its ends may follow another,
    since no match of the pattern crosses there.  The ids are parted again by the bytes
    that each stands for; a joined text that can't be parted is encoded piece by piece.
    """
    import os
    from array import array

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    # A special token's string may hold a space: texts with one are encoded whole.
    special = [t.content for t in tok.get_added_tokens_decoder().values()]
    size = np.zeros(max(tok.get_vocab().values(), default=0) + 1, np.int64)
    for name, i in tok.get_vocab(with_added_tokens=False).items():
        size[i] = len(name)  # byte-level names have a character for each byte
    joinable = all(" " not in t for t in special)

    def alone(pieces: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in tok.encode_batch_fast(pieces, add_special_tokens=False)]

    def parted(pieces: list[str], ids: list[int]) -> list[bytes] | None:
        ends = np.cumsum([len(p.encode("utf-8", "surrogatepass")) for p in pieces])
        at = np.cumsum(size[ids])
        cuts = np.searchsorted(at, ends)
        if len(at) != cuts[-1] + 1 or (at[cuts] != ends).any():
            return None
        raw, out, start = array("I", ids).tobytes(), [], 0
        for cut in ((cuts + 1) * 4).tolist():
            out.append(raw[start:cut])
            start = cut
        return out

    def encode(pieces: list[str]) -> list[bytes]:
        fits = [joinable and len(p) > 1 and p[0] == " " and not p[1].isspace() and not p[-1].isspace() for p in pieces]
        found = dict.fromkeys(pieces)
        several = [p for p, ok in zip(pieces, fits) if ok]
        groups = [several[k : k + JOINED] for k in range(0, len(several), JOINED)]
        rest = [p for p, ok in zip(pieces, fits) if not ok]
        for k in range(0, len(groups), GROUPS):  # the library's results take some 100 bytes a token
            some = groups[k : k + GROUPS]
            for group, e in zip(some, tok.encode_batch_fast(["".join(g) for g in some], add_special_tokens=False)):
                parts = parted(group, e.ids)
                if parts is None:
                    rest += group
                else:
                    found.update(zip(group, parts))
        found.update(zip(rest, alone(rest)))
        return [found[p] for p in pieces]

    return encode, special


_workers: dict[str, tuple] = {}


def _encoder(path: str) -> tuple[PieceCache, list[str], object]:
    if path not in _workers:
        encode, special = json_encoder(path)
        _workers[path] = (PieceCache(encode), special, encode)
    return _workers[path]


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: the remainder first, then full ones."""
    first = n % capacity
    return [first] * (first > 0) + [capacity] * (n // capacity)


def _encode(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, special, whole = _encoder(path)
        end = np.zeros(1, "<u4").tobytes()
        for big in batches:
            for batch in slices(big, 1):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                ids = cache.encode_texts(["" if any(s in t for s in special) else t for t in texts])
                index, piece, start, length, crc = [], [], [], [], []
                for i, (t, b) in enumerate(zip(texts, ids)):
                    if t and not b:
                        b = whole([t])[0]
                    b += end
                    done = 0
                    for k, n in enumerate(piece_lengths(len(b) // 4, capacity)):
                        index.append(i), piece.append(k), start.append(done), length.append(n)
                        crc.append(zlib.crc32(b[4 * done : 4 * (done + n)]))
                        done += n
                arrays = [batch.column(0).take(pa.array(index, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                yield pa.record_batch(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32"])
                del texts, ids, arrays
                give_back()

    return run


class BestFit:
    """Bounded-space online best fit; ``place`` returns (bin number, offset)."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins, self.mask, self.n_open, self.made = capacity, open_bins, 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        b = bins.pop()
        if not bins:
            self.mask ^= 1 << free
        self.n_open -= 1
        return b

    def place(self, size: int) -> tuple[int, int]:
        fits = self.mask >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = self._take(free)
        else:
            free, b, self.made = self.capacity, self.made, self.made + 1
            if size < self.capacity and self.n_open >= self.open_bins and self.mask:  # the fullest closes
                self._take((self.mask & -self.mask).bit_length() - 1)
        left = free - size
        if left:
            if not self.by_free[left]:
                self.mask |= 1 << left
            self.by_free[left].append(b)
            self.n_open += 1
        return b, self.capacity - free


def _pack(capacity: int, open_bins: int):
    """Rows sorted by group; one group's bins are held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, fit = None, None
        for batch in batches:
            seq, off = [], []
            for g, n in zip(batch.column(5).to_pylist(), batch.column(3).to_pylist()):
                if g != group:
                    group, fit = g, BestFit(capacity, open_bins)
                b, o = fit.place(n)
                seq.append((g << 40) | b), off.append(o)
            yield pa.record_batch([*batch.columns[:5], pa.array(seq, pa.int64()), pa.array(off, pa.int64())], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, open_bins: int = 2048, group_pieces: int = 131_072, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The number of groups follows the number of documents, so that each group fills many
    thousands of sequences and leaves few of them open at its end; a task packs many groups,
    one after the other.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    pieces = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(_encode(tokenizer, capacity), _PIECE.format(kind=kind))
    groups = max(1, math.ceil(docs.count() / group_pieces))
    order = F.xxhash64("doc_id", "piece", "length", "ids_crc32")
    dealt = pieces.withColumn("g", F.pmod(order, F.lit(groups))).repartition("g")
    dealt = dealt.sortWithinPartitions("g", F.xxhash64(F.lit(1), order), "doc_id", "piece")
    out = _PIECE.format(kind=kind) + ", sequence_id bigint, offset bigint"
    return dealt.mapInArrow(_pack(capacity, open_bins), out)
