"""Byte-level BPE over distinct words, shared by encoding and packing.

Texts are cut before each single space that a word follows; no match of the
tokenizers' pattern crosses such a cut, so that the pieces can be encoded apart and
each distinct one only once.  A worker keeps the ids of a bounded number of pieces, those met last.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Runs in which white space stands at both sides of a space: not cut.
_TIGHT = re.compile(r"\s \s")


#: Pieces that are encoded, and words that are laid out, in one go.
_AT_ONCE, _WORDS = 1 << 14, 1 << 17
_TEXT = pa.large_string()


class _Pieces:
    """Distinct pieces and their ids, end to end: some 40 bytes a piece, where a Python dict
    of strings takes 200."""

    def __init__(self, names: pa.Array, ids: np.ndarray, size: np.ndarray):
        self.names, self.ids, self.size = names, ids, size

    def __len__(self) -> int:
        return len(self.names)

    @classmethod
    def none(cls) -> _Pieces:
        return cls(pa.array([], _TEXT), np.empty(0, "<u4"), np.empty(0, np.int32))

    @classmethod
    def joined(cls, *parts: _Pieces) -> _Pieces:
        return cls(pa.concat_arrays([p.names for p in parts]), np.concatenate([p.ids for p in parts]), np.concatenate([p.size for p in parts]))

    @functools.cached_property
    def begins(self) -> np.ndarray:
        return np.cumsum(self.size, dtype=np.int64) - self.size

    def take(self, at: np.ndarray) -> _Pieces:
        return _Pieces(self.names.take(pa.array(at)), *self.laid(at))

    def laid(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces at these places, one after the other, and how many each has."""
        each = self.size[at]
        out, done = np.empty(each.sum(dtype=np.int64), "<u4"), 0
        for k in range(0, len(at), _WORDS):  # the places of all ids at once take four times their memory
            own = each[k : k + _WORDS]
            ends = np.cumsum(own, dtype=np.int64)
            places = np.repeat(self.begins[at[k : k + _WORDS]] - ends + own, own)
            places += np.arange(len(places))
            out[done : done + len(places)] = self.ids[places]
            done += len(places)
        return out, each


class PieceCache:
    """Ids (as bytes, little-endian uint32) of distinct pieces.

    ``encode`` maps a list of pieces to a list of byte strings.  At most ``limit`` pieces
    are kept, in two generations: when the younger one is half of that, the older one goes
    and the younger takes its place.  Pieces met again move to the younger one, so that
    frequent ones stay, whatever the corpus's order.  A worker outlives its stage, and so
    does the cache: it is held in arrays, and looked up by Arrow.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = 600_000):
        self.encode, self.half = encode, max(1, limit // 2)
        self.known, self.before = _Pieces.none(), _Pieces.none()

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        """Each text's ids.  The words of all texts are numbered in one go by Arrow, looked up
        once each, and laid out by number."""
        out = [b""] * len(texts)
        tight = [bool(t) and _TIGHT.search(t) is not None for t in texts]
        at = [i for i, (t, x) in enumerate(zip(texts, tight)) if t and not x]
        if at:
            split = pc.split_pattern(pa.array([texts[i] for i in at], _TEXT), " ")
            starts = split.offsets.to_numpy()
            coded = split.values.dictionary_encode()
            codes, words = coded.indices.to_numpy().copy(), coded.dictionary
            del split, coded
            # A word has a space ahead of it unless it begins its text.
            first, heads = np.unique(codes[starts[:-1]], return_inverse=True)
            codes[starts[:-1]] = heads + len(words)
            spaced = pc.binary_join_element_wise(pa.scalar(" ", _TEXT), words, pa.scalar("", _TEXT))
            self._lay(out, at, pa.concat_arrays([spaced, words.take(pa.array(first))]), codes, starts)
        at = [i for i, x in enumerate(tight) if x]
        if at:
            apart = [_cut_apart(texts[i]) for i in at]
            coded = pa.array([p for pieces in apart for p in pieces], _TEXT).dictionary_encode()
            self._lay(out, at, coded.dictionary, coded.indices.to_numpy(), np.cumsum([0, *map(len, apart)]))
        return out

    def _lay(self, out: list[bytes], at: list[int], pieces: pa.Array, codes: np.ndarray, starts: np.ndarray) -> None:
        """The ids of the texts ``at``, whose pieces' numbers begin at ``starts``."""
        held, where = self._held(pieces)
        a = 0
        while a < len(at):
            b = max(a + 1, int(np.searchsorted(starts, starts[a] + _WORDS, "right")) - 1)
            laid, each = held.laid(where[codes[starts[a] : starts[b]]])
            cuts = np.cumsum(each, dtype=np.int64)[starts[a + 1 : b + 1] - starts[a] - 1].tolist()
            for i, x, y in zip(at[a:b], [0, *cuts], cuts):
                out[i] = laid[x:y].tobytes()
            a = b

    def _held(self, pieces: pa.Array) -> tuple[_Pieces, np.ndarray]:
        """Pieces, and the places among them of the distinct ``pieces``."""
        old = _Pieces.joined(self.known, self.before)
        where = pc.fill_null(pc.index_in(pieces, value_set=old.names), -1).to_numpy().copy()
        missing = np.flatnonzero(where < 0)
        new = self._encoded(pieces.take(pa.array(missing)))
        where[missing] = len(old) + np.arange(len(missing), dtype=where.dtype)
        held = _Pieces.joined(old, new)
        fresh = held.take(where[where >= len(self.known)][: self.half])
        if len(self.known) + len(fresh) > self.half:
            self.before, self.known = self.known, fresh
        elif len(fresh):
            self.known = _Pieces.joined(self.known, fresh)
        return held, where

    def _encoded(self, pieces: pa.Array) -> _Pieces:
        """Encodes pieces; the empty piece has no ids."""
        ids, sizes = [np.empty(0, "<u4")], [np.empty(0, np.int32)]
        for k in range(0, len(pieces), _AT_ONCE):
            names = pieces.slice(k, _AT_ONCE).to_pylist()
            found = iter(self.encode([p for p in names if p]))
            raw = [next(found) if p else b"" for p in names]
            ids.append(np.frombuffer(b"".join(raw), "<u4"))
            sizes.append(np.array([len(x) // 4 for x in raw], np.int32))
        return _Pieces(pieces, np.concatenate(ids), np.concatenate(sizes))


def slices(batch: pa.RecordBatch, column: int, limit: int = 12 << 20, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most ``limit`` bytes of text (or one row) and ``rows`` rows."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    while at < batch.num_rows:
        held = int(np.searchsorted(np.cumsum(size[at : at + rows]), limit, "right"))
        yield batch.slice(at, max(1, held))
        at += max(1, held)


#: A space between a non-space and a non-space: the only place where a text with
#: runs of white space is cut.
_APART = re.compile(r"(?<=\S)(?= \S)")


def _cut_apart(text: str) -> list[str]:
    return _APART.split(text)
