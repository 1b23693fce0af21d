"""The tokenizers' cache of pieces: bounded, and kind to frequent pieces."""

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("public_tokenizers")
from scriptorium.llm.tokens import PieceCache, slices  # noqa: E402


def _codes(piece):
    return np.array([ord(c) for c in piece], "<u4").tobytes()


def test_frequent_pieces_stay_and_memory_is_bounded():
    asked = []

    def encode(pieces):
        asked.extend(pieces)
        return list(map(_codes, pieces))

    cache = PieceCache(encode, limit=40)
    for k in range(500):
        text = f"often {k} {k + 0.5}"
        assert cache.encode_texts([text, ""]) == [_codes(text), b""]
        assert len(cache.known) <= 20 and len(cache.before) <= 20
    assert asked.count("often") == 1  # the order of the corpus doesn't push it out
    assert asked.count(" often") <= 1 and len(asked) <= 1002


def test_texts_of_any_spacing():
    cache = PieceCache(lambda pieces: list(map(_codes, pieces)), limit=6)
    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "a b a b", "\n", " \n a", "a \n", "a\tb c", "é é 日 　x", "a b a b"]
    assert cache.encode_texts(texts) == list(map(_codes, texts)) == cache.encode_texts(texts)


def test_slices_by_bytes_and_rows():
    batch = pa.record_batch([pa.array(["x" * n if n is not None else None for n in (5, 5, None, 30, 1, 1, 1, 9)])], names=["t"])
    parts = [p.column(0).to_pylist() for p in slices(batch, 0, limit=10, rows=3)]
    assert [len(p) for p in parts] == [3, 1, 3, 1] and sum(parts, []) == batch.column(0).to_pylist()
    assert list(slices(batch.slice(0, 0), 0)) == []
