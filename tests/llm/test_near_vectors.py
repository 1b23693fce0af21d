"""Operator 6 against brute force: one cell or many, chunks, repeated and missing ids."""

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
from scriptorium.llm import embed  # noqa: E402


def _rows():
    rng = np.random.default_rng(9)
    free = rng.normal(size=(260, 24))
    tight = rng.normal(size=24) + 0.02 * rng.normal(size=(120, 24))  # a dense group that no cut parts
    ladder = [rng.normal(size=24)]
    for _ in range(60):
        ladder.append(ladder[-1] + 0.14 * rng.normal(size=24))
    vectors = np.concatenate([free, tight, np.array(ladder)]).astype("float32").tolist()
    rows = [(i, v, i % 3 // 2) for i, v in enumerate(vectors)]
    rows += [(5, vectors[300], 0), (5, [-0.0] + vectors[300][1:], 0), (5, [0.0] + vectors[300][1:], 0), (None, vectors[301], 0), (None, vectors[2], 1), (None, vectors[2], 1), (None, None, 1)]
    return rows


def _brute(rows):
    good = [k for k, (_, v, l) in enumerate(rows) if v is not None and l is not None]
    x = np.array([rows[k][1] for k in good], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([rows[k][2] for k in good])
    linked = (x @ x.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(linked, False)
    out = [(i, 0, i, True) for i, _, _ in rows]
    left = set(range(len(good)))
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            a = todo.pop()
            group.add(a)
            near = set(np.flatnonzero(linked[a]).tolist()) & left
            left -= near
            todo += near
        ids = [rows[good[a]][0] for a in group if rows[good[a]][0] is not None]
        least = min(ids) if ids else None
        for a in group:
            i = rows[good[a]][0]
            out[good[a]] = (i, int(linked[a].sum()), least, i == least)
    return out


def _key(r):
    return tuple((x is not None, x if x is not None else 0) for x in r)


@pytest.mark.parametrize("cell_rows,most", [(8192, 32768), (16, 20), (4, 1000)])
def test_cells_and_chunks(spark, cell_rows, most):
    rows = _rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = [tuple(r) for r in embed.NearVectors(df, cell_rows=cell_rows, most=most).run().collect()]
    assert sorted(got, key=_key) == sorted(_brute(rows), key=_key)


def test_bit_sets_leave_few_candidates():
    near = embed.Near(0.98, 8, 8192, 32768, 7)
    rng = np.random.default_rng(1)
    y = near.turn(rng.normal(size=(600, 64)))
    met = sum(len(near.candidates(y[:, a:b], y[:, a:b], near.share(a, b, 64) ** 0.5)[0]) - len(y) for a, b in embed.blocks_of(64, 8))
    assert met < 0.02 * len(y) * (len(y) - 1)


def test_turn_is_the_same_in_any_batch():
    near = embed.Near(0.98, 8, 8192, 32768, 7)
    x = np.random.default_rng(2).normal(size=(50, 64))
    assert (near.turn(x)[7:9] == near.turn(x[7:9])).all()
