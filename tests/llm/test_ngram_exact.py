"""Operator 1 against brute force where prefixes of true pairs overlap in part only."""

import random

import pytest

pytest.importorskip("public_tokenizers")
from scriptorium.llm import ngramjoin  # noqa: E402


def _versions():
    """Chains of versions, each with a stretch put in, cut or moved, and texts around passages of them."""
    rng = random.Random(5)
    fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    texts = []
    for _ in range(12):
        now = fresh(rng.randint(60, 160))
        chain = [now]
        for _ in range(7):
            at, now = rng.randrange(len(now)), list(now)
            step = rng.random()
            if step < 0.5:
                now[at:at] = fresh(rng.randint(4, 12))
            elif step < 0.8:
                del now[at : at + rng.randint(4, 12)]
            else:
                now = now[at:] + now[:at]
            chain.append(now)
        for other in range(6):
            source = rng.choice(chain)
            at = rng.randrange(len(source) // 2)
            texts.append(fresh(rng.randint(5, 40)) + source[at : at + rng.randint(20, 60)] + fresh(rng.randint(5, 40)))
        texts += chain
    rng.shuffle(texts)
    return [" ".join(t) for t in texts]


def _components(texts):
    words = [t.split() for t in texts]
    sets = [frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) for w in words]
    up = list(range(len(texts)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                up[max(top(i), top(j))] = min(top(i), top(j))
    return [(i, len(s), top(i)) for i, s in enumerate(sets)]


@pytest.mark.parametrize("copies", [0, 5])
def test_chains_and_shared_passages(spark, copies):
    texts = _versions()
    texts += texts[:4] * copies  # exact copies change no link
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(tuple(r) for r in ngramjoin.ngram_components(docs).collect()) == _components(texts)


def test_one_id_with_two_texts(spark):
    rng = random.Random(8)
    text = lambda: " ".join(f"w{rng.randrange(10**9)}" for _ in range(40))
    a, b, c = text(), text(), text()
    rows = [(1, a, "x"), (2, a + " end", "x"), (2, b, "y"), (2, b, "y"), (3, c, "x"), (4, c, "x"), (5, "", "x"), (5, a, "z"), (None, a, "x"), (6, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone_id string")
    kept = ngramjoin.keep_one(docs)
    assert kept.columns == docs.columns
    want = [(1, a, "x"), (2, b, "y"), (2, b, "y"), (3, c, "x"), (5, "", "x"), (None, a, "x"), (6, None, "x")]
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, want))
    comp = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in ngramjoin.ngram_components(docs).collect()}
    assert comp[2, 37] == 1 and comp[2, 36] == 2 and comp[None, 36] == 1


def test_copies_add_no_prefix_rows(spark):
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(60)) for _ in range(5)]
    order = ngramjoin.Order(__import__("numpy").zeros(ngramjoin.WIDTH, "uint8"))
    rows = lambda k: spark.createDataFrame([(t,) for t in texts + texts[:1] * k], "text string").coalesce(1).mapInArrow(ngramjoin._prefixes(order, 80), "token bigint, hi bigint, n bigint, pos int").count()
    assert rows(10_000) == rows(0) == 5 * ngramjoin.prefix_size(56, 80)


def test_many_partners_of_one_centre(spark, monkeypatch):
    monkeypatch.setattr(ngramjoin, "PAIRS", 7)
    rng = random.Random(10)
    base = [f"w{rng.randrange(10**9)}" for _ in range(120)]
    texts = [" ".join(base[:k] + [f"x{k}"] + base[k:]) for k in range(100)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(tuple(r) for r in ngramjoin.ngram_components(docs).collect()) == _components(texts)


def test_classes_with_half_a_digest_in_common(spark, monkeypatch):
    whole = ngramjoin.class_of
    monkeypatch.setattr(ngramjoin, "class_of", lambda words: (whole(words)[0] % 3, whole(words)[1]))
    texts = _versions()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    batch = __import__("pyarrow").RecordBatch.from_pandas(docs.toPandas())
    # The workers see the library's own digest; the rows are made here with the short one.
    order = ngramjoin.Order(__import__("numpy").zeros(ngramjoin.WIDTH, "uint8"))
    rows = [r for b in ngramjoin._prefixes(order, 80)(iter([batch.select([1])])) for r in b.to_pylist()]
    prefix = spark.createDataFrame([(r["token"], r["hi"], r["n"], r["pos"]) for r in rows], "token long, hi long, n long, pos int")
    sets = {i: ngramjoin.shingles(ngramjoin.words_of(t)) for i, t in enumerate(texts)}
    keys = {i: (*ngramjoin.class_of(ngramjoin.words_of(t)), len(sets[i])) for i, t in enumerate(texts)}
    least = {}
    for i, k in keys.items():
        least.setdefault(k, i)
    reps = spark.createDataFrame([((rep, hi, lo, n),) for (hi, lo, n), rep in least.items()], "id struct<rep: long, hi: long, lo: long, n: long>")
    join = ngramjoin.NgramJoin(docs)
    shared = {(r["token"], tuple(r["id"])[1:]) for r in join._shared(prefix, reps).collect()}
    clashes = {frozenset((tuple(r["a"])[1:], tuple(r["b"])[1:])) for r in join._clashes(reps).collect()}
    own = {}
    for i, t in enumerate(texts):
        for token in order.sort(sets[i])[0][: ngramjoin.prefix_size(len(sets[i]), 80)].view("int64").tolist():
            own.setdefault(token, set()).add(keys[i])
    half = lambda k: (k[0], k[2])
    assert clashes == {frozenset((k, m)) for k in least for m in least if k != m and half(k) == half(m)} and clashes
    for token, ks in own.items():
        if len({half(k) for k in ks}) > 1:
            assert all((token, k) in shared for k in ks)
