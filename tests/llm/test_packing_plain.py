"""Operator 5: placements against a plain best fit; operator 9: overfull buckets, files."""

import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
from scriptorium.llm import packing, sharding  # noqa: E402


def _plain(sizes, capacity, open_bins):
    """Looks at every open bin for the least free space; of equal ones the latest touched."""
    bins, out, made = [], [], 0  # open bins [number, free, time]
    for time, size in enumerate(sizes):
        fits = [b for b in bins if b[1] >= size]
        if fits:
            b = min(fits, key=lambda b: (b[1], -b[2]))
            bins.remove(b)
        else:
            b, made = [made, capacity, 0], made + 1
            if size < capacity and len(bins) >= open_bins:
                bins.remove(min(bins, key=lambda b: (b[1], -b[2])))
        out.append((b[0], capacity - b[1]))
        if b[1] > size:
            bins.append([b[0], b[1] - size, time])
    return out


@pytest.mark.parametrize("capacity,open_bins", [(10, 2), (64, 8), (2048, 100)])
def test_placements_are_plain_best_fit(capacity, open_bins):
    rng = random.Random(capacity)
    for _ in range(20):
        sizes = [min(capacity, 1 + int(rng.expovariate(4 / capacity))) for _ in range(400)]
        fit = packing.BestFit(capacity, open_bins)
        assert [fit.place(n) for n in sizes] == _plain(sizes, capacity, open_bins)


def test_groups_share_tasks(spark):
    public = pytest.importorskip("public_tokenizers")
    docs = spark.createDataFrame([(i, "a b c " * (i % 40)) for i in range(600)], "doc_id long, text string")
    rows = packing.pack(docs, public.path("byte_bpe_50k.json"), capacity=128, open_bins=4, group_pieces=20).collect()
    groups = {r["sequence_id"] >> 40 for r in rows}
    assert len(groups) == 30
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        ends = [0]
        for offset, length in sorted(parts):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 128


@pytest.mark.parametrize("tasks", [1 << 16, 5])
def test_overfull_buckets_and_missing_ids(spark, monkeypatch, tasks):
    monkeypatch.setattr(sharding, "MOST_TASKS", tasks)
    monkeypatch.setattr(sharding, "SPAN", 7)
    rows = [(7, "same text " * 30, 1)] * 900 + [(None, "no id", 2)] * 300 + [(i, f"text {i}" * (i % 9), 3) for i in range(500)] + [(8, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    out = sharding.shard(docs, bucket_bytes=2000)
    assert out.columns == ["doc_id", "text", "slot", "shard", "_slot"]
    got = out.collect()
    key = lambda r: repr(tuple(r[:3]))
    assert sorted(map(key, got)) == sorted(map(key, rows))
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["_slot"])
    assert sorted(slots) == list(range(8)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 600  # 900 equal rows aren't one task's


def test_written_shards_hold_every_record_once(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    sharding.write_shards(docs, str(tmp_path / "out"), 3)
    assert sorted(p.name for p in (tmp_path / "out").glob("shard=*")) == ["shard=0", "shard=1", "shard=2"]
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in back) == [(i, f"text {i}") for i in range(200)]
    for k in range(3):
        assert sorted(r["slot"] for r in back if r["shard"] == k) == list(range(len(range(k, 200, 3))))
