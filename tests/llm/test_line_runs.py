"""Operator 3: runs merge without exchange; rows without ids; clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
from scriptorium.llm import linededup  # noqa: E402
from scriptorium.llm.common import Scratch  # noqa: E402


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("fanout", [2, 3])
def test_runs_add_up(spark, fanout):
    rng = random.Random(fanout)
    rows = [(bytes([rng.randrange(60)]) * 16, i % 7) for i in range(900)]
    keys = spark.createDataFrame(rows, f"{linededup.KEY} binary, batch int")
    runs = linededup.LineRuns(Scratch(spark, "runs"), 15, fanout)
    for i in range(7):
        runs.add(keys.where(F.col("batch") == i))
    counts = {k: sum(r[0] == k for r in rows) for k, _ in rows}
    found = runs.frequent()
    runs.close()
    assert {bytes(r[0]) for r in found.collect()} == {k for k, n in counts.items() if n >= 15}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_")]


def test_runs_merge_without_exchange_or_sort(spark):
    runs = linededup.LineRuns(Scratch(spark, "runs"), 5)
    names = []
    for k in range(2):
        keys = spark.range(500).select(F.unhex(F.md5((F.col("id") + 200 * k).cast("string"))).alias(linededup.KEY))
        names.append(runs._save(keys.groupBy(linededup.KEY).agg(F.count(F.lit(1)).alias(linededup.DOCS)), f"run{k}"))
    with linededup._ordered_scans(spark):
        merged = runs.merged(names)
        plan = _plan(merged)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
    assert merged.count() == 700 and merged.agg(F.sum(linededup.DOCS)).first()[0] == 1000
    runs.close()


def test_rows_without_ids_and_clashing_columns(spark):
    rows = [(None, f"common\nown {i}", "x") for i in range(12)] + [(3, "common\nCOMMON \nz", "y"), (3, "q", "y"), (None, None, None), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, line_kept string").withColumn("id", F.lit(1)).withColumn("line_drop", F.lit("d"))
    out = linededup.split_lines(docs, 10)
    assert out.columns == [*docs.columns, "line_n", "line_gone", "_line_kept"]
    got = sorted((repr(r["text"]), r["line_n"], r["line_gone"], r["_line_kept"], r["line_kept"]) for r in out.collect())
    want = [(repr(f"common\nown {i}"), 2, 1, f"own {i}", "x") for i in range(12)] + [(repr("common\nCOMMON \nz"), 3, 2, "z", "y"), (repr("q"), 1, 0, "q", "y"), ("None", 1, 0, "", None), ("None", 1, 0, "", None)]
    assert got == sorted(want)
    assert linededup.dedup_lines(docs, 10).columns == docs.columns
