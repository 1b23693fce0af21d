"""Joins, aggregates, geometry, audit log, parsers, staging."""

import hashlib
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from scriptorium import queries
from scriptorium.functions import scalars as S
from scriptorium.operators import audit as A
from scriptorium.operators import boxes as B
from scriptorium.operators import coverage as C
from scriptorium.operators import filters as L
from scriptorium.operators import sampling as P
from scriptorium.operators import staging as G
from scriptorium.operators import stats as T
from scriptorium.sources import parsers, readers


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_claims_and_leftovers(spark):
    words = spark.createDataFrame([(1, 0, 0, 10), (1, 1, 10, 11), (1, 2, 90, 99)], "page int, word_id int, y0 int, y1 int")
    lines = spark.createDataFrame([(1, 0, 0, 10), (1, 1, 5, 20)], "page int, line_pos int, y0 int, y1 int")
    claimed, left = B.claim_words(words, lines)
    assert rows(claimed.select("word_id", "line_pos")) == [(0, 0), (1, 0)]
    assert rows(left.select("word_id")) == [(2,)]


@pytest.mark.parametrize("name", ["join_claim_words", "join_unassigned_words", "join_glyph_words"])
def test_exploded_sides_are_not_broadcast(spark, tmp_path, name):
    spark.sql("select id as o_orderkey from range(100)").write.parquet(str(tmp_path / "orders.parquet"))
    items = "select id % 100 as l_orderkey, id as l_partkey, id as l_suppkey, cast(id % 7 as int) as l_linenumber, cast(id as double) as l_quantity from range(300)"
    spark.sql(items).write.parquet(str(tmp_path / "lineitem.parquet"))
    plan = queries.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_glyphs_and_as_of(spark):
    glyphs = spark.createDataFrame([(1, 0, 0, 0, 5, 9), (1, 4, 4, 1, 9, 8), (1, 5, 7, 0, 8, 8)], "sample int, cluster int, x0 int, y0 int, x1 int, y1 int")
    spans = spark.createDataFrame([(1, 0, 0, 5), (1, 1, 6, 9)], "sample int, word int, start int, end int")
    assert rows(B.glyph_words(glyphs, spans)) == [(1, 0, 0, 0, 9, 9)]
    marks = spark.createDataFrame([(1, 0, 10), (1, 5, 20)], "k int, t int, v int")
    points = spark.createDataFrame([(1, 4), (1, 5), (1, 9), (2, 3)], "k int, t int")
    assert sorted((r["k"], r["t"], r["v"]) for r in B.as_of(points, marks, "k", "t", "v").collect()) == [(1, 4, 10), (1, 5, 20), (1, 9, 20), (2, 3, None)]


def test_wrap(spark):
    df = spark.createDataFrame([("the quick brown fox jumps over",), ("incomprehensibilities a",), ("",)], "t string")
    got = [r[0] for r in df.select(B.wrap(F.col("t"), F.lit(10))).collect()]
    assert got == [["the quick", "brown fox", "jumps over"], ["incomprehensibilities", "a"], []]


def test_histogram_order_and_cap(spark):
    df = spark.createDataFrame([(c,) for c in "zzzaammq"], "v string")
    assert [tuple(r) for r in T.histogram(df, F.col("v")).collect()] == [("z", 3), ("a", 2), ("m", 2), ("q", 1)]
    assert [tuple(r) for r in T.histogram(df, F.col("v"), 2).collect()] == [("z", 3, 2), ("a", 2, 2)]


def test_content_sha(spark):
    files = [("b", "2"), ("a", "1"), ("Z", "3")]
    want = hashlib.sha256("".join(f"{p}\n{s}\n" for p, s in sorted(files)).encode()).hexdigest()
    assert T.content_sha(spark.createDataFrame(files, "path string, sha string")).first()["content_sha"] == want


def test_resume_and_last_wins(spark):
    manifest = spark.createDataFrame([(0, "rendered"), (1, "skipped")], "index long, status string")
    assert rows(L.pending(spark.range(3).withColumnRenamed("id", "index"), manifest)) == [(1,), (2,)]
    new = spark.createDataFrame([(1, "rendered")], "index long, status string")
    assert rows(T.merged_manifest(manifest, new)) == [(0, "rendered"), (1, "rendered")]
    twice = spark.createDataFrame([("k", 1, "a"), ("k", 2, None)], "k string, n int, v string")
    assert rows(T.last_by_key(twice, ["k"], "n")) == [("k", 2, None)]


def test_audit_log(spark):
    lines = [json.dumps(x) for x in ({"recipe_name": "a", "count": "3", "runtime_seconds": 1.25, "timestamp": "2026-01-02"}, {"recipe_name": "b", "schema_version": 1, "recipe_sha": "ABc", "count": "x", "timestamp": "2026-01-03"}, {"schema_version": 2}, {"schema_version": "1"}, {"schema_version": True})]
    log = spark.createDataFrame([(i, v) for i, v in enumerate([*lines, ""])], "line_no int, value string")
    runs, unknown = A.read_log(log)
    assert [r["recipe_name"] for r in runs.orderBy("line_no").collect()] == ["a", "b"]
    assert rows(unknown) == [('"1"', 1), ("2", 1), ("true", 1)]
    assert rows(A.select_runs(runs, sha="aB").select("recipe_name")) == [("b",)]
    assert rows(A.select_runs(runs, since="2026-01-03", until="2026-01-03").select("recipe_name")) == [("b",)]
    s = A.summary(runs).first()
    assert (s["runs"], s["total_count"], s["total_runtime"], s["shas"]) == (2, 3, 1.25, 1)
    empty = A.summary(runs.where("false")).first()
    assert empty["runs"] == 0 and empty["first_run"] is None
    with pytest.raises(PySparkException):
        A.read_log(spark.createDataFrame([(0, "[1]")], "line_no int, value string"))[0].collect()


def test_scalars(spark):
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    assert value(S.image_name(F.lit(123456789), F.lit(7))) == "123456789.png"
    assert [value(S.pad_width(F.lit(n))) for n in (1, 50_000, 100_000_000)] == [7, 7, 8]
    assert value(S.sample_seed(F.lit(42), F.lit(7))) == 108349618682
    assert value(S.polygon(*map(F.lit, (10, 20, 30, 40)))) == [[10, 20], [30, 20], [30, 40], [10, 40]]
    assert value(S.utc_stamp(F.lit(" 2026-05-06T20:00:00+05:00"))) == "2026-05-06T15:00:00Z"
    assert value(S.utc_stamp(F.lit("nonsense"))) is None
    assert [value(S.safe_int(F.lit(v))) for v in ("7", "3.5", "x")] == [7, 0, 0]
    assert [value(S.size_class(F.lit(n))) for n in (0, 999, 1000, 10**7)] == [None, "n<1K", "1K<n<10K", "n>10M"]
    assert [value(S.human_bytes(F.lit(n))) for n in (5, 17150, 247_300_000)] == ["5 B", "17.1 KB", "247.3 MB"]
    assert value(S.codepoint_name(F.lit(0x1D4B3))) == "U+1D4B3"
    assert value(S.plain_number(F.lit(14.0))) == "14"
    assert value(S.safe_filename(F.lit("a/b"))) != value(S.safe_filename(F.lit("a_b")))


def test_parsers():
    body = "<html><style>x</style><script>var t='</p>'</script><p>One <em>two</em> three</p><!-- no --><p>A &amp; b</p></html>"
    assert parsers.html_text(body) == "One\ntwo\nthree\nA & b\n"
    assert parsers.tei_text("<TEI><teiHeader>no</teiHeader><text><body><p>yes</p></body></text></TEI>") == "yes\n"
    assert parsers.json_text('{"entries":[{"body":"a"},{"body":2}]}', "$.entries[*].body") == "a\n2\n"
    assert parsers.json_text('{"a":"é"}') == '{"a": "é"}'
    for path in ("a.b", "$.missing", "$.a[*]"):
        with pytest.raises(parsers.ParserError):
            parsers.json_text('{"a":1}', path)
    with pytest.raises(parsers.ParserError):
        parsers.get_parser("pdf")


def test_json_lines_scan(spark):
    lines = spark.createDataFrame([('{"a":1}',), ("[1]",), ("nope",), ("",), ('"s"',)], "value string")
    good, bad = readers.json_objects(lines, "a int")
    assert rows(good) == [(1,)] and bad.count() == 3


def test_local_scan(spark, tmp_path):
    (tmp_path / "b.txt").write_text("second")
    (tmp_path / "a.txt").write_text("first\nline\n")
    got = readers.read_local(spark, "*.txt", tmp_path).orderBy("ord").collect()
    assert [r["text"] for r in got] == ["first\nline\n", "second"]
    for bad in ("*.md", "none.txt"):
        with pytest.raises(readers.SourceError):
            readers.expand(bad, tmp_path)


def test_fetch_retries():
    import io
    import urllib.error

    calls = []

    def opener(url, timeout):
        calls.append(url)
        if len(calls) < 3:
            raise urllib.error.HTTPError(url, 503, "busy", {}, io.BytesIO())
        return io.BytesIO(b"ok")

    waits = []
    assert readers.fetch("http://h/", opener=opener, sleep=waits.append) == b"ok" and waits == [0.5, 1.0]

    def gone(url, timeout):
        raise urllib.error.HTTPError(url, 404, "gone", {}, io.BytesIO())

    with pytest.raises(readers.SourceError):
        readers.fetch("http://h/", opener=gone, sleep=waits.append)


def test_staging(spark):
    labels = spark.createDataFrame([("a.png", "A"), ("b.png", "B"), ("c.png", "C")], "file_name string, text string")
    manifest = spark.createDataFrame([("images/a.png", "old", 1), ("images/a.png", "new", 2)], "image string, font string, line_no int")
    files = spark.createDataFrame([("a.png",), ("b.png",)], "file_name string")
    assert sorted(G.staged_rows(labels, manifest, files).collect()) == [("a.png", "A", "new"), ("b.png", "B", None)]
    assert rows(G.missing_labels(labels, files)) == [("c.png",)]


def test_draws_and_picks(spark):
    df = spark.range(4000)
    u = P.draw(1, F.col("id"), "x")
    got = df.select(P.draw_value({"min": 1, "max": 3}, u).alias("v"), P.weighted_index([1.0, 0.0, 3.0], u).alias("w"), P.weighted_index([0.0, -1.0], u).alias("z")).toPandas()
    assert set(got["v"]) == {1, 2, 3} and set(got["w"]) == {0, 2} and set(got["z"]) == {0, 1}
    assert 0.2 < (got["w"] == 0).mean() < 0.3
    tokens = spark.createDataFrame([(i, f"t{i % 5}") for i in range(100)], "pos int, token string")
    a = sorted(P.pick_tokens(spark, tokens.repartition(3), 300, 9, order=["pos"]).collect())
    b = sorted(P.pick_tokens(spark, tokens.repartition(7), 300, 9, order=["pos"]).collect())
    assert a == b and [r["index"] for r in a] == list(range(300))
    assert P.pick_tokens(spark, tokens.where("false"), 5, 1, order=["pos"]).count() == 0
    assert [P.workers(None, n) for n in (1, 2, 4, 64)] == [1, 2, 3, 8]


def test_coverage(spark):
    tokens = spark.createDataFrame([("abc",), ("né",)], "token string")
    fonts = spark.createDataFrame([("ascii", [chr(i) for i in range(128)])], "font string, chars array<string>")
    assert rows(C.uncovered(tokens, fonts)) == [("né", "ascii", ["é"])]
