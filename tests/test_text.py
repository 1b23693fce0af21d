"""Transforms, tokenizers and filters on small fixed texts."""

import re
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.util import PythonEvalType

from scriptorium.functions import text as X
from scriptorium.operators import filters as L
from scriptorium.operators import tokenize as K


def column(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.select("i", build(F.col("t")).alias("o")).orderBy("i").select("o").collect()]


def test_transforms(spark):
    cases = [
        (["normalize_whitespace"], "hello   world\t\tfoo  bar\n", "hello world foo bar\n"),
        (["normalize_whitespace"], "para 1\n\n\n\npara 2\n", "para 1\n\npara 2\n"),
        (["normalize_whitespace"], "", ""),
        ([{"keep_only": {"chars": "abcdefghijklmnopqrstuvwxyz "}}], "hello123 world!", "hello world"),
        ([{"keep_only": {"chars": "]^-\\"}}], "a]b^c-d\\e", "]^-\\"),
        ([{"regex_replace": {"pattern": "foo", "replacement": "x", "flags": "i"}}], "FOO foo Foo", "x x x"),
        ([{"regex_replace": {"pattern": r"(\w)(\d)", "replacement": r"\2$\1"}}], "é1", "1$é"),
        ([{"min_token_length": {"min": 3}}], "a bb ccc dddd", "ccc dddd"),
        ([{"max_token_length": {"max": 2}}], "a bb\n\nccc dddd", "a bb\n\n"),
        (["apply_lenition_dots"], "bhi bhocht thinn", "ḃi ḃoċt ṫinn"),
        ([{"apply_lenition_dots": {"mode": "conservative"}}], "bha bhcons", "ḃa bhcons"),
        (["apply_lenition_dots", "dot_to_seimhiu"], "bhi Thinn", "bhi Thinn"),
        (["long_s_medial"], "usual loves sun yes, grass sh", "uſual loves ſun yeſ, graſs sh".replace("graſs", "grass")),
        (["tironian_et"], "Agus sand and et", "⁊ sand ⁊ ⁊"),
        (["lowercase", "tironian_et", "apply_lenition_dots"], "AGUS Bhocht", "⁊ ḃoċt"),
        (["strip_punctuation"], "a-b, «c»!", "ab c"),
        (["uppercase"], "straße", "STRASSE"),
    ]
    for steps, given, want in cases:
        assert column(spark, [given], lambda c, s=steps: X.apply_chain(c, s)) == [want], (steps, given)


def test_normal_forms_and_nulls(spark):
    texts = ["é", "é", "ﬁ", "plain", None]
    for form in ("nfc", "nfd", "nfkc", "nfkd"):
        want = [None if t is None else unicodedata.normalize(form.upper(), t) for t in texts]
        assert column(spark, texts, lambda c, f=form: X.apply_chain(c, [f])) == want


def test_drawn_matches_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i, "and et agus " * 20) for i in range(40)], "i int, t string")
    step = [{"tironian_et": {"probability": 0.5}}]
    run = lambda d: {r[0]: r[1] for r in d.select("i", X.apply_chain(F.col("t"), step, seed=3, key=F.col("i"))).collect()}
    one, many = run(df.repartition(1)), run(df.repartition(7))
    assert one == many
    share = sum(t.count("⁊") for t in one.values()) / (40 * 60)
    assert 0.4 < share < 0.6


def test_errors():
    with pytest.raises(X.TransformError):
        X.DEFAULT.get("nothing")
    with pytest.raises(X.TransformError):
        X.DEFAULT.register("lowercase", lambda c: c)
    with pytest.raises(X.TransformError):
        X.keep_only(None)
    with pytest.raises(X.TransformError):
        X.lenition_pattern("wild")


def test_redaction_is_idempotent(spark):
    text = "token hf_" + "A" * 24 + " and hf_short"
    once = column(spark, [text], X.redact_token)[0]
    assert once == "token [redacted-hf-token] and hf_short"
    assert column(spark, [once], X.redact_token)[0] == once


def test_tokenizers(spark):
    one = lambda text, mode: column(spark, [text], lambda c: K.tokens_of(c, mode))[0]
    assert one('"hello," she said.', "word_crops") == ["hello", "she", "said"]
    assert one("--- ... !!", "word_crops") == []
    assert one("a b it's", "word_crops") == ["a", "b", "it's"]
    assert one("a b\r\n\x85c\n \n", "lines") == ["a", "b", "c"]
    assert one("a\n\n\nb\n \nc", "paragraphs") == ["a", "b", "c"]
    assert one("a\n\nb\n\n\nc", "pages") == ["a\n\nb", "c"]
    assert one("only one", "pages") == ["only one"]
    with pytest.raises(ValueError):
        K.tokens_of(F.lit(""), "verses")


def test_word_spans(spark):
    got = column(spark, [" 𝒳a  bc\n", "", None], K.word_spans)
    assert [tuple(x) for x in got[0]] == [("𝒳a", 1, 3), ("bc", 5, 7)] and got[1] == [] and got[2] is None


def test_line_filter(spark):
    run = lambda t, **k: column(spark, [t], lambda c: L.filter_lines(c, **k))[0]
    assert run("alpha\n123\nbeta\n", drop=[r"^\d+$"]) == "alpha\nbeta\n"
    assert run("1\n2\n", drop=[r"^\d+$"]) == ""
    assert run("a\r\nb", drop=None) == "a\r\nb"
    assert run(" a \nbcd\n", min_chars=2) == "bcd\n"
    assert run("ab\ncd\n", keep=["a"]) == "ab\n"


def test_against_plain_python(spark):
    texts = ["Is, «and» the\tof  s's\n\n\n\nhouse shs", "", "x" * 1000, "a b\x1cc", "ends with s"]
    words = lambda t: [w for w in (_trim(r) for r in re.findall(r"\S+", t)) if w]
    assert column(spark, texts, K.words) == [words(t) for t in texts]


def _trim(w):
    bad = lambda c: unicodedata.category(c).startswith("P")
    while w and bad(w[0]):
        w = w[1:]
    while w and bad(w[-1]):
        w = w[:-1]
    return w


def test_word_spans_over_many_lists(spark):
    texts = [None if i % 7 == 3 else " \u00e9\U0001d4b3 " * (i % 5) + f"w{i}\n" for i in range(700)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    for i, got in df.select("i", K.word_spans(F.col("t"))).collect():
        assert (None if got is None else [tuple(x) for x in got]) == (None if texts[i] is None else [(m[0], m.start(), m.end()) for m in re.finditer(r"\S+", texts[i])])


@pytest.mark.parametrize("build", [lambda c: K.word_spans(c), lambda c: X.apply_chain(c, ["nfc"]), lambda c: X.apply_chain(c, [{"long_s_medial": {"probability": 0.5}}], key=c)])
def test_batches_stay_arrow(spark, build):
    """Pandas would hold each text or word of a batch as a Python object."""
    plan = spark.createDataFrame([("a",)], "t string").select(build(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(rf"ArrowEvalPython .*, {PythonEvalType.SQL_SCALAR_ARROW_UDF}\n", plan)


def test_only_a_few_texts_at_once(monkeypatch):
    monkeypatch.setattr(X, "AT_ONCE", 5)
    texts = ["abc", None, "defghij", "", "k"] * 3
    assert X._few_at_once(lambda t, k: t.upper() + k)(pa.array(texts), pa.array(["x"] * 15)).to_pylist() == [None if t is None else t.upper() + "x" for t in texts]
    assert X._few_at_once(str)(pa.array([], pa.string())).to_pylist() == []


def test_plain_texts_do_not_leave_the_jvm(spark):
    plan = spark.createDataFrame([("a",)], "t string").select(X.apply_chain(F.col("t"), ["nfc"]))._jdf.queryExecution().optimizedPlan().toString()
    assert "run(CASE WHEN" in plan
