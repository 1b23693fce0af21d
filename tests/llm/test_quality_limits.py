"""Operator 10: a text without common words is rejected by the word rule."""

import random

import pytest

pytest.importorskip("public_tokenizers")
from scriptorium.llm import quality  # noqa: E402


def test_no_common_word_is_rejected(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("bcdeghilmnoprstu") for _ in range(rng.randint(5, 9)))
    rows, k = [], 0
    for lang, listed in quality.COMMON_WORDS.items():
        for _ in range(60):  # one word in six is a common one, as in the tables
            rows.append((k, " ".join(rng.choice(listed) if i % 6 == 0 else word() for i in range(120)), lang))
            k += 1
    junk = [(1000 + i, " ".join(word() for _ in range(50)), lang) for i, lang in enumerate(quality.COMMON_WORDS)]
    docs = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string")
    judged = {r["doc_id"]: r for r in quality.assess(docs).collect()}
    assert all(judged[i]["quality"]["kept"] for i, _, _ in rows)
    for i, _, _ in junk:
        r = judged[i]["quality"]
        assert not r["base_failed"] and r["class_distance"] <= quality.QualityRules.class_limit
        assert r["word_distance"] > quality.QualityRules.word_limit and not r["kept"]
