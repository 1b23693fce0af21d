"""The pipeline's ``run`` on the whole of the smallest tables against a plain restatement of
all four stages."""

import math
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
import regex

public = pytest.importorskip("public_tokenizers")
pipeline = pytest.importorskip("corpus_pipeline")
from scriptorium.llm import packing, quality  # noqa: E402

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
needs_tables = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no tables")


def _measured(text, lang):
    words, rest, sizes = WORD.findall(text), text, []
    for _, pattern in quality.CLASSES:
        left = regex.sub(pattern.replace(r"\p{L}", r"\p{L}"), "", rest)
        sizes.append(len(rest) - len(left))
        rest = left
    blank = len(text) - sum(map(len, words))
    classes = [sizes[0] - blank, *sizes[1:], len(rest), blank]
    common = quality.COMMON_WORDS.get(lang)
    hist = None
    if common:
        hist = [words.count(w) for w in common]
        hist.append(len(words) - sum(hist))
    seen, again = {}, set()
    for i in range(len(words) - 7):
        window = tuple(words[i : i + 8])
        if window in seen:
            again.update(range(seen[window], seen[window] + 8), range(i, i + 8))
        seen.setdefault(window, i)
    return {"words": words, "classes": classes, "hist": hist, "repeat": len(again), "chars": len(text) - blank, "all": len(text)}


def _distance(counts, total, reference):
    out = 0.0
    for c, q in zip(counts, reference):
        p = c / total
        out += (p * math.log2(2 * p / (p + q)) if p > 0 else 0) + (q * math.log2(2 * q / (p + q)) if q > 0 else 0)
    return math.sqrt(max(out / 2, 0))


def _good(docs):
    rules = quality.QualityRules()
    told = {i: _measured(t or "", lang) for i, t, lang in docs}
    share = lambda rows, n: [sum(r[k] for r in rows) / (sum(map(sum, rows)) or 1) for k in range(n)]
    pooled = share([m["classes"] for m in told.values()], 8)
    refs = {}
    for lang in quality.COMMON_WORDS:
        own = [told[i] for i, _, x in docs if x == lang]
        refs[lang] = (share([m["classes"] for m in own], 8), share([m["hist"] for m in own], quality.K + 1))
    kept = []
    for i, t, lang in docs:
        m = told[i]
        n = len(m["words"])
        if n < rules.least_words or 100 * m["repeat"] > rules.repeat_percent * n:
            continue
        if m["chars"] >= rules.min_chars and _distance(m["classes"], m["all"], refs[lang][0] if lang in refs else pooled) > rules.class_limit:
            continue
        if n >= rules.min_words and m["hist"] and _distance(m["hist"], n, refs[lang][1]) > rules.word_limit:
            continue
        kept.append((i, t))
    return kept


def _without_lines(docs):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    found = {}
    for i, t in docs:
        for k in {key(x) for x in t.split("\n")}:
            found[k] = found.get(k, 0) + 1
    return [(i, "\n".join(x for x in t.split("\n") if not key(x) or found[key(x)] < 10)) for i, t in docs]


def _one_of_each(docs):
    sets = []
    for _, t in docs:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(t)]
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    up = {i: i for i, _ in docs}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(docs)):
        for b in range(a + 1, len(docs)):
            if sets[a] and 100 * min(len(sets[a]), len(sets[b])) >= 80 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = top(docs[a][0]), top(docs[b][0])
                    up[max(x, y)] = min(x, y)
    return [(i, t) for i, t in docs if top(i) == i]


@needs_tables
def test_run_is_the_plain_pipeline(spark):
    tok = pytest.importorskip("tokenizers").Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").collect()
    docs = [tuple(r) for r in rows]
    assert len({i for i, _, _ in docs}) == len(docs)
    good = _good(docs)
    lines = _without_lines(good)
    left = _one_of_each(lines)
    assert 0 < len(left) < len(good) < len(docs) and any(a != b for a, b in zip(good, lines))
    want = []
    for i, t in left:
        ids = tok.encode(t, add_special_tokens=False).ids + [0]
        start = 0
        for k, n in enumerate(packing.piece_lengths(len(ids), 2048)):
            want.append((i, k, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())))
            start += n
    got = pipeline.run(spark, DATA).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 1.1 * sum(w[3] for w in want) / 2048 + 2


@needs_tables
def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "best-fit packing"]
    empty = docs.where("false")
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, empty, DATA)
        assert out.columns == docs.columns and out.count() == 0
    assert pipeline.STAGES[-1][1](spark, empty, DATA).count() == 0
