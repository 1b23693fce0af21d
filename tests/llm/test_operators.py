"""Each operator against a plain restatement on small rows: nulls, empty and long texts,
repeated rows, ties, clashing columns, empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

public = pytest.importorskip("public_tokenizers")
from scriptorium.llm import bpe, embed, htmltext, linededup, ngramjoin, packing, quality, sharding, toolchat, urlfilter  # noqa: E402
from scriptorium.llm.tokens import PieceCache  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeéñ") for _ in range(rng.randint(1, 6)))
    base = [" ".join(word() for _ in range(rng.randint(3, 120))) for _ in range(24)]
    near = [b.replace(" ", "  ", 1) + " tail" for b in base[:6]]
    lines = [f"\t{b[:20]}\nCommon LINE \n{b[20:60]}" for b in base[:12]]
    return [*base, *base[:4], *near, *lines, None, "", "   \n\t", "one two", "ONE two", "Und " * 400, "x y " * 3000, "a\x0bb c"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ("en", "fr", None, "xx")[i % 4], "s", len(t or "")) for i, t in enumerate(_texts())]
    rows.append((0, rows[0][1], "en", "s", 1))  # a repeated row
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def shingle_set(text):
    w = [x.encode().lower() for x in WORD.findall(text or "")]
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_ngram_join(docs, nothing):
    rows = [(r["doc_id"], shingle_set(r["text"])) for r in docs.collect()]
    up = {i: i for i, _ in rows}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in rows:
        for j, b in rows:
            if i < j and a and 100 * len(a & b) >= 80 * len(a | b):
                up[max(top(i), top(j))] = min(top(i), top(j))
    want = sorted((i, len(s), top(i)) for i, s in rows)
    assert sorted(tuple(r) for r in ngramjoin.ngram_components(docs).collect()) == want
    assert ngramjoin.ngram_components(nothing).count() == 0
    kept = ngramjoin.keep_one(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {t for _, _, t in want}


def test_similar_filters_lose_nothing():
    rng = np.random.default_rng(3)
    order = ngramjoin.Order(rng.integers(0, 200, ngramjoin.WIDTH).astype(np.uint8))
    for _ in range(400):
        a = np.unique(rng.integers(0, 1 << 62, rng.integers(1, 60)).astype(np.uint64))
        b = np.unique(np.concatenate([a[: rng.integers(0, len(a) + 1)], rng.integers(0, 1 << 62, rng.integers(0, 9)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        want = len(b) > 0 and 100 * both >= 80 * (len(a) + len(b) - both)
        assert ngramjoin.similar(order.sort(a), order.sort(b), 80) == want


def test_bpe_round_trip(spark, docs, nothing):
    tiktoken = pytest.importorskip("tiktoken")
    path = public.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.load_ranks(path)
    own = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = {r["doc_id"]: r for r in bpe.round_trip(docs, path, public.PATTERN).collect()}
    for r in docs.collect():
        ids = own.encode_ordinary(r["text"] or "")
        assert (got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["ids_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes()))
        assert got[r["doc_id"]]["decoded_sha256"] == sha((r["text"] or "").encode())
    back = bpe.decode(bpe.encode(docs, path, public.PATTERN), path, public.PATTERN)
    assert all(bytes(r["bpe_bytes"]).decode() == (r["text"] or "") for r in back.collect())
    assert bpe.round_trip(nothing, path, public.PATTERN).count() == 0
    clash = docs.select("*", F.lit(1).alias("_t"), F.lit(2).alias("bpe_ids"), F.lit(3).alias("x"), F.lit(4).alias("bpe_bytes"))
    there = bpe.encode(clash, path, public.PATTERN)
    assert there.columns == [*clash.columns, "_bpe_ids"]
    back = bpe.decode(there, path, public.PATTERN, "_bpe_ids")
    assert back.columns == [*there.columns, "_bpe_bytes"] and all(bytes(r["_bpe_bytes"]).decode() == (r["text"] or "") for r in back.collect())
    rng = random.Random(1)
    odd = ["".join(rng.choice("a b\n  \té’'s12<|>\x1c　日") for _ in range(rng.randint(0, 50))) for _ in range(3000)] + ["x" * 3000]
    cache, _ = bpe.worker(path, public.PATTERN)
    assert [np.frombuffer(x, "<u4").tolist() for x in cache.encode_texts(odd)] == [own.encode_ordinary(t) for t in odd]
    words = [w.encode() for w in (" the", "a", " éñcde", "\n\n", " 12345", "日本", "zzzzzzzzzzzz", " abcabcabc")] + [bytes([200, 201])]
    folded = spark.createDataFrame([(i, bytearray(w)) for i, w in enumerate(words)], "i int, w binary").select("i", bpe.fold_words(F.col("w"), ranks).alias("ids"))
    assert [r["ids"] for r in folded.orderBy("i").collect()] == [own._encode_single_piece(w) for w in words] == [bpe.merge(w, ranks) for w in words] == [bpe.merge_long(w, ranks) for w in words]
    small = PieceCache(cache.encode, limit=3)
    assert small.encode_texts(odd[:200]) == cache.encode_texts(odd[:200])


def test_line_dedup(docs, nothing):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    rows = [(r["doc_id"], (r["text"] or "").split("\n")) for r in docs.collect()]
    for least in (2, 10):
        often = [k for k in {key(x) for _, ls in rows for x in ls} if k and sum(any(key(x) == k for x in ls) for _, ls in rows) >= least]
        want = []
        for i, ls in rows:
            kept = [x for x in ls if key(x) not in often]
            want.append((i, len(ls), len(ls) - len(kept), linededup.kept_sha256(x.encode() for x in kept)))
        assert sorted(tuple(r) for r in linededup.line_digests(docs, least).collect()) == sorted(want)
    out = linededup.dedup_lines(docs, 10)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert all(r["n_chars"] == len(r["text"]) for r in out.where("text is not null and doc_id > 0").collect())
    assert linededup.line_digests(nothing).count() == 0


def test_url_filter(spark):
    urls = ["https://blog.example.org/es/1", "http://example.org/en/12", "http://EXAMPLE.org/en/2", "https://a.com/de/", "https://a.com/fr/x?y#z", "http://x.net/", "http://x.org", "http://org/?a", "com/de/", None, "", "ftp://u@a.com:80/de/", "http://notcom/de/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    want = ["block", "block", "allow", "block", "allow", "allow", "allow", "allow", "allow", "allow", "allow", "allow", "allow"]
    rules = ["example.org/es/", "example.org/en/1", "org/", "com/de/", "com/fr/", None, None, "org/", None, None, None, None, None]
    got = urlfilter.judge_urls(pages).orderBy("page_id").collect()
    assert [(r["rule"], r["verdict"]) for r in got] == list(zip(rules, want))
    table = urlfilter.rules_table(spark, urlfilter.RULES)
    joined = urlfilter.judge_by_join(pages, table).orderBy("page_id").collect()
    assert [(r["rule"], r["verdict"], r["host"], r["path"]) for r in joined] == [(r["rule"], r["verdict"], r["host"], r["path"]) for r in got]
    assert urlfilter.judge_urls(pages.where("false")).count() == 0


def test_packing(docs, nothing):
    tok = pytest.importorskip("tokenizers").Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rows = packing.pack(docs, public.path("byte_bpe_50k.json"), capacity=256, open_bins=16).collect()
    ids = {}
    for r in docs.collect():
        ids.setdefault(r["doc_id"], []).append(tok.encode(r["text"] or "", add_special_tokens=False).ids + [0])
    want = sorted((i, k, sum(packing.piece_lengths(len(x), 256)[:k]), n) for i, xs in ids.items() for x in xs for k, n in enumerate(packing.piece_lengths(len(x), 256)))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"]) for r in rows) == want
    for r in rows:
        part = ids[r["doc_id"]][0][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(bins) <= 1.1 * sum(r["length"] for r in rows) / 256 + 2
    assert packing.pack(nothing, public.path("byte_bpe_50k.json")).count() == 0


def test_best_fit_closes_the_fullest():
    fit = packing.BestFit(10, 2)
    assert [fit.place(n) for n in (6, 7, 4, 9)] == [(0, 0), (1, 0), (0, 6), (2, 0)]
    assert fit.place(5) == (3, 0)  # the bin with one left has closed
    assert fit.place(1) == (1, 7)


def test_embeddings(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(6, 16))
    vectors = [(centre[i % 6] + rng.normal(size=16) * (0.06 if i % 3 else 0.2)).astype("float32").tolist() for i in range(90)]
    rows = [(i, v, i % 2) for i, v in enumerate(vectors)] + [(100 + i, vectors[0], 0) for i in range(5)]
    rows += [(200, None, 1), (201, [0.0] * 16, 1), (202, [float("nan")] * 16, 1), (203, vectors[0], None), (204, [None] * 16, 1), (205, [], 1), (206, [1.0, 0.0], 1), (207, [2.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    good = [(i, np.array(v, float), l) for i, v, l in rows if l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i, _, _ in rows}
    for i, a, l in good:
        for j, b, m in good:
            if i != j and l == m and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.98:
                links[i].add(j)

    def least(i):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        return min(seen)

    want = sorted((i, len(links[i]), least(i), least(i) == i) for i in links)
    assert sum(map(len, links.values())) > 50
    assert sorted(tuple(r) for r in embed.near_vectors(df).collect()) == want
    assert embed.near_vectors(df.where("false")).count() == 0


def test_html_text(spark):
    body = "<body><nav><a href=x>menu</a></nav><div class='cookie-notice'>ok?</div><article><header><h1>Title</h1></header><p><b>One &amp; two<br>three<p>Four&nbsp;five.</p><form>no<input></form><ul><li>a<li>b</ul><script>var a='</p>'</script></article><section id='comments'><p>first! a long comment of a reader</p></section><footer>foot</footer></body>"
    pages = spark.createDataFrame([(1, "u", body), (2, "u", None), (3, "u", ""), (4, None, "<div>" * 3000 + "deep" + "</div>" * 3000), (5, "u", "<nav>only</nav>")], "page_id int, url string, html string")
    got = {r["page_id"]: r for r in htmltext.page_texts(pages).collect()}
    assert got[1]["text"] == "Title\n\nOne & two three\n\nFour five.\n\na\n\nb" and got[1]["n_chars"] == len(got[1]["text"])
    assert [got[i]["text"] for i in (2, 3, 4, 5)] == ["", "", "deep", ""]
    assert htmltext.extract(pages).columns == [*pages.columns, "main_text"]
    side = "<body><div class=sidebar><p>j j j</p></div><div id=content><h2>H</h2><p>Hello big world</p><div><p>two two two</p><p>three three</p></div></div></body>"
    assert htmltext.main_text(side) == "H\n\nHello big world\n\ntwo two two\n\nthree three"


def test_tool_chat(spark):
    call = lambda i, a, after="[]", name="reply": '{"tool_calls":[{"id":%s,"name":"%s","arguments":"%s","after":%s}]}' % (i, name, a.replace('"', '\\"'), after)
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "assistant", call('"b"', '{"turn":1,"prompt":"x"}', '["a"]')), (1, 2, "assistant", call('"a"', '{"prompt":"y","turn":2}')),
        (1, 3, "tool", '{"tool_call_id":"a","content":"A"}'), (1, 4, "tool", '{"tool_call_id":"a","content":"late"}'), (1, 5, "tool", '{"tool_call_id":"zz","content":"?"}'),
        (1, 6, "assistant", call('"c"', '{"prompt":1,"turn":2}', '["d"]')), (1, 7, "assistant", call('"d"', '{"prompt":"z"}', '["c"]')), (1, 8, "assistant", call("null", "[]", name="other")),
        (1, 9, "assistant", call('"a"', '{"prompt":"y","turn":2,"more":[]}')), (2, 0, None, None), (None, 0, "user", "{not json"),
    ]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    chat = toolchat.tool_chat(df.withColumn("state", F.lit(1)).withColumn("message", F.lit("x")))
    got = {(r["turn"], r["kind"], r["state"]): r for r in chat.where("conv_id = 1").collect()}
    assert set(got) == {
        (0, 0, "plain"), (1, 0, "unanswered"), (2, 0, "answered"), (2, 1, "result"), (2, 2, "repeated"), (5, 2, "orphan"), (6, 0, "unanswered"), (7, 0, "unanswered"), (8, 0, "unanswered"), (9, 0, "unanswered")
    }
    assert {t: r["issue"] for (t, kind, _), r in got.items() if kind == 0 and t} == {1: None, 2: None, 6: "prompt isn't string", 7: "missing turn", 8: "unknown tool", 9: "unknown argument"}
    assert {t for (t, kind, _), r in got.items() if r["cyclic"]} == {6, 7} and got[1, 0, "unanswered"]["at_turn"] == 2
    out = {r["conv_id"]: r for r in toolchat.documents(chat).collect()}
    places = [out[1]["chat_json"].index(x) for x in ("be kind", '"call_id":"a"', '"content":"A"', '"call_id":"b"', '"name":"other"', '"call_id":"c"')]
    assert places == sorted(places) and '{\\"prompt\\":\\"x\\",\\"turn\\":1}' in out[1]["chat_json"] and "late" not in out[1]["chat_json"]
    assert out[2]["chat_json"] == '[{"content":"","role":"user"}]' and out[None]["n_messages"] == 1


def test_sharding(docs, nothing):
    rows = sharding.shard_digests(docs).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.collect())
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(8)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert all((r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]].encode()) + 1, zlib.crc32(texts[r["doc_id"]].encode())) for r in rows)
    place = lambda rs: sorted((r["doc_id"], r["shard"], r["slot"]) for r in rs)
    assert place(sharding.shard_digests(docs.repartition(7)).collect()) == place(rows)
    assert sharding.shard_digests(nothing).count() == 0
    clash = sharding.shard(docs.withColumn("bucket", F.lit("x")))
    assert clash.columns == [*docs.columns, "bucket", "shard", "slot"]
    assert sorted(sharding.fisher_yates(50, 1, 2).tolist()) == list(range(50))


def test_quality(docs, nothing):
    rows = quality.assess(docs).collect()
    for r in rows:
        text = r["text"] or ""
        w = WORD.findall(text)
        seen = [x for x in text.split("\n") if WORD.search(x)]
        windows = {}
        for i in range(len(w) - 7):
            windows.setdefault(tuple(w[i : i + 8]), []).append(i)
        covered = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
        failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
        m, q = r["measures"], r["quality"]
        assert (m["n_words"], m["word_chars"], m["n_symbols"], m["n_dup_lines"], m["n_repeat_words"], q["base_failed"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(seen) - len(set(seen)), len(covered), failed
        )
        assert not (failed and q["kept"])
    assert quality.quality_filter(docs).columns == docs.columns
    assert quality.assess(nothing).count() == 0
    clash = docs.select("*", F.lit(1).alias("_q_note"), F.lit(2).alias("measures"), F.lit(3).alias("quality"), F.lit(4).alias("c0"), F.lit(5).alias("a.b"))
    assert quality.assess(clash).columns == [*clash.columns, "_measures", "_quality"]
    kept = quality.quality_filter(clash)
    assert kept.columns == clash.columns and kept.count() == sum(r["quality"]["kept"] for r in rows)
