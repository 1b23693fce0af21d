"""Operator 4 with thousands of rules: the mapped array, the join and a plain restatement."""

import random

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
from scriptorium.llm import urlfilter  # noqa: E402


def _judged(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    best = None
    for (h, p), block in rules.items():
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0, False, b""), (len(h + p), block, (h + p).encode()))
    return host, path, best and best[2].decode(), "block" if best and best[1] else "allow"


def _rules(rng, n):
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 2)))
    rules = [("block", "Example.org", "/"), ("allow", "org", "/abcdefgh"), ("block", None, "/"), ("block", "x", None), ("allow", "x.org", ""), ("block", "x.org", "")]
    for _ in range(n):
        rules.append((rng.choice(["allow", "block"]), ".".join(word() for _ in range(rng.randint(1, 3))), "/" + "/".join(word() for _ in range(rng.randint(0, 3)))))
    return rules


def test_thousands_of_rules_both_ways(spark):
    rng = random.Random(2)
    rules = _rules(rng, 5000)
    plain = {}
    for v, h, p in rules:
        if h is not None and p is not None:
            plain[h.lower(), p] = plain.get((h.lower(), p), False) or v == "block"
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 2)))
    urls = [None, "", "no", "http://", "http://EXAMPLE.org/abcdefghi", "http://x.org", "http://u@x.org:80/?q#f", "http://.x.org./a", "ftp://a.b/" + "a/" * 3000]
    urls += [f"http://{'.'.join(word() for _ in range(rng.randint(1, 4)))}/{'/'.join(word() for _ in range(rng.randint(0, 4)))}?{word()}" for _ in range(500)]
    pages = spark.createDataFrame([(i, u, "own", "mine") for i, u in enumerate(urls)], "page_id int, url string, host string, rule string")
    want = [(i, u, "own", "mine", *_judged(u, plain)) for i, u in enumerate(urls)]
    assert sum(w[6] is not None for w in want) > 200
    table = urlfilter.rules_table(spark, rules)
    for got in (urlfilter.judge_urls(pages, rules), urlfilter.judge_urls(pages, table), urlfilter.judge_urls(pages, table, max_index_bytes=1000), urlfilter.judge_urls(pages, rules, max_index_bytes=1000)):
        assert got.columns == ["page_id", "url", "host", "rule", "_host", "path", "_rule", "verdict"]
        assert sorted(map(tuple, got.collect())) == want


def test_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id int, url string")
    for limit in (0, 1000):
        assert [r["verdict"] for r in urlfilter.judge_urls(pages, [], max_index_bytes=limit).collect()] == ["allow"]


def test_colliding_keys_are_told_apart_by_their_strings():
    index = urlfilter.DigestArray(urlfilter.DigestArray.pack(urlfilter.RULES))
    said = [urlfilter.rule_key(h, p) for _, h, p in urlfilter.RULES]
    assert sorted(index.probe(said)) == list(range(len(said)))
    clash = np.repeat(index.keys[:1], len(said))
    assert sorted(index.probe(said, clash)) == [-1] * (len(said) - 1) + [0]
