"""Operator 7: density decides. A plain restatement of the density sums, pages without any
telling name, names that mislead, and pages that are deep."""

import math
import time
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
from scriptorium.llm import htmltext  # noqa: E402

PAGE = (
    "<html><body><div><a>one</a><a>two</a><a>three four</a></div><div><div><p>A paragraph of some length, with <a>a link</a> in it.</p><p>Another one, <b>bold</b> and longer than the first by far.</p>"
    "<div><a>more</a></div></div><div><p>short</p></div></div><div>end</div></body></html>"
)


def _restated(page):
    """Composite density and density sum of every element, by walking the tree."""
    root = ElementTree.fromstring(page)
    size = lambda e, inside=True: len("".join("".join(e.itertext()).split()))

    def linked(e, within=False):
        within = within or e.tag == "a"
        own = len("".join((e.text or "").split())) if within else 0
        return own + sum(linked(c, within) + (len("".join((c.tail or "").split())) if within else 0) for c in e)

    share = linked(root) / size(root)

    def density(e):
        c, t, lc, lt = size(e), len(list(e.iter())) - 1 or 1, linked(e), len(list(e.iter("a"))) - (e.tag == "a")
        if not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
        return c / t * math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0) + 1) / max(math.log(base), 0.1)

    order = list(root.iter())
    return [density(e) for e in order], [sum(density(c) for c in e) for e in order]


def test_densities_are_the_plain_ones():
    dom = htmltext.Dom()
    dom.feed(PAGE)
    dom.close()
    dense = htmltext.densities(dom)[0][1:]
    want, sums = _restated(PAGE)
    assert dense == pytest.approx(want)
    # The article's block has the greatest density sum of all blocks below the body's.
    tags = [e.tag for e in ElementTree.fromstring(PAGE).iter()]
    blocks = [i for i, t in enumerate(tags) if t == "div"]
    assert max(blocks, key=lambda i: sums[i]) in (blocks[1], blocks[2])
    assert htmltext.main_text(PAGE).startswith("A paragraph of some length") and "two" not in htmltext.main_text(PAGE)


def _soup():
    menu = "<div>" + "".join(f"<div><a href=x>Topic {k}</a></div>" for k in range(12)) + "</div>"
    side = "<div><div><a href=y>Read this other story</a></div><div><a href=z>And one more that you may like</a></div></div>"
    body = "<div><div>" + "".join(f"<div>Paragraph {k}. {'Words that tell the story. ' * 12}</div>" for k in range(6)) + "</div></div>"
    foot = "<div><div><a href=t>Terms</a></div><div><a href=p>Privacy</a></div></div>"
    return menu, side, body, foot


def test_only_density_tells():
    """Nothing but div and a: no name, role or element speaks of the page's parts."""
    menu, side, body, foot = _soup()
    for page in (menu + side + body + foot, side + body + menu + foot, f"<div>{menu}<div>{body}{side}</div></div>{foot}"):
        blocks = htmltext.main_text(f"<html><body>{page}</body></html>").split("\n\n")
        assert [b.split(".")[0] for b in blocks] == [f"Paragraph {k}" for k in range(6)]


def test_density_overrules_a_name():
    menu, side, body, foot = _soup()
    page = f"<html><body>{menu}<div class='sidebar widget'>{body}</div><div class=content>{side}</div>{foot}</body></html>"
    assert [b.split(".")[0] for b in htmltext.main_text(page).split("\n\n")] == [f"Paragraph {k}" for k in range(6)]


def test_a_name_weighs_against_a_dense_block():
    _, _, body, _ = _soup()
    comments = "<div class=comments>" + "".join(f"<p>Reader {k}. {'I do not agree with this at all. ' * 9}</p>" for k in range(20)) + "</div>"
    for page in (f"<body>{body}{comments}</body>", f"<body><article>{body}{comments}</article></body>"):
        text = htmltext.main_text(page)
        assert "Paragraph 5" in text and "Reader" not in text


@pytest.mark.parametrize("page", ["<div>" + "<span>" * 100_000 + "x", "<b><article>" + "<span>" * 50_000 + "</b>" * 50_000 + "x", "<p><li>" * 50_000 + "x", "<div>" * 100_000 + "x"])
def test_deep_pages_take_linear_time(page):
    began = time.process_time()
    assert htmltext.main_text(page) == "x"
    assert time.process_time() - began < 5


def test_clashing_columns_and_nothing(spark):
    pages = spark.createDataFrame([(1, "u", "<p>text</p>", "own")], "page_id int, url string, html string, main_text string").withColumn("h", F.lit(1)).withColumn("_h", F.lit(2))
    out = htmltext.extract(pages)
    assert out.columns == [*pages.columns, "_main_text"]
    assert [(r["main_text"], r["_main_text"]) for r in out.collect()] == [("own", "text")]
    assert htmltext.extract(pages.where("false")).count() == 0 and htmltext.page_texts(pages.where("false")).count() == 0
