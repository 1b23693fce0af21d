"""Operator 7 on pages without article or main whose text stands in several blocks."""

import pytest

pytest.importorskip("public_tokenizers")
from scriptorium.llm import htmltext  # noqa: E402


def _block(name, n, tag="div"):
    return f"<{tag}><h2>Part {name}</h2>" + "".join(f"<p>{name}{i} {'word ' * 99}</p>" for i in range(n)) + f"</{tag}>"


@pytest.mark.parametrize("tag", ["div", "section"])
def test_sibling_blocks_stay(tag):
    links = "<div>" + "".join(f"<p><a href=x>{'go there ' * 60}</a></p>" for _ in range(3)) + "</div>"
    page = f"<html><body><nav>menu</nav><div id=content>{_block('a', 5, tag)}{_block('b', 3, tag)}</div>{links}<div class=footer><p>foot</p></div></body></html>"
    blocks = htmltext.main_text(page).split("\n\n")
    assert [b.split()[0] for b in blocks] == ["Part", "a0", "a1", "a2", "a3", "a4", "Part", "b0", "b1", "b2"]


def test_blocks_right_under_the_body_stay():
    page = f"<body>{_block('a', 5)}{_block('b', 3)}</body>"
    assert [b.split()[0] for b in htmltext.main_text(page).split("\n\n")] == ["Part", "a0", "a1", "a2", "a3", "a4", "Part", "b0", "b1", "b2"]


def test_dense_block_beside_a_wrapped_one_stays():
    page = f"<body><div><div>{_block('a', 5)}</div></div><div>{_block('b', 3)}</div><div><p>x</p></div></body>"
    assert [b.split()[0] for b in htmltext.main_text(page).split("\n\n")] == ["Part", "a0", "a1", "a2", "a3", "a4", "Part", "b0", "b1", "b2"]


def test_two_blocks_and_nothing_else():
    part = lambda name, n: f"<div><h2>{name}</h2>" + f"<p>{name * 500}</p>" * n + "</div>"
    blocks = htmltext.main_text(f"<body><div id=content>{part('a', 5)}{part('b', 3)}</div></body>").split("\n\n")
    assert [b[0] for b in blocks] == ["a"] * 6 + ["b"] * 4


def test_header_deep_in_an_article_keeps_its_title():
    page = f"<body><article>{'<div>' * 80}<header><h1>Title</h1></header><p>{'word ' * 99}</p>{'</div>' * 80}</article></body>"
    assert htmltext.main_text(page).startswith("Title")
