"""Source decoders: plain text, HTML, TEI, JSON."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ParserError(ValueError):
    pass


class _Nodes(HTMLParser):
    """Text nodes in order; comments and declarations part them and have no text."""

    def __init__(self, skip: frozenset[str], only: str | None = None):
        super().__init__(convert_charrefs=True)
        self.skip, self.only = skip, only
        self.depth, self.inside, self.done = 0, 0, False
        self.texts: list[str] = []
        self.chosen: list[str] = []
        self._glue = False

    def _cut(self):
        self._glue = False

    def handle_starttag(self, tag, attrs):
        self._cut()
        if tag in self.skip:
            self.depth += 1
        elif tag == self.only and not self.done and not self.depth:
            self.inside += 1

    def handle_endtag(self, tag):
        self._cut()
        if tag in self.skip:
            self.depth = max(0, self.depth - 1)
        elif tag == self.only and self.inside and not self.depth:
            self.inside -= 1
            self.done = not self.inside

    def handle_startendtag(self, tag, attrs):
        self._cut()

    def handle_comment(self, data):
        self._cut()

    def handle_decl(self, decl):
        self._cut()

    def handle_pi(self, data):
        self._cut()

    def handle_data(self, data):
        if self.depth:
            return
        for into in [self.texts] + ([self.chosen] if self.inside else []):
            if self._glue and into:
                into[-1] += data
            else:
                into.append(data)
        self._glue = True


def html_text(body: str) -> str:
    """Every text node on lines of its own, stripped, blank runs as one blank line."""
    nodes = _Nodes(frozenset(["script", "style"]))
    nodes.feed(body)
    nodes.close()
    rows = [line.strip() for line in "\n".join(nodes.texts).splitlines()]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(rows)).strip() + "\n"


def tei_text(body: str) -> str:
    """The first ``<text>`` outside any header, without headers; else the whole document."""
    nodes = _Nodes(frozenset(["teiheader"]), "text")
    nodes.feed(body)
    nodes.close()
    return "\n".join(nodes.chosen if nodes.inside or nodes.done else nodes.texts).strip() + "\n"


def split_path(path: str) -> list[str]:
    if not path.startswith("$"):
        raise ParserError(f"a JSON path starts with $: {path!r}")
    return [p for p in path[1:].replace("[*]", ".*").split(".") if p]


def json_text(body: str, path: str | None = None) -> str:
    """The values at ``path``, a line each; without a path the document, written anew."""
    whole = json.loads(body)
    parts = split_path(path) if path else []
    if not parts and path in (None, "$", "$."):
        return json.dumps(whole, ensure_ascii=False)
    found = [whole]
    for part in parts:
        if part == "*":
            if not all(isinstance(x, (list, dict)) for x in found):
                raise ParserError("* stands for the items of a list or an object")
            found = [y for x in found for y in (x.values() if isinstance(x, dict) else x)]
        else:
            if not all(isinstance(x, dict) and part in x for x in found):
                raise ParserError(f"JSON path: {part!r} is missing")
            found = [x[part] for x in found]
    return "\n".join(x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in found) + "\n"


PARSERS: dict[str, Callable[..., str]] = {"plain": lambda body: body, "html-text": html_text, "tei-text": tei_text, "json": json_text}


def get_parser(name: str) -> Callable[..., str]:
    if name not in PARSERS:
        raise ParserError(f"parser {name!r} is unknown; known are {', '.join(sorted(PARSERS))}")
    return PARSERS[name]


def parse(body: Column, parser: str, path: str | None = None) -> Column:
    """A parser as a column; ``plain`` is the column itself."""
    run = get_parser(parser)
    if parser == "plain":
        return body
    options = {"path": path} if parser == "json" else {}

    @F.pandas_udf(T.StringType())
    def udf(bodies: pd.Series) -> pd.Series:
        return bodies.map(lambda b: None if b is None else run(b, **options))

    return udf(body)


def json_lines(body: Column, path: str) -> Column:
    """``json_text`` for paths through objects and lists, without leaving the JVM; null
    where the body isn't JSON, the path is missing or ``*`` stands for a plain value.

    Values of an object's ``*`` come in the order of their keys; objects and lists at the
    path's end are written without spaces.
    """
    found = F.array(F.try_parse_json(body))
    for part in split_path(path):
        if part == "*":
            found = F.flatten(F.transform(found, _items))
        else:
            found = F.transform(found, _member(part))
        found = F.when(~F.exists(found, lambda v: v.isNull()), found)
    value = lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))
    return F.concat(F.array_join(F.transform(found, value), "\n"), F.lit("\n"))


def _member(name: str) -> Callable[[Column], Column]:
    quote = '"' if "'" in name else "'"
    at = f"$[{quote}{name}{quote}]"
    return lambda v: F.try_variant_get(v, at, "variant")


def _items(v: Column) -> Column:
    """The items of a list or an object; one null for anything else."""
    kind = F.schema_of_variant(v)
    members = F.map_values(F.try_variant_get(v, "$", "map<string,variant>"))
    listed = F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(kind.startswith("OBJECT"), members)
    return F.coalesce(listed, F.array(F.lit(None).cast("variant")))


def parser_of(path: Column) -> Column:
    """The parser that a file name's suffix speaks for."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^./]*)$", 1))
    return F.when(suffix.isin("html", "htm"), "html-text").when(suffix.isin("xml", "tei"), "tei-text").when(suffix == "json", "json").otherwise("plain")
