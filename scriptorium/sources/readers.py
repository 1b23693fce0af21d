"""Scans: local text, pages, JSON lines, maps of labels, the corpus of a recipe."""

from __future__ import annotations

import glob
import json
import os
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.filters import TRANSIENT, filter_lines
from .parsers import ParserError, get_parser, parser_of


class SourceError(ValueError):
    pass


def expand(raw: str, base: Path = Path(".")) -> list[str]:
    """Files of a path, a pattern or a folder (with its subfolders), sorted."""
    path = raw if os.path.isabs(raw) else str(base / raw)
    if any(c in path for c in "*?["):
        found = sorted(p for p in glob.glob(path, recursive=True) if os.path.isfile(p))
        if not found:
            raise SourceError(f"no file fits {raw}")
        return found
    if os.path.isdir(path):
        found = sorted(os.path.join(d, n) for d, _, names in os.walk(path) for n in names)
        if not found:
            raise SourceError(f"folder {raw} is empty")
        return found
    if not os.path.exists(path):
        raise SourceError(f"{raw} isn't there")
    return [path]


def read_local(spark: SparkSession, raw: str, base: Path = Path(".")) -> DataFrame:
    """(ord, path, text): a row per file, in the order of the paths; plain text only."""
    files = expand(raw, base)
    bad = [f for f in files if Path(f).suffix.lower() not in (".txt", ".text", "") and _suffix_parser(f) != "plain"]
    if bad:
        raise SourceError(f"local text is plain: {bad[0]}")
    # Paths are patterns to Spark: what has a meaning there is escaped.
    raw = spark.read.format("binaryFile").load([re.sub(r"([\\*?\[\]{},])", r"\\\1", os.path.abspath(f)) for f in files])
    found = raw.select(plain_path(F.col("path")).alias("path"), "content")
    listed = spark.createDataFrame([(i, os.path.abspath(f)) for i, f in enumerate(files)], "ord int, path string")
    told = listed.join(found, "path", "left")
    text = F.col("content").cast("string")
    fault = F.when(F.col("content").isNull(), "wasn't read").when(~F.is_valid_utf8(text), "isn't UTF-8")
    text = F.when(fault.isNotNull(), F.raise_error(F.concat_ws(" ", "path", fault))).otherwise(text)
    return told.select("ord", "path", line_ends(text).alias("text"))


def plain_path(uri: Column) -> Column:
    """The local path in a ``file:`` URI as Spark gives it."""
    return F.regexp_replace(uri, "^file:/+", "/")


def line_ends(text: Column) -> Column:
    """All line ends as ``\\n``, as reading a text file gives them."""
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def _suffix_parser(path: str) -> str:
    return {"html": "html-text", "htm": "html-text", "xml": "tei-text", "tei": "tei-text", "json": "json"}.get(Path(path).suffix.lower().lstrip("."), "plain")


def read_tree(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, text, parser) of a folder that Spark lists and reads, of any size."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(folder, wholetext=True)
    path = F.input_file_name()
    return files.select(path.alias("path"), F.col("value").alias("text"), parser_of(path).alias("parser"))


def read_binary(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)


# --------------------------------------------------------------- JSON lines


def json_objects(lines: DataFrame, schema: T.StructType | str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rows, unparseable): lines that hold an object, and those that hold something else.
    Blank lines are neither."""
    kind = F.schema_of_variant(F.try_parse_json(F.col(value)))
    there = lines.where(F.trim(F.col(value)) != "")
    good = kind.isNotNull() & kind.startswith("OBJECT")
    rows = there.where(good).select(*[c for c in lines.columns if c != value], F.from_json(value, schema).alias("row"))
    return rows.select(*[c for c in rows.columns if c != "row"], "row.*"), there.where(~F.coalesce(good, F.lit(False)))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) of one log file, numbered in file order.

    Spark leaves out files whose names begin with an underscore or a dot; a run's log is
    such a file, a line a run, and is read where the driver is.
    """
    if os.path.basename(path).startswith(("_", ".")):
        with open(path, encoding="utf-8") as f:
            return spark.createDataFrame(list(enumerate(f.read().split("\n"))), "line_no int, value string")
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split("value", "\n", -1)).alias("line_no", "value"))


def read_labels(spark: SparkSession, path: str, value: str = "string") -> DataFrame:
    """(file_name, label) of a file that is one JSON object."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("file_name", "label"))


# --------------------------------------------------------------------- web


def fetch(url: str, *, opener: Callable = urllib.request.urlopen, retries: int = 3, timeout: float = 30.0, sleep: Callable = time.sleep, wait: Callable[[str], None] | None = None) -> bytes:
    """GET with retries on network errors and passing statuses, each wait twice the last."""
    for attempt in range(retries + 1):
        if wait:
            wait(url)
        try:
            with opener(url, timeout=timeout) as answer:
                return answer.read()
        except urllib.error.HTTPError as e:
            if e.code not in TRANSIENT or attempt == retries:
                raise SourceError(f"{url}: status {e.code}") from e
        except OSError as e:
            if attempt == retries:
                raise SourceError(f"{url}: {e}") from e
        sleep(0.5 * 2**attempt)
    raise SourceError(url)


class HostLimiter:
    """At most one request a host in ``every`` seconds; one object for each reader."""

    def __init__(self, every: float = 1.0, clock: Callable[[], float] = time.monotonic, sleep: Callable = time.sleep):
        self.every, self.clock, self.sleep, self.last = every, clock, sleep, {}

    def wait(self, url: str) -> None:
        host = urllib.parse.urlsplit(url).netloc
        left = self.last.get(host, float("-inf")) + self.every - self.clock()
        if left > 0:
            self.sleep(left)
        self.last[host] = self.clock()


class _Urls(InputPartition):
    def __init__(self, urls: list[tuple[int, str]]):
        self.urls = urls


class WebReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        """One partition a host, so that the limit of requests holds for each."""
        hosts: dict[str, list] = {}
        for i, url in enumerate(u for u in self.options["urls"].split("\n") if u):
            hosts.setdefault(urllib.parse.urlsplit(url).netloc, []).append((i, url))
        return [_Urls(v) for v in hosts.values()]

    def read(self, partition):
        limit = HostLimiter(float(self.options.get("every", 1.0)))
        for i, url in partition.urls:
            try:
                body = fetch(url, retries=int(self.options.get("retries", 3)), wait=limit.wait).decode("utf-8")
                yield i, url, self.decoded(body), None
            except (SourceError, ParserError, ValueError) as e:
                yield i, url, None, f"{url}: {e}"

    def decoded(self, body: str) -> str:
        """The body by the option ``parser``; ``json`` takes the option ``path``."""
        name = self.options.get("parser", "plain")
        if name == "wiki":
            return wiki_text(body)
        return get_parser(name)(body, **({"path": self.options["path"]} if name == "json" and self.options.get("path") else {}))


class WebSource(DataSource):
    """``spark.read.format("scriptorium_web").option("urls", "a\\nb")``; a failed url is a
    row with an error, not a failed job."""

    @classmethod
    def name(cls):
        return "scriptorium_web"

    def schema(self):
        return "ord int, url string, text string, error string"

    def reader(self, schema):
        return WebReader(self.options)


def wikisource_url(language: str, title: str) -> str:
    host = "wikisource.org" if language == "mul" else f"{language}.wikisource.org"
    return f"https://{host}/w/api.php?" + urllib.parse.urlencode({"action": "parse", "page": title, "prop": "text", "format": "json", "formatversion": 2})


def wiki_text(body: str) -> str:
    """The text of a page in an answer of the wiki's ``parse`` action; its errors raise."""
    answer = json.loads(body)
    if "error" in answer:
        raise SourceError(f"the wiki says: {answer['error'].get('info', 'unknown error')}")
    text = (answer.get("parse") or {}).get("text")
    text = text.get("*") if isinstance(text, dict) else text
    if not isinstance(text, str):
        raise SourceError("the wiki's answer holds no text")
    return get_parser("html-text")(text)


# ------------------------------------------------------------------ corpus

Provider = Callable[[SparkSession, dict], DataFrame]


class ProviderRegistry:
    GROUP = "scriptorium.corpus_providers"

    def __init__(self):
        self._known: dict[str, Provider] = {}

    def register(self, name: str, provider: Provider) -> None:
        if self._known.setdefault(name, provider) is not provider:
            raise SourceError(f"provider {name!r} is registered already")

    def names(self) -> list[str]:
        """Registered providers and those of installed plug-ins."""
        from importlib.metadata import entry_points

        return sorted({*self._known, *(p.name for p in entry_points(group=self.GROUP))})

    def get(self, name: str) -> Provider:
        if name not in self._known:
            from importlib.metadata import entry_points

            for point in entry_points(group=self.GROUP, name=name):
                self.register(name, point.load())
        if name not in self._known:
            raise SourceError(f"provider {name!r} is unknown; known are {', '.join(self.names())}")
        return self._known[name]


def _fetched(spark: SparkSession, urls: str, **options) -> DataFrame:
    spark.dataSource.register(WebSource)
    return spark.read.format("scriptorium_web").options(urls=urls, **options).load()


def _web(spark: SparkSession, entry: dict) -> DataFrame:
    path = {"path": entry["field_path"]} if entry.get("field_path") else {}
    return _fetched(spark, entry["url"], parser=entry.get("parser") or "plain", retries=entry.get("retries", 3), **path)


def _wikisource(spark: SparkSession, entry: dict) -> DataFrame:
    """One text for all titles, in their order, a blank line between them; the first title
    that fails is the entry's error."""
    if entry.get("category") or entry.get("max_pages"):
        raise SourceError("wikisource: category and max_pages aren't supported")
    urls = "\n".join(wikisource_url(entry["language"] or "mul", t) for t in entry["titles"])
    raw = _fetched(spark, urls, parser="wiki", retries=entry.get("retries", 3))
    return joined_titles(raw)


def joined_titles(pages: DataFrame) -> DataFrame:
    """(ord, url, text, error) of a list of titles as one row."""
    ordered = F.array_sort(F.collect_list(F.struct("ord", "text", "error")))
    whole = pages.agg(ordered.alias("p"), F.min("url").alias("url"))
    error = F.get(F.filter(F.transform("p", lambda x: x["error"]), lambda e: e.isNotNull()), F.lit(0))
    text = F.concat(F.regexp_replace(F.array_join(F.transform("p", lambda x: x["text"]), "\n\n"), r"\s+$", ""), F.lit("\n"))
    return whole.select(F.lit(0).alias("ord"), "url", F.when(error.isNull(), text).alias("text"), error.alias("error"))


PROVIDERS = ProviderRegistry()
PROVIDERS.register("local", lambda spark, entry: read_local(spark, entry["path"]))
PROVIDERS.register("web", _web)
PROVIDERS.register("wikisource", _wikisource)


def read_corpus(spark: SparkSession, entries: list[dict], registry: ProviderRegistry = PROVIDERS, held: dict[int, str] | None = None) -> DataFrame:
    """(entry, ord, text) of all entries, each with its line filter; UNION ALL in order.

    ``held``: texts of entries that were fetched before.  A remote page that can't be read
    fails the query with its error.
    """
    parts = []
    for i, entry in enumerate(entries):
        if held and i in held:
            df = spark.createDataFrame([(0, held[i])], "ord int, text string")
        else:
            df = registry.get(entry["type"])(spark, entry)
        if "error" in df.columns:
            df = df.withColumn("text", F.when(F.col("error").isNotNull(), F.raise_error(F.col("error"))).otherwise(F.col("text")))
        rules = entry.get("filter") or {}
        text = filter_lines(F.col("text"), rules.get("drop_lines_matching"), rules.get("keep_lines_matching"), rules.get("min_line_chars") or 0)
        parts.append(df.select(F.lit(i).alias("entry"), "ord", text.alias("text")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
