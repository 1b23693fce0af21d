"""Runs of a recipe: plan, fetch, tokens, samples, render, preview."""

from __future__ import annotations

import sys
import threading
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import __version__
from ..functions.text import apply_chain
from ..operators.filters import pending
from ..operators.images import list_textures
from ..operators.render import render_rows
from ..operators.sampling import draw_style, pick_from_texts
from ..operators.tokenize import tokens_of
from ..scratch import Scratch
from ..sources import sinks
from ..sources.cache import CacheStore, key_of
from ..sources.readers import PROVIDERS, SourceError, read_corpus
from .recipe import Recipe


def entry_key(entry: dict) -> str:
    parts = {"local": ("parser", "path"), "web": ("parser", "field_path", "url")}.get(entry["type"], ("language", "titles"))
    return key_of(entry["type"], *[str(entry.get(p) or "") for p in parts])


#: Sources that are read where they are, in every run.
UNCACHED = {"local"}


def fetch(spark: SparkSession, recipe: Recipe, cache: CacheStore, refresh: bool = False, only: list[bool] | None = None) -> list[dict]:
    """Every entry (or those that ``only`` marks) once, into the cache; an entry that fails
    doesn't stop the others."""
    out = []
    for i, entry in enumerate(recipe.model_dump()["corpus"]):
        if only and not only[i]:
            continue
        began, key, row = time.time(), entry_key(entry), {"index": i, "type": entry["type"], "key": entry_key(entry), "error": None}
        try:
            cached = cache.has(entry["type"], key) and not refresh and entry["type"] not in UNCACHED
            if not cached:
                chunks = PROVIDERS.get(entry["type"])(spark, entry).orderBy("ord").toLocalIterator()
                texts = []
                for chunk in chunks:
                    if chunk["text"] is None:
                        raise SourceError(chunk["error"])
                    texts.append(chunk["text"])
                cache.write(entry["type"], key, "\n".join(texts), str(entry.get("path") or entry.get("url") or entry.get("titles")))
            row |= {"was_cached": cached, "chars": len(cache.read_text(entry["type"], key))}
        except (SourceError, OSError, ValueError) as e:
            row |= {"was_cached": False, "chars": 0, "error": str(e)}
        out.append(row | {"elapsed_s": round(time.time() - began, 3)})
    return out


def corpus(spark: SparkSession, recipe: Recipe, cache: CacheStore | None = None) -> DataFrame:
    """(entry, ord, text) after the line filters and the ordered transforms.

    With a cache, remote entries come from it; what it lacks is fetched into it first.

    Document boundaries count as paragraph breaks; texts stay rows and are never joined
    into one string.
    """
    entries = recipe.model_dump()["corpus"]
    held = {}
    if cache is not None:
        remote = [e["type"] not in UNCACHED for e in entries]
        for row in fetch(spark, recipe, cache, only=remote) if any(remote) else []:
            if row["error"]:
                raise SourceError(row["error"])
            held[row["index"]] = cache.read_text(row["type"], row["key"])
    df = read_corpus(spark, entries, held=held)
    key = F.concat_ws(":", "entry", "ord")
    return df.withColumn("text", apply_chain(F.col("text"), recipe.text_transforms, seed=recipe.seed, key=key))


def present_fonts(recipe: Recipe) -> list[dict]:
    fonts = [f.model_dump() for f in recipe.fonts if Path(f.path).is_file()]
    absent = [f.path for f in recipe.fonts if not f.optional and not Path(f.path).is_file()]
    if absent or not fonts:
        raise FileNotFoundError(f"fonts: {', '.join(absent) or 'none is there'}")
    return fonts


def plan(spark: SparkSession, recipe: Recipe, cache: CacheStore | None = None) -> dict:
    totals = corpus(spark, recipe, cache).agg(F.sum(F.length("text"))).first()[0] or 0
    here = [f for f in recipe.fonts if Path(f.path).is_file()]
    return {
        "name": recipe.name, "mode": recipe.layout.mode, "count": recipe.output.count, "seed": recipe.seed, "corpus_chars": totals, "fonts_present": len(here),
        "fonts_missing_optional": sum(f.optional for f in recipe.fonts if f not in here), "transforms": [s if isinstance(s, str) else next(iter(s)) for s in recipe.text_transforms],
    }


def samples(spark: SparkSession, recipe: Recipe, count: int | None = None, cache: CacheStore | None = None) -> DataFrame:
    """(index, text, style) of a run's samples."""
    drawn = pick_from_texts(spark, corpus(spark, recipe, cache), tokens_of(F.col("text"), recipe.layout.mode), count or recipe.output.count, recipe.seed, key=["entry", "ord"])
    look = recipe.model_dump(exclude_none=True)
    look["fonts"] = present_fonts(recipe)
    return draw_style(drawn.withColumnRenamed("token", "text"), look, recipe.seed, page=recipe.layout.mode == "pages")


def rendered(recipe: Recipe, drawn: DataFrame) -> DataFrame:
    fonts = {f["path"]: Path(f["path"]).read_bytes() for f in present_fonts(recipe)}
    stages = with_textures(drawn.sparkSession, [s.model_dump() for s in recipe.degradation])
    return render_rows(drawn, recipe.layout.mode, fonts, recipe.layout.model_dump(exclude_none=True), stages, recipe.seed)


def with_textures(spark: SparkSession, stages: list[dict]) -> list[dict]:
    """Each ``paper_texture`` stage with the names of its folder's images, which Spark sends
    to every machine once."""
    out = []
    for stage in stages:
        if stage["kind"] == "paper_texture" and "textures" not in stage:
            names = []
            for path in list_textures(stage.get("directory")):
                held = f"{sinks.file_sha(path)[:32]}{path.suffix.lower()}"
                if held not in _sent.setdefault(spark.sparkContext.applicationId, set()):
                    spark.sparkContext.addFile(Scratch(spark, "textures").put(held, path.read_bytes()))
                    _sent[spark.sparkContext.applicationId].add(held)
                names.append(held)
            stage = {**stage, "textures": names}
        out.append(stage)
    return out


_sent: dict[str, set[str]] = {}


class Progress:
    """Progress on stderr: a line that is drawn anew at most twice a second on a terminal,
    and one line with the rate at the end."""

    def __init__(self, spark: SparkSession, total: int, every: float = 0.5, out=None):
        self.spark, self.total, self.every, self.out = spark, total, every, out or sys.stderr
        self.stop, self.began = threading.Event(), time.monotonic()
        self.thread = threading.Thread(target=self._run, daemon=True) if self.out.isatty() else None

    def _share(self) -> float:
        tracker = self.spark.sparkContext.statusTracker()
        found = [tracker.getStageInfo(i) for i in tracker.getActiveStageIds()]
        tasks = sum(x.numTasks for x in found if x)
        return sum(x.numCompletedTasks for x in found if x) / tasks if tasks else 0.0

    def _run(self) -> None:
        while not self.stop.wait(self.every):
            print(f"\r{self._share():6.1%} of the stage's tasks, {self.total} samples", end="", file=self.out, flush=True)

    def __enter__(self) -> Progress:
        if self.thread:
            self.thread.start()
        return self

    def __exit__(self, *_) -> None:
        self.stop.set()
        if self.thread:
            self.thread.join()
            print(file=self.out)

    def done(self, count: int) -> None:
        took = time.monotonic() - self.began
        print(f"rendered {count}/{self.total} in {took:.1f}s ({count / took if took else 0:.1f} samples/s)", file=self.out)


def render(spark: SparkSession, recipe: Recipe, *, force: bool = False, resume: bool = False, cache: CacheStore | None = None, audit: list[str] | None = None, log: bool = True) -> dict:
    began = time.time()
    raw = recipe.model_dump(mode="json", exclude={"source_path"})
    inputs = {f.path: sinks.file_sha(f.path) for f in recipe.fonts if Path(f.path).is_file()}
    out = sinks.open_destination(recipe.output.destination, sinks.snapshot_of(raw, __version__, inputs), force=force, resume=resume)
    drawn = samples(spark, recipe, cache=cache)
    done = out / "manifest.jsonl"
    if resume and done.exists():
        manifest = spark.read.schema("index bigint, status string").json(str(done))
        drawn = pending(drawn, manifest)
    with Progress(spark, recipe.output.count) as progress:
        stats = sinks.write_dataset(
            rendered(recipe, drawn), out, recipe.output.count, detection=recipe.output.mode == "detection", stages=[s.model_dump() for s in recipe.degradation], transforms=[s if isinstance(s, str) else next(iter(s)) for s in recipe.text_transforms]
        )
    progress.done(stats["count_written"])
    sha = sinks.file_sha(recipe.source_path) if recipe.source_path and Path(recipe.source_path).is_file() else None
    entry = {
        "timestamp": sinks.now_utc(), "recipe_name": recipe.name, "recipe_sha": sha, "output_dir": str(out), "count": recipe.output.count, "seed": recipe.seed, "workers": spark.sparkContext.defaultParallelism,
        "rendered": stats["count_written"], "skipped": stats["count_skipped"], "runtime_seconds": round(time.time() - began, 3),
    }
    stats["audit_failures"] = sinks.append_audit(entry, [out / "_audit.jsonl", *(audit or [])] if log else [])
    return stats


def preview(spark: SparkSession, recipe: Recipe, folder: str | Path, count: int = 50, cache: CacheStore | None = None) -> dict:
    """Images named by seed and index, with a manifest and stats of what was drawn and what
    was skipped, of this preview alone."""
    from ..functions.scalars import preview_name

    Path(folder, "images").mkdir(parents=True, exist_ok=True)
    Path(folder, "manifest.jsonl").unlink(missing_ok=True)
    rows = rendered(recipe, samples(spark, recipe, count, cache)).withColumn("file_name", preview_name(F.lit(recipe.seed), F.col("index")))
    stats = sinks.write_dataset(rows, folder, count, labels=False, stages=[s.model_dump() for s in recipe.degradation])
    return {"rendered": stats["count_written"], "skipped": stats["count_skipped"], "skip_reasons": stats["skip_reasons"]}
