"""Sinks: dataset folders, staging, cards, the audit log, the hub behind a transport.

Samples are rendered once: the tasks that hold them write the images, hash them and make
their manifest and label lines, which go to a written table.  The layout's JSON files are
single files by definition; they are merged row by row from that table and the files of
an earlier run, both in key order, so that the driver holds one row of each.

A destination is a folder that every machine sees; a task that doesn't see it says so.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import heapq
import json
import os
import re
import shutil
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import image_name, page_name
from ..scratch import Scratch


class DestinationNotEmptyError(ValueError):
    """One class for both layouts, so that every caller can catch it."""


class SnapshotError(ValueError):
    pass


class StagingError(ValueError):
    pass


#: What a page's file name begins with.
PAGE_PREFIX = "page_"


# ------------------------------------------------------------ snapshots


def file_sha(path: str | Path) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def snapshot_of(recipe: dict, tool: str, inputs: dict[str, str]) -> dict:
    return {"tool_version": tool, "seed": recipe.get("seed", 0), "recipe": recipe, "input_hashes": dict(sorted(inputs.items()))}


def snapshot_fits(old: dict, new: dict, growth: bool = True) -> bool:
    """Whether a run can go on: all alike but for the count, which may grow."""

    def bare(s: dict) -> dict:
        r = json.loads(json.dumps(s))
        r["recipe"].get("output", {}).pop("count", None)
        return r

    count = lambda s: s["recipe"].get("output", {}).get("count", 0)
    return bare(old) == bare(new) and (count(new) >= count(old) if growth else count(new) == count(old))


def open_destination(folder: str | Path, snapshot: dict, *, force: bool = False, resume: bool = False) -> Path:
    import yaml

    if force and resume:
        raise ValueError("force and resume exclude each other")
    path, note = Path(folder), Path(folder) / "recipe.snapshot.yaml"
    if path.exists() and any(path.iterdir()):
        if force:
            shutil.rmtree(path)
        elif resume:
            if not note.exists() or not snapshot_fits(yaml.safe_load(note.read_text("utf-8")), snapshot):
                raise SnapshotError(f"{path} holds a run of another recipe")
        else:
            raise DestinationNotEmptyError(f"{path} isn't empty")
    (path / "images").mkdir(parents=True, exist_ok=True)
    note.write_text(yaml.safe_dump(json.loads(json.dumps(snapshot)), sort_keys=True, allow_unicode=True), "utf-8")
    return path


# ------------------------------------------------------------ layouts


def named(rows: DataFrame, count: int, detection: bool) -> DataFrame:
    width = F.lit(max(7, len(str(max(count - 1, 0)))))
    return rows.withColumn("file_name", (page_name if detection else image_name)(F.col("index"), width))


def _put_image(folder: str, r: dict) -> None:
    """The image of a rendered row; what an earlier run left of a skipped one goes."""
    target = f"{folder}/images/{r['file_name']}"
    if r["status"] == "rendered":
        with open(f"{target}.{os.getpid()}.tmp", "wb") as f:
            f.write(r["image"])
        os.replace(f.name, target)
    elif os.path.exists(target):
        os.remove(target)


def _boxes(b) -> list[int]:
    return [b["x0"], b["y0"], b["x1"], b["y1"]]


def _polygon(b) -> list[list[int]]:
    x0, y0, x1, y1 = _boxes(b)
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1]]


def detection_label(r: dict) -> dict:
    """Lines with the words that their rows claim, first line first; the rest apart."""
    lines = [{"text": x["text"], "bbox": _boxes(x["bbox"]), "polygon": _polygon(x["bbox"]), "words": []} for x in r["line_boxes"]]
    left = []
    for w in r["word_boxes"]:
        b = _boxes(w["bbox"])
        middle = (b[1] + b[3]) // 2
        home = next((x for x in lines if x["bbox"][1] <= middle <= x["bbox"][3]), None)
        (home["words"] if home else left).append({"text": w["text"], "bbox": b, "polygon": _polygon(w["bbox"])})
    out = {"img_dimensions": [r["width"], r["height"]], "img_hash": hashlib.sha256(r["image"]).hexdigest(), "polygons": [_polygon(w["bbox"]) for w in r["word_boxes"]], "lines": lines}
    if r["paragraph_boxes"]:
        out["paragraphs"] = [{"text": p["text"], "bbox": _boxes(p["bbox"])} for p in r["paragraph_boxes"]]
    if left:
        out["unassigned_words"] = left
    return out


def manifest_record(r: dict, stages: list[dict], transforms: list, detection: bool) -> dict:
    base = {"index": r["index"], "id": Path(r["file_name"]).stem, "text": r["text"], "status": r["status"]}
    if r["status"] != "rendered":
        extra = {"reason": r["reason"], "missing_codepoints": r["missing"], "font_path": r["font_path"], "message": r["message"]}
        return base | {k: v for k, v in extra.items() if v}
    out = base | {
        "image": f"images/{r['file_name']}",
        "font": {"name": Path(r["font_path"]).name, "path": r["font_path"], "size_pt": r["font_size_pt"]},
        "render": {"dpi": r["dpi"], "ink_rgb": list(r["ink"]), "bg_rgb": list(r["background"])},
        "size": [r["width"], r["height"]],
        "bbox": _boxes(r["bbox"]),
        "transforms_applied": transforms,
        "degradations_applied": [{k: s[k] for k in ("kind", "probability", "name") if k in s} for s in stages],
    }
    if r["word_boxes"] and not detection:
        out["word_boxes"] = [{"text": w["text"], "bbox": _boxes(w["bbox"])} for w in r["word_boxes"]]
    if detection:
        out |= {"n_lines": len(r["line_boxes"]), "n_words": len(r["word_boxes"])} | ({"n_paragraphs": len(r["paragraph_boxes"])} if r["paragraph_boxes"] else {})
    return out


def _read_jsonl(path: Path) -> Iterator[dict]:
    """The objects among a file's lines, one at a time."""
    if not path.exists():
        return
    with open(path, encoding="utf-8") as f:
        for line in f:
            try:
                row = json.loads(line)
            except ValueError:
                continue
            if isinstance(row, dict):
                yield row


def _read_labels(path: Path) -> Iterator[tuple[str, object]]:
    """(name, label) of a labels file, a line each as ``write_dataset`` writes them; a file
    in another layout is read whole."""
    if not path.exists():
        return
    with open(path, encoding="utf-8") as f:
        if f.readline() != "{\n":
            f.seek(0)
            yield from sorted(json.load(f).items())
            return
        for line in f:
            if line.strip() not in ("}", ""):
                yield from json.loads("{" + line.strip().rstrip(",") + "}").items()


def _merged(old: Iterable[tuple], new: Iterable[tuple]) -> Iterator[tuple]:
    """(key, value) of two sequences in key order; a new value replaces an old one."""
    last, held = None, None
    for key, rank, value in heapq.merge(((k, 0, v) for k, v in old), ((k, 1, v) for k, v in new), key=lambda x: x[:2]):
        if held is not None and key != last:
            yield last, held
        last, held = key, value
    if held is not None:
        yield last, held


_LINES = "index bigint, file_name string, record string, label string"


def _store(folder: str, detection: bool, stages: list[dict], transforms: list) -> Callable:
    """Writes a batch's images and makes its manifest and label lines."""
    dump = lambda x: json.dumps(x, ensure_ascii=False)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if not os.path.isdir(f"{folder}/images"):
            raise FileNotFoundError(f"{folder}/images isn't there: the destination must be a folder that every machine sees")
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                r = {k: _plain(v) for k, v in r.items()}
                _put_image(folder, r)
                label = (detection_label(r) if detection else r["text"]) if r["status"] == "rendered" else None
                out.append((r["index"], r["file_name"], dump(manifest_record(r, stages, transforms, detection)), None if label is None else dump(label)))
            yield pd.DataFrame(out, columns=["index", "file_name", "record", "label"])

    return run


def _plain(value):
    """A cell as Python values: arrays as lists, missing numbers as None."""
    if hasattr(value, "tolist") and not isinstance(value, bytes):
        value = value.tolist()
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return None if value is pd.NA or (isinstance(value, float) and value != value) else value


class Stats:
    """Counts over manifest records, as they pass."""

    def __init__(self, planned: int):
        self.counts = {"count_planned": planned, "count_written": 0, "count_skipped": 0, "skip_reasons": {}, "fonts_used": {}, "lines": 0, "words": 0, "paragraphs": 0}

    def add(self, r: dict) -> None:
        c, rendered = self.counts, r["status"] == "rendered"
        name = r["font"]["name"] if rendered else r.get("reason", "unknown")
        kind = c["fonts_used" if rendered else "skip_reasons"]
        kind[name] = kind.get(name, 0) + 1
        c["count_written" if rendered else "count_skipped"] += 1
        for x in ("lines", "words", "paragraphs"):
            c[x] += r.get(f"n_{x}", 0)


def write_dataset(rendered: DataFrame, folder: str | Path, count: int, *, detection: bool = False, stages: list[dict] | None = None, transforms: list | None = None, labels: bool = True) -> dict:
    """images/, labels.json, manifest.jsonl and stats.json; returns the stats.

    Rows of indexes that are there already replace them, so that running twice is once.
    A row's own ``file_name`` is kept; without ``labels`` no labels are written (previews).
    """
    path, dump = Path(folder), lambda x: json.dumps(x, ensure_ascii=False)
    rows = rendered if "file_name" in rendered.columns else named(rendered, count, detection)
    stats = Stats(count)
    with Scratch.dropped():
        made = Scratch(rendered.sparkSession, "dataset").write(rows.mapInPandas(_store(str(path), detection, stages or [], transforms or []), _LINES), "lines")
        new = ((r["index"], json.loads(r["record"])) for r in made.select("index", "record").orderBy("index").toLocalIterator())
        old = ((r["index"], r) for r in _read_jsonl(path / "manifest.jsonl"))
        with open(path / "manifest.jsonl.tmp", "w", encoding="utf-8") as f:
            for _, r in _merged(old, new):
                f.write(dump(r) + "\n")
                stats.add(r)
        if labels:
            new = ((r["file_name"], (r["label"],)) for r in made.select("file_name", "label").orderBy("file_name").toLocalIterator())
            old = ((name, (dump(label),)) for name, label in _read_labels(path / "labels.json"))
            with open(path / "labels.json.tmp", "w", encoding="utf-8") as f:
                start = "{\n"
                for name, (label,) in _merged(old, new):
                    if label is not None:
                        f.write(f"{start}{dump(name)}: {label}")
                        start = ",\n"
                f.write("\n}\n" if start != "{\n" else "{}\n")
            os.replace(path / "labels.json.tmp", path / "labels.json")
        os.replace(path / "manifest.jsonl.tmp", path / "manifest.jsonl")
    (path / "stats.json").write_text(json.dumps(stats.counts, ensure_ascii=False, indent=1, sort_keys=True), "utf-8")
    return stats.counts


# ------------------------------------------------------------ audit log


def now_utc() -> str:
    return dt.datetime.now(dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def append_audit(entry: dict, files: list[str | Path]) -> list[str]:
    """One line to each log; a log that can't be written is named, not raised."""
    failed = []
    for path in files:
        try:
            Path(path).parent.mkdir(parents=True, exist_ok=True)
            with open(path, "a", encoding="utf-8") as f:
                f.write(json.dumps({"schema_version": 1, **entry}, ensure_ascii=False) + "\n")
        except OSError as e:
            failed.append(f"{path}: {e}")
    return failed


# ------------------------------------------------------------ publishing


class Transport(Protocol):
    def create_repo(self, repo: str, private: bool) -> None: ...
    def card(self, repo: str) -> dict | None: ...
    def upload(self, repo: str, folder: str, message: str) -> str: ...
    def tag(self, repo: str, name: str, commit: str) -> None: ...


class MemoryTransport:
    """Keeps repositories in memory; for tests and dry runs."""

    def __init__(self):
        self.repos: dict[str, dict] = {}

    def create_repo(self, repo, private):
        self.repos.setdefault(repo, {"private": private, "files": {}, "commits": [], "tags": {}})

    def card(self, repo):
        data = self.repos.get(repo, {}).get("files", {}).get("README.md")
        return front_matter(data.decode()) if data else None

    def upload(self, repo, folder, message):
        files = {str(p.relative_to(folder)): p.read_bytes() for p in sorted(Path(folder).rglob("*")) if p.is_file()}
        self.repos[repo]["files"] = files
        commit = hashlib.sha256(message.encode() + b"".join(files.values())).hexdigest()[:40]
        self.repos[repo]["commits"].append((commit, message))
        return commit

    def tag(self, repo, name, commit):
        self.repos[repo]["tags"][name] = commit


class HubTransport:
    """The hub through its own client library, if that is installed."""

    def __init__(self, token: str | None = None):
        try:
            from huggingface_hub import HfApi
        except ImportError as e:
            raise TransportError("the hub's client library isn't installed") from e
        self.api = HfApi(token=token)

    def create_repo(self, repo, private):
        self.api.create_repo(repo, repo_type="dataset", private=private, exist_ok=True)

    def card(self, repo):
        from huggingface_hub.utils import EntryNotFoundError, RepositoryNotFoundError

        try:
            return front_matter(Path(self.api.hf_hub_download(repo, "README.md", repo_type="dataset")).read_text("utf-8"))
        except (EntryNotFoundError, RepositoryNotFoundError):
            return None

    def upload(self, repo, folder, message):
        # What the folder no longer holds goes from the hub as well.
        return self.api.upload_folder(repo_id=repo, folder_path=folder, repo_type="dataset", commit_message=message, delete_patterns="*").oid

    def tag(self, repo, name, commit):
        self.api.create_tag(repo, tag=name, revision=commit, repo_type="dataset", exist_ok=True)


class TransportError(RuntimeError):
    pass


_FRONT = re.compile(r"\A---\n(.*?)\n---\n?", re.S)
_SHA_LINE = re.compile(r"^content_sha: .*\n", re.M)


def front_matter(text: str) -> dict:
    import yaml

    m = _FRONT.match(text)
    return (yaml.safe_load(m[1]) or {}) if m else {}


def tree_sha(folder: str | Path) -> str:
    """Digest of a staged folder; the card counts without its own digest's line."""
    digest = hashlib.sha256()
    for p in sorted((p for p in Path(folder).rglob("*") if p.is_file()), key=lambda p: str(p.relative_to(folder)).encode()):
        name = str(p.relative_to(folder))
        own = hashlib.sha256(_SHA_LINE.sub("", p.read_text("utf-8")).encode()).hexdigest() if name == "README.md" else file_sha(p)
        digest.update(f"{name}\n{own}\n".encode())
    return digest.hexdigest()


def embed_sha(folder: str | Path) -> str:
    card = Path(folder) / "README.md"
    sha = tree_sha(folder)
    bare = _SHA_LINE.sub("", card.read_text("utf-8"))
    card.write_text(bare.replace("---\n", f"---\ncontent_sha: {sha}\n", 1), "utf-8")
    return sha


#: What a dataset of each mode is for.
TASKS = {"recognition": "image-to-text", "detection": "object-detection"}


def dataset_card(name: str, samples: int, license_: str | None, description: str, histograms: dict[str, list[tuple]], top: int = 10, mode: str = "recognition", facts: dict | None = None) -> str:
    """Front matter, description, facts of the run and the most frequent values."""
    bounds = ((1_000, "n<1K"), (10_000, "1K<n<10K"), (100_000, "10K<n<100K"), (1_000_000, "100K<n<1M"), (10_000_000, "1M<n<10M"))
    size = next((n for b, n in bounds if samples < b), "n>10M") if samples > 0 else None
    head = {"pretty_name": name, "license": license_, "task_categories": [TASKS[mode]], "size_categories": [size] if size else [], "shape": f"{mode}/v1"}
    import yaml

    out = ["---", yaml.safe_dump(head, sort_keys=True).strip(), "---", "", f"# {name}", "", description.strip(), "", f"Samples: {samples}", ""]
    out += [f"- {k}: {v}" for k, v in (facts or {}).items() if v not in (None, "", [])] + [""]
    for title, counts in histograms.items():
        if counts:
            out += [f"## {title}", ""] + [f"- {v}: {n}" for v, n in counts[:top]] + ([f"- (+{len(counts) - top} more)"] if len(counts) > top else []) + [""]
    return "\n".join(out)


REQUIRED = ("license", "pretty_name", "size_categories", "task_categories")


def preflight(folder: str | Path) -> list[tuple[str, str]]:
    """(key, missing or empty) of the card's required keys."""
    front = front_matter((Path(folder) / "README.md").read_text("utf-8"))
    return [(k, "missing" if k not in front else "empty") for k in REQUIRED if front.get(k) in (None, "", [], {})]


def _open_staging(local: Path, staging: Path, overwrite: bool) -> None:
    if not (local / "images").is_dir() or not (local / "labels.json").is_file():
        raise StagingError(f"{local} holds no dataset")
    if staging.exists() and any(staging.iterdir()):
        if not overwrite:
            raise DestinationNotEmptyError(f"{staging} is there already")
        shutil.rmtree(staging)
    (staging / "data").mkdir(parents=True, exist_ok=True)


def _by_count(counts: dict) -> list[tuple]:
    return sorted(((k, n) for k, n in counts.items() if k), key=lambda x: (-x[1], x[0]))


def _card(local: Path, staging: Path, mode: str, samples: int, license_: str | None, histograms: dict[str, dict]) -> str | None:
    """The snapshot's copy and the card made from it; None without a snapshot."""
    import yaml

    note = local / "recipe.snapshot.yaml"
    if not note.is_file():
        return None
    shutil.copyfile(note, staging / note.name)
    snapshot = yaml.safe_load(note.read_text("utf-8")) or {}
    recipe = snapshot.get("recipe") or {}
    publish = recipe.get("publish") or {}
    about = Path(publish["description_file"]).read_text("utf-8") if publish.get("description_file") and Path(publish["description_file"]).is_file() else recipe.get("description") or ""
    facts = {
        "recipe": recipe.get("name"), "recipe_sha": file_sha(note), "tool_version": snapshot.get("tool_version"), "seed": snapshot.get("seed"),
        "corpus": ", ".join(str(c.get("path") or c.get("url") or c.get("titles")) for c in recipe.get("corpus") or []), "transforms": ", ".join(t if isinstance(t, str) else next(iter(t)) for t in recipe.get("text_transforms") or []),
    }
    card = dataset_card(recipe.get("name") or local.name, samples, license_ or publish.get("license"), about, {k: _by_count(v) for k, v in histograms.items()}, mode=mode, facts=facts)
    (staging / "README.md").write_text(card, "utf-8")
    return embed_sha(staging)


def stage_recognition(local: str | Path, staging: str | Path, license_: str | None = None, overwrite: bool = False) -> dict:
    """data/, metadata.jsonl, the snapshot and the card."""
    local, staging = Path(local), Path(staging)
    _open_staging(local, staging, overwrite)
    records = ((Path(r["image"]).name, r) for r in _read_jsonl(local / "manifest.jsonl") if r.get("image"))
    missing, rows, fonts, stages = [], 0, {}, {}
    pairs = heapq.merge(((n, 1, t) for n, t in _read_labels(local / "labels.json")), ((n, 0, r) for n, r in records), key=lambda x: x[:2])
    name_of, record = None, {}
    with open(staging / "metadata.jsonl", "w", encoding="utf-8") as f:
        for name, kind, value in pairs:
            if kind == 0:
                name_of, record = name, value
                continue
            if not (local / "images" / name).is_file():
                missing.append(name)
                continue
            shutil.copyfile(local / "images" / name, staging / "data" / name)
            r = record if name_of == name else {}
            row = {"file_name": f"data/{name}", "text": value, "font": r.get("font", {}).get("name"), "font_size_pt": r.get("font", {}).get("size_pt"), "degradations": [d.get("kind") or d.get("name") for d in r.get("degradations_applied", [])]}
            f.write(json.dumps({k: v for k, v in row.items() if v not in (None, [])}, ensure_ascii=False) + "\n")
            rows += 1
            fonts[row["font"]] = fonts.get(row["font"], 0) + 1
            for d in row["degradations"]:
                stages[d] = stages.get(d, 0) + 1
    sha = _card(local, staging, "recognition", rows, license_, {"Fonts": fonts, "Degradations": stages})
    return {"rows": rows, "missing": missing, "sha": sha}


def stage_detection(local: str | Path, staging: str | Path, license_: str | None = None, overwrite: bool = False) -> dict:
    """data/ with the labelled pages, labels.json as it is, the snapshot and the card.

    Labels of anything but pages are an error: they would not fit the layout.
    """
    local, staging = Path(local), Path(staging)
    _open_staging(local, staging, overwrite)
    missing, rows = [], 0
    for name, _ in _read_labels(local / "labels.json"):
        if not name.startswith(PAGE_PREFIX):
            raise StagingError(f"labels.json: {name!r} doesn't begin with {PAGE_PREFIX!r}")
        if not (local / "images" / name).is_file():
            missing.append(name)
            continue
        shutil.copyfile(local / "images" / name, staging / "data" / name)
        rows += 1
    shutil.copyfile(local / "labels.json", staging / "labels.json")
    fonts: dict[str, int] = {}
    for r in _read_jsonl(local / "manifest.jsonl"):
        if r.get("status") == "rendered":
            name = r.get("font", {}).get("name")
            fonts[name] = fonts.get(name, 0) + 1
    sha = _card(local, staging, "detection", rows, license_, {"Fonts": fonts})
    return {"rows": rows, "missing": missing, "sha": sha}


STAGING = {"recognition": stage_recognition, "detection": stage_detection}


def commit_message(given: str | None, staging: str | Path) -> str:
    """The given message unless it is blank, else one that names the snapshot's digest."""
    note = Path(staging) / "recipe.snapshot.yaml"
    return (given or "").strip() or f"scriptorium render{f' @{file_sha(note)}' if note.is_file() else ''}"


def publish(transport: Transport, repo: str, staging: str | Path, *, private: bool = True, message: str | None = None, tag: str | None = None) -> dict:
    """preflight, digest, comparison with what is there, create, upload, tag."""
    problems = preflight(staging)
    if problems:
        raise ValueError(f"dataset card: {problems}")
    sha = embed_sha(staging)
    card = transport.card(repo)
    if card and card.get("content_sha") == sha:
        return {"state": "same", "sha": sha, "commit": None}
    transport.create_repo(repo, private)
    commit = transport.upload(repo, str(staging), commit_message(message, staging))
    if tag:
        transport.tag(repo, tag, commit)
    return {"state": "changed" if card else "new", "sha": sha, "commit": commit}


def resolve_token(flag: str | None, env: dict[str, str], file: str | Path | None) -> str | None:
    """Flag, then environment, then file; blank counts as missing."""
    read = Path(file).read_text("utf-8") if file and Path(file).is_file() else None
    return next((t.strip() for t in (flag, env.get("HF_TOKEN"), read) if t and t.strip()), None)
