"""Sources, staging, textures, progress and the command line's edges."""

import io
import json
import struct
import urllib.error
import zlib
from pathlib import Path

import numpy as np
import pytest
import yaml
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from scriptorium import cli
from scriptorium.operators import coverage as C
from scriptorium.operators import images as I
from scriptorium.plans import recipe as R
from scriptorium.plans import run, validate
from scriptorium.sources import parsers, readers, sinks
from scriptorium.sources.cache import CacheStore

from .test_run import FONT, needs_font, raw


def test_local_names_and_encodings(spark, tmp_path):
    files = {"a b.txt": b"one\r\ntwo\rthree", "b[1].txt": "é".encode(), "c{x},%20.txt": b"c", "q?.txt": b"q", "é.txt": b"acc"}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got = readers.read_local(spark, str(tmp_path)).orderBy("ord").collect()
    assert [(Path(r["path"]).name, r["text"]) for r in got] == [(n, d.decode().replace("\r\n", "\n").replace("\r", "\n")) for n, d in sorted(files.items())]
    (tmp_path / "z.txt").write_bytes(b"\xff\xfe")
    with pytest.raises(PySparkException, match="UTF-8"):
        readers.read_local(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("path", ["$.k", "$.a[*].b", "$.one[*].b", "$.o.*", "$.d.*.x", "$.l[*]", "$.sp ace", "$.no'q", "$.m[*][*]", "$.zz", "$.k.*"])
def test_json_lines_is_json_text(spark, path):
    bodies = ['{"k":"v","a":[{"b":"x"},{"b":"y z"}],"one":[{"b":"only"}],"o":{"p":1,"q":"two","r":true},"d":{"e":{"x":"1"}},"l":[],"sp ace":"S","no\'q":"Q","m":[[1,2.5],[null]]}', "no", '{"a":5}', None]
    want = []
    for b in bodies:
        try:
            want.append(parsers.json_text(b, path))
        except (parsers.ParserError, ValueError, TypeError):
            want.append(None)
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string")
    assert [r[0] for r in df.orderBy("i").select(parsers.json_lines(F.col("body"), path)).collect()] == want


def test_web_options_and_wiki_answers(spark):
    reader = readers.WebReader({"urls": "", "parser": "json", "path": "$.text"})
    assert reader.decoded('{"text": "t"}') == "t\n" and readers.WebReader({"urls": ""}).decoded("<p>x</p>") == "<p>x</p>"
    assert readers.wiki_text('{"parse": {"text": "<p>a</p>"}}') == "a\n" == readers.wiki_text('{"parse": {"text": {"*": "<p>a</p>"}}}')
    with pytest.raises(readers.SourceError, match="no such page"):
        readers.wiki_text('{"error": {"info": "no such page"}}')
    pages = [(1, "u1", "b\n", None), (0, "u0", "a\n", None)]
    joined = readers.joined_titles(spark.createDataFrame(pages, "ord int, url string, text string, error string")).first()
    assert joined["text"] == "a\n\n\nb\n" and joined["error"] is None
    failed = readers.joined_titles(spark.createDataFrame([*pages, (2, "u2", None, "u2: gone")], "ord int, url string, text string, error string")).first()
    assert failed["text"] is None and failed["error"] == "u2: gone"


def test_a_failing_page_fails_the_corpus(spark):
    registry = readers.ProviderRegistry()
    registry.register("bad", lambda s, e: s.createDataFrame([(0, None, "u: status 404")], "ord int, text string, error string"))
    with pytest.raises(PySparkException, match="status 404"):
        readers.read_corpus(spark, [{"type": "bad"}], registry).collect()
    assert readers.read_corpus(spark, [{"type": "bad"}], registry, held={0: "kept"}).first()["text"] == "kept"


def test_plug_in_providers_pass_validation(tmp_path):
    entry = {"type": "own_source"}
    codes = lambda: {x[1] for x in validate.issues(R.parse_recipe(raw(tmp_path, corpus=[entry])))}
    assert "corpus_provider_not_implemented" in codes()
    readers.PROVIDERS.register("own_source", lambda s, e: None)
    try:
        assert "corpus_provider_not_implemented" not in codes()
    finally:
        del readers.PROVIDERS._known["own_source"]


# ------------------------------------------------------------ textures


def _png(px, depth, colour, filters, palette=None):
    """A PNG written the long way: every filter, any depth."""
    h, w = px.shape[:2]
    n = I._SAMPLES[colour]
    bits = np.unpackbits(px.reshape(h, -1, 1).astype(np.uint8), axis=2)[:, :, 8 - min(depth, 8) :].reshape(h, -1)
    lines = np.packbits(bits, axis=1) if depth < 8 else px.reshape(h, -1).astype(np.uint8) if depth == 8 else np.repeat(px.reshape(h, -1).astype(np.uint8), 2, axis=1)
    bpp, out, above = max(1, n * depth // 8), b"", [0] * lines.shape[1]
    for y in range(h):
        line, kind = lines[y].tolist(), filters[y % len(filters)]
        left = lambda i, of: of[i - bpp] if i >= bpp else 0
        made = []
        for i, v in enumerate(line):
            a, b, c = left(i, line), above[i], left(i, above)
            p = a + b - c
            paeth = a if abs(p - a) <= abs(p - b) and abs(p - a) <= abs(p - c) else b if abs(p - b) <= abs(p - c) else c
            made.append((v - [0, a, b, (a + b) // 2, paeth][kind]) % 256)
        out += bytes([kind, *made])
        above = line
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, colour, 0, 0, 0)) + (chunk(b"PLTE", palette.tobytes()) if palette is not None else b"") + chunk(b"IDAT", zlib.compress(out)) + chunk(b"IEND", b"")


@pytest.mark.parametrize("depth,colour", [(8, 2), (8, 0), (8, 6), (8, 4), (16, 2), (1, 0), (4, 3), (2, 0)])
def test_png_of_any_kind(depth, colour):
    rng = np.random.default_rng(depth * 10 + colour)
    n, palette = I._SAMPLES[colour], None
    px = rng.integers(0, 1 << min(depth, 8), (11, 13, n))
    if colour == 3:
        palette = rng.integers(0, 256, (16, 3)).astype(np.uint8)
    got = I.png_decode(_png(px, depth, colour, [0, 1, 2, 3, 4], palette))
    scale = 255 // ((1 << min(depth, 8)) - 1)
    want = palette[px[..., 0]] if colour == 3 else np.repeat(px[..., :1], 3, axis=2) * scale if colour in (0, 4) else px[..., :3]
    assert (got == want).all()
    assert (I.png_decode(I.png_encode(got)) == got).all()


def test_unreadable_images_are_refused(tmp_path):
    with pytest.raises(I.StageError):
        I.png_decode(b"no image")
    (tmp_path / "t.jpg").write_bytes(b"\xff\xd8")
    with pytest.raises(I.StageError, match="t.jpg"):
        I.list_textures(tmp_path)
    with pytest.raises(I.StageError, match="isn't a folder"):
        I.list_textures(tmp_path / "none")


def test_bmp():
    px = np.arange(2 * 3 * 3, dtype=np.uint8).reshape(2, 3, 3)
    rows = b"".join(px[y, :, ::-1].tobytes() + b"\0" * 3 for y in (1, 0))
    data = b"BM" + struct.pack("<IHHI", 54 + len(rows), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, 3, 2, 1, 24, 0, len(rows), 0, 0, 0, 0) + rows
    assert (I.bmp_decode(data) == px).all()


@needs_font
def test_paper_texture_recipe_renders(spark, tmp_path):
    folder = tmp_path / "paper"
    folder.mkdir()
    (folder / "grey one.png").write_bytes(I.png_encode(np.full((400, 900, 3), 128, np.uint8)))
    (folder / "note.txt").write_text("no image")
    stage = {"kind": "paper_texture", "directory": str(folder), "opacity": 1.0, "blend": "multiply"}
    recipe = R.parse_recipe(raw(tmp_path, degradation=[stage]))
    assert not [x for x in validate.issues(recipe) if x[0] == "error"]
    stats = run.render(spark, recipe)
    assert stats["count_written"] == 6 and not stats["skip_reasons"]
    image = I.png_decode(next((tmp_path / "out" / "images").iterdir()).read_bytes())
    assert image.max() == 128  # white paper times the texture


# ------------------------------------------------------------ sinks


def test_merging_files_in_key_order():
    old, new = [(1, "a"), (2, "b"), (4, "d")], [(0, "z"), (2, "B"), (5, "e")]
    assert list(sinks._merged(old, new)) == [(0, "z"), (1, "a"), (2, "B"), (4, "d"), (5, "e")]
    assert list(sinks._merged([], [])) == []


@needs_font
def test_samples_are_rendered_once(spark, tmp_path):
    recipe = R.parse_recipe(raw(tmp_path))
    seen = spark.sparkContext.accumulator(0)
    drawn = run.samples(spark, recipe)

    def count(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    rows = run.rendered(recipe, drawn.mapInPandas(count, drawn.schema))
    sinks.write_dataset(rows, sinks.open_destination(tmp_path / "o", {"recipe": {}}), 6)
    assert seen.value == 6
    with pytest.raises(PySparkException, match="every machine sees"):
        sinks.write_dataset(rows, tmp_path / "nowhere" / "deep", 6)


@needs_font
def test_preview_counts_this_preview(spark, tmp_path):
    recipe = R.parse_recipe(raw(tmp_path))
    first = run.preview(spark, recipe, tmp_path / "p", 5)
    second = run.preview(spark, recipe, tmp_path / "p", 3)
    assert (first["rendered"], second["rendered"], second["skipped"]) == (5, 3, 0)
    lines = [json.loads(x) for x in (tmp_path / "p" / "manifest.jsonl").read_text().splitlines()]
    assert len(lines) == 3 and not (tmp_path / "p" / "labels.json").exists()


@needs_font
def test_detection_is_staged_as_detection(spark, tmp_path, capsys):
    out = {"destination": str(tmp_path / "out"), "count": 3, "mode": "detection"}
    text = raw(tmp_path, output=out, layout={"mode": "paragraphs", "max_width_px": 200}, publish={"repo_id": "a/b", "license": "mit"})
    (tmp_path / "r.yaml").write_text(yaml.safe_dump(text))
    run.render(spark, R.load_recipe(tmp_path / "r.yaml"))
    assert cli.main(["publish", str(tmp_path / "r.yaml"), "--dry-run", "--staging", str(tmp_path / "st"), "--no-private", "--message", " "]) == 0
    plan = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert plan["mode"] == "detection" and plan["rows"] == 3 and plan["problems"] == [] and plan["private"] is False and plan["message"].startswith("scriptorium render @")
    card = sinks.front_matter((tmp_path / "st" / "README.md").read_text())
    assert card["task_categories"] == ["object-detection"] and card["shape"] == "detection/v1"
    assert (tmp_path / "st" / "labels.json").read_bytes() == (tmp_path / "out" / "labels.json").read_bytes()
    assert cli.main(["publish", str(tmp_path / "r.yaml"), "--staging", str(tmp_path / "st")]) == 7  # no client library here
    labels = json.loads((tmp_path / "out" / "labels.json").read_text())
    (tmp_path / "out" / "labels.json").write_text(json.dumps({**labels, "cover.png": {}}))
    with pytest.raises(sinks.StagingError, match="cover.png"):
        sinks.stage_detection(tmp_path / "out", tmp_path / "st2")
    with pytest.raises(sinks.StagingError):
        sinks.stage_detection(tmp_path / "absent", tmp_path / "st3")


@needs_font
def test_render_uses_the_cache_and_both_logs(spark, tmp_path, monkeypatch, capsys):
    asked = []

    def page(s, entry):
        asked.append(entry["url"])
        return s.createDataFrame([(0, "uno dos tres", None)], "ord int, text string, error string")

    monkeypatch.setitem(readers.PROVIDERS._known, "web", page)
    monkeypatch.setenv("SCRIPTORIUM_AUDIT", str(tmp_path / "log" / "all.jsonl"))
    text = raw(tmp_path, corpus=[{"type": "web", "url": "http://x"}, {"type": "local", "path": str(tmp_path / "c.txt")}])
    (tmp_path / "r.yaml").write_text(yaml.safe_dump(text))
    call = lambda *more: cli.main(["render", str(tmp_path / "r.yaml"), "--cache", str(tmp_path / "k"), *more])
    assert call() == 0 and call("--force") == 0 and call("--force", "--no-audit") == 0
    assert asked == ["http://x"]
    assert len((tmp_path / "log" / "all.jsonl").read_text().splitlines()) == 2
    assert call("--force", "--no-cache", "--no-audit") == 0 and len(asked) > 1
    assert "rendered 6/6 in" in capsys.readouterr().err
    assert cli.main(["audit"]) == 0 and cli.main(["audit", "--since", "soon"]) == 2 and cli.main(["audit", "--limit", "0"]) == 2
    assert call() == 6


def test_audit_bounds():
    assert cli.stamp("2026-05-06T20:00:00+05:00") == "2026-05-06T15:00:00Z"
    assert cli.stamp(" 2026-05-06 ") == "2026-05-06T00:00:00Z" and cli.stamp("2026-05-06T01:02:03Z") == "2026-05-06T01:02:03Z"
    assert cli.stamp("") is None and cli.stamp("soon") is None and cli.stamp(None) is None


def test_progress_on_a_terminal(spark):
    class Screen(io.StringIO):
        def isatty(self):
            return True

    out = Screen()
    with run.Progress(spark, 7, every=0.01, out=out) as progress:
        spark.range(10).repartition(3).count()
    progress.done(5)
    assert "rendered 5/7 in" in out.getvalue() and "%" in out.getvalue()
    plain = io.StringIO()
    with run.Progress(spark, 7, out=plain) as progress:
        pass
    progress.done(7)
    assert plain.getvalue().count("\n") == 1


def test_tokens_and_messages(tmp_path):
    (tmp_path / "t").write_text(" from-file \n")
    assert sinks.resolve_token(" ", {"HF_TOKEN": ""}, tmp_path / "t") == "from-file"
    assert sinks.resolve_token("flag", {"HF_TOKEN": "env"}, None) == "flag" and sinks.resolve_token(None, {"HF_TOKEN": "env"}, None) == "env"
    assert sinks.resolve_token(None, {}, tmp_path / "none") is None
    assert sinks.commit_message("mine", tmp_path) == "mine" and sinks.commit_message(None, tmp_path) == "scriptorium render"


def test_fetch_retries_and_gives_up():
    calls, waits = [], []

    def opener(url, timeout):
        calls.append(url)
        if len(calls) < 3:
            raise urllib.error.HTTPError(url, 503, "busy", None, None)
        return io.BytesIO(b"body")

    assert readers.fetch("http://x", opener=opener, sleep=waits.append) == b"body" and waits == [0.5, 1.0]

    def gone(url, timeout):
        raise urllib.error.HTTPError(url, 404, "gone", None, None)

    with pytest.raises(readers.SourceError, match="404"):
        readers.fetch("http://x", opener=gone, sleep=waits.append)


# ------------------------------------------------------------ the rest


@needs_font
def test_fonts_and_trees(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "ok.ttf").write_bytes(Path(FONT).read_bytes())
    (tmp_path / "f" / "bad.ttf").write_bytes(b"nothing")
    rows = {Path(r["path"]).name: r for r in C.scan_fonts(readers.read_binary(spark, str(tmp_path / "f"), "*.ttf")).collect()}
    assert rows["ok.ttf"]["num_glyphs"] > 100 and rows["ok.ttf"]["error"] is None and rows["bad.ttf"]["error"]
    assert C.coverage(C.scan_fonts(readers.read_binary(spark, str(tmp_path / "f"), "ok.ttf"))).where("codepoint = 65").count() == 1
    (tmp_path / "t" / "sub").mkdir(parents=True)
    (tmp_path / "t" / "a.html").write_text("<p>x</p>")
    (tmp_path / "t" / "sub" / "b.txt").write_text("y")
    assert {(r["text"], r["parser"]) for r in readers.read_tree(spark, str(tmp_path / "t")).collect()} == {("<p>x</p>", "html-text"), ("y", "plain")}


def test_issue_rows_and_lints(spark, tmp_path):
    recipe = R.parse_recipe(raw(tmp_path, fonts=[{"path": "/no.ttf", "optional": True}], text_transforms=[]))
    rows = validate.issue_rows(spark, recipe, lint=True)
    codes = {r["code"] for r in rows.collect()}
    assert codes >= {"optional_font_missing", "lint_single_font", "lint_no_text_transforms", "lint_all_optional_fonts", "lint_low_sample_count"}
    counts = validate.severity_counts(rows).first()
    assert counts["errors"] == 0 and counts["is_ok"] and counts["warnings"] == rows.count()
    folder = tmp_path / "file"
    folder.write_text("x")
    bad = R.parse_recipe(raw(tmp_path, degradation=[{"kind": "paper_texture", "directory": str(tmp_path / "none")}, {"kind": "paper_texture", "directory": str(folder)}], fonts=[{"path": str(folder)}]))
    assert {x[1] for x in validate.issues(bad)} >= {"paper_texture_directory_missing", "paper_texture_directory_not_dir", "font_unreadable"}


def test_registered_stages():
    I.register_stage("invert", lambda rgb, o, rng: 255 - rgb)
    try:
        sample = {"image": np.full((2, 2, 3), 10, np.uint8)}
        out = I.degrade(sample, [{"kind": "invert"}], np.random.default_rng(1), I.registered(["invert"]))
        assert (out["image"] == 245).all()
        with pytest.raises(I.StageError):
            I.register_stage("invert", lambda *a: None)
        with pytest.raises(I.StageError):
            I.degrade(sample, [{"kind": "unknown"}], np.random.default_rng(1))
    finally:
        del I.PIXEL_STAGES["invert"]


def test_cache_store(tmp_path):
    store = CacheStore(tmp_path)
    store.write("web", "k/1", "text", "src")
    assert store.read_text("web", "k/1") == "text" and store.keys("web") == ["k/1"] and store.remove("web", "k/1") and not store.has("web", "k/1")
