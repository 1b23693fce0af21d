"""Recipes, validation, rendering, sinks, resume, publishing, streaming, command line."""

import json
from pathlib import Path

import numpy as np
import pytest
import yaml
from pyspark.sql import functions as F

from scriptorium import cli
from scriptorium.operators import images as I
from scriptorium.plans import recipe as R
from scriptorium.plans import run, validate
from scriptorium.sources import sinks
from scriptorium.sources.cache import CacheStore
from scriptorium.streaming import audit_stream

FONT = "/usr/share/fonts/truetype/dejavu/DejaVuSans.ttf"
needs_font = pytest.mark.skipif(not Path(FONT).is_file(), reason="font absent")


def raw(tmp_path, **more):
    (tmp_path / "c.txt").write_text("maidin mhaith duit\nagus slán leat\n\nbeo agus beathach\n")
    base = {
        "schema_version": 1, "name": "small", "seed": 1, "output": {"destination": str(tmp_path / "out"), "count": 6, "mode": "recognition"}, "corpus": [{"type": "local", "path": str(tmp_path / "c.txt")}],
        "text_transforms": ["normalize_whitespace"], "fonts": [{"path": FONT}], "rendering": {"font_size_pt": 10, "dpi": 100}, "layout": {"mode": "word_crops", "padding_px": 2},
    }
    return {**base, **more}


def test_recipe_rules(tmp_path):
    r = R.parse_recipe(raw(tmp_path, degradation_presets={"p": [{"kind": "blur"}, {"kind": "noise"}]}, degradation=[{"kind": "preset", "name": "p"}, {"kind": "jpeg"}]))
    assert [s.kind for s in r.degradation] == ["blur", "noise", "jpeg"]
    for bad in ({"schema_version": 2}, {"unknown": 1}, {"fonts": []}, {"degradation": [{"kind": "preset", "name": "q"}]}, {"degradation": [{"kind": "blur", "probability": 2}]}):
        with pytest.raises(R.RecipeError):
            R.parse_recipe(raw(tmp_path, **bad))


def test_validation_codes(tmp_path):
    bad = raw(
        tmp_path, seed=0, output={"destination": "${NOWHERE}/x", "count": 5, "mode": "detection"}, corpus=[{"type": "hf_dataset", "max_chars": 3, "min_word_length": 2}, {"type": "local", "path": str(tmp_path / "no.txt")}],
        text_transforms=["nothing"], fonts=[{"path": "/no.ttf"}, {"path": "/no2.ttf", "optional": True, "weight": 0.0}], rendering={"shaping_engine": "pillow", "antialiasing": False}, layout={"mode": "lines", "page_size_px": [1, 1]},
        degradation=[{"kind": "wild"}, {"kind": "scale"}, {"kind": "blur", "strength": 1}, {"kind": "paper_texture"}], publish={"repo_id": "CHANGE-ME/x", "description_file": "/none.md"},
    )
    codes = {x[1] for x in validate.issues(R.parse_recipe(bad), lint=True)}
    assert codes >= {
        "output_destination_unresolved", "output_layout_mode_mismatch", "corpus_provider_not_implemented", "corpus_max_chars_not_implemented", "corpus_min_word_length_not_implemented", "local_corpus_missing", "text_transform_not_implemented",
        "font_missing", "optional_font_missing", "shaping_engine_not_implemented", "antialiasing_disable_not_implemented", "layout_key_unused", "degradation_kind_unknown", "degradation_kind_not_implemented",
        "degradation_stage_unknown_option", "paper_texture_missing_directory", "publish_repo_placeholder", "publish_description_file_missing", "lint_seed_default", "lint_low_sample_count", "lint_zero_weight_font", "lint_degradation_always_certain",
    }


@needs_font
def test_render_resume_and_stage(spark, tmp_path):
    recipe = R.parse_recipe(raw(tmp_path, degradation=[{"kind": "blur", "sigma": 0.7, "probability": 0.5}, {"kind": "skew", "angle_deg": 3.0}]))
    stats = run.render(spark, recipe)
    out = tmp_path / "out"
    assert stats["count_written"] == 6 and len(list((out / "images").iterdir())) == 6
    labels = json.loads((out / "labels.json").read_text())
    assert list(labels) == sorted(labels) and list(labels)[0] == "0000000.png"
    first = {p.name: p.read_bytes() for p in (out / "images").iterdir()}
    with pytest.raises(sinks.DestinationNotEmptyError):
        run.render(spark, recipe)
    more = R.parse_recipe(raw(tmp_path, output={"destination": str(out), "count": 8, "mode": "recognition"}, degradation=[{"kind": "blur", "sigma": 0.7, "probability": 0.5}, {"kind": "skew", "angle_deg": 3.0}]))
    assert run.render(spark, more, resume=True)["count_written"] == 8
    assert all((out / "images" / n).read_bytes() == data for n, data in first.items())
    with pytest.raises(sinks.SnapshotError):
        run.render(spark, R.parse_recipe(raw(tmp_path, seed=2)), resume=True)
    staged = sinks.stage_recognition(out, tmp_path / "staging", "mit")
    assert staged["rows"] == 8 and sinks.preflight(tmp_path / "staging") == []
    hub = sinks.MemoryTransport()
    assert sinks.publish(hub, "a/b", tmp_path / "staging", tag="v1")["state"] == "new"
    assert sinks.publish(hub, "a/b", tmp_path / "staging")["state"] == "same"
    assert sinks.embed_sha(tmp_path / "staging") == sinks.embed_sha(tmp_path / "staging")
    audit = [json.loads(x) for x in (out / "_audit.jsonl").read_text().splitlines()]
    assert [a["rendered"] for a in audit] == [6, 8]


@needs_font
@pytest.mark.parametrize("mode", ["lines", "paragraphs", "pages"])
def test_layouts(spark, tmp_path, mode):
    recipe = R.parse_recipe(raw(tmp_path, output={"destination": str(tmp_path / "o"), "count": 3, "mode": "recognition" if mode == "lines" else "detection"}, layout={"mode": mode, "padding_px": 3, "max_width_px": 120, "paragraph_alignment": "justify"}))
    drawn = run.samples(spark, recipe)
    rows = run.rendered(recipe, drawn).collect()
    again = run.rendered(recipe, drawn.repartition(5)).collect()
    assert {r["index"]: r["image"] for r in rows} == {r["index"]: r["image"] for r in again}
    for r in rows:
        assert r["status"] == "rendered", r["message"]
        assert I.png_decode(bytes(r["image"])).shape == (r["height"], r["width"], 3)
        b = r["bbox"]
        assert 0 <= b["x0"] < b["x1"] <= r["width"] and 0 <= b["y0"] < b["y1"] <= r["height"]
        for box in [*r["word_boxes"], *r["line_boxes"], *r["paragraph_boxes"]]:
            assert b["x0"] <= box["bbox"]["x0"] and box["bbox"]["x1"] <= b["x1"]
        assert [w["text"] for w in r["word_boxes"]] == r["text"].split()
    if mode != "lines":
        stats = sinks.write_dataset(run.rendered(recipe, drawn), sinks.open_destination(tmp_path / "o", {"recipe": {}}), 3, detection=True)
        assert stats["words"] and stats["lines"]
        label = next(iter(json.loads((tmp_path / "o" / "labels.json").read_text()).values()))
        assert label["lines"][0]["words"] and len(label["img_hash"]) == 64


@needs_font
def test_skips_are_rows(spark, tmp_path):
    recipe = R.parse_recipe(raw(tmp_path))
    drawn = spark.createDataFrame([(0, "ok"), (1, "\U0001F9FF")], "index long, text string")
    from scriptorium.operators.sampling import draw_style

    styled = draw_style(drawn, recipe.model_dump(exclude_none=True), 1)
    got = {r["index"]: (r["status"], r["reason"], r["missing"]) for r in run.rendered(recipe, styled).collect()}
    assert got == {0: ("rendered", None, None), 1: ("skipped", "missing_glyph", ["U+1F9FF"])}


STAGES = [
    {"kind": "blur", "filter": "gaussian", "sigma": 1.0}, {"kind": "blur", "filter": "motion", "motion_length_px": 5, "motion_angle_deg": 30.0}, {"kind": "blur", "filter": "defocus", "sigma": 2},
    {"kind": "noise", "noise_kind": "gaussian"}, {"kind": "noise", "noise_kind": "salt_pepper", "amount": 0.1}, {"kind": "noise", "noise_kind": "poisson"}, {"kind": "noise", "noise_kind": "speckle"},
    {"kind": "brightness", "factor": 0.8}, {"kind": "contrast", "factor": 0.5}, {"kind": "gamma", "gamma": 1.5}, {"kind": "ink_bleed", "kernel_size_px": 1}, {"kind": "ink_thin", "kernel_size_px": 1}, {"kind": "foxing"},
    {"kind": "jpeg", "quality": 20}, {"kind": "webp", "quality": 20}, {"kind": "grayscale", "method": "average"}, {"kind": "skew", "angle_deg": 5.0, "fill": "black"},
    {"kind": "paper_texture", "textures": [np.full((7, 5, 3), 200, np.uint8)], "blend": "overlay"},
]


@pytest.mark.parametrize("stage", STAGES, ids=lambda s: "-".join(str(v) for v in s.values() if isinstance(v, str)))
def test_stages_are_deterministic(stage):
    rng = lambda: np.random.Generator(np.random.PCG64(5))
    image = rng().integers(0, 256, (20, 33, 3)).astype(np.uint8)
    sample = {"image": image, "background": (255, 255, 255), "bbox": (2, 2, 30, 18), "glyphs": [], "words": [("w", (2, 2, 30, 18))], "lines": [], "paragraphs": []}
    a, b = (I.degrade(sample, [stage], rng()) for _ in range(2))
    assert np.array_equal(a["image"], b["image"]) and not np.array_equal(a["image"], image)
    assert np.array_equal(I.degrade(sample, [{**stage, "probability": 0.0}], rng())["image"], image)


def test_stage_errors():
    with pytest.raises(I.StageError):
        I.degrade({"image": None}, [{"kind": "none"}], np.random.default_rng(1))
    with pytest.raises(I.StageError):
        I.grayscale(np.zeros((2, 2, 3)), {"method": "odd"}, None)


def test_cache(tmp_path):
    store = CacheStore(tmp_path)
    store.write("web", "a/b", "text", "http://x")
    assert store.has("web", "a/b") and not store.has("web", "a_b") and store.keys("web") == ["a/b"]
    next((tmp_path / "web").glob("*.meta.json")).write_text("{")
    assert not store.has("web", "a/b")
    assert store.remove("web", "a/b") and not store.remove("web", "a/b")


def test_stream_windows_and_upserts(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    rows = [{"timestamp": f"2026-01-01T0{h}:10:00Z", "recipe_name": "a", "rendered": 2, "skipped": 1, "runtime_seconds": 1.5} for h in (1, 1, 2)] + [{"timestamp": "2026-01-01T05:00:00Z", "recipe_name": "b", "schema_version": 9}]
    (log / "1.json").write_text("\n".join(map(json.dumps, rows)))
    q = audit_stream.runs_by_window(audit_stream.log_stream(spark, str(log))).writeStream.format("memory").queryName("w").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r["start"].hour, r["runs"], r["rendered"]) for r in spark.table("w").collect()) == [(1, 2, 4), (2, 1, 2)]
    sink = audit_stream.upsert_by_index(str(tmp_path / "up"))
    sink(spark.createDataFrame([(1, "a"), (2, "a")], "index int, v string"), 0)
    for _ in range(2):
        sink(spark.createDataFrame([(2, "b")], "index int, v string"), 1)
    assert sorted(tuple(r) for r in audit_stream.read_upserts(spark, str(tmp_path / "up")).collect()) == [(1, "a"), (2, "b")]


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.chdir(tmp_path)
    assert cli.main(["init", "demo"]) == 0 and cli.main(["init", "demo"]) == 2
    assert cli.main(["list"]) == 0 and "demo" in capsys.readouterr().out
    assert cli.main(["validate", "demo"]) == 3
    path = tmp_path / "r.yaml"
    path.write_text(yaml.safe_dump(raw(tmp_path, fonts=[{"path": FONT if Path(FONT).is_file() else "/none"}])))
    assert cli.main(["describe", str(path)]) == 0 and cli.main(["schema"]) == 0
    assert cli.main(["describe", "missing"]) == 2
    assert cli.main(["fetch", str(path), "--cache", str(tmp_path / "k")]) == 0 and cli.main(["clean", str(path), "--cache", str(tmp_path / "k")]) == 0
    assert cli.main(["audit", str(tmp_path)]) == 6
    (tmp_path / "_audit.jsonl").write_text('{"recipe_name": "a", "timestamp": "2026-01-01T00:00:00Z", "count": 3}\n')
    capsys.readouterr()
    assert cli.main(["audit", str(tmp_path), "--summary"]) == 0
    assert json.loads(capsys.readouterr().out.strip().split("\n")[-1])["total_count"] == 3
