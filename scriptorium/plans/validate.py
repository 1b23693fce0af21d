"""Validation and lint: every rule is a predicate that gives issue rows."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import DEFAULT, TransformError, step_of
from .recipe import SUPPORTED, Recipe

ISSUE = "severity string, code string, message string, location string"
# The catalogue of stages with the options of those that run, the
# layout keys and layouts by mode.
STAGE_OPTIONS = {
    "skew": {"angle_deg", "fill"},
    "blur": {"filter", "sigma", "motion_angle_deg", "motion_length_px"},
    "noise": {"noise_kind", "stddev", "amount"},
    "brightness": {"factor"},
    "contrast": {"factor"},
    "gamma": {"gamma"},
    "ink_bleed": {"iterations", "kernel_size_px"},
    "ink_thin": {"iterations", "kernel_size_px"},
    "paper_texture": {"directory", "blend", "opacity", "scale", "rotate_deg"},
    "foxing": {"count", "radius_px", "color", "opacity"},
    "jpeg": {"quality", "chroma_subsampling"},
    "webp": {"quality"},
    "grayscale": {"method"},
}
CATALOGUED_STAGES = {"perspective", "scale", "bleed_through", "scratches", "fold_line", "binarize", "preset"}
LAYOUT_KEYS = {
    "word_crops": {"padding_px", "baseline_jitter_px"},
    "lines": {"padding_px", "max_width_px", "line_spacing"},
    "paragraphs": {"padding_px", "max_width_px", "line_spacing", "paragraph_alignment"},
    "pages": {"padding_px", "max_width_px", "line_spacing", "paragraph_spacing", "paragraph_indent_px", "paragraph_alignment", "page_size_px"},
}
LAYOUTS = {"recognition": {"word_crops", "lines"}, "detection": {"paragraphs", "pages"}}
SMALL_RUN = 100

Issue = tuple[str, str, str, str | None]


def _error(code: str, message: str, at: str | None = None) -> Issue:
    return ("error", code, message, at)


def _warning(code: str, message: str, at: str | None = None) -> Issue:
    return ("warning", code, message, at)


def _output(r: Recipe) -> Iterator[Issue]:
    if r.schema_version not in SUPPORTED:
        yield _error("schema_version_unsupported", f"version {r.schema_version}", "schema_version")
    if r.layout.mode not in LAYOUTS[r.output.mode]:
        yield _error("output_layout_mode_mismatch", f"{r.output.mode} with {r.layout.mode}", "layout.mode")
    to = r.output.destination
    if "${" in to or to.startswith("~"):
        yield _error("output_destination_unresolved", to, "output.destination")
        return
    near = Path(to)
    while not near.exists() and near != near.parent:
        near = near.parent
    if not os.access(near, os.W_OK):
        yield _error("output_destination_unwritable", to, "output.destination")


def _fonts(r: Recipe) -> Iterator[Issue]:
    from ..operators.coverage import FontError, read_font

    for i, font in enumerate(r.fonts):
        at = f"fonts[{i}]"
        if not Path(font.path).is_file():
            yield _warning("optional_font_missing", font.path, at) if font.optional else _error("font_missing", font.path, at)
            continue
        try:
            info = read_font(Path(font.path).read_bytes())
        except FontError as e:
            yield _error("font_unreadable", f"{font.path}: {e}", at)
            continue
        if not info["num_glyphs"] or not info["codepoints"]:
            yield _error("font_empty", font.path, at)


def _corpus(r: Recipe) -> Iterator[Issue]:
    from ..sources.readers import PROVIDERS

    known = PROVIDERS.names()  # plug-ins too
    for i, entry in enumerate(r.corpus):
        at = f"corpus[{i}]"
        if entry.type == "local" and entry.path and not Path(entry.path).exists():
            yield _error("local_corpus_missing", entry.path, at)
        if entry.type not in known:
            yield _error("corpus_provider_not_implemented", entry.type, at)
        if entry.max_chars is not None:
            yield _error("corpus_max_chars_not_implemented", str(entry.max_chars), at)
        if entry.min_word_length > 1:
            yield _error("corpus_min_word_length_not_implemented", str(entry.min_word_length), at)


def _transforms(r: Recipe) -> Iterator[Issue]:
    for i, step in enumerate(r.text_transforms):
        name = step if isinstance(step, str) else next(iter(step), "")
        try:
            DEFAULT.get(step_of(step)[0])
        except TransformError:
            yield _error("text_transform_not_implemented", str(name), f"text_transforms[{i}]")


def _look(r: Recipe) -> Iterator[Issue]:
    if r.rendering.shaping_engine != "harfbuzz":
        yield _error("shaping_engine_not_implemented", r.rendering.shaping_engine, "rendering.shaping_engine")
    if not r.rendering.antialiasing:
        yield _error("antialiasing_disable_not_implemented", "antialiasing: false", "rendering.antialiasing")
    every = set().union(*LAYOUT_KEYS.values())
    for key in sorted(r.layout.model_fields_set & every - LAYOUT_KEYS[r.layout.mode]):
        yield _warning("layout_key_unused", f"{key} has no meaning for {r.layout.mode}", f"layout.{key}")


def _stages(r: Recipe) -> Iterator[Issue]:
    from ..operators.images import GEOMETRY_STAGES, PIXEL_STAGES

    own = (set(PIXEL_STAGES) | set(GEOMETRY_STAGES)) - set(STAGE_OPTIONS)
    listed = [(f"degradation[{i}]", s) for i, s in enumerate(r.degradation)]
    listed += [(f"degradation_presets.{n}[{i}]", s) for n, ss in r.degradation_presets.items() for i, s in enumerate(ss)]
    for at, stage in listed:
        options = stage.model_extra or {}
        if stage.kind in own:
            continue  # a plug-in's options are its own
        if stage.kind not in STAGE_OPTIONS:
            code = "degradation_kind_not_implemented" if stage.kind in CATALOGUED_STAGES else "degradation_kind_unknown"
            yield _error(code, stage.kind, at)
            continue
        for option in sorted(set(options) - STAGE_OPTIONS[stage.kind] - {"name"}):
            yield _error("degradation_stage_unknown_option", f"{stage.kind}: {option}", at)
        if stage.kind == "paper_texture":
            folder = options.get("directory")
            if not folder:
                yield _error("paper_texture_missing_directory", "no directory", at)
            elif not Path(folder).exists():
                yield _error("paper_texture_directory_missing", folder, at)
            elif not Path(folder).is_dir():
                yield _error("paper_texture_directory_not_dir", folder, at)


def _publish(r: Recipe) -> Iterator[Issue]:
    if r.publish is None:
        return
    if r.publish.description_file and not Path(r.publish.description_file).is_file():
        yield _warning("publish_description_file_missing", r.publish.description_file, "publish.description_file")
    repo = r.publish.repo_id
    if repo is not None and ("/" not in repo or repo.startswith("CHANGE-ME/")):
        yield _warning("publish_repo_placeholder", repo, "publish.repo_id")


def _lint(r: Recipe) -> Iterator[Issue]:
    if r.degradation and all(s.probability >= 1 for s in r.degradation):
        yield _warning("lint_degradation_always_certain", "every stage always runs", "degradation")
    if len(r.fonts) <= 1:
        yield _warning("lint_single_font", "one font only", "fonts")
    if not r.text_transforms:
        yield _warning("lint_no_text_transforms", "the text is used as it is", "text_transforms")
    if r.output.count < SMALL_RUN:
        yield _warning("lint_low_sample_count", f"{r.output.count} samples", "output.count")
    if r.seed == 0:
        yield _warning("lint_seed_default", "seed is 0", "seed")
    if any(f.weight == 0.0 for f in r.fonts):
        yield _warning("lint_zero_weight_font", "a font is never drawn", "fonts")
    if all(f.optional for f in r.fonts):
        yield _warning("lint_all_optional_fonts", "no font is required", "fonts")


CHECKS = (_output, _fonts, _corpus, _transforms, _look, _stages, _publish)


def issues(recipe: Recipe, lint: bool = False) -> list[Issue]:
    found = [x for check in CHECKS for x in check(recipe)]
    return found + list(_lint(recipe)) if lint else found


def issue_rows(spark: SparkSession, recipe: Recipe, lint: bool = False) -> DataFrame:
    return spark.createDataFrame(issues(recipe, lint), ISSUE)


def severity_counts(rows: DataFrame) -> DataFrame:
    errors = F.count_if(F.col("severity") == "error")
    return rows.agg(errors.alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings"), (errors == 0).alias("is_ok"))
