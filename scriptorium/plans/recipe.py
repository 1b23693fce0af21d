"""Recipes: the driver-side plan of a run.

YAML -> paths -> presets -> a frozen, strict model.  Nothing here reads the corpus.
"""

from __future__ import annotations

import os
from collections.abc import Iterable
from pathlib import Path
from typing import Any, Literal

from pydantic import BaseModel, ConfigDict, Field, model_validator

SUPPORTED = (1,)
#: Where a recipe holds paths: (section, key).
PATH_KEYS = (("output", "destination"), ("corpus", "path"), ("fonts", "path"), ("degradation", "directory"), ("publish", "description_file"))


class RecipeError(ValueError):
    pass


class Strict(BaseModel):
    model_config = ConfigDict(extra="forbid", frozen=True)


class Span(Strict):
    min: float | int
    max: float | int

    @model_validator(mode="after")
    def _ordered(self):
        if self.max < self.min:
            raise ValueError("max is below min")
        return self


class Weighted(Strict):
    value: Any
    weight: float = Field(1.0, ge=0)


class Choices(Strict):
    choices: list[Weighted] = Field(min_length=1)


Varying = int | float | Span | Choices


class Colour(Strict):
    r: Varying = 0
    g: Varying = 0
    b: Varying = 0


class Output(Strict):
    format: str = "default"
    mode: Literal["recognition", "detection"] = "recognition"
    destination: str
    count: int = Field(gt=0)
    manifest: str | None = None


class LineFilter(Strict):
    drop_lines_matching: list[str] = []
    keep_lines_matching: list[str] = []
    min_line_chars: int = 0


class Corpus(Strict):
    type: str
    path: str | None = None
    parser: str | None = None
    url: str | None = None
    field_path: str | None = None
    retries: int = 3
    language: str | None = None
    titles: list[str] = []
    category: str | None = None
    max_pages: int | None = None
    filter: LineFilter | None = None
    max_chars: int | None = None
    min_word_length: int = 1
    cache_key: str | None = None
    user_agent: str | None = None
    timeout_seconds: float | None = None
    respect_robots: bool = True

    @model_validator(mode="after")
    def _source(self):
        needs = {"local": self.path, "web": self.url, "wikisource": self.titles or self.category}
        if self.type in needs and not needs[self.type]:
            raise ValueError(f"corpus of type {self.type}: what to read is missing")
        return self


class Font(Strict):
    path: str
    weight: float = 1.0
    optional: bool = False
    features: dict[str, bool] = {}


class Rendering(Strict):
    font_size_pt: Varying = 14
    dpi: Varying = 300
    ink_color: Colour = Colour()
    background_color: Colour = Colour(r=255, g=255, b=255)
    shaping_engine: str = "harfbuzz"
    antialiasing: bool = True


class Layout(Strict):
    mode: Literal["word_crops", "lines", "paragraphs", "pages"] = "word_crops"
    padding_px: Varying = 0
    baseline_jitter_px: Varying | None = None
    max_width_px: int | None = Field(None, gt=0)
    line_spacing: Varying | None = None
    paragraph_spacing: Varying | None = None
    paragraph_indent_px: int | None = None
    paragraph_alignment: Literal["left", "center", "right", "justify"] | None = None
    page_size_px: tuple[int, int] | None = None

    @model_validator(mode="after")
    def _page(self):
        if self.page_size_px and min(self.page_size_px) <= 0:
            raise ValueError("page_size_px: both sides are above zero")
        return self


class Stage(BaseModel):
    """A degradation stage; its own options are open here and checked by ``validate``."""

    model_config = ConfigDict(extra="allow", frozen=True)
    kind: str
    probability: float = Field(1.0, ge=0, le=1)


class Publish(Strict):
    repo_id: str | None = None
    private: bool = True
    license: str | None = None
    description_file: str | None = None
    tags: list[str] = []


class Recipe(Strict):
    schema_version: int
    name: str
    description: str | None = None
    seed: int = 0
    output: Output
    corpus: list[Corpus] = Field(min_length=1)
    text_transforms: list[str | dict[str, Any]] = []
    fonts: list[Font] = Field(min_length=1)
    rendering: Rendering = Rendering()
    layout: Layout = Layout()
    degradation_presets: dict[str, list[Stage]] = {}
    degradation: list[Stage] = []
    publish: Publish | None = None
    source_path: str | None = None

    @model_validator(mode="after")
    def _version(self):
        if self.schema_version not in SUPPORTED:
            raise ValueError(f"schema_version {self.schema_version} isn't supported")
        return self


def expand_path(text: str, base: Path) -> str:
    """``~``, ``${NAME}`` and paths relative to the recipe; names without a value stay."""
    out = os.path.expanduser(os.path.expandvars(text))
    return out if "${" in out or os.path.isabs(out) or "://" in out else str(base / out)


def resolve_paths(raw: dict, base: Path) -> dict:
    out = dict(raw)
    for section, key in PATH_KEYS:
        part = out.get(section)
        fix = lambda x: {**x, key: expand_path(x[key], base)} if isinstance(x, dict) and isinstance(x.get(key), str) else x  # noqa: B023, E731
        if isinstance(part, list):
            out[section] = [fix(x) for x in part]
        elif part is not None:
            out[section] = fix(part)
    return out


def expand_presets(raw: dict) -> dict:
    """Each stage ``{kind: preset, name}`` gives way to the preset's stages, in order."""
    presets, stages = raw.get("degradation_presets") or {}, []
    for stage in raw.get("degradation") or []:
        if isinstance(stage, dict) and (stage.get("kind") == "preset" or set(stage) == {"preset"}):
            name = stage.get("name", stage.get("preset"))
            if name not in presets:
                raise RecipeError(f"degradation preset {name!r} is unknown")
            stages += presets[name]
        else:
            stages.append(stage)
    return {**raw, "degradation": stages}


def parse_recipe(raw: dict, base: Path = Path("."), source: str | None = None) -> Recipe:
    if not isinstance(raw, dict):
        raise RecipeError("a recipe is a mapping")
    try:
        return Recipe.model_validate({**expand_presets(resolve_paths(raw, base)), "source_path": source})
    except ValueError as e:
        raise RecipeError(str(e)) from e


def load_recipe(path: str | Path) -> Recipe:
    import yaml

    path = Path(path)
    try:
        raw = yaml.safe_load(path.read_text("utf-8"))
    except FileNotFoundError as e:
        raise RecipeError(f"recipe {path}: not found") from e
    except yaml.YAMLError as e:
        raise RecipeError(f"recipe {path}: {e}") from e
    return parse_recipe(raw, path.parent, str(path))


def search_path(env: str = "SCRIPTORIUM_RECIPES") -> list[Path]:
    listed = [Path(p) for p in os.environ.get(env, "").split(os.pathsep) if p]
    return [*listed, Path("recipes"), Path(__file__).parent / "recipes"]


def list_recipes(folders: Iterable[Path] | None = None) -> dict[str, Path]:
    """name -> file, by name; earlier folders win, and a flat file wins over a subfolder."""
    found: dict[str, Path] = {}
    for folder in folders if folders is not None else search_path():
        for pattern in ("*.yaml", "*.yml", "*/recipe.yaml"):
            for path in sorted(Path(folder).glob(pattern)):
                found.setdefault(path.parent.name if path.name == "recipe.yaml" else path.stem, path)
    return dict(sorted(found.items()))


def resolve_recipe(arg: str, folders: Iterable[Path] | None = None) -> Path:
    path = Path(arg)
    if path.suffix in (".yaml", ".yml") or "/" in arg:
        if path.is_file():
            return path
        raise RecipeError(f"recipe {arg}: not found")
    known = list_recipes(folders)
    if arg not in known:
        raise RecipeError(f"recipe {arg!r} is unknown; known are {', '.join(known) or 'none'}")
    return known[arg]


def scaffold_recipe(name: str, folder: str | Path) -> Path:
    path = Path(folder) / f"{name}.yaml"
    if path.exists():
        raise RecipeError(f"{path} is there already")
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(
        f"schema_version: 1\nname: {name}\nseed: 1\noutput:\n  mode: recognition\n  destination: ./out/{name}\n  count: 1000\n"
        "corpus:\n  - type: local\n    path: ./corpus.txt\ntext_transforms:\n  - normalize_whitespace\nfonts:\n  - path: ./fonts/font.ttf\n    weight: 1.0\n"
        "rendering:\n  font_size_pt: 14\n  dpi: 300\nlayout:\n  mode: word_crops\n  padding_px: 4\n"
    )
    return path


def json_schema() -> dict:
    return Recipe.model_json_schema()
