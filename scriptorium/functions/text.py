"""Text transforms as Column -> Column builders, and the ordered chain over them.

Every transform is a Catalyst expression unless Spark has none for it (Unicode
normalisation) or a per-match probability below 1 is asked for; those run in Arrow
batches.  Randomness is a hash of (seed, step, row key, match number), so that a result
doesn't depend on the partitioning.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Consonants that take a dot, the dotted forms in the same order, the
# vowels of the conservative mode, the default words of the Tironian sign.
LENITABLE = "bcdfgmpstBCDFGMPST"
DOTTED = "ḃċḋḟġṁṗṡṫḂĊḊḞĠṀṖṠṪ"
LENITION_VOWELS = "aeiouáéíóúAEIOUÁÉÍÓÚ"
TIRONIAN_WORDS = ("agus", "and", "et")
TIRONIAN_SIGN = "⁊"
LONG_S = "ſ"
REDACTED = "[redacted-hf-token]"

#: Python's idea of white space for Java: \s under (?U) plus U+001C-001F.
PY_SPACE = r"[\s\x1c-\x1f]"
PY_WORD = r"[^\s\x1c-\x1f]"


class TransformError(ValueError):
    """A transform's name or options can't be used."""


def java_literal(text: str) -> str:
    """``text`` as a Java pattern that matches itself."""
    return "".join(f"\\x{{{ord(c):x}}}" if not c.isalnum() or ord(c) > 127 else c for c in text)


def java_replacement(template: str) -> str:
    """A ``\\1`` / ``\\g<1>`` template as Java's ``$1`` form."""
    out = template.replace("$", "\\$")
    out = re.sub(r"\\g<(\w+)>", lambda m: f"${m[1]}" if m[1].isdigit() else f"${{{m[1]}}}", out)
    return re.sub(r"\\(\d+)", r"$\1", out)


def _replace(col: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(col, F.lit(pattern), F.lit(by))


def normalize_whitespace(col: Column, **_) -> Column:
    flat = _replace(_replace(_replace(col, r"(?md)[ \t]+$", ""), r"[ \t]+", " "), r"\n{3,}", "\n\n")
    return F.when(flat == "", "").otherwise(F.concat(_replace(flat, r"\A\n+|\n+\z", ""), F.lit("\n")))


def strip_punctuation(col: Column, **_) -> Column:
    return _replace(col, r"\p{P}", "")


def regex_replace(col: Column, pattern: str | None = None, replacement: str = "", flags: str = "", **_) -> Column:
    if pattern is None:
        raise TransformError("regex_replace: a pattern is needed")
    # (?U) gives the classes their Unicode meaning; d and a undo what Python doesn't do.
    known = {"i": "iu", "m": "m", "s": "s", "x": "x"}
    on = "".join(known.get(f, "") for f in dict.fromkeys(flags or "")) + "d" + ("" if "a" in (flags or "") else "U")
    return _replace(col, f"(?{on}){pattern}", java_replacement(replacement))


def keep_only(col: Column, chars: str = "", **_) -> Column:
    if not chars:
        raise TransformError("keep_only: chars are needed")
    return _replace(col, f"[^{java_literal(''.join(dict.fromkeys(chars)))}]", "")


def _by_token_length(col: Column, test: Callable[[Column], Column]) -> Column:
    def paragraph(p: Column) -> Column:
        words = F.regexp_extract_all(p, F.lit(f"((?U){PY_WORD}+)"), F.lit(1))
        return F.array_join(F.filter(words, lambda w: test(F.length(w))), " ")

    return F.array_join(F.transform(F.split(col, "\n\n", -1), paragraph), "\n\n")


def min_token_length(col: Column, min: int | None = None, length: int = 0, **_) -> Column:  # noqa: A002
    n = int(length if min is None else min)
    return col if n <= 0 else _by_token_length(col, lambda size: size >= n)


def max_token_length(col: Column, max: int | None = None, length: int = 0, **_) -> Column:  # noqa: A002
    n = int(length if max is None else max)
    return col if n <= 0 else _by_token_length(col, lambda size: size <= n)


def lenition_pattern(mode: str) -> str:
    if mode not in ("aggressive", "conservative"):
        raise TransformError(f"lenition: mode {mode!r} is unknown")
    return f"h(?=[{LENITION_VOWELS}])" if mode == "conservative" else "h"


def apply_lenition_dots(col: Column, mode: str = "aggressive", **_) -> Column:
    tail = lenition_pattern(mode)
    if tail == "h":
        return reduce(lambda c, pair: F.replace(c, F.lit(pair[0] + "h"), F.lit(pair[1])), zip(LENITABLE, DOTTED), col)
    return reduce(lambda c, pair: _replace(c, pair[0] + tail, pair[1]), zip(LENITABLE, DOTTED), col)


def dot_to_seimhiu(col: Column, **_) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[1]), F.lit(pair[0] + "h")), zip(LENITABLE, DOTTED), col)


def tironian_et(col: Column, replace_words: list[str] | None = None, case_sensitive: bool = False, **_) -> Column:
    words = "|".join(java_literal(w) for w in replace_words or TIRONIAN_WORDS)
    return _replace(col, f"(?{'' if case_sensitive else 'i'}U)\\b({words})\\b", TIRONIAN_SIGN)


def long_s_medial(col: Column, **_) -> Column:
    return _replace(col, rf"(?U)s(?={PY_WORD})(?![sh])", LONG_S)


def redact_token(col: Column) -> Column:
    """Access tokens in free text become a fixed mark; doing it twice changes nothing."""
    return _replace(col, r"\b(?:hf_[A-Za-z0-9]{20,}|api_org_[A-Za-z0-9]{20,})\b", REDACTED)


#: Code points of texts that are Python strings at a time.
AT_ONCE = 1 << 20


def _few_at_once(one: Callable[..., str]) -> Callable[..., pa.Array]:
    """``one`` of each text that isn't null.  A batch holds 10,000 texts, and as Python strings
    all of them would take a worker several times the batch's bytes; so only some are.

    Made on the driver, so that it goes to the workers by value: they need no package of ours.
    """

    def run(texts: pa.Array, *others: pa.Array) -> pa.Array:
        done, held, size = [], [], 0
        for text, *more in zip(texts, *others):
            text = text.as_py()
            held.append(None if text is None else one(text, *(m.as_py() for m in more)))
            size += len(held[-1] or "")
            if size > AT_ONCE:
                done.append(pa.array(held, texts.type))
                held, size = [], 0
        return pa.concat_arrays([*done, pa.array(held, texts.type)])

    return run


def _normal(form: str) -> Callable[..., Column]:
    def one(text):
        import unicodedata

        return unicodedata.normalize(form, text)

    few = _few_at_once(one)

    def build(col: Column, **_) -> Column:
        @F.arrow_udf(T.StringType())
        def run(texts: pa.Array) -> pa.Array:
            return few(texts)

        # Plain ASCII is in every normal form; it doesn't leave the JVM, where nulls go in its place.
        plain = col.rlike(r"\A\p{ASCII}*\z")
        return F.when(plain, col).otherwise(run(F.when(~plain, col)))

    return build


# ------------------------------------------------------------ probabilities


def hash01(*parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts only; the same in any SQL with md5."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def _by_match(pattern: str, probability: float, to: Callable[[str], str], seed: int, step: int) -> Callable[[Column, Column], Column]:
    """Each match is replaced unless its draw exceeds the probability."""
    import hashlib

    def one(text, key):
        import regex

        count = iter(range(1 << 62))

        def put(m):
            draw = int(hashlib.md5(f"{seed}|{step}|{key}|{next(count)}".encode()).hexdigest()[:8], 16) / 2**32
            return m[0] if draw > probability else to(m[0])

        return regex.compile(pattern).sub(put, text)  # kept by the library

    few = _few_at_once(one)

    @F.arrow_udf(T.StringType())
    def run(texts: pa.Array, keys: pa.Array) -> pa.Array:
        return few(texts, keys)

    return run


def _chance_of(name: str, options: dict) -> tuple[str, Callable[[str], str]] | None:
    """(pattern, replacement of a match) of the transforms that draw for each match."""
    if name in ("apply_lenition_dots", "seimhiu_to_dot"):
        dots = dict(zip(LENITABLE, DOTTED))
        return f"[{LENITABLE}]" + lenition_pattern(options.get("mode", "aggressive")), lambda m: dots[m[0]]
    if name == "tironian_et":
        words = "|".join(re.escape(w) for w in options.get("replace_words") or TIRONIAN_WORDS)
        return f"{'' if options.get('case_sensitive') else '(?i)'}\\b(?:{words})\\b", lambda m: TIRONIAN_SIGN
    if name == "long_s_medial":
        return r"s(?=\S)(?![sh])", lambda m: LONG_S
    return None


# ------------------------------------------------------------------ chain

Builder = Callable[..., Column]


class TransformRegistry:
    """Names to builders.  Plug-ins of the entry-point group are read at the first miss;
    one that can't be loaded is skipped."""

    GROUP = "scriptorium.text_transforms"

    def __init__(self):
        self._known: dict[str, Builder] = {}
        self._looked = False

    def register(self, name: str, build: Builder) -> None:
        if self._known.setdefault(name, build) is not build:
            raise TransformError(f"transform {name!r} is registered with another builder")

    def names(self) -> list[str]:
        return sorted(self._known)

    def get(self, name: str) -> Builder:
        if name not in self._known and not self._looked:
            self._looked = True
            from importlib.metadata import entry_points

            for point in entry_points(group=self.GROUP):
                try:
                    self._known.setdefault(point.name, point.load())
                except Exception:  # noqa: BLE001 - a broken plug-in must not stop the others
                    continue
        if name not in self._known:
            raise TransformError(f"transform {name!r} is unknown; known are {', '.join(self.names())}")
        return self._known[name]


DEFAULT = TransformRegistry()
for _name, _build in {
    "normalize_whitespace": normalize_whitespace,
    "lowercase": lambda c, **_: F.lower(c),
    "uppercase": lambda c, **_: F.upper(c),
    "strip_punctuation": strip_punctuation,
    "nfc": _normal("NFC"),
    "nfd": _normal("NFD"),
    "nfkc": _normal("NFKC"),
    "nfkd": _normal("NFKD"),
    "regex_replace": regex_replace,
    "keep_only": keep_only,
    "min_token_length": min_token_length,
    "max_token_length": max_token_length,
    "apply_lenition_dots": apply_lenition_dots,
    "seimhiu_to_dot": apply_lenition_dots,
    "dot_to_seimhiu": dot_to_seimhiu,
    "tironian_et": tironian_et,
    "long_s_medial": long_s_medial,
}.items():
    DEFAULT.register(_name, _build)


def step_of(step) -> tuple[str, dict]:
    """A bare name, or one name with its options."""
    if isinstance(step, str):
        return step, {}
    if isinstance(step, dict) and len(step) == 1:
        ((name, options),) = step.items()
        return name, dict(options or {})
    raise TransformError("a step is a name or a mapping of one name to its options")


def apply_chain(col: Column, steps: list, *, seed: int = 0, key: Column | None = None, registry: TransformRegistry = DEFAULT) -> Column:
    """The steps in order, each on what the one before returned.

    ``key`` names the row for steps whose matches are drawn (probability below 1).
    """
    for number, step in enumerate(steps):
        name, options = step_of(step)
        build = registry.get(name)
        chance = float(options.get("probability", 1.0))
        drawn = _chance_of(name, options) if chance < 1 else None
        if drawn:
            if key is None:
                raise TransformError(f"{name}: a row key is needed for a probability below 1")
            col = _by_match(drawn[0], chance, drawn[1], seed, number)(col, key.cast("string"))
        else:
            col = build(col, **options)
    return col
