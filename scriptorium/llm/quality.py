"""Quality rules: distribution divergence against language references.

A document's character-class histogram and its histogram of common words are
compared with those of all documents in its language by the Jensen-Shannon
distance.  Everything is DataFrame expressions: each text is measured once and its few
numbers are written; the references are sums over them, and the verdicts are read off
the same table.  No text is shuffled; the only shuffle is one pre-aggregated row per task
and language for the references.

Defined results
---------------
* null text counts as empty: no words, ``base_failed`` true, ``kept`` false.
* a null or unlisted language is compared with the pooled reference of all documents
  by character classes only (no common-word list belongs to it).
* documents under ``min_chars`` word characters (classes) or ``min_words`` words
  (common words) aren't judged by that histogram: its distance is null.
* repeated rows are judged alike; ties don't arise; an empty table gives no rows.
* extra columns are kept as they are, whatever their names: what is added is one struct
  column, the last, whose name takes leading underscores where the input has it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Scratch, column_of

#: Frequent function words by language (fixed lists; all of one length).
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por"),
}
#: Classes in the order in which they are removed from the text: (name, regex).
CLASSES = (
    ("lower", f"[a-z{SPACE}]+"),  # runs over words; white space is counted apart
    ("upper", "[A-Z]+"),
    ("letter", r"\p{L}+"),
    ("digit", "[0-9]+"),
    ("mark", r"[.,;:'\"()\-]+"),
    ("symbol", r"[#*$%&|<>]+"),
)
CLASS_NAMES = tuple(n for n, _ in CLASSES) + ("other", "space")
K = len(next(iter(COMMON_WORDS.values())))
_P = "_q_"


@dataclass(frozen=True)
class QualityRules:
    """Thresholds: Jensen-Shannon distances (root of the divergence in bits)."""

    class_limit: float = 0.32
    word_limit: float = 0.29
    min_chars: int = 200
    min_words: int = 50
    window: int = 8
    least_words: int = 20
    repeat_percent: int = 30


def _with_features(df: DataFrame, text: str, lang: str) -> DataFrame:
    """Adds class counts, words and counts of the language's common words, as arrays.

    The work is done inside higher-order functions: spelled out class by class it makes
    one generated method too large for the JIT compiler, ten times slower.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    plain = whole
    for c in "\t\n\x0b\x0c\r":
        plain = F.replace(plain, F.lit(c), F.lit(" "))
    rest = F.aggregate(
        F.array(*[F.lit(p) for _, p in CLASSES]), F.array(whole), lambda done, p: F.array_append(done, F.regexp_replace(F.element_at(done, -1), p, F.lit("")))
    )
    words = F.col(f"{_P}words")
    df = df.withColumns({f"{_P}sizes": F.transform(rest, lambda x: F.length(x).cast("long")), f"{_P}words": F.array_remove(F.split(plain, " "), "")})
    # Each word stands between spaces of its own, so that counting " w " counts whole words.
    df = df.withColumn(f"{_P}marked", F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" ")))
    df = df.withColumn(f"{_P}n_words", F.size(words).cast("long"))
    listed = _by_lang(F.col(lang), {k: F.array(*[F.lit(f" {w} ") for w in v]) for k, v in COMMON_WORDS.items()})
    marked, n, size = F.col(f"{_P}marked"), F.col(f"{_P}n_words"), F.col(f"{_P}sizes")
    bytes_of = F.octet_length(marked)
    df = df.withColumns(
        {
            f"{_P}chars": F.length(marked) - F.when(n > 0, 2 * n).otherwise(F.lit(2)),
            f"{_P}hist": F.transform(listed, lambda w: F.floor((bytes_of - F.octet_length(F.replace(marked, w, F.lit("")))) / F.octet_length(w))),
        }
    )
    chars, hist = F.col(f"{_P}chars"), F.col(f"{_P}hist")
    counts = F.zip_with(size, F.slice(size, F.lit(2), F.size(size)), lambda x, y: x - F.coalesce(y, F.lit(0).cast("long")))
    blank = F.get(size, F.lit(0)) - chars
    df = df.withColumns(
        {
            f"{_P}classes": F.concat(F.transform(counts, lambda c, i: F.when(i == 0, c - blank).otherwise(c)), F.array(blank)),
            f"{_P}hist": F.concat(hist, F.array(n - F.aggregate(hist, F.lit(0).cast("long"), lambda s, x: s + x))),
        }
    )
    return df


def _by_lang(lang: Column, values: dict[str, Column], otherwise: Column | None = None) -> Column:
    out = None
    for k, v in values.items():
        out = F.when(lang == k, v) if out is None else out.when(lang == k, v)
    return out if otherwise is None else out.otherwise(otherwise)


def references(measured: DataFrame, lang: str = "lang") -> dict[str, dict[str, list[float]]]:
    """Histograms of every listed language and of all documents (key ``*``), from ``measure``.

    One aggregate over all documents; its result has at most one row for each listed
    language and one for the rest, whatever the input's size.
    """
    m = measured.columns[-1]
    group = F.when(F.col(lang).isin(list(COMMON_WORDS)), F.col(lang)).otherwise(F.lit("*"))
    sums = [F.sum(F.get(f"{m}.classes", F.lit(i))).alias(f"c{i}") for i in range(len(CLASS_NAMES))]
    sums += [F.sum(F.get(f"{m}.hist", F.lit(i))).alias(f"w{i}") for i in range(K + 1)]
    found = {r["g"]: r for r in measured.groupBy(group.alias("g")).agg(*sums).collect()}

    def shares(rows: list, name: str, n: int) -> list[float]:
        counts = [sum(r[f"{name}{i}"] or 0 for r in rows) for i in range(n)]
        return [c / (sum(counts) or 1) for c in counts]

    groups = {g: [r] for g, r in found.items() if g != "*"} | {"*": list(found.values())}
    return {g: {"classes": shares(rows, "c", len(CLASS_NAMES)), "words": shares(rows, "w", K + 1)} for g, rows in groups.items()}


def _distance(counts: Column, total: Column, reference: Column) -> Column:
    """Jensen-Shannon distance, by the terms p log2(2p/(p+q)) and q log2(2q/(p+q))."""
    term = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    terms = F.zip_with(F.transform(counts, lambda c: c / total), reference, lambda p, q: term(p, q) + term(q, p))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def _repeated_words(n: int) -> tuple[Column, ...]:
    """Words inside n-word windows that occur twice or more in the row's words.

    Hashes tell the rows without any repeated window, nearly all of them; the others
    compare the windows themselves, so that a collision of hashes changes nothing.
    """
    h, words = F.col(f"{_P}hash"), F.col(f"{_P}words")
    starts = F.sequence(F.lit(0), F.size(words) - n)
    hashes = h
    for step in (1 << k for k in range(n.bit_length() - 1)):  # windows of 2, 4, 8 ... words; the last ones are shorter
        hashes = F.zip_with(hashes, F.slice(hashes, F.lit(1 + step), F.size(h)), lambda a, b: F.xxhash64(a, b))
    windows = F.transform(
        starts, lambda i: F.struct(F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)]).alias("w"), i.alias("i"))
    )
    ordered = F.array_sort(windows)
    pairs = F.zip_with(
        F.col(f"{_P}sorted"),
        F.slice(f"{_P}sorted", F.lit(2), F.size(f"{_P}sorted")),
        lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")),
    )
    at = F.col(f"{_P}at")
    gaps = F.zip_with(at, F.slice(at, F.lit(2), F.size(at)), lambda a, b: F.least(F.lit(n), F.coalesce(b - a, F.lit(n))))
    return hashes, ordered, F.array_sort(F.array_distinct(F.flatten(pairs))), F.aggregate(gaps, F.lit(0), lambda s, x: s + x)


def measure(docs: DataFrame, rules: QualityRules = QualityRules(), text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with one struct column of a document's numbers: n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, n_chars, classes, hist."""
    n = rules.window
    if n < 2 or n & (n - 1):
        raise ValueError("window must be a power of two")
    named = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    body, tongue = (f"c{docs.columns.index(c)}" for c in (text, lang))
    df = _with_features(named, body, tongue)
    hashes, ordered, positions, covered = _repeated_words(n)
    df = df.withColumn(f"{_P}hash", F.transform(F.col(f"{_P}words"), lambda w: F.xxhash64(w)))
    df = df.withColumn(f"{_P}windows", F.when(F.col(f"{_P}n_words") > n, hashes))
    # A row without repeats keeps nulls from here on, and the dear steps are skipped for it.
    df = df.withColumn(f"{_P}sorted", F.when(F.size(F.array_distinct(f"{_P}windows")) < F.size(f"{_P}windows"), ordered))
    df = df.withColumn(f"{_P}at", F.when(F.col(f"{_P}sorted").isNotNull(), positions))
    repeat = F.when(F.col(f"{_P}at").isNotNull(), covered).otherwise(F.lit(0)).cast("long")
    df = df.withColumn(
        f"{_P}lines", F.filter(F.split(F.coalesce(F.col(body), F.lit("")), "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    )
    held = F.col(f"{_P}classes")
    symbol, space = (F.get(held, F.lit(CLASS_NAMES.index(c))) for c in ("symbol", "space"))
    chars = F.get(f"{_P}sizes", F.lit(0))
    numbers = F.struct(
        F.col(f"{_P}n_words").alias("n_words"),
        (chars - space).alias("word_chars"),
        symbol.alias("n_symbols"),
        (F.size(f"{_P}lines") - F.size(F.array_distinct(f"{_P}lines"))).cast("long").alias("n_dup_lines"),
        repeat.alias("n_repeat_words"),
        chars.alias("n_chars"),
        held.alias("classes"),
        F.col(f"{_P}hist").alias("hist"),
    )
    return df.select(*named.columns, numbers.alias("m")).toDF(*docs.columns, column_of(docs, "measures"))


def judge(measured: DataFrame, refs: dict, rules: QualityRules = QualityRules(), lang: str = "lang") -> DataFrame:
    """The rows of ``measure`` with one struct column more: base_failed, class_distance,
    word_distance, kept."""
    m = lambda c: F.col(f"{measured.columns[-1]}.{c}")
    refer = lambda kind: _by_lang(
        F.col(lang), {g: F.array(*map(F.lit, refs[g][kind])) for g in COMMON_WORDS if g in refs} | {"*": F.array(*map(F.lit, refs["*"][kind]))}, F.array(*map(F.lit, refs["*"][kind]))
    )
    by_class = F.when(m("word_chars") >= rules.min_chars, _distance(m("classes"), m("n_chars"), refer("classes")))
    by_word = F.when((m("n_words") >= rules.min_words) & m("hist").isNotNull(), _distance(m("hist"), m("n_words"), refer("words")))
    failed = (m("n_words") < rules.least_words) | (100 * m("n_repeat_words") > rules.repeat_percent * m("n_words"))
    within = (F.coalesce(by_class, F.lit(0.0)) <= rules.class_limit) & (F.coalesce(by_word, F.lit(0.0)) <= rules.word_limit)
    verdict = F.struct(failed.alias("base_failed"), by_class.alias("class_distance"), by_word.alias("word_distance"), (~failed & within).alias("kept"))
    return measured.withColumn(column_of(measured, "quality"), verdict)


def assess(docs: DataFrame, rules: QualityRules = QualityRules(), keep: list[str] | None = None, lang: str = "lang") -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default; ``lang`` among them), measured,
    written and judged: the last two columns are the structs of ``measure`` and ``judge``."""
    measured = measure(docs, rules, lang=lang)
    written = Scratch(docs.sparkSession, "quality").write(measured.select(*[f"`{c}`" for c in keep or docs.columns], measured.columns[-1]), "measures")
    return judge(written, references(written, lang), rules, lang)


def quality_filter(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The documents that the rules keep, with the input's columns."""
    judged = assess(docs, rules)
    return judged.where(F.col(f"{judged.columns[-1]}.kept")).select(*[f"`{c}`" for c in docs.columns])
