"""DuckDB SQL for the results of the operators that SQL can express."""

from __future__ import annotations

from . import quality, urlfilter

_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = f"'{_AZ}', '{_AZ.lower()}'"
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"[^\x20\x09-\x0D]+"

#: Least node reachable, for a table ``links(a, b)`` with both directions.
_REACH = """
reach(node, least) as (
  select a, a from links union select r.node, l.b from reach r join links l on l.a = r.least
), component as (select node, min(least) as least from reach group by 1)
"""

NGRAM_JOIN = f"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '{_WORD}') as w from documents
), sets as (
  select doc_id, case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from words
), grams as (select doc_id, unnest(s) as g, len(s) as n from sets),
shared as (
  select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as inter
  from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2
), links as (select a, b from shared where 100 * inter >= 80 * (na + nb - inter)),
{_REACH}
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, coalesce(c.least, s.doc_id) as component_id
from sets s left join component c on c.node = s.doc_id
"""

LINE_DEDUP = f"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents
), keyed as (select *, translate(trim(line, {_SPACES}), {_LOWER}) as k from lines),
often as (select k from keyed where length(k) >= 1 group by k having count(distinct doc_id) >= 10),
marked as (select doc_id, i, line, k in (select k from often) as gone from keyed)
select doc_id, cast(count(*) as bigint) as n_lines, cast(count(*) filter (gone) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""


def url_filter(rules: tuple = urlfilter.RULES) -> str:
    listed = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return f"""
with rules(verdict, h, p) as (values {listed}),
parts as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {_LOWER}) as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path from pages
), hits as (
  select page_id, h || p as rule, r.verdict from parts join rules r on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
), best as (select page_id, max_by(rule, length(rule)) as rule, max_by(verdict, length(rule)) as verdict from hits group by 1)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join best using (page_id)
"""


EMBEDDING_DEDUP = f"""
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id < b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.98
), links as (select a, b from pairs union select b, a from pairs),
degree as (select a as vec_id, count(*) as n from links group by 1),
{_REACH}
select e.vec_id, coalesce(d.n, 0) as n_links, coalesce(c.least, e.vec_id) as component_id, coalesce(c.least, e.vec_id) = e.vec_id as kept
from embeddings e left join degree d on d.vec_id = e.vec_id left join component c on c.node = e.vec_id
"""


def quality_rules(rules: quality.QualityRules = quality.QualityRules()) -> str:
    """Counts, histograms of every document and language, and the two distances."""
    steps, names = [], []
    for i, (_, pattern) in enumerate(quality.CLASSES):
        quoted = pattern.replace("'", "''")
        steps.append(f"r{i + 1} as (select *, regexp_replace(t{i}, '{quoted}', '', 'g') as t{i + 1} from r{i})")
    n = len(quality.CLASSES)
    blank = "length(t0) - word_chars"
    sizes = [f"length(t{i}) - length(t{i + 1})" for i in range(n)]
    sizes[0] += f" - ({blank})"
    names = [*sizes, f"length(t{n})", blank]
    lists = " ".join(f"when '{k}' then ['" + "', '".join(v) + "']" for k, v in quality.COMMON_WORDS.items())
    hist = ", ".join(f"len(list_filter(w, lambda x: x = common[{i + 1}]))" for i in range(quality.K))
    known = ", ".join(f"'{k}'" for k in quality.COMMON_WORDS)
    m, k = len(names), quality.K + 1

    def shares(name: str, size: int) -> str:
        total = " + ".join(f"sum({name}[{i + 1}])" for i in range(size))
        return "[" + ", ".join(f"coalesce(sum({name}[{i + 1}]) / nullif({total}, 0), 0)::double" for i in range(size)) + "]"

    def distance(counts: str, total: str, reference: str, size: int) -> str:
        term = lambda a, b: f"case when {a} > 0 then {a} * log2(2 * {a} / ({a} + {b})) else 0 end"
        pairs = [(f"({counts}[{i + 1}] / {total}::double)", f"({reference})[{i + 1}]") for i in range(size)]
        return "sqrt(greatest((" + " + ".join(f"{term(p, q)} + {term(q, p)}" for p, q in pairs) + ") / 2, 0))"

    return f"""
with r0 as (
  select doc_id, lang, coalesce(text, '') as t0, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents
), {", ".join(steps)},
sized as (select *, length(array_to_string(w, '')) as word_chars, len(w) as n_words, case lang {lists} end as common from r{n}),
counted as (select *, [{", ".join(names)}] as classes, case when common is not null then [{hist}] end as h from sized),
told as (select *, case when h is not null then list_append(h, n_words - list_sum(h)) end as words from counted),
refs as (
  select case when lang in ({known}) then lang else '*' end as g, {shares("classes", m)} as rc, {shares("words", k)} as rw from told group by 1
), pooled as (select {shares("classes", m)} as rc from told),
windows as (
  select doc_id, i, array_to_string(w[i:i+{rules.window - 1}], ' ') as s from (select doc_id, w, unnest(range(1, len(w) - {rules.window - 2})) as i from told where len(w) >= {rules.window})
), again as (select doc_id, i from windows qualify count(*) over (partition by doc_id, s) > 1),
covered as (
  select doc_id, sum(least({rules.window}, coalesce(nxt - i, {rules.window}))) as n from (select doc_id, i, lead(i) over (partition by doc_id order by i) as nxt from again) group by 1
), lines as (
  select doc_id, count(*) - count(distinct line) as n from (select doc_id, unnest(string_split(t0, chr(10))) as line from told)
  where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by 1
), judged as (
  select t.doc_id, n_words, word_chars, t.classes[{quality.CLASS_NAMES.index("symbol") + 1}] as n_symbols, coalesce(l.n, 0) as n_dup_lines, coalesce(c.n, 0) as n_repeat_words,
    case when word_chars >= {rules.min_chars} then {distance("classes", "length(t0)", "coalesce(case when t.lang in (" + known + ") then r.rc end, p.rc)", m)} end as cd,
    case when n_words >= {rules.min_words} and words is not null then {distance("words", "n_words", "r.rw", k)} end as wd
  from told t cross join pooled p left join refs r on r.g = t.lang left join covered c using (doc_id) left join lines l using (doc_id)
), failed as (select *, n_words < {rules.least_words} or 100 * n_repeat_words > {rules.repeat_percent} * n_words as base_failed from judged)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
  cast(n_repeat_words as bigint) as n_repeat_words, base_failed, not base_failed and coalesce(cd, 0) <= {rules.class_limit} and coalesce(wd, 0) <= {rules.word_limit} as kept
from failed
"""
