"""SQL twins of the operators that SQL can express."""

from __future__ import annotations

import string

from . import divergence, fill_in_middle, quality, url_filter


def _rules(host: str, path: str, field: str) -> str:
    cases = []
    for name, prefix, verdict in sorted(url_filter.RULES, key=lambda r: -len(r[0] + r[1])):
        value = name + prefix if field == "rule" else verdict
        cases.append(f"when ({host} = '{name}' or ends_with({host}, '.{name}')) and starts_with({path}, '{prefix}') then '{value}'")
    return "case " + " ".join(cases) + " end"


def _host(url: str) -> str:
    rest = f"case when instr({url}, '://') > 0 then substr({url}, instr({url}, '://') + 3) else '' end"
    return f"coalesce(translate(regexp_extract({rest}, '^[^/?#]*'), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '')"


def _path(url: str) -> str:
    rest = f"case when instr({url}, '://') > 0 then substr({url}, instr({url}, '://') + 3) else '' end"
    return f"coalesce(regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1), '')"


def _node(url: str) -> str:
    plain = f"regexp_extract({url}, '^[^#]*')"
    at = f"instr({plain}, '://')"
    return f"case when {at} > 0 then substr({plain}, 1, {at} + 2) || {_host(plain)} || substr({plain}, {at} + 3 + length({_host(plain)})) else {plain} end"


_HREF = r"""(?is)<link\b[^>]*\bhref\s*=\s*["'']?([^\s"''>]+)"""
_REL = r"""(?is)\brel\s*=\s*["'']?canonical\b"""
_REFRESH = r"""(?is)\bhttp-equiv\s*=\s*["'']?refresh\b"""
_CONTENT = r"""(?is)<meta\b[^>]*\bcontent\s*=\s*["'']?[^"''>]*?\burl\s*=\s*["'']?([^\s"''>]+)"""
_SCRIPT = r"""(?s)\blocation(?:\.href)?\s*(?:=|\.(?:replace|assign)\()\s*["'']([^"'']+)["'']"""

REDIRECT_EQUIVALENCE = f"""
with recursive found as (
  select url, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, '(?is)<link\\b[^>]*>'), lambda x: regexp_matches(x, '{_REL}') and regexp_matches(x, '{_HREF}')), lambda x: regexp_extract(x, '{_HREF}', 1)),
    list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\\b[^>]*>'), lambda x: regexp_matches(x, '{_REFRESH}') and regexp_matches(x, '{_CONTENT}')), lambda x: regexp_extract(x, '{_CONTENT}', 1)),
    regexp_extract_all(html, '{_SCRIPT}', 1))) target
  from pages where url is not null and html is not null),
named as (select url, replace(target, '&amp;', '&') t, split_part(url, '://', 1) scheme, {_host("url")} host, {_path("url")} path from found where target <> '' and not starts_with(target, '#')),
links as (select distinct {_node("url")} src, {_node("dst")} dst from (
  select url, case when regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') then t when starts_with(t, '//') then scheme || ':' || t
    when starts_with(t, '/') then scheme || '://' || host || t when starts_with(t, '?') then scheme || '://' || host || path || t
    else scheme || '://' || host || case when contains(path, '/') then regexp_extract(path, '(?s)^.*/') else '/' end || t end dst from named)),
edges as (select src a, dst b from links union select dst, src from links),
bad as (select a node from edges where {_rules(_host("a"), _path("a"), "verdict")} = 'block' union select e.b from bad join edges e on e.a = bad.node),
judged as (select page_id, url, {_host("url")} host, {_path("url")} path from pages)
select page_id, host, path, {_rules("host", "path", "rule")} as rule,
  coalesce({_rules("host", "path", "verdict")}, case when exists (select 1 from bad where bad.node = {_node("judged.url")}) then 'block' end, '{url_filter.DEFAULT}') as verdict
from judged
"""

_WORD, _SPACE = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]"
_BY = {"cell": "lang, source, ", "lang": "lang, ", "corpus": ""}


def _quartiles(level: str) -> str:
    by = _BY[level]
    return f"""q_{level} as (select {by}metric, max(total) n, min(case when upto >= 0.25 * total then value end) q1, min(case when upto >= 0.75 * total then value end) q3
 from (select {by}metric, case when bucket is null then 0.0 else 2 * pow({quality.GAMMA}, bucket) / {quality.GAMMA + 1} end as value,
   sum(n) over (partition by {by}metric order by bucket asc nulls first rows between unbounded preceding and current row) upto, sum(n) over (partition by {by}metric) total
   from (select {by}metric, bucket, sum(n) n from cells group by all)) group by all)"""


def _blended(q: str) -> str:
    return f"(c.n * c.{q} + {quality.PRIOR} * ((l.n * l.{q} + {quality.PRIOR} * a.{q}) / (l.n + {quality.PRIOR}))) / (c.n + {quality.PRIOR})"


_MEASURES = ", ".join(f"{e} as {m}" for m, (e, _, _) in quality.METRICS.items())
_SPREAD = "case metric " + " ".join(f"when '{m}' then {least}" for m, (_, least, _) in quality.METRICS.items()) + " end"
_BEYOND = " or ".join(f"coalesce(m.{m} > max(case when f.metric = '{m}' then f.high end), false)" + (f" or coalesce(m.{m} < max(case when f.metric = '{m}' then f.low end), false)" if both else "") for m, (_, _, both) in quality.METRICS.items())

ADAPTIVE_QUALITY = f"""
with docs as (select doc_id, coalesce(text, '') as text, coalesce(lang, chr(1)) lang, coalesce(source, chr(1)) source from documents),
w as (select doc_id, unnest(regexp_extract_all(text, '{_WORD}')) word, generate_subscripts(regexp_extract_all(text, '{_WORD}'), 1) i from docs),
win as (select doc_id, i, word || ' ' || lead(word, 1) over o || ' ' || lead(word, 2) over o || ' ' || lead(word, 3) over o || ' ' || lead(word, 4) over o g from w window o as (partition by doc_id order by i)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) c from win where g is not null) where c > 1),
cover as (select doc_id, count(distinct i + k) n from twice, (select unnest([0, 1, 2, 3, 4]) k) group by 1),
lines as (select doc_id, count(*) n, count(distinct line) d from (select doc_id, unnest(string_split(text, chr(10))) line from docs) where regexp_matches(line, '{_WORD}') group by 1),
counts as (select d.doc_id, lang, source, cast(len(regexp_extract_all(text, '{_WORD}')) as bigint) n_words, cast(length(regexp_replace(text, '{_SPACE}', '', 'g')) as bigint) word_chars,
  cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) n_symbols, cast(coalesce(l.n - l.d, 0) as bigint) n_dup_lines, cast(coalesce(c.n, 0) as bigint) n_repeat_words, coalesce(l.n, 0) n_lines
  from docs d left join cover c using (doc_id) left join lines l using (doc_id)),
f as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed from counts),
measured as (select doc_id, lang, source, {_MEASURES} from f where not base_failed),
long as (select lang, source, unnest({list(quality.METRICS)}) metric, unnest([{", ".join(quality.METRICS)}]) v from measured),
cells as (select lang, source, metric, case when v > 0 then cast(ceil(ln(v) / ln({quality.GAMMA})) as int) end bucket, count(*) n from long group by all),
{_quartiles("cell")}, {_quartiles("lang")}, {_quartiles("corpus")},
used as (select c.lang, c.source, metric, {_blended("q1")} q1, {_blended("q3")} q3
  from q_cell c join q_lang l using (lang, metric) join q_corpus a using (metric)),
fences as (select lang, source, metric, q3 + {quality.REACH} * greatest(q3 - q1, {_SPREAD}) high, q1 - {quality.REACH} * greatest(q3 - q1, {_SPREAD}) low from used),
over as (select m.doc_id from measured m join fences f using (lang, source) group by m.doc_id, {", ".join(f"m.{m}" for m in quality.METRICS)} having {_BEYOND})
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and doc_id not in (select doc_id from over) kept from f
"""

_LETTERS = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def _share(count: str, total: str, kept: str) -> str:
    return f"1 + cast({divergence.SCALE} as hugeint) * ({count} + 2) // ({total} + 2 * {kept})"


SOURCE_DIVERGENCE = f"""
with docs as (select row_number() over () id, coalesce(text, '') t, coalesce(lang, '') lang, coalesce(source, '') source from documents),
w as (select id, lang, source, translate(unnest(regexp_extract_all(t, '{_LETTERS}')), '{string.ascii_uppercase}', '{string.ascii_lowercase}') term from docs),
kept as (select lang, term, count(*) n from w group by all having count(distinct id) >= {divergence.MIN_DOCS}),
langs as (select lang, count(*) v, sum(n) n from kept group by all),
counts as (select lang, source, term, count(*) n from w join kept using (lang, term) group by all),
totals as (select lang, source, sum(n) n from counts group by all),
groups as (select distinct lang, source from docs),
p as (select g.lang, g.source, k.term, coalesce(c.n, 0) c, {_share("coalesce(c.n, 0)", "coalesce(t.n, 0)", "l.v")} p, {_share("k.n", "l.n", "l.v")} q
  from groups g join kept k using (lang) join langs l using (lang) left join totals t on (t.lang = g.lang and t.source = g.source) left join counts c on (c.lang = g.lang and c.source = g.source and c.term = k.term)),
sums as (select a.lang, a.source, b.source item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) f from p a join p b on (a.lang = b.lang and a.term = b.term and a.source <> b.source) group by all),
found as (
  select a.lang, a.source, 'pair' part, b.source item, coalesce(f, 0) f from groups a join groups b on (a.lang = b.lang and a.source <> b.source) left join sums s on (s.lang = a.lang and s.source = a.source and s.item = b.source)
  union all select lang, source, 'term', term, (p - q) * (p - q) // (p + q) from p where c > 0 and p > q)
select lang, source, part, item, cast(f as bigint) as value, cast(row_number() over (partition by lang, source, part order by f desc, item) as int) as rank
from found qualify part = 'pair' or rank <= {divergence.TOP}
"""

_P, _S, _M = fill_in_middle.PREFIX, fill_in_middle.SUFFIX, fill_in_middle.MIDDLE


def _draw(i: int) -> str:
    return f"cast('0x' || substr(h, {8 * i - 7}, 8) as bigint)"


FILL_IN_MIDDLE = f"""
with drawn as (select doc_id, coalesce(text, '') t, cast(length(coalesce(text, '')) as bigint) n, sha256('{fill_in_middle.SALT}:' || coalesce(cast(doc_id as varchar), '')) h from documents),
cuts as (select doc_id, t, n, least({_draw(1)} % (n + 1), {_draw(2)} % (n + 1)) i, greatest({_draw(1)} % (n + 1), {_draw(2)} % (n + 1)) j,
  case when n = 0 or contains(t, '{_P}') or contains(t, '{_S}') or contains(t, '{_M}') or {_draw(3)} % 100 >= {fill_in_middle.CUT} then 'plain' when {_draw(4)} % 100 < {fill_in_middle.SUFFIX_FIRST} then 'spm' else 'psm' end form from drawn),
pieces as (select *, substr(t, 1, i) a, substr(t, i + 1, j - i) b, substr(t, j + 1) c from cuts)
select doc_id, n, form, case when form <> 'plain' then i end as prefix_chars, case when form <> 'plain' then j - i end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '{_P}' || a || '{_S}' || c || '{_M}' || b else '{_S}' || c || '{_P}' || a || '{_M}' || b end) as output_sha256, sha256(t) as restored_sha256
from pieces
"""

DIGEST_INDEX = """
select doc_id, max(doc_id) over (partition by coalesce(text, '')) as keep_id, count(*) over (partition by coalesce(text, '')) as group_size,
  doc_id = max(doc_id) over (partition by coalesce(text, '')) as kept, sha256(coalesce(text, '')) as text_sha256
from documents
"""
