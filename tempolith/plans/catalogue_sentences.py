"""Queries of learned sentences and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sentences
from .catalogue import query, table

_OPEN, _CLOSE = r"""^[("''\[{]+""", r"""[)"''\]}]+$"""
#: word types of all documents: w (the word bare), t (its type), dotted, and what follows it
_TYPES = rf"""docs as (select doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') ws from documents),
 bare as (select doc_id, i, w raw, regexp_replace(regexp_replace(w, '{_OPEN}', ''), '{_CLOSE}', '') w from (select doc_id, unnest(ws) w, generate_subscripts(ws, 1) i from docs)),
 plain as (select *, regexp_matches(w, '[^.]\.$') dotted, lower(regexp_replace(w, '[.,;:!?]+$', '')) p from bare),
 words as (select *, case when dotted then lower(substr(w, 1, length(w) - 1)) else p end t, lead(p) over o nxt, lead(w) over o nxt_w from plain window o as (partition by doc_id order by i)),
 types as (select t, count(*) filter (dotted) k, count(*) filter (not dotted) m from words where t <> '' group by t),
 sums as (select sum(k) dots, sum(k + m) n from types),
 scores as (select t, k, m, 2 * (k * (ln(0.99) - ln(dots / n)) + m * (ln(0.01) - ln(1 - dots / n))) * exp(-(length(t) - dots_in)) * (dots_in + 1) * pow(cast(length(t) - dots_in as double), -m) score
  from (select *, length(regexp_replace(t, '[^.]', '', 'g')) dots_in from types), sums where k > 0 and regexp_matches(t, '\p{{L}}') and dots < n)"""

_STARTERS = rf"""short as (select t from scores where score >= {sentences.ABBREVIATION}),
 after as (select nxt t, count(*) a from words where t <> '' and dotted and regexp_matches(nxt_w, '^\p{{Lu}}') and nxt <> '' and t not in (select t from short) group by 1),
 joined as (select t, cast(a as double) a, cast(k + m as double) c, (select cast(sum(a) as double) from after) e, (select cast(sum(k + m) as double) from types) n from after join types using (t)),
 rates as (select *, greatest(c - a, 0) x, c / n p, a / e p1, greatest(c - a, 0) / (n - e) p2 from joined where n > e),
 first as (select t, a, c, case when p1 > p2 then 2 * (a * ln(p1) + case when e > a then (e - a) * ln(1 - p1) else 0 end + case when x > 0 then x * ln(p2) else 0 end + case when n - e > x then (n - e - x) * ln(1 - p2) else 0 end
   - a * ln(p) - case when e > a then (e - a) * ln(1 - p) else 0 end - case when x > 0 then x * ln(p) else 0 end - case when n - e > x then (n - e - x) * ln(1 - p) else 0 end) else 0.0 end score from rates)"""


@query(f"with {_TYPES} select t as type, k with_period, m alone, round(score, 6) + 0.0 score from scores")
def abbreviation_scores(spark, d):
    """How strongly each word type of all documents is bound to its period."""
    found = sentences.abbreviation_scores(table(spark, d, "documents"))
    return found.select("type", "with_period", "alone", F.round("score", 6).alias("score"))


@query(f"with {_TYPES}, {_STARTERS} select t as type, a as after, cast(c as bigint) total, round(score, 4) + 0.0 score from first".replace("a as after", 'cast(a as bigint) as "after"'))
def starter_scores(spark, d):
    """How strongly word types draw to the place behind a sentence's end."""
    docs = table(spark, d, "documents")
    short = sentences.abbreviation_scores(docs).where(F.col("score") >= sentences.ABBREVIATION)
    return sentences.starter_scores(docs, short).select("type", "after", "total", F.round("score", 4).alias("score"))


@query(
    rf"""with {_TYPES}, {_STARTERS}, starts as (select t from first where score >= {sentences.STARTER} and regexp_matches(t, '^\p{{L}}')),
 cut as (select doc_id, i, regexp_matches(raw, '[.!?][.!?)"''\]}}]*$') and nxt_w is not null and not (dotted and t in (select t from short) and not (regexp_matches(nxt_w, '^\p{{Lu}}') and nxt in (select t from starts))) ends_here from words),
 numbered as (select doc_id, i, coalesce(sum(cast(ends_here as int)) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) s from cut),
 counts as (select doc_id, s, count(*) n from numbered group by all)
 select doc_id, count(*) n_sentences, md5(string_agg(cast(n as varchar), ',' order by s)) word_counts from counts group by doc_id"""
)
def learned_sentences(spark, d):
    """All documents in sentences whose abbreviations and starters were learned from them: how many, and a digest of their words' numbers."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = sentences.split(docs, ("doc_id",), sentences.learn(docs))
    n = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    lists = found.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("sentence_id", n.alias("n")))).alias("s"))
    return lists.select("doc_id", F.array_size("s").cast("long").alias("n_sentences"), F.md5(F.array_join(F.transform("s", lambda x: x["n"].cast("string")), ",")).alias("word_counts"))
