"""Plain SQL for the queries that SQL can express: DuckDB over the same tables."""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP8_BASE = rf"""
with w as (select doc_id, coalesce(text, '') as text, {_WORDS} as words from documents),
lines as (select doc_id, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls from w),
grams as (
  select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as g
  from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from w)),
again as (select doc_id, i from grams qualify count(*) over (partition by doc_id, g) > 1),
covered as (
  select doc_id, sum(least(3, coalesce(next_i - i, 3))) as n
  from (select doc_id, i, lead(i) over (partition by doc_id order by i) as next_i from again) group by doc_id)
select w.doc_id, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
  (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
  (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words,
  len(words) < 50 or 100 * coalesce(n, 0) > 50 * len(words) as base_failed
from w join lines using (doc_id) left join covered using (doc_id)
"""

#: The queries' whole rows depend on sketches, hashes or learned models that DuckDB does not
#: have; they are held against brute force in tests/llm. ``OP8_BASE`` gives the columns of
#: op8 that do not.
ORACLES: dict[str, str] = {}
