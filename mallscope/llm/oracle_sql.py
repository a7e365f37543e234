"""DuckDB SQL for the operators that SQL can express, over the same tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(column: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}'), "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


OP7 = r"""
with d as (select doc_id, source host, coalesce(text, '') t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
p as (select doc_id, i, array_to_string(w[i:i + 4], ' ') five
      from (select doc_id, w, unnest(range(1, len(w) - 3)) i from d)),
r as (select doc_id, count(distinct i + k) n_repeat_words
      from (select *, count(*) over (partition by doc_id, five) times from p), range(5) x(k)
      where times > 1 group by doc_id),
m as (select d.doc_id, host, cast(len(w) as bigint) n_words, cast(length(array_to_string(w, '')) as bigint) word_chars,
             cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) n_symbols,
             cast(len(lines) - len(list_distinct(lines)) as bigint) n_dup_lines, len(lines) n_lines,
             cast(coalesce(n_repeat_words, 0) as bigint) n_repeat_words
      from (select *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) lines from d) d
      left join r on d.doc_id = r.doc_id),
f as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed,
             n_symbols > greatest(n_words, 1) * 0.1 or n_dup_lines > greatest(n_lines, 1) * 0.5
               or not (word_chars / greatest(n_words, 1) between 2 and 15) rule_failed from m),
h as (select host, count(*) n, cast(count(*) filter (where base_failed or rule_failed) as double) k from f group by host),
s as (select sum(n) n, sum(k) / sum(n) mean,
             (sum(k * k / n) - sum(n) * power(sum(k) / sum(n), 2)
              - (count(*) - 1) * (sum(k) / sum(n)) * (1 - sum(k) / sum(n))) / nullif(sum(n) - sum(n * n) / sum(n), 0) v,
             count(*) hosts from h),
g as (select host, case when hosts > 1 and mean > 0 and mean < 1 and v > 0
                        then (k + mean * greatest(0, mean * (1 - mean) / v - 1)) / (h.n + greatest(0, mean * (1 - mean) / v - 1))
                        else mean end rate from h, s)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, rule_failed, f.host,
       case when rate > 0.5 then 'rejected' when rate <= 0.02 then 'trusted' else 'watched' end host_verdict,
       not base_failed and rate <= 0.5 and (rate <= 0.02 or not rule_failed) kept
from f join g on f.host is not distinct from g.host
"""

OP10 = f"""
with i as (select distinct cast(item_id as varchar) item_id, {_words('text')} w from benchmark),
k as (select distinct item_id, least(len(w), 10) n, array_to_string(w[s:s + 9], ' ') phrase
      from (select *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) s from i where len(w) > 0)),
d as (select doc_id, {_words('text')} w from documents),
o as (select doc_id, s, n, phrase from (
        select doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') phrase, len(w) size
        from (select *, unnest(range(1, len(w) + 1)) s from d), (select distinct n from k)) where s + n - 1 <= size),
x as (select o.doc_id, o.s, o.n, k.item_id from o join k on o.n = k.n and o.phrase = k.phrase),
hit as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(s, s + n)) p from x) group by doc_id),
who as (select doc_id, count(distinct item_id) n_items,
               array_to_string(list_sort(list(distinct item_id) filter (where item_id is not null)), ',') ids
        from x group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit,
       cast(coalesce(n_items, 0) as bigint) n_items, sha256(coalesce(ids, '')) items_sha256, n_hit is not null contaminated
from d left join hit on d.doc_id = hit.doc_id left join who on d.doc_id = who.doc_id
"""

ORACLE_SQL = {"op7_host_rules": OP7, "op10_decontamination": OP10}
