"""DuckDB SQL of the numbered queries that SQL can express."""

from __future__ import annotations

import string

from tidemark.llm import quality

_BLANK = r"\x20\x09-\x0D"
_URLS = f"translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def _quality() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS)))
    symbols = "[" + "".join(f"\\{c}" for c in quality.SYMBOLS) + "]"
    fails = {r.name: " or ".join([f"{r.metric} < {r.least}::double"] * (r.least is not None)
                                 + [f"{r.metric} > {r.most}::double"] * (r.most is not None)) for r in quality.RULES}
    names = ", ".join(f"case when {f} then '{n}' end" for n, f in fails.items())
    return rf"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
w as (select rid, doc_id, t, regexp_extract_all(t, '[^{_BLANK}]+') as ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{_BLANK}]')) as ls from d),
grams as (select rid, unnest(range(1, len(ws) - 6)) as i,
                 unnest(list_transform(range(1, len(ws) - 6), lambda k: array_to_string(ws[k:k + 7], ' '))) as g from w),
again as (select rid, i from (select *, count(*) over (partition by rid, g) as n from grams) x where n > 1),
inside as (select rid, count(distinct i + k) as n_repeat_words from again, range(8) r(k) group by rid),
base as (
  select w.rid, doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
         len(regexp_extract_all(t, '{symbols}')) as n_symbols, len(ls) - len(list_distinct(ls)) as n_dup_lines,
         coalesce(n_repeat_words, 0) as n_repeat_words, len(ls) as n_lines,
         len(list_filter(ls, lambda x: length(x) < {quality.SHORT_LINE})) as n_short,
         len(list_filter(ws, lambda x: x in ({stop}))) as n_stop,
         len(list_filter(range(2, len(ws) + 1), lambda k: ws[k] = ws[k - 1])) as n_same
  from w left join inside using (rid)),
m as (
  select *, n_words < {quality.LEAST_WORDS} or 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words as base_failed,
         word_chars / greatest(n_words, 1)::double as mean_word_chars, n_symbols / greatest(n_words, 1)::double as symbol_ratio,
         n_stop / greatest(n_words, 1)::double as stop_ratio, n_same / greatest(n_words, 1)::double as same_word_ratio,
         n_dup_lines / greatest(n_lines, 1)::double as dup_line_ratio,
         n_short / greatest(n_lines, 1)::double as short_line_ratio
  from base)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
       not base_failed and concat_ws(',', {names}) = '' as kept, mean_word_chars, symbol_ratio, stop_ratio,
       same_word_ratio, dup_line_ratio, short_line_ratio, concat_ws(',', {names}) as failed_rules
from m"""


ORACLES: dict[str, str] = {
    "op1_quality_rules": _quality(),
    "op2_warc_packages": """
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
g as (select payload, min(page_id) as head, sha1(payload) as h from p group by payload)
select page_id, octet_length(p.payload)::bigint as payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(h, (10 * (i // 8) + 1)::int, 10))::bigint >> (35 - 5 * (i % 8))) & 31) + 1)::int, 1)), '') as payload_digest,
       case when page_id is distinct from head and head is not null then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from head then head end as refers_to
from p join g on p.payload = g.payload""",
    "op9_url_filters": f"""
with u as (select row_number() over () as rid, page_id, {_URLS} as host,
                  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
r(action, h, p) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                           ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
best as (select rid, arg_max(h || p, length(h || p)) as rule, arg_max(action, length(h || p)) as action
         from u join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by rid)
select page_id, host, path, rule, coalesce(action, 'allow') as verdict from u left join best using (rid)""",
    "op10_jaccard_join": rf"""
with recursive k as (select coalesce(text, '') as t, min(doc_id) as text_id from documents group by coalesce(text, '')),
c as (select row_number() over () as n, t, text_id, regexp_extract_all(t, '[^{_BLANK}]+') as ws from k),
s as (select distinct n, unnest(case when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                                     when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as g from c),
z as (select n, count(*) as size from s group by n),
common as (select a.n as x, b.n as y, count(*) as c from s a join s b on a.g = b.g and a.n <> b.n group by all),
l as (select x, y from common join z zx on zx.n = x join z zy on zy.n = y where 5 * c >= 4 * (zx.size + zy.size - c)),
reach(n, r) as (select n, n from c union select reach.n, l.y from reach join l on reach.r = l.x),
roots as (select n, min(r) as root from reach group by n),
classes as (select root, min(text_id) as class_id from roots join c using (n) group by root),
links as (select x as n, count(*) as n_links from l group by x)
select d.doc_id, class_id, text_id, coalesce(n_links, 0)::bigint as n_links
from documents d join c on coalesce(d.text, '') = c.t join roots using (n) join classes using (root) left join links using (n)""",
    "op12_hard_negatives": """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
         list_transform(embedding, lambda c: floor(256 * c::double)) as x
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
r as (select row_number() over () as n, * from e),
s as (select a.n as an, a.vec_id as anchor_id, c.n as cn, c.vec_id as cand_id, a.label = c.label as same,
             list_inner_product(a.x, c.x)::bigint as score
      from r a, r c where a.vec_id % 50 = 0 and a.n <> c.n),
p as (select * from (select *, row_number() over (partition by an order by score desc, cand_id nulls last) as k from s where same) x
      where k <= 5),
w as (select p.an, p.anchor_id, p.cn, p.cand_id as positive_id, p.score as positive_score, s.cand_id as negative_id,
             s.score as negative_score,
             row_number() over (partition by p.an, p.cn order by s.score desc, s.cand_id nulls last) as rank
      from p join s on s.an = p.an and not s.same
        and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from w where rank <= 3""",
}
