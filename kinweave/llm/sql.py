"""DuckDB SQL for the queries of this folder that SQL can express, over whole tables."""

from kinweave.llm.urlfilter import OP8_SQL

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"
_WORDS = f"docs as (select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') as w from documents)"

OP3_SQL = f"""
with {_WORDS},
tf as (select rid, doc_id, t, count(*) as tf from (select rid, doc_id, unnest(w) as t from docs) group by all),
df as (select t, count(*) as df from tf group by t),
size as (select rid, len(w) as n from docs), total as (select count(*) as n, avg(n) as mean from size),
scored as (select q.doc_id as query_id, d.doc_id, d.rid, sum(ln(1 + (total.n - df + 0.5) / (df + 0.5)) * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * size.n / mean))) as s
  from (select distinct doc_id, t from tf where doc_id % 50 = 0) q join tf d using (t) join df using (t) join size on size.rid = d.rid, total where d.doc_id <> q.doc_id group by all),
best as (select query_id, doc_id, max(round(s, 6)) as score from scored where s > 0 group by all)
select query_id, rank::int as rank, doc_id, score from (select *, row_number() over (partition by query_id order by score desc, doc_id) as rank from best) where rank <= 10
"""

OP7_SQL = f"""
with recursive {_WORDS},
s as (select distinct rid, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from docs),
n as (select rid, count(*) as n from s group by rid),
met as (select a.rid as x, b.rid as y, count(*) as c from s a join s b on a.s = b.s and a.rid <> b.rid group by all),
links as (select x, y from met join n a on a.rid = x join n b on b.rid = y where 100 * c >= 75 * (a.n + b.n - c)),
reach as (select rid as a, rid as b from docs union select a, y from reach join links on b = x)
select d.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(o.doc_id) as component_id from docs d left join n using (rid) join reach on a = d.rid join docs o on o.rid = b group by d.rid, d.doc_id
"""

OP10_SQL = f"""
with docs as (select row_number() over () as rid, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents),
windows as (select rid, unnest(range(1, len(w) - 33)) as i, unnest(list_transform(range(1, len(w) - 33), lambda i: md5(array_to_string(w[i : i + 34], ' ')))) as h from docs where len(w) >= 35),
twice as (select h from windows group by h having count(*) > 1),
gone as (select distinct rid, unnest(range(i, i + 35)) as p from windows where h in (select h from twice)),
words as (select rid, unnest(w) as t, unnest(range(1, len(w) + 1)) as p from docs),
kept as (select rid, string_agg(t, ' ' order by p) as kept from words where (rid, p) not in (select rid, p from gone) group by rid),
many as (select rid, count(*) as n from gone group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from docs left join kept using (rid) left join many using (rid)
"""

ORACLES = {"op3_topk_search": OP3_SQL, "op7_ngram_jaccard_join": OP7_SQL, "op8_url_filter": OP8_SQL, "op10_substring_dedup": OP10_SQL}
