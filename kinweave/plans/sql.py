"""DuckDB SQL for the registered queries, put together from common table expressions."""

from __future__ import annotations

from kinweave.functions.normalize import ADDRESS_WORDS, NAME_WORDS

_LINE = "split_part(coalesce(text, ''), chr(10), 1)"


def _entities(key: str, name: str, address: str, country: str, source: str) -> str:
    return f"select 'S' || ({key} % 3 + 1) || '-' || lpad({key}::varchar, 9, '0') as entity_id, {name} as business_name, {address} as business_address, coalesce({country}, '') as country, ({key} % 3)::int as src_ord, {key} as row_ord from {source}"


DOCUMENTS = _entities("doc_id", _LINE, f"substr(coalesce(text, ''), length({_LINE}) + 2)", "lang", "documents")
WEAK = _entities("doc_id", "''", f"substr(coalesce(text, ''), length({_LINE}) + 2)", "lang", "documents")
PARTS = _entities("p_partkey", "p_name || ' ' || p_type || ' ' || ['Ltd.', 'Inc', 'Co', 'LLC'][p_partkey % 4 + 1]", "p_size || ' ' || p_type || ' St. ' || lpad((p_partkey % 97)::varchar, 5, '5')", "p_brand", "part")
CUSTOMERS = _entities("c_custkey", "c_name", "''", "n_name", "customer join nation on c_nationkey = n_nationkey")


def clean(c: str, words: dict[str, str], fold: bool = True) -> str:
    out = f"regexp_replace(strip_accents({c}), '[^\\x00-\\x7F]', '', 'g')"
    out = f"lower(case when trim({out}) = '' then {c} else {out} end)" if fold else f"replace(lower(strip_accents({c})), 'ß', 'qzxzq')"  # a letter to the engine's ASCII word borders
    for short, full in words.items():
        out = f"regexp_replace({out}, '\\b{short}\\b', '{full}', 'g')"
    out = f"regexp_replace({out}, '[!-/:-@\\[-`{{-~]', ' ', 'g')"
    return f"replace(trim(regexp_replace({out}, '[\\t-\\r \\x1c-\\x1f]+', ' ', 'g')), 'qzxzq', 'ß')"


def _soundex(t: str) -> str:
    head = f"case when regexp_matches({t}, '^[b-gi-vx-z]') then substr({t}, 1, 1) else 'a' end"
    out = f"replace(translate({head} || regexp_replace(substr({t}, 2), '[^a-z]', 'a', 'g'), 'bfpvcgjkqsxzdtlmnraeiouyhw', '11112222222233455600000099'), '9', '')"
    for d in "123456":
        out = f"regexp_replace({out}, '{d}+', '{d}', 'g')"
    return f"upper(substr({t}, 1, 1)) || substr(replace(substr({out}, 2), '0', '') || '000', 1, 3)"


def base(source: str = DOCUMENTS, phonetic: bool = True, scalar: bool = False) -> str:
    """Tables up to the candidates: ent, norm, keys, idx, hit, pairs, gt, truth."""
    ph = f"union all select entity_id, src_ord, row_ord, 6, 'ph:' || co || '_' || {_soundex('coalesce(tok, toks[1])')} from bound where named and len(toks) > 0" if phonetic else ""
    return rf"""
with ent as ({source}),
norm as (select *, {clean('business_name', NAME_WORDS, not scalar)} as name_clean, {clean('business_address', ADDRESS_WORDS, not scalar)} as address_clean, lower(trim(country)) as country_clean from ent),
split as (select *, case when country_clean = '' then 'xx' else country_clean end as co, name_clean as nm, address_clean as ad,
  list_filter(string_split(name_clean, ' '), lambda t: t <> '') as toks, list_filter(string_split(address_clean, ' '), lambda t: t <> '') as atoks from norm),
bound as (select *, length(nm) >= 5 as named, list_filter(toks, lambda t: length(t) >= 5)[1] as tok, list_filter(atoks, lambda t: length(t) >= 5)[1] as atok,
  case when len(toks) > 1 and toks[1] in ('the', 'a', 'an') then array_to_string(toks[2:], ' ') else nm end as ps,
  list_sort(list_filter(toks, lambda t: length(t) >= 4)) as long from split),
keys as (
  select entity_id, src_ord, row_ord, 1 as ord, 'c5:' || co || '_' || substr(ps, 1, 5) as key from bound where named and length(substr(ps, 1, 5)) >= 4
  union all select entity_id, src_ord, row_ord, 2, 'c7:' || co || '_' || substr(ps, 1, 7) from bound where named and length(substr(ps, 1, 7)) >= 5
  union all select entity_id, src_ord, row_ord, 3, 'ct:' || co || '_' || tok from bound where named and tok is not null
  union all select entity_id, src_ord, row_ord, 4, 'p7:' || substr(ps, 1, 7) from bound where named and length(substr(ps, 1, 7)) >= 5
  union all select entity_id, src_ord, row_ord, 5, 'st:' || array_to_string(long, '_') from bound where named and len(long) >= 2
  {ph}
  union all select entity_id, src_ord, row_ord, 1, 'ca:' || co || '_' || trim(substr(ad, 1, 6)) from bound where not named and length(ad) >= 4 and length(trim(substr(ad, 1, 6))) >= 4
  union all select entity_id, src_ord, row_ord, 2, 'at:' || co || '_' || atok from bound where not named and length(ad) >= 4 and atok is not null
  union all select entity_id, src_ord, row_ord, 3, 'ap:' || trim(substr(ad, 1, 7)) from bound where not named and length(ad) >= 4 and length(trim(substr(ad, 1, 7))) >= 5
  union all select entity_id, src_ord, row_ord, 4, 'aa:' || co || '_' || substr(ad, 1, 6) from bound where not named and length(ad) >= 3 and length(substr(ad, 1, 6)) >= 4),
idx as (select key, cand_id from (select key, entity_id as cand_id, row_number() over (partition by key order by min(src_ord), min(row_ord), entity_id) as rn from keys where src_ord > 0 group by key, entity_id) where rn <= 60),
hit as (select k.entity_id as s1_id, i.cand_id, min(k.ord) as f from keys k join idx i using (key) where k.src_ord = 0 group by 1, 2),
pairs as (select s1_id, cand_id from (select *, row_number() over (partition by s1_id order by cand_id) as rn from
  (select *, rank() over (partition by s1_id order by f) as r from hit) where r <= 240 and cand_id <> s1_id) where rn <= 80),
s1 as (select * from norm where src_ord = 0), others as (select * from norm where src_ord > 0),
gt as (select a.entity_id as source1_entity_id, coalesce(string_agg(b.entity_id, ',' order by b.entity_id), '') as matched_entity_ids from s1 a
  left join others b on md5(a.business_name || chr(10) || a.business_address) = md5(b.business_name || chr(10) || b.business_address) group by 1),
truth as (select distinct source1_entity_id as s1_id, trim(unnest(string_split(matched_entity_ids, ','))) as cand_id from gt where matched_entity_ids <> ''),
counts as (select source1_entity_id, case when trim(matched_entity_ids) = '' then 0 else len(string_split(matched_entity_ids, ',')) end as match_count from gt),
jac as (select s1_id, cand_id, case when len(list_distinct(list_concat(x, y))) = 0 then 1.0 else len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) end as score from
  (select p.*, list_filter(string_split(a.name_clean, ' '), lambda t: t <> '') as x, list_filter(string_split(b.name_clean, ' '), lambda t: t <> '') as y
   from pairs p join s1 a on a.entity_id = p.s1_id join others b on b.entity_id = p.cand_id)),
per as (select entity_id as s1_id, count(cand_id) as n from s1 left join pairs on s1_id = entity_id group by 1)
"""


def _sets(a: str, b: str, f: str) -> str:
    x, y = (f"list_distinct({f.format(c)})" for c in (a, b))
    return x, y, f"len(list_intersect({x}, {y}))", f"len(list_distinct(list_concat({x}, {y})))"


def native_features() -> str:
    toks, digits = "list_filter(string_split({}, ' '), lambda t: t <> '')", "regexp_extract_all({}, '[0-9]+')"
    out = []
    for side, a, b in (("name", "an", "bn"), ("addr", "aa", "ba")):
        x, y, both, either = _sets(a, b, toks)
        _, _, dboth, deither = _sets(a, b, digits)
        most = f"greatest(length({a}), length({b}))"
        out += [
            f"({a} <> '' and {a} = {b})::int::double as {side}_exact", f"round(case when {most} = 0 then 1.0 else 1 - levenshtein({a}, {b}) / {most} end, 6) as {side}_lev",
            f"round(case when {either} = 0 then 1.0 else {both} / {either} end, 6) as {side}_jaccard", f"round(case when len({x}) = 0 then (len({y}) = 0)::int::double else {both} / len({x}) end, 6) as {side}_containment",
            f"{both}::double as {side}_shared_tokens", f"abs(length({a}) - length({b}))::double as {side}_len_diff",
            f"round(least(length({a}), length({b})) / greatest({most}, 1), 6) as {side}_len_ratio", f"round(case when {deither} = 0 then 1.0 else {dboth} / {deither} end, 6) as {side}_digit_jaccard",
        ]
    for i, k in ((1, "first"), (-1, "last")):
        out.append(f"coalesce(({toks.format('an')}[{i}] <> '' and {toks.format('an')}[{i}] = {toks.format('bn')}[{i}])::int, 0)::double as name_{k}_token_match")
    out.append("(an <> '' and substr(an, 1, 4) = substr(bn, 1, 4))::int::double as name_prefix4_match")
    for k, p in (("housenum", r"\b([0-9]+[a-zA-Z]?)\b"), ("pin", r"\b([0-9]{5,6})\b")):
        a, b = (f"lower(regexp_extract({c}, '{p}', 1))" for c in ("aa", "ba"))
        out.append(f"({a} <> '' and {a} = {b})::int::double as addr_{k}_match")
    out += ["(ac <> '' and ac = bc)::int::double as country_exact", "(ac <> '' and bc <> '' and ac <> bc)::int::double as country_conflict", "(ac <> '' and bc <> '')::int::double as country_both_present", "(ac = '')::int::double as country_s1_missing", "(bc = '')::int::double as country_cand_missing", "starts_with(cand_id, 'S2-')::int::double as cand_is_s2", "starts_with(cand_id, 'S3-')::int::double as cand_is_s3", "(count(*) over (partition by s1_id))::double as n_candidates_for_s1"]
    return ", ".join(out)


_F = "case when pr + re > 0 then 1.25 * pr * re / (0.25 * pr + re + 1e-12) else 0 end"


def _f05(entities: str, pred: str, by: str = "") -> str:
    on = f"and q.{by} = e.{by}" if by else ""
    group, first = (f"group by {by}", f"{by} / 100.0 as threshold, ") if by else ("", "")
    return f"""select {first}round(avg({_F}), 6) as macro_f05, round(avg(pr), 6) as macro_precision, round(avg(re), 6) as macro_recall, count(*) as n_entities from (
  select e.*, case when coalesce(np, 0) > 0 then tp / np else 0 end as pr, case when coalesce(nt, 0) > 0 then coalesce(tp, 0) / nt else 0 end as re from ({entities}) e
  left join (select {by + ',' if by else ''} p.s1_id, count(*) as np, count(t.cand_id) as tp from ({pred}) p left join truth t using (s1_id, cand_id) group by all) q on q.s1_id = e.s1_id {on}
  left join (select s1_id, count(*) as nt from truth group by 1) n on n.s1_id = e.s1_id) {group}"""


def _ratio(a: str, b: str) -> str:
    """200 times the longest common subsequence over both lengths, 100 for two empty texts; a of 126 characters at most. The subsequence's length: a bit a character of a, a step a character of b."""
    masks = f"list_transform(string_split({b}, ''), lambda c: list_sum(list_transform(range(length({a})), lambda i: case when substr({a}, i::bigint + 1, 1) = c then 1::hugeint << i::int else 0::hugeint end))::hugeint)"
    full = f"((1::hugeint << length({a})::int) - 1)"
    v = f"list_reduce(list_concat([{full}], {masks}), lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full})"
    lcs = f"case when {a} = '' or {b} = '' then 0 else length({a}) - bit_count({v}) end"
    return f"case when {a} = '' and {b} = '' then 100.0::double else 200.0::double * ({lcs}) / (length({a}) + length({b})) end"


def _sorted(c: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split({c}, ' '), lambda t: t <> '')), ' ')"


def _sides(pairs: str) -> str:
    return f", sides as (select p.s1_id, p.cand_id, a.name_clean as an, a.address_clean as aa, b.name_clean as bn, b.address_clean as ba from ({pairs}) p join s1 a on a.entity_id = s1_id join others b on b.entity_id = cand_id)"


def _ranked(pairs: str) -> str:
    part = lambda a, b: f"case when {a} = '' or {b} = '' then 0.0::double else {_ratio(a, b)} end"
    return base(PARTS, scalar=True) + _sides(pairs) + f", names as (select an, bn, {part('an', 'bn')} as r from (select distinct an, bn from sides)), streets as (select aa, ba, {part('aa', 'ba')} as r from (select distinct aa, ba from sides)), scored as (select s1_id, cand_id, 0.7::double * n.r + 0.3::double * t.r as score from sides join names n using (an, bn) join streets t using (aa, ba)), ranked as (select s1_id, cand_id, row_number() over (partition by s1_id order by score desc, cand_id desc)::int as rn, score, score >= 50 as matched from scored qualify rn <= 5) "


B, BP = base(), base(phonetic=False)
_ALL = "select s1_id, cand_id from hit where cand_id <> s1_id"
_SUB = "sub as (select s.entity_id as s1_id, coalesce(string_agg(j.cand_id, ',' order by j.cand_id), '') as matched from s1 s left join jac j on j.s1_id = s.entity_id and j.score >= 0.5 group by 1)"

ORACLES = {
    "scan_entities": B + "select * from ent",
    "gt_match_count": B + "select source1_entity_id, match_count from counts",
    "parse_candidates": B + ", cells as (select s1_id, string_agg(cand_id, ',' order by cand_id) as c from pairs group by 1) select s1_id as source1_entity_id, (unnest(range(len(string_split(c, ',')))))::int as pos, unnest(string_split(c, ',')) as cand_id from cells",
    "normalize_entities": B + "select entity_id, name_clean, address_clean, country_clean from norm",
    "normalize_scalar": base(scalar=True) + "select entity_id, name_clean, address_clean, country_clean from norm",
    "normalize_parts": base(PARTS) + "select entity_id, name_clean, address_clean, country_clean from norm",
    "blocking_keys": BP + "select entity_id, ord, key from keys",
    "blocking_keys_phonetic": B + "select entity_id, ord, key from keys",
    "blocking_keys_weak": base(WEAK) + "select entity_id, ord, key from keys",
    "inverted_index": B + "select key, cand_id from idx",
    "inverted_index_hot": base(CUSTOMERS) + "select key, cand_id from idx",
    "index_size": B + "select count(distinct key) as n_keys from keys where src_ord > 0",
    "candidate_pairs": B + "select * from pairs",
    "candidate_pairs_hot": base(CUSTOMERS) + "select * from pairs",
    "candidate_pairs_weak": base(WEAK) + "select * from pairs",
    "candidate_stats": B + "select count(*) as entities, sum(n)::bigint as total, round(avg(n), 6) as average, max(n) as most, count(*) filter (n = 0) as without, round(100 * count(*) filter (n = 0) / count(*), 6) as without_pct, (12 * sum(n) + 20 * count(*))::bigint as bytes from per",
    "candidate_file": B + "select entity_id as s1_id, coalesce(string_agg(cand_id, ',' order by cand_id), '') as candidates from s1 left join pairs on s1_id = entity_id group by 1",
    "gt_explode": B + "select * from truth",
    "gt_semi": B + "select g.* from gt g where source1_entity_id in (select s1_id from pairs)",
    "label_pairs": B + "select p.*, (t.s1_id is not null)::int as label from pairs p left join truth t using (s1_id, cand_id)",
    "sample_pairs": B + ", lab as (select p.*, (t.s1_id is not null)::int as label from pairs p left join truth t using (s1_id, cand_id)) select s1_id, cand_id, label from (select *, sum(label) over (partition by s1_id) as pos, row_number() over (partition by s1_id, label order by md5('42' || s1_id || cand_id), cand_id) as rn from lab) where pos > 0 and (label = 1 or rn <= 5 * pos)",
    "group_split": B + "select s1_id, cand_id, ('0x' || substr(md5(s1_id || '42'), 1, 8))::bigint % 100 < 20 as is_val from pairs",
    "pair_features_native": base(PARTS) + f", both_sides as (select p.*, a.name_clean as an, a.address_clean as aa, a.country_clean as ac, b.name_clean as bn, b.address_clean as ba, b.country_clean as bc from pairs p join s1 a on a.entity_id = s1_id join others b on b.entity_id = cand_id) select s1_id, cand_id, {native_features()} from both_sides",
    "block_and_rank_native": base(PARTS) + "select s1_id, cand_id, rn::int as rn, round(score, 6) as score from (select *, row_number() over (partition by s1_id order by score desc, cand_id desc) as rn from jac) where rn <= 5",
    "rank_score": _ranked("select * from pairs") + "select s1_id, cand_id, round(score, 6) as score from scored",
    "topk_rank": _ranked("select * from pairs") + "select s1_id, cand_id, rn, round(score, 6) as score, matched from ranked",
    "block_and_rank": _ranked(_ALL) + "select s1_id, cand_id, round(score, 6) as score, rn, matched from ranked",
    "rank_summary": _ranked(_ALL) + "select entity_id as s1_id, coalesce(string_agg(cand_id, ',' order by rn) filter (matched), '') as matched, coalesce(string_agg(cand_id, ',' order by rn), '') as candidates from s1 left join ranked on s1_id = entity_id group by 1",
    "pair_ratios": base(PARTS) + _sides("select * from pairs") + "select s1_id, cand_id, " + ", ".join(f"round(({_ratio(*(f(c) for c in x))}) / 100, 6) as {k}_{n}" for k, x in (("name", ("an", "bn")), ("addr", ("aa", "ba"))) for n, f in (("ratio", str), ("token_sort", _sorted))) + " from sides",
    "recall_ceiling": B + "select count(p.cand_id) as hits, count(*) as total, round(case when count(*) > 0 then count(p.cand_id) / count(*) else 0 end, 6) as recall_ceiling from truth t left join pairs p using (s1_id, cand_id)",
    "full_evaluation": B + f", f as ({_f05('select entity_id as s1_id from s1', 'select * from jac where score >= 0.5')}) select f.*, (select round(count(p.cand_id) / count(*), 6) from truth t left join pairs p using (s1_id, cand_id)) as blocking_recall_ceiling, 0.5::double as threshold from f",
    "label_counts": B + "select count(t.s1_id) as positive, count(*) - count(t.s1_id) as negative, round(count(t.s1_id) / count(*), 6) as positive_rate from pairs p left join truth t using (s1_id, cand_id)",
    "prediction_counts": B + f", {_SUB}, n as (select case when matched = '' then 0 else len(string_split(matched, ',')) end as n from sub) select count(*) filter (n > 0) as entities_with_match, sum(n)::bigint as links from n",
    "candidate_lookup": B + ", others2 as (select entity_id, country, src_ord, row_ord, 0 as again from ent where src_ord > 0 union all select 'S2-' || lpad((row_ord - 1)::varchar, 9, '0'), 'again', src_ord, row_ord, 1 from ent where src_ord = 2 and row_ord % 5 = 0) select entity_id, country, src_ord, row_ord from others2 qualify row_number() over (partition by entity_id order by src_ord desc, row_ord desc, again desc) = 1",
    "normalize_country": "select 'S' || (doc_id % 3 + 1) || '-' || lpad(doc_id::varchar, 9, '0') as entity_id, lower(trim(coalesce(lang, ''))) as country_clean from documents",
    "normalize_vectorized": f"select doc_id, {clean('t', ADDRESS_WORDS)} as clean from (select doc_id, coalesce(text, '') as t from documents)",
    "eda_shape": B + "select src_ord, count(*) as n_rows from ent group by 1",
    "eda_country_counts": B + "select src_ord, country, count(*) as n from ent group by 1, 2",
    "eda_country_nunique": B + "select src_ord, count(distinct country) as n from ent group by 1",
    "eda_match_buckets": B + "select case when match_count = 0 then '0' when match_count = 1 then '1' else '2+' end as bucket, count(*) as n, round(100 * count(*) / sum(count(*)) over (), 6) as pct from counts group by 1",
    "eda_match_breakdown": B + "select match_count, count(*) as n from counts where match_count >= 2 group by 1",
    "blocking_recall": B + "select count(*) as true_pairs, count(p.cand_id) as found_pairs, count(distinct t.s1_id) as true_entities, count(distinct p.s1_id) as found_entities, round(count(p.cand_id) / count(*), 6) as blocking_recall, round(count(distinct p.s1_id) / count(distinct t.s1_id), 6) as entity_recall from truth t left join pairs p using (s1_id, cand_id)",
    "macro_f05": B + _f05("select entity_id as s1_id from s1", "select * from jac where score >= 0.5"),
    "threshold_sweep": B + _f05("select entity_id as s1_id, unnest(range(50, 100)) as step from s1", "select s1_id, cand_id, unnest(range(50, least(floor(score * 100 + 1e-9)::int, 99) + 1)) as step from jac where score >= 0.5", "step"),
    "submission_stats": B + f", {_SUB}, n as (select case when matched = '' then 0 else len(string_split(matched, ',')) end as n from sub) select count(*) filter (n = 0) as none, count(*) filter (n = 1) as one, count(*) filter (n > 1) as more, round(avg(n), 6) as average from n",
    "complete_submission": B + f", {_SUB} select s1_id, matched from sub",
    "validate_submission": B + f", {_SUB}, faulty as (select s1_id, case when s1_id like '%7' then 'NaN' when s1_id like '%8' then matched || ',S1-000000000' else matched end as matched from sub), ids as (select s1_id, unnest(string_split(matched, ',')) as id from faulty where trim(matched) <> '') select distinct rule, s1_id, detail from (select 'V9 blank' as rule, s1_id, matched as detail from faulty where matched = 'NaN' union all select 'V11 invalid id', s1_id, id from ids where id not in (select entity_id from others) union all select 'V11 own source', s1_id, id from ids where id like 'S1-%' union all select 'V12 not a candidate', s1_id, id from ids where (s1_id, id) not in (select s1_id, cand_id from pairs))",
    "union_sources": B + "select entity_id, src_ord from ent where src_ord > 0",
    "dedupe_last": "select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn = 1",
}
