"""SQL for the operators that SQL can express."""

from __future__ import annotations

#: crc32 of the distinct byte strings in ``items`` (column w): the table of the reflected polynomial, then one step a byte.
CRC = """bits as (
  select i, i::bigint as c, 0 as k from range(256) r(i)
  union all select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8),
tab as (select list(c order by i) as t from bits where k = 8),
crcs as (
  select w, xor(4294967295, list_reduce(
    list_prepend(4294967295::bigint, [('0x' || substr(h, 2 * i - 1, 2))::bigint for i in range(1, 1 + length(h) // 2)]),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) as crc
  from (select distinct w, hex(encode(w)) as h from items), tab)"""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = rf"""with recursive doc_words as (
  select rowid as r, doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from (select row_number() over () as rowid, doc_id, text from documents)),
doc_features as (select r, unnest(words) as w from doc_words),
aim_features as (select unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from benchmark),
items as (select w from doc_features union select w from aim_features),
{CRC},
s as (select crc % 10000 as b, count(*) as s from doc_features join crcs using (w) group by 1),
t as (select crc % 10000 as b, count(*) as t from aim_features join crcs using (w) group by 1),
sizes as (select (select coalesce(sum(s), 0) from s)::double as ss, (select coalesce(sum(t), 0) from t)::double as tt),
gain as (
  select b, floor(1000 * ln((coalesce(t, 0) + 1)::double * (ss + 10000) / ((coalesce(s, 0) + 1)::double * (tt + 10000))))::bigint as g
  from (select range as b from range(10000)) left join s using (b) left join t using (b), sizes),
weights as (
  select r, count(*) as n, sum(g)::bigint as total
  from doc_features join crcs using (w) join gain on b = crc % 10000 group by r),
scored as (
  select doc_id, len(words)::bigint as n_features,
    coalesce((total - ((total % n) + n) % n) // n, 0)::bigint as weight,
    floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::bigint + 0.5::double) / 4294967296)))::bigint as noise
  from doc_words left join weights using (r)),
fit as (
  select *, row_number() over (partition by n_features >= 20 order by weight + noise desc, doc_id) as place,
    count(*) filter (n_features >= 20) over () as fit from scored)
select doc_id, n_features, weight, weight + noise as score,
  case when n_features >= 20 and place <= 10 * fit // 100 then place end as rank from fit"""

#: Near words share what is left when one code point is taken out of one of them or of both.
OP13 = rf"""with recursive runs as (
  select doc_id, w, count(*) as k from (
    select doc_id, unnest(regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as w from documents)
  where length(w) >= 5 group by doc_id, w),
items as (select concat(doc_id, ':', w) as w from runs),
{CRC},
altered as (
  select case when crc % 97 = 0 then left(r.w, crc % length(r.w)) || substr(r.w, crc % length(r.w) + 2) else r.w end as word, k
  from runs r join crcs on crcs.w = concat(doc_id, ':', r.w)),
words as (select word, sum(k)::bigint as n from altered where length(word) >= 5 group by word having sum(k) >= 3),
outs as (select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
pairs as (
  select a.word, a.n, b.word as near, b.n as near_n from outs a join outs b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select a.word, a.n, b.word, b.n from outs a join words b on a.rest = b.word
  union select b.word, b.n, a.word, a.n from outs a join words b on a.rest = b.word),
best as (select word, count(*) as n_near, arg_min(near, (-near_n, near)) as near, max(near_n) as near_n from pairs group by word),
forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when near_n >= 2 * w.n then near end as form, case when near_n >= 2 * w.n then near_n end as form_n
  from words w left join best using (word)),
paths as (
  select word, form as root, 1 as d from forms where form is not null
  union all select p.word, f.form, d + 1 from paths p join forms f on p.root = f.word where f.form is not null),
roots as (select word, arg_max(root, d) as root from paths group by word)
select word, form, coalesce(root, word) as root, n, n_near, form_n from forms left join roots using (word)"""
