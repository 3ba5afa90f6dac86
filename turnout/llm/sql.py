"""What SQL can say of the operators' results, in DuckDB's dialect."""

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

JACCARD_JOIN = rf"""
with recursive w as (select doc_id, {_WORDS.format(text='''translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')''')} as ws from documents),
s as (select distinct doc_id, s from (select doc_id, unnest(case
  when len(ws) >= 5 then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
  when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as s from w)),
n as (select doc_id, count(*) as n from s group by doc_id),
both_have as (select a.doc_id as a, b.doc_id as b, count(*) as k
  from s a join s b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from both_have join n na on a = na.doc_id join n nb on b = nb.doc_id
  where 100 * k >= 75 * (na.n + nb.n - k)),
sides as (select a, b from links union all select b, a from links),
reach as (select doc_id as node, doc_id as start from w
  union select b, start from reach join sides on a = node)
select node as doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(start) as component_id
from reach left join n on n.doc_id = node group by node
"""

SUBSTRING_DEDUP = rf"""
with w as (select doc_id, {_WORDS.format(text="coalesce(text, '')")} as ws from documents),
windows as (select doc_id, i, array_to_string(ws[i:i + 49], ' ') as k from
  (select doc_id, ws, unnest(range(1, len(ws) - 48)) as i from w where len(ws) >= 50)),
firsts as (select k, min(doc_id) as first from windows group by k),
gone as (select distinct doc_id, unnest(range(i, i + 50)) as p
  from windows join firsts using (k) where first < doc_id),
places as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as p from w),
kept as (select doc_id, string_agg(word, ' ' order by p) as text, count(*) as n
  from places anti join gone using (doc_id, p) group by doc_id)
select doc_id, len(ws) as n_words, len(ws) - coalesce(n, 0) as n_removed,
  sha256(coalesce(text, '')) as kept_sha256
from w left join kept using (doc_id)
"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

LEXICAL_SEARCH = rf"""
with d as (select doc_id, {_TERMS} as ws from documents),
n as (select doc_id, len(ws) as n from d where len(ws) > 0),
held as (select doc_id, term, count(*) as tf
  from (select doc_id, unnest(ws) as term from d) group by all),
asked as (select item_id, term, count(*) as r
  from (select item_id, unnest({_TERMS}) as term from benchmark) group by all),
c as (select count(*)::bigint as n_docs, sum(n)::bigint as n_terms from n),
w as (select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from held, c where term in (select term from asked) group by term, n_docs),
m as (select doc_id, 25 + (75 * n * n_docs) // n_terms as m from n, c),
s as (select item_id, doc_id,
    sum(r * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
  from asked join w using (term) join held using (term) join m using (doc_id) group by all),
ranked as (select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank,
  doc_id, score from s where score > 0)
select * from ranked where rank <= 10
"""

_CRC32 = """xor(4294967295::bigint, list_reduce(
  list_concat([4294967295::bigint], list_transform(string_split({text}, ''), lambda s: ascii(s)::bigint)),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
    lambda x, i: case when x % 2 = 1 then xor(x // 2, 3988292384::bigint) else x // 2 end)))"""

PREFIX_TRIE = rf"""
with own as (select conv_id, row_number() over (partition by conv_id order by turn nulls first) as d,
  struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) as turn from conversations),
c as (select conv_id, count(*) as n, conv_id - conv_id % 20 as base,
  {_CRC32.format(text="conv_id::varchar")} % 4 as h from conversations group by conv_id),
taken as (select c.*, least(c.h, coalesce(b.n, 0)) as k from c left join c b on b.conv_id = c.base),
grown as (select taken.conv_id, d, turn from taken join own on own.conv_id = base and d <= k
  union all select conv_id, k + d - h, turn from taken join own using (conv_id) where d > h),
keyed as (select conv_id, d, turn,
  list(turn) over (partition by conv_id order by d rows unbounded preceding) as key from grown),
nodes as (select min(conv_id) as conv_id, d as depth, key, count(*) as n_convs,
    len({_WORDS.format(text="any_value(turn.t)")}) as words from keyed group by d, key
  union all select min(conv_id), 0, [], count(*), 0 from c having count(*) > 0),
paths as (select k.conv_id, d, n.conv_id as node from keyed k join nodes n on n.depth = d and n.key = k.key
  union all select conv_id, 0, (select min(conv_id) from c) from c),
linked as (select n.conv_id, depth, p.node as parent_conv_id, n_convs, (n_convs - 1) * words as saved
  from nodes n left join paths p on p.conv_id = n.conv_id and p.d = depth - 1),
children as (select parent_conv_id, depth - 1 as depth, count(*) as n_children
  from linked where depth > 0 group by all),
counted as (select l.*, coalesce(n_children, 0) as n_children from linked l left join children x
  on x.parent_conv_id = l.conv_id and x.depth = l.depth),
subtrees as (select p.node as conv_id, p.d as depth, sum((n_children = 0)::bigint)::bigint as n_leaves,
  sum(saved)::bigint as saved_tokens
  from counted u join paths p on p.conv_id = u.conv_id and p.d <= u.depth group by all),
last as (select conv_id, max(d) as d from paths group by conv_id),
ends as (select p.node as conv_id, p.d as depth,
  sha256(string_agg(p.conv_id::varchar, ',' order by p.conv_id)) as ends_sha256
  from paths p join last using (conv_id, d) group by all)
select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
  coalesce(ends_sha256, sha256('')) as ends_sha256
from counted join subtrees using (conv_id, depth) left join ends using (conv_id, depth)
"""
