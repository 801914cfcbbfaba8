"""SQL twins (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

import re

from agrospark.llm import chat, quality, url_filter
from agrospark.llm.common import BREAKS

_WORDS = rf"list_filter(string_split_regex(t, '[{BREAKS}]+'), lambda x: x <> '')"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _less(pattern: str) -> str:
    return f"length(t) - length(regexp_replace(t, {_literal(pattern)}, '', 'g'))"


def quality_sql(max_class: float = 0.28, max_common: float = 0.5, min_class: int = 50, min_common: int = 100,
                reach: float = quality.REACH, floor: float = quality.LEAST_COMMON) -> str:
    classes = [_less(p) for p in quality.CLASSES.values()]
    bins = " ".join(f"when '{k}' then [{', '.join(map(_literal, v.split()))}]" for k, v in quality.COMMON.items())

    def distance(counts: str, ref: str) -> str:
        p, q = f"({counts}[i] / list_sum({counts}))", f"{ref}[i]"
        part = lambda x, y: f"case when {x} > 0 then {x} * log2({x} / (({x} + {y}) / 2)) else 0 end"
        return (f"case when list_sum({counts}) > 0 then sqrt(greatest(0, list_sum([{part(p, q)} + {part(q, p)} "
                f"for i in range(1, len({counts}) + 1)]) / 2)) end")

    return rf"""
with d as (select doc_id, lang, coalesce(text, '') as t from documents),
 w as (select *, {_WORDS} as ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{BREAKS}]')) as ls,
  case lang {bins} end as bins from d),
 g as (select doc_id, i, count(*) over (partition by doc_id, ws[i:i + 4]) as c from w, unnest(range(1, len(ws) - 3)) u(i)),
 r as (select doc_id, count(distinct i + k) as n from g, unnest([0, 1, 2, 3, 4]) u(k) where c > 1 group by doc_id),
 m as (select doc_id, lang, len(ws) as n_words, length(regexp_replace(t, '[{BREAKS}]+', '', 'g')) as word_chars, {_less("[#*$%&|<>]+")} as n_symbols,
  len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words, length(t) as n_chars,
  [{", ".join(classes)}] as cs, list_transform(bins, lambda b: len(list_filter(ws, lambda x: x = b))) as bs from w left join r using (doc_id)),
 h as (select * replace (list_append(cs, n_chars - list_sum(cs))::double[] as cs, list_append(bs, n_words - list_sum(bs))::double[] as bs) from m),
 s as (select lang, {", ".join(f"sum(cs[{i}]) as c{i}" for i in range(1, len(classes) + 2))},
  {", ".join(f"sum(bs[{i}]) as b{i}" for i in range(1, 22))} from h group by lang),
 f as (select lang as l, list_transform([{", ".join(f"c{i}" for i in range(1, len(classes) + 2))}], lambda x: x / ({" + ".join(f"c{i}" for i in range(1, len(classes) + 2))})) as rc,
  list_transform([{", ".join(f"b{i}" for i in range(1, 22))}], lambda x: x / ({" + ".join(f"b{i}" for i in range(1, 22))})) as rb from s),
 j as (select *, {distance("cs", "rc")} as jc, case when bs is not null then {distance("bs", "rb")} end as jb,
  least({max_common}, greatest({floor}, {reach} * {distance("no", "rb")})) as lim, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed
  from (select *, list_append(list_transform(range(20), lambda x: 0.0), 1.0) as no from h) h left join f on lang is not distinct from l)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed
 and not coalesce(n_words >= {min_class} and jc > {max_class}, false) and not coalesce(n_words >= {min_common} and jb > lim, false) as kept,
 round(jc, 4) as js_classes, round(jb, 4) as js_common from j"""


def minhash_sql(size: int = 3, percent: int = 85) -> str:
    """All pairs that share a shingle; meant for the small tables."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    shingle = " || ' ' || ".join(f"ws[i + {k}]" for k in range(size))
    return f"""
with recursive d as (select doc_id, translate(coalesce(text, ''), '{upper}', '{lower}') as t from documents),
 w as (select doc_id, {_WORDS} as ws from d),
 s as (select doc_id, case when len(ws) = 0 then [] when len(ws) < {size} then [array_to_string(ws, ' ')]
  else list_distinct([{shingle} for i in range(1, len(ws) - {size - 2})]) end as sh from w),
 e as (select doc_id, len(sh) as n, unnest(sh) as x from s),
 p as (select a.doc_id as x, b.doc_id as y, count(*) as c, any_value(a.n) as nx, any_value(b.n) as ny from e a
  join e b on a.x = b.x and a.doc_id < b.doc_id group by 1, 2),
 l as (select x, y from p where 100 * c >= {percent} * (nx + ny - c)),
 b as (select x, y from l union all select y, x from l),
 r as (select doc_id as x, doc_id as y from s union select r.x, b.y from r join b on r.y = b.x),
 k as (select x, min(y) as component_id from r group by x)
select doc_id, len(sh) as n_shingles, component_id, doc_id = component_id as kept from s join k on k.x = s.doc_id"""


def chat_sql() -> str:
    def escaped(column: str, role: bool = False) -> str:
        out = f"replace({column}, '\\', '\\\\')"
        if role:
            out = f"replace({out}, chr(10), '\\n')"
        for c in chat.CONTROLS:
            out = f"replace({out}, '{c}', '{c[0]}\\;{c[1:]}')"
        return out

    said, order = "</s>[INST] ok [/INST]", "order by turn, role, text"
    learned = f"role = '{chat.LEARNED}'"
    return f"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{said}' union all select -1, 1, 'assistant', '{said}')
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {order})) as turns_sha256,
 coalesce(sum(length(text)) filter ({learned}), 0)::bigint as loss_chars,
 sha256(coalesce(string_agg(text, '' {order}) filter ({learned}), '')) as loss_sha256,
 sum(length({escaped("role", role=True)}) + length({escaped("text")}) + {len(chat.HEAD) + 1 + len(chat.TAIL)})::bigint as formatted_chars
from c group by conv_id"""


def collocations_sql(least: int = 30, first: int = 2000, share: int = 80) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
with p as (select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) as t
  from documents),
 w as (select lang, list_filter(string_split_regex(t, '[\x20\x09]+'), lambda x: x <> '') as ws from p),
 o as (select lang, k, unnest([array_to_string(ws[i:i + k - 1], ' ') for i in range(1, len(ws) - k + 2)]) as phrase from w, unnest([1, 2, 3, 4]) u(k)),
 f as materialized (select lang, k, phrase, count(*) as a from o group by all),
 n as (select lang, sum(a)::bigint as n from f where k = 1 group by lang),
 c as materialized (select lang, k, phrase, a, string_split(phrase, ' ') as ph from f where k >= 2 and a >= {least}),
 d as (select lang, array_to_string(ph[i:i + m - 1], ' ') as phrase, max(a) as b from c, unnest([2, 3]) u(m), unnest([1, 2, 3]) v(i)
  where m < k and i + m - 1 <= k group by all),
 e as materialized (select *, array_to_string(ph[1:cut], ' ') as head, array_to_string(ph[cut + 1:k], ' ') as tail from c, unnest([1, 2, 3]) u(cut) where cut < k),
 s as (select e.lang, e.phrase, e.a, l.a as l, r.a as r, cut, 2000000::hugeint * e.a // (l.a + r.a) as score
  from e join f l on l.lang = e.lang and l.phrase = e.head join f r on r.lang = e.lang and r.phrase = e.tail),
 b as (select * from s qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
 x as (select b.lang, b.phrase, a, l, r, score::bigint as score, cut::int as cut from b
  left join d on d.lang = b.lang and d.phrase = b.phrase where d.b is null or 100::hugeint * d.b < {share}::hugeint * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score, cut from x join n using (lang)
qualify rank <= {first}"""


def merkle_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    polynomial = 0xEDB88320

    def part(value: str) -> str:
        return f"case when {value} is null then '-' else octet_length(encode({value}))::varchar || ':' || {value} end"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(part, ("doc_id::varchar", "source", "lang", "n_chars::varchar", text))) + ")"

    def tree(name: str, nodes: str, keys: str) -> str:
        """Nodes of all levels: keys, level, i, d (the digest), n (nodes of the level)."""
        return f"""{name} as (select {keys}, 0 as level, i, d, n from {nodes} union all
  select {keys}, level + 1, i // 8, sha256(string_agg(d, '' order by i)), (n + 7) // 8 from {name} where n > 1 group by {keys}, level, i // 8, n)"""

    # A checksum of decimal digits, eight steps a byte.
    steps = f"list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, _: xor(x >> 1, {polynomial} * (x & 1)))"
    crc = ("xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda s: ord(s)::bigint)), "
           f"lambda a, b: {steps.replace('[c,', '[xor(a, b),')}))")
    folded = "sha256(string_agg(case when s.i = f.i then f.d else s.d end, '' order by s.i))"
    return f"""
with recursive l as (select row_number() over () as row, doc_id, coalesce('=' || lang, '') as g, {leaf("text")} as d, case when {crc} % 3 = 0 then
   {leaf(f"translate(text, '{upper}', '{lower}')")} else {leaf("text")} end as claimed from documents),
 t as (select *, row_number() over (partition by g order by doc_id nulls first, d, claimed) - 1 as i, count(*) over (partition by g) as n from l),
 {tree("a", "t", "g")},
 top as (select g, d, row_number() over (order by g) - 1 as i, count(*) over () as n, 0 as one from a where n = 1),
 {tree("b", "top", "one")},
 w as (select row, g, 0 as level, i, claimed as d, n, '' as proof from t union all
  select f.row, f.g, f.level + 1, f.i // 8, {folded}, (f.n + 7) // 8, f.proof || coalesce(string_agg(s.d, '' order by s.i) filter (s.i <> f.i), '')
  from w f join a s on s.g = f.g and s.level = f.level and s.i // 8 = f.i // 8 where f.n > 1 group by f.row, f.g, f.level, f.i, f.n, f.proof, f.d),
 v as (select w.row, 0 as level, top.i, w.d, top.n, w.proof from w join top on top.g = w.g where w.n = 1 union all
  select f.row, f.level + 1, f.i // 8, {folded}, (f.n + 7) // 8, f.proof || coalesce(string_agg(s.d, '' order by s.i) filter (s.i <> f.i), '')
  from v f join b s on s.level = f.level and s.i // 8 = f.i // 8 where f.n > 1 group by f.row, f.level, f.i, f.n, f.proof, f.d)
select t.doc_id, t.d as leaf, top.d as subroot, b.d as root, sha256(v.proof) as proof_sha256, v.d as folded_root, v.d = b.d as verified
from t join v on v.row = t.row and v.n = 1 join top on top.g = t.g join b on b.n = 1"""


def url_sql() -> str:
    ranked = sorted(url_filter.RULES, key=lambda r: -len(r.name))
    rule = " ".join(f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') then '{r.name}'" for r in ranked)
    verdict = " ".join(f"when '{r.name}' then '{r.verdict}'" for r in ranked)

    def regex(glob: str) -> str:
        out = "".join(f"[{re.escape(p[1:-1])}]" if p[0] == "[" else {"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}.get(p) or re.escape(p)
                      for p in re.findall(r"\[[^\]]+\]|\*\*|.", glob))
        return "'^" + out + "$'"

    globs = " ".join(f"when regexp_matches('.' || host || path, {regex(g)}) then '{g}'" for g in url_filter.GLOBS)
    return rf"""
with r as (select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
 h as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from r),
 j as (select *, case {rule} end as rule, case {globs} end as "glob" from h)
select page_id, host, path, rule, case rule {verdict} else case when "glob" is null then 'allow' else 'block' end end as verdict, "glob" from j"""


SQL = {
    "op7_quality": quality_sql(), "op9_minhash": minhash_sql(), "op10_chat": chat_sql(),
    "op11_collocations": collocations_sql(), "op12_merkle": merkle_sql(), "op13_url_filter": url_sql(),
}
