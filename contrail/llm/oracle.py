"""SQL (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from contrail.llm import decontaminate, embedding_dedup, prefix_trie, quality_rules, ranked_search
from contrail.llm.queries import MIX_SEED, MIX_SHARE, MIX_WEIGHTS

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op6() -> str:
    n = decontaminate.WINDOW
    words = (f"list_filter(regexp_split_to_array({_LOWER}, "
             r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
    return rf"""
with d as (select doc_id, {words} as w from documents),
b as (select cast(item_id as varchar) as item, {words} as w from benchmark),
win as (select distinct item, array_to_string(w[i:i + least({n}, len(w)) - 1], ' ') as win,
               least({n}, len(w)) as m
        from (select item, w, unnest(range(1, greatest(len(w) - {n}, 0) + 2)) as i from b where len(w) > 0)),
sizes as (select distinct m from win),
place as (select doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') as win
       from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from d, sizes where len(w) >= m)),
hit as (select distinct doc_id, i, m, win from place where win in (select win from win)),
pos as (select doc_id, count(distinct i + k) as n_hit
        from (select doc_id, i, unnest(range(0, m)) as k from hit) group by doc_id),
items as (select doc_id, count(distinct item) as n_items,
                 sha256(string_agg(item, ',' order by item)) as items_sha256
          from (select distinct doc_id, item from hit join win using (win)) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, coalesce(items_sha256, sha256('')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join pos using (doc_id) left join items using (doc_id)
"""


def op8() -> str:
    rules = list(quality_rules.RULES.items())
    share = quality_rules.MAX_FALSE_REJECTION / len(rules)
    alpha = 1 - quality_rules.CONFIDENCE
    cutoffs = ", ".join(map(str, quality_rules.CUTOFFS))
    values = " union all ".join(
        f"select doc_id, stratum, base_failed, '{r}' as rule, "
        f"case when {d} > 0 then {c} * 1000 // {d} else 0 end as value from m"
        for r, (c, d) in rules)
    trials = values.replace("select doc_id, stratum, base_failed,", "select stratum, quality,").replace(
        " from m", " from once")
    return rf"""
with t as (select doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x09-\x0D\x20]+'), lambda x: x <> '') as w,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda x: regexp_matches(x, '[^\x09-\x0D\x20]')) as l
           from documents),
g as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as win
      from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from t where len(w) >= 3)),
r as (select doc_id, count(distinct i + k) as n
      from (select doc_id, i, unnest(range(0, 3)) as k
            from g join (select doc_id, win from g group by all having count(*) > 1) using (doc_id, win))
      group by doc_id),
m as (select doc_id, stratum, md5(text) as th, cast(len(w) as bigint) as n_words,
             cast(length(array_to_string(w, '')) as bigint) as word_chars,
             cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
             cast(length(regexp_replace(text, '[^!]', '', 'g')) as bigint) as n_exclamations,
             cast(length(regexp_replace(text, '\P{{Lu}}', '', 'g')) as bigint) as n_capitals,
             len(l) as n_lines, cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
             coalesce(r.n, 0) as n_repeat_words,
             len(w) < 50 or 100 * coalesce(r.n, 0) > 50 * len(w) as base_failed
      from t left join r using (doc_id)),
v as ({values}),
k as (select doc_id, min(quality) as quality from labels where quality is not null group by doc_id),
once as (select * replace (min(quality) over (partition by stratum, th) as quality)
         from (select * from m join k using (doc_id) where not base_failed
               qualify row_number() over (partition by doc_id order by th, stratum) = 1)
         qualify row_number() over (partition by stratum, th order by doc_id) = 1),
h as ({trials}),
tests as (select count(distinct stratum) * {len(rules)} * {len(quality_rules.CUTOFFS)} as n_tests from h),
tot as (select stratum, rule, cast(sum(cast(quality = 1 as int)) as double) as n from h group by all),
c as (select stratum, rule, cutoff, sum(cast(quality = 1 as int)) as g, sum(cast(quality = 0 as int)) as b
      from h, (select unnest([{cutoffs}]) as cutoff) where value > cutoff group by all),
ok as (select stratum, rule, cutoff, b - g as gain from c join tot using (stratum, rule), tests
       where b > g and g < n * {share}
         and list_sum(list_transform(range(0, cast(g as bigint) + 1), lambda j:
               exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
                   + j * ln({share}) + (n - j) * ln(1 - {share})))) <= {alpha} / n_tests),
best as (select stratum, rule, cutoff from ok
         qualify row_number() over (partition by stratum, rule order by gain desc, cutoff desc) = 1),
bad as (select distinct doc_id from v join best using (stratum, rule) where value > cutoff)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and doc_id not in (select doc_id from bad) as kept
from m
"""


def op2() -> str:
    levels = ("domain", "lang", "source")
    a, b = MIX_SHARE

    def weight(level: str) -> str:
        whens = " ".join(f"when '{k}' then {v}" for k, v in MIX_WEIGHTS.get(level, {}).items())
        return f"case {level} {whens} else 1 end" if whens else "1"

    steps, parents = [], ""
    shares = "root as (select least(sum(tokens) * 2, sum(tokens) * {0} // {1}) as budget from leaf)".format(a, b)
    steps.append(shares)
    previous = "root"
    for depth, level in enumerate(levels):
        keys = "".join(f"{p}, " for p in levels[:depth])
        part = f"partition by {', '.join(levels[:depth])} " if depth else ""
        on = f"join {previous} using ({', '.join(levels[:depth])})" if depth else f", {previous}"
        prior = f"{part}order by ratio, {level} rows between unbounded preceding and 1 preceding"
        steps.append(f"""
n{depth} as (select {keys}{level}, sum(tokens) * 2 as cap, any_value({weight(level)}) as weight
      from leaf group by {keys}{level}),
p{depth} as (select *, coalesce(sum(cap) over ({prior}), 0) as cb, coalesce(sum(weight) over ({prior}), 0) as wb
      from (select *, cast(cap as double) / weight as ratio, sum(weight) over ({part}) as wa
            from n{depth} {on})),
f{depth} as (select *, cap * (wa - wb) <= (budget - cb) * weight as full_ from p{depth}),
s{depth} as (select *, case when full_ then cap else
        (budget - coalesce(sum(case when full_ then cap end) over ({part}), 0)) * weight
        // sum(case when not full_ then weight end) over ({part}) end as part_ from f{depth}),
b{depth} as (select {keys}{level}, part_ + case when not full_ and
        sum(cast(not full_ as int)) over ({part}order by full_, {level} rows unbounded preceding)
        <= budget - sum(part_) over ({part}) then 1 else 0 end as budget from s{depth})""")
        previous = f"b{depth}"
    return rf"""
with d as (select doc_id, case when source = 'src0' then 'hub' else 'web' end as domain,
                  coalesce(lang, '') as lang, coalesce(source, '') as source,
                  len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x09-\x0D\x20]+'), lambda x: x <> ''))
                  as n_tokens from documents),
leaf as (select domain, lang, source, sum(n_tokens) as tokens from d where n_tokens > 0 group by all),
{', '.join(steps)},
e as (select d.*, tokens, budget, unnest(range(0, 2)) as e from d join leaf using (domain, lang, source)
      join b2 using (domain, lang, source) where n_tokens > 0),
o as (select *, coalesce(sum(n_tokens) over (partition by domain, lang, source, e
             order by md5('{MIX_SEED}:' || (e + 1) || ':' || doc_id), doc_id
             rows between unbounded preceding and 1 preceding), 0) + e * tokens as start from e)
select doc_id, domain, lang, source, cast(e + 1 as int) as epoch, n_tokens,
       cast(least(n_tokens, budget - start) as bigint) as n_taken
from o where start < budget
"""


def op10() -> str:
    # base32: every five hexadecimal digits are four letters
    letters = " || ".join(
        f"'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[1 + ((('0x' || h[{i * 5 + 1}:{i * 5 + 5}])::int >> {s}) & 31)]"
        for i in range(8) for s in (15, 10, 5, 0))
    return f"""
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
m as (select h, max(page_id) as first_id from p group by h)
select page_id, cast(strlen(html) as bigint) as payload_bytes, {letters} as payload_digest,
       case when page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id <> first_id then first_id end as refers_to
from p join m using (h)
"""


def op11() -> str:
    return f"""
with v as (select vec_id, label, cast(embedding as double[]) as x from embeddings
           where label is not null and embedding is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
             and len(list_filter(embedding, lambda x: x <> 0)) > 0),
p as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
        and len(a.x) = len(b.x) and list_cosine_similarity(a.x, b.x) >= {embedding_dedup.THRESHOLD}),
n as (select a, count(*) as n_links from p group by a),
r as (with recursive reach as (select a, b from p union select r.a, p.b from reach r join p on r.b = p.a)
      select a, min(b) as low from reach group by a)
select vec_id, coalesce(n_links, 0) as n_links, least(vec_id, coalesce(low, vec_id)) as component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) as kept
from embeddings left join n on vec_id = n.a left join r on vec_id = r.a
"""


def op12() -> str:
    terms = (f"regexp_extract_all({_LOWER}, "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return rf"""
with d as (select doc_id, {terms} as w from documents),
s as (select count(*) as n_docs, sum(len(w)) as n_terms from d where len(w) > 0),
m as (select doc_id, w, 50 + (50 * len(w) * n_docs) // n_terms as m from d, s where len(w) > 0),
t as (select doc_id, m, term, count(*) as tf from (select doc_id, m, unnest(w) as term from m) group by all),
q as (select distinct item_id, unnest({terms}) as term from benchmark),
f as (select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w
      from t, s where term in (select term from q) group by term, n_docs),
r as (select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
      from q join f using (term) join t using (term) group by item_id, doc_id)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank,
       doc_id, score
from r where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id) <= {ranked_search.TOP}
"""


def op13() -> str:
    # CRC-32 bit by bit over the decimal digits
    crc = ("xor(list_reduce(list_transform(string_split(cast(conv_id as varchar), ''), lambda c: cast(ascii(c) as bigint)), "
           "lambda a, c: list_reduce(range(0, 8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(a, c)), "
           "4294967295), 4294967295)")
    return f"""
with o as (select conv_id, md5(concat(strlen(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as turn_md5,
                  turn, strlen(coalesce(text, '')) as n from conversations where conv_id is not null),
t as (select conv_id, turn_md5, n, row_number() over (partition by conv_id order by turn nulls first, turn_md5) as pos from o),
c as (select conv_id, conv_id - conv_id % {prefix_trie.GROUP} as base, {crc} % {prefix_trie.HEADS} as h
      from (select distinct conv_id from t)),
r as (select c.conv_id, pos, turn_md5, n from c join t on c.base = t.conv_id where pos <= h
      union all select conv_id, pos, turn_md5, n from c join t using (conv_id) where pos > h),
l as (select conv_id, list(turn_md5 order by pos) as k, list(n order by pos) as b from r group by conv_id),
a as (select conv_id, coalesce(k, []) as k, coalesce(b, []) as b from c left join l using (conv_id)),
e as (select conv_id, d, array_to_string(k[1:d], ' ') as node, array_to_string(k[1:d - 1], ' ') as up, len(k) = d as ends,
             case when d > 0 then b[d] else 0 end as n
      from (select *, unnest(range(0, len(k) + 1)) as d from a)),
g as (select node, d, any_value(case when d > 0 then up end) as up, min(conv_id) as conv_id, count(*) as n_convs,
             any_value(n) * (count(*) - 1) as saved,
             sha256(coalesce(string_agg(case when ends then cast(conv_id as varchar) end, ',' order by conv_id), '')) as ends_sha256
      from e group by node, d),
k as (select up, d - 1 as d, count(*) as n_children from g where d > 0 group by up, d),
m as (select g.*, coalesce(n_children, 0) as n_children from g left join k on g.node = k.up and g.d = k.d),
s as (select node, d, sum(leaf) as n_leaves, sum(saved) as saved_tokens
      from (select array_to_string(string_split(node, ' ')[1:x], ' ') as node, x as d,
                   cast(n_children = 0 as bigint) as leaf, saved
            from (select *, unnest(range(0, d + 1)) as x from m)) group by node, d)
select m.conv_id, m.d as depth, u.conv_id as parent_conv_id, m.n_convs, m.n_children,
       cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens, m.ends_sha256
from m join s on m.node = s.node and m.d = s.d left join g u on u.node = m.up and u.d = m.d - 1
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_source_mixture": op2(),
        "op6_benchmark_decontamination": op6(),
        "op8_quality_rules": op8(),
        "op10_warc_zip": op10(),
        "op11_embedding_near_dedup": op11(),
        "op12_ranked_search": op12(),
        "op13_prefix_trie": op13(),
    }
