"""DuckDB SQL of the operators that SQL can express, written apart from the operators."""

_SPACE = r"[ \t\n\x0b\f\r]+"

#: Words of every text: those of null or blank texts are an empty list.
_WORDS = f"words as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') as w from documents)"

#: (node, component) by reaching along ``links`` (u, v), given in both directions.
_REACH = """reach(node, other) as (
    select u, v from links
    union
    select r.node, l.v from reach r join links l on l.u = r.other
), least as (select node, min(other) as other from reach group by node)"""

NGRAM_JACCARD = f"""
with recursive low as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}'), lambda x: x <> '') as w
    from documents
), sets as (
    select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
    from low
), tokens as (select doc_id, len(s) as n, unnest(s) as token from sets
), pairs as (
    select a.doc_id as u, b.doc_id as v, any_value(a.n) as nu, any_value(b.n) as nv, count(*) as common
    from tokens a join tokens b on a.token = b.token and a.doc_id < b.doc_id group by all
), linked as (select u, v from pairs where 100 * common >= 80 * (nu + nv - common)
), links as (select u, v from linked union all select v, u from linked
), {_REACH}
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, least(s.doc_id, coalesce(l.other, s.doc_id)) as component_id
from sets s left join least l on l.node = s.doc_id
"""

EMBEDDING_DEDUP = f"""
with recursive usable as (
    select vec_id, cast(embedding as double[]) as v from embeddings
    where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
      and len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked as (
    select a.vec_id as u, b.vec_id as v from usable a join usable b on a.vec_id < b.vec_id and len(a.v) = len(b.v)
    where list_cosine_similarity(a.v, b.v) >= 0.95
), links as (select u, v from linked union all select v, u from linked
), counts as (select u, count(*) as n from links group by u
), {_REACH}
select e.vec_id, coalesce(c.n, 0) as n_links, least(e.vec_id, coalesce(l.other, e.vec_id)) as component_id,
    e.vec_id = least(e.vec_id, coalesce(l.other, e.vec_id)) as kept
from embeddings e left join counts c on c.u = e.vec_id left join least l on l.node = e.vec_id
"""

SUBSTRING_DEDUP = f"""
with {_WORDS}, places as (
    select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i, len(w) as n, w from words
), windows as (
    select doc_id, i, case when i + 19 <= n then array_to_string(w[i:i + 19], ' ') end as run, word from places
), judged as (
    select doc_id, i, word, run is not null and row_number() over (partition by run order by doc_id, i) > 1 as again from windows
), covered as (
    select doc_id, i, word, count(*) filter (again) over (partition by doc_id order by i rows between 19 preceding and current row) > 0 as gone from judged
), kept as (
    select doc_id, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as text from covered group by doc_id
)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(k.n_removed, 0) as n_removed, sha256(coalesce(k.text, '')) as kept_sha256
from words d left join kept k on k.doc_id = d.doc_id
"""


def _fences(min_docs: int = 100) -> str:
    """SQL of the fences of each group, by sorted values instead of sketches; ``v`` is cut to eleven leading bits from 20,000 on."""
    slack = {"symbol_ratio": 150, "dup_line_ratio": 200, "repeat_ratio": 150, "word_length": 3000}
    groups = {0: ("lang", "source"), 1: ("lang",), 2: ()}
    out = []
    for level, by in groups.items():
        for name, least in slack.items():
            cut = f"case when {name} < 20000 then {name} else (({name} >> (len(bin({name})) - 11)::int) + 1 << (len(bin({name})) - 11)::int) - 1 end"
            over = f"partition by {', '.join(by)}" if by else ""
            out.append(f"""
    select {level} as level, {'lang' if level < 2 else 'null'} as lang, {'source' if not level else 'null'} as source, '{name}' as metric, any_value(docs) as docs,
        min(v) filter (100 * k >= 90 * docs) + greatest(3 * (min(v) filter (100 * k >= 90 * docs) - min(v) filter (100 * k >= 50 * docs)), {least}) as most
    from (select lang, source, v, row_number() over ({over} order by v) as k, count(*) over ({over}) as docs from (select lang, source, {cut} as v from ratios where not base_failed))
    {'group by ' + ', '.join(by) if by else 'having count(*) > 0'}""")
    return "marks as (" + "\n    union all".join(out) + f"\n), fences as (select * from marks where level = 2 or docs >= {min_docs})"


_RATIOS = ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "word_length")


def _joins() -> str:
    out = ""
    for level, on in ((0, "f.lang is not distinct from r.lang and f.source is not distinct from r.source"), (1, "f.lang is not distinct from r.lang"), (2, "true")):
        out += f"\nleft join (select lang, source, {', '.join(f'max(most) filter (metric = $${m}$$) as {m}' for m in _RATIOS)} from fences where level = {level} group by lang, source) f{level} on {on.replace('f.', f'f{level}.')}"
    return out


QUALITY_RULES = f"""
with {_WORDS}, base as (
    select d.doc_id, d.lang, d.source, w, coalesce(d.text, '') as t, list_filter(string_split(coalesce(d.text, ''), chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> '') as lines
    from documents d join words using (doc_id)
), windows as (
    select doc_id, i, count(*) over (partition by doc_id, run) > 1 as twice
    from (select doc_id, unnest(range(1, len(w) - 6)) as i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) as run from words where len(w) >= 8)
), covered as (
    select doc_id, count(distinct place) as n from (select doc_id, unnest(range(i, i + 8)) as place from windows where twice) group by doc_id
), counts as (
    select b.doc_id, lang, source, cast(len(w) as bigint) as n_words, cast(len(array_to_string(w, '')) as bigint) as word_chars,
        cast(len(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
        coalesce(c.n, 0) as n_repeat_words, len(lines) as n_lines
    from base b left join covered c on c.doc_id = b.doc_id
), ratios as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
        case when word_chars > 0 then 1000 * n_symbols // word_chars else 0 end as symbol_ratio, case when n_lines > 0 then 1000 * n_dup_lines // n_lines else 0 end as dup_line_ratio,
        case when n_words > 0 then 1000 * n_repeat_words // n_words else 0 end as repeat_ratio, case when n_words > 0 then 1000 * word_chars // n_words else 0 end as word_length
    from counts
), {_fences()}
select r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed {' '.join(f"and coalesce(r.{m} <= case when f0.{_RATIOS[0]} is not null then f0.{m} when f1.{_RATIOS[0]} is not null then f1.{m} else f2.{m} end, true)" for m in _RATIOS)} as kept,
    {', '.join('r.' + m for m in _RATIOS)}
from ratios r {_joins()}
""".replace("$$", "'")


LINE_DEDUP = """
with lines as (
    select doc_id, line, i, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from (
        select doc_id, unnest(l) as line, unnest(range(1, len(l) + 1)) as i from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents))
), common as (
    select k, max(doc_id) as keeper from lines where length(k) >= 40 group by k having count(distinct doc_id) >= 5
), judged as (
    select doc_id, i, line, c.k is not null and doc_id <> keeper as gone from lines l left join common c on c.k = l.k
)
select doc_id, cast(count(*) as bigint) as n_lines, cast(count(*) filter (gone) as bigint) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""


def _crc32(text: str) -> str:
    """SQL of the CRC-32 of an ASCII text, bit by bit."""
    step = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split({text}, ''), lambda z: cast(ascii(z) as bigint))), lambda c, b: {step}), 4294967295)"


def _tree(name: str, key: str, levels: int) -> str:
    """SQL of the levels of trees from <name>0 (key, pos, d, n), and of the siblings of their nodes."""
    out = []
    for k in range(levels):
        out.append(f"""{name}{k + 1} as (
    select {key}, pos // 8 as pos, case when any_value(n) = 1 then any_value(d) else sha256(string_agg(d, '' order by pos)) end as d, (any_value(n) + 7) // 8 as n from {name}{k} group by {key}, pos // 8
), {name}s{k} as (
    select a.{key}, a.pos, a.n, coalesce(string_agg(b.d, '' order by b.pos) filter (b.pos < a.pos), '') as before, coalesce(string_agg(b.d, '' order by b.pos) filter (b.pos > a.pos), '') as after
    from {name}{k} a join {name}{k} b on a.{key} = b.{key} and a.pos // 8 = b.pos // 8 group by all
)""")
    return ", ".join(out)


def _merkle(depth: int = 8, top: int = 4) -> str:
    """For at most 8 ** depth rows in a lang and 8 ** top langs."""
    cell = lambda c, v: f"case when {c} is null then '-' else strlen(cast({v} as varchar)) || ':' || cast({v} as varchar) end"
    leaf = lambda text: f"sha256({' || '.join(cell(c, text if c == 'text' else c) for c in ('doc_id', 'source', 'lang', 'n_chars', 'text'))})"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ways = [(f"ts{k}", "tree", "l.tree", f"l.pos // {8**k}") for k in range(depth)] + [(f"us{k}", "tree", "0", f"p.pos // {8**k}") for k in range(top)]
    joins = " ".join(f"join {s} w{i} on w{i}.{key} = {tree} and w{i}.pos = {pos}" for i, (s, key, tree, pos) in enumerate(ways))
    steps = ", ".join(f"f{i + 1} as (select * exclude (f), case when n{i} = 1 then f else sha256(b{i} || f || a{i}) end as f from f{i})" for i in range(len(ways)))
    return f"""
with leaves as (
    select doc_id, case when lang is null then '' else '=' || lang end as tree, {leaf('text')} as d, case when doc_id is not null and {_crc32('cast(doc_id as varchar)')} % 3 = 0 then {leaf(lower)} else {leaf('text')} end as claimed from documents
), t0 as (select *, row_number() over (partition by tree order by doc_id nulls first, d) - 1 as pos, count(*) over (partition by tree) as n from leaves
), {_tree('t', 'tree', depth)}, u0 as (select 0 as tree, tree as lang, row_number() over (order by tree) - 1 as pos, d, count(*) over () as n from t{depth}
), {_tree('u', 'tree', top)}, f0 as (
    select l.doc_id, l.d as leaf, p.d as subroot, (select d from u{top}) as root, l.claimed as f, sha256({' || '.join(f'w{i}.before || w{i}.after' for i in range(len(ways)))}) as proof_sha256,
        {', '.join(f'w{i}.n as n{i}, w{i}.before as b{i}, w{i}.after as a{i}' for i in range(len(ways)))}
    from t0 l join u0 p on p.lang = l.tree {joins}
), {steps}
select doc_id, leaf, subroot, root, proof_sha256, f as folded_root, f = root as verified from f{len(ways)}
"""


MERKLE_MANIFEST = _merkle()
