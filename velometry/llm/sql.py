"""The queries of this folder as DuckDB SQL, written independently of Spark.

Left out: named data spans (4), BPE (5), XXH64 fingerprints (9), edit matching (7) and
the language model (10), which SQL has no functions for; tests compare those with
brute-force versions.
"""

from __future__ import annotations

from velometry.llm.queries import RULES, TRICKY_ID, TRICKY_TEXT
from velometry.llm.repetition import RepetitionRules
from velometry.llm.url_filter import wide_vocabulary

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_CHAT = f"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
    from conversations
    union all select {TRICKY_ID}, 0, 'user', '{TRICKY_TEXT}'
    union all select {TRICKY_ID}, 1, 'assistant', '{TRICKY_TEXT}'
), steps as (
    select *, lag(role, 1, 'start') over w as before,
           lead(role) over w as after
    from rows window w as (partition by conv_id order by turn, role, text)
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text))
           as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text)
           filter (role = 'assistant'), '')) as loss_sha256,
       cast(sum(length('### ' || role || ': </turn>' || chr(10)) + length(text)
           + length(regexp_replace(text, '[^\\\\#<]', '', 'g'))) as bigint) as formatted_chars,
       bool_and((before, role) in (('start', 'system'), ('start', 'user'), ('system', 'user'),
                                   ('user', 'assistant'), ('assistant', 'user'))
                and (after is not null or role = 'assistant')) as valid
from steps group by conv_id
"""


def _url_filter() -> str:
    vocabulary = wide_vocabulary()

    def hit(term: str) -> str:
        return f"cast(regexp_matches(low, '(^|[^a-z0-9]){term}($|[^a-z0-9])') as bigint)"

    def hits(term: str) -> str:
        # A neighbour may stand between two terms, so it is doubled before the count.
        doubled = "regexp_replace(low, '([^a-z0-9])', '\\1\\1', 'g')"
        return f"len(regexp_extract_all({doubled}, '(^|[^a-z0-9]){term}($|[^a-z0-9])'))"

    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)
    strict = " + ".join(map(hits, vocabulary.strict))
    soft = " + ".join(map(hit, vocabulary.soft))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    with parts as (
        select page_id, translate(coalesce(url, ''), '{upper}', '{upper.lower()}') as low,
               translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                         '{upper}', '{upper.lower()}') as host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
        from pages
    ), counted as (
        select *, cast({strict} as bigint) as n_strict, {soft} as n_soft from parts
    ), rules(act, rule_host, rule_path) as (values {rules})
    select page_id, host, path,
           (select arg_max(rule_host || rule_path, length(rule_host || rule_path)) from rules
            where (host = rule_host or ends_with(host, '.' || rule_host))
              and starts_with(path, rule_path)) as rule,
           coalesce((select arg_max(act, length(rule_host || rule_path)) from rules
            where (host = rule_host or ends_with(host, '.' || rule_host))
              and starts_with(path, rule_path)),
            case when n_strict > 0 or n_soft >= {vocabulary.soft_limit} then 'block'
                 else 'allow' end) as verdict,
           n_strict, n_soft
    from counted
    """


_WARC = """
with rows as (
    select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages
), last as (select html, max(page_id) as last from rows group by html),
digits as (
    select rows.*, last.last,
           list_transform(range(8), lambda g: cast('0x' || substr(hex, 1 + 5 * g, 5) as bigint)) as v
    from rows join last using (html)
)
select page_id, octet_length(encode(html)) as payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + cast((v[1 + i // 4] >> (15 - 5 * (i % 4))) & 31 as int), 1)), '') as payload_digest,
       case when page_id = last then 'response' else 'revisit' end as record_type,
       case when page_id <> last then last end as refers_to,
       cast(null as varchar) as problem
from digits
"""


def _quality() -> str:
    r = RepetitionRules()

    def cover(size: int) -> str:
        """Words inside windows of ``size`` words that a document has twice or more."""
        return f"""
        select doc_id, count(distinct place) as n from (
            select doc_id, unnest(range(i, i + {size})) as place from (
                select doc_id, i, count(*) over (partition by doc_id, w) as copies from (
                    select doc_id, i, array_to_string(words[i : i + {size - 1}], ' ') as w
                    from (select doc_id, words, unnest(range(1, n_words - {size} + 2)) as i
                          from base where n_words >= {size})))
            where copies > 1)
        group by doc_id"""

    # A repeat of more words is a run of equal windows at the same distance.
    least = min(r.window_words, r.least_words)
    return f"""
    with base as materialized (
        select doc_id, coalesce(text, '') as text, {_WORDS} as words, len({_WORDS}) as n_words
        from documents
    ), repeated as materialized ({cover(r.window_words)}),
    spans as materialized ({cover(r.least_words)}),
    starts as materialized (
        select doc_id, i, array_to_string(words[i : i + {least - 1}], ' ') as w
        from (select doc_id, words, unnest(range(1, n_words - {least} + 2)) as i
              from base where n_words >= {least})
    ), pairs as (
        select x.doc_id, x.i, y.i - x.i as apart
        from starts x join starts y on x.doc_id = y.doc_id and x.w = y.w and x.i < y.i
    ), runs as (
        select doc_id, apart, i - row_number() over (partition by doc_id, apart order by i) as run
        from pairs
    ), longest as (
        select doc_id, max(n) + {least - 1} as n
        from (select doc_id, count(*) as n from runs group by doc_id, apart, run) group by doc_id
    )
    select doc_id, cast(n_words as bigint) as n_words,
           cast(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as bigint)
               as word_chars,
           cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
           cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
           coalesce(repeated.n, 0) as n_repeat_words,
           coalesce(spans.n, 0) as n_covered_words,
           cast(coalesce(longest.n, 0) as bigint) as longest_repeat,
           n_words < {r.fewest_words}
               or 100 * coalesce(repeated.n, 0) > {r.window_percent} * n_words as base_failed,
           not (n_words < {r.fewest_words}
               or 100 * coalesce(repeated.n, 0) > {r.window_percent} * n_words)
               and 100 * coalesce(spans.n, 0) <= {r.covered_percent} * n_words
               and coalesce(longest.n, 0) <= {r.longest_words} as kept
    from (select *, list_filter(string_split(text, chr(10)),
                 lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from base)
    left join repeated using (doc_id) left join spans using (doc_id)
    left join longest using (doc_id)
    """


def crc32(text: str) -> str:
    """The unsigned CRC-32 of ASCII text, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda c: cast(ascii(c) as bigint))"
    bit = "lambda x, y: if(x & 1 = 1, xor(x >> 1, 3988292384), x >> 1)"
    byte = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], {bit})"
    start = f"list_prepend(4294967295::bigint, {codes})"
    return f"xor(list_reduce({start}, lambda c, b: {byte}), 4294967295)"


def _tree(name: str, group: str, levels: int) -> str:
    """CTEs of the levels over ``{name}0`` (group, i from 0, digest).

    ``{name}Ns`` has what stands before and after each node of level N; only groups with
    several nodes have rows there, and ``{name}`` has each group's top.
    """
    steps = []
    for n in range(levels):
        steps.append(
            f"""{name}{n}c as (select *, count(*) over (partition by {group}) as size from {name}{n}),
            {name}{n}r as (
                select {group}, i // 16 as run, list(digest order by i) as d
                from {name}{n}c where size > 1 group by all
            ), {name}{n}s as (
                select c.{group}, c.i, array_to_string(d[:i % 16], '') as before,
                       array_to_string(d[i % 16 + 2:], '') as after
                from {name}{n}c c join {name}{n}r r
                  on c.{group} is not distinct from r.{group} and c.i // 16 = r.run
            ), {name}{n + 1} as (
                select {group}, run as i, sha256(array_to_string(d, '')) as digest from {name}{n}r
                union all select {group}, i, digest from {name}{n}c where size = 1
            )"""
        )
    top = f"{name} as (select {group}, digest from {name}{levels})"
    return ", ".join([*steps, top])


def _merkle(levels: int = 7, source_levels: int = 5) -> str:
    """Enough levels for 268 million leaves of a source and a million sources."""

    def leaf(text: str) -> str:
        cells = ["doc_id", "source", "lang", "n_chars", text]
        return " || ".join(
            f"coalesce(octet_length(encode(cast({c} as varchar))) || ':' || {c}, '-')" for c in cells
        )

    joins, proof, fold = [], [], "shown"
    chain = [("s", n, f"p.source is not distinct from s{n}s.source and s{n}s.i = p.i // {16**n}")
             for n in range(levels)]
    chain += [("t", n, f"t{n}s.i = g.i // {16**n}") for n in range(source_levels)]
    for name, n, on in chain:
        joins.append(f"left join {name}{n}s on {on}")
        here = f"{name}{n}s"
        proof.append(f"coalesce({here}.before || {here}.after, '')")
        fold = f"if({here}.i is null, {fold}, sha256({here}.before || {fold} || {here}.after))"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
with leaves as (
    select doc_id, source, sha256({leaf("text")}) as leaf,
           if(coalesce({crc32("cast(doc_id as varchar)")} % 5 = 0, false),
              sha256({leaf(lower)}), sha256({leaf("text")})) as shown
    from documents
), placed as (
    select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i
    from leaves
), s0 as (select source, i, leaf as digest from placed),
{_tree("s", "source", levels)},
groups as (
    select source, digest, row_number() over (order by source nulls first) - 1 as i from s
), t0 as (select 0 as one, i, digest from groups),
{_tree("t", "one", source_levels)},
folded as (
    select p.doc_id, p.leaf, g.digest as subroot, t.digest as root,
           sha256({" || ".join(proof)}) as proof_sha256, {fold} as folded_root
    from placed p join groups g on p.source is not distinct from g.source cross join t
    {" ".join(joins)}
)
select *, folded_root = root as verified from folded
"""


_NEGATIVES = """
with named as (
    select vec_id, if(vec_id % 7 = 0, (label + 1) % 10, label) as label,
           list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same,
           (select cast(sum(x * y) as bigint)
            from (select unnest(a.v) as x, unnest(r.v) as y)) as score
    from named a join named r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id
), positives as (
    select anchor_id, id, score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select p.anchor_id, p.id as positive_id,
       cast(row_number() over (partition by p.anchor_id, p.id order by n.score desc, n.id) as int)
           as rank,
       n.id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scored n
  on p.anchor_id = n.anchor_id and not n.same
 and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
qualify rank <= 10
"""


def all_sql() -> dict[str, str]:
    return {
        "op1_chat_format": _CHAT,
        "op2_url_filter": _url_filter(),
        "op3_warc": _WARC,
        "op8_quality_rules": _quality(),
        "op12_hard_negatives": _NEGATIVES,
        "op13_merkle": _merkle(),
    }
